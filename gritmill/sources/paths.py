"""Small files of the driver on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _on(spark, path)
    return system.exists(target)


def put(spark: SparkSession, path: str, content: str | bytes) -> None:
    """Writes a file; it appears whole or not at all."""
    target, system = _on(spark, path)
    part, _ = _on(spark, f"{path}.part")
    stream = system.create(part, True)
    stream.write(bytearray(content.encode() if isinstance(content, str) else content))
    stream.close()
    if system.exists(target):
        system.delete(target, False)
    system.rename(part, target)


def local(path: str) -> str:
    """The path without a ``file:`` scheme."""
    return path.split(":", 1)[-1].replace("//", "/") if path.startswith("file:") else path

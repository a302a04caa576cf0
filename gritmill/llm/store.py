"""Intermediate tables in the shared folder: columnar, pruned and compressed, unlike a checkpoint of rows."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame

from gritmill.session import ensure_checkpoint_dir

_written: list[tuple[object, str]] = []


def clear_saved() -> list[str]:
    """Removes all tables written so far, once their results are no longer read; returns the paths that could not be removed.

    A long-lived driver calls it between jobs; it is called when the driver ends.
    """
    failed = []
    for jvm, path in _written:
        try:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone, then the folder's owner clears it
            failed.append(path)
    _written.clear()
    return failed


atexit.register(clear_saved)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the folder of spark.checkpoint.dir and read again; removed when the driver ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark.sparkContext._jvm, path))
    return spark.read.schema(df.schema).parquet(path)

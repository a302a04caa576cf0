"""Session settings, table loading and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("gritmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small tables in tests and benchmarks keep all cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; make a local one only where it is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "gritmill-checkpoints")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder; it survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

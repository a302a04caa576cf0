"""Incremental counterparts: windowed counts of events, first-wins content, sessions. Each equals its batch form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions.hashing import content_key


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total) per tumbling window; on a stream, rows later than ``late`` are dropped by the watermark."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    counts = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n) of runs of events of a user without a longer gap."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    counts = rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return counts.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_contents(records: DataFrame, text: str, at: str | None = None, late: str = "1 day") -> DataFrame:
    """The first record of each content as records arrive.

    Without ``at`` the state holds one key per content for ever; with a column of event times only those of the last ``late``, so
    repeated contents are dropped within that time.
    """
    keyed = records.withColumn("dedup_hash", content_key(text)).where("dedup_hash is not null")
    if at is not None and records.isStreaming:
        return keyed.withWatermark(at, late).dropDuplicatesWithinWatermark(["dedup_hash"])
    return keyed.dropDuplicates(["dedup_hash"])


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Rows of JSON lines files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def answer_stream(gold: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "record_id"):
    """Answers rows as they arrive and appends them to ``out``; returns the query.

    A row that has an answer is passed over, and each batch has a folder of its own that is written whole: a batch that is run again
    after a failure replaces its own rows and adds none.
    """

    def step(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(out)
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        fresh = rows.dropDuplicates([key])
        if there:
            done = spark.read.option("basePath", out).schema(f"{key} string, batch long").json(out).where(F.col("batch") != batch)
            fresh = fresh.join(done.select(key).distinct(), key, "left_anti")
        answer(fresh).write.mode("overwrite").json(f"{out}/batch={batch}")

    return gold.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

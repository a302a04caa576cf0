"""Sinks: tables by format, capped silver tables, per-split JSON lines, appended predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.operators import validate


class RowCapExceeded(ValueError):
    pass


def write_table(df: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """parquet, json (nulls kept, one object per line), csv or csv.gz (header, quotes doubled)."""
    writer = df.write.mode(mode)
    if kind == "parquet":
        writer.parquet(path)
    elif kind in ("json", "jsonl"):
        writer.option("ignoreNullFields", False).json(path)
    elif kind in ("csv", "csv.gz"):
        writer.options(header=True, escape='"', compression="gzip" if kind == "csv.gz" else "none").csv(path)
    else:
        raise ValueError(f"no sink for {kind}")


def write_benchmark(df: DataFrame, path: str, manifest: dict, kinds: tuple[str, ...] = ("csv", "parquet")) -> None:
    """A benchmark table as CSV and/or Parquet with its manifest beside."""
    for kind in kinds:
        write_table(df if kind == "parquet" else columnar(df), f"{path}/{kind}", kind)
    log_event(df.sparkSession, f"{path}/manifest", manifest, "overwrite")


def log_event(spark, path: str, event: dict, mode: str = "append") -> None:
    """One JSON line more in a log of events, errors or runs; keys are sorted."""
    import json

    spark.createDataFrame([(json.dumps(event, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode(mode).text(path)


def columnar(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks without them; keys of maps are sorted."""
    ordered = {c: F.map_from_entries(F.array_sort(F.map_entries(c))) for c, kind in df.dtypes if kind.startswith("map")}
    df = df.withColumns(ordered) if ordered else df
    nested = [c for c, kind in df.dtypes if kind.startswith(("array", "struct", "map"))]
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "true"}) for c in nested})


def write_silver(df: DataFrame, path: str, most: int = 50_000, checked: bool = False) -> int:
    """Parquet and gzipped CSV of a silver table of at most ``most`` rows and, with ``checked``, without issues; nothing is written else."""
    n = df.limit(most + 1).count()
    if n > most:
        raise RowCapExceeded(f"more than {most} rows")
    if checked:
        validate.assert_valid(validate.silver_issues(df))
    write_table(df, f"{path}/parquet", "parquet")
    write_table(columnar(df), f"{path}/csv", "csv.gz")
    return n


def write_splits(df: DataFrame, path: str) -> None:
    """One folder of JSON lines per split."""
    df.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(path)


def append_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)

"""Exact ranks within groups of any size, without one task per group.

A group's order is by a coarse key first and by the md5 of the identifier last, so the leading hex digits of the md5 split a group
of equal keys into pieces (salts) that follow each other in the order. Each piece is ranked by itself and gets the number of rows
before it from aggregated counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def salted_rank(df: DataFrame, group: str, key: str | None, identifier: str, hex_digits: int = 3, seed: str = "") -> DataFrame:
    """Adds ``rank`` (from 1) and ``group_rows`` within ``group``, by ``key`` descending, then md5 of seed and identifier, then identifier.

    ``key`` is an integer column of few distinct values per group. Ties of all three are broken arbitrarily but each row gets a
    rank of its own. A null group is a group. With h hex digits the largest task holds 1/16**h of the rows of one group and key.
    """
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(identifier).cast("string"), F.lit(""))))
    rows = df.withColumn("__gm_md5", digest).withColumn("__gm_salt", F.substring("__gm_md5", 1, hex_digits))
    rows = rows.withColumn("__gm_key", F.col(key).cast("long") if key else F.lit(0).cast("long")).withColumn("__gm_group", F.coalesce(F.concat(F.lit("="), group), F.lit("")))
    piece = ["__gm_group", "__gm_key", "__gm_salt"]
    counts = rows.groupBy(*piece).agg(F.count("*").alias("__gm_n"))
    within_key = Window.partitionBy("__gm_group", "__gm_key").orderBy("__gm_salt").rowsBetween(Window.unboundedPreceding, -1)
    keys = counts.groupBy("__gm_group", "__gm_key").agg(F.sum("__gm_n").alias("__gm_kn"))
    over_keys = Window.partitionBy("__gm_group").orderBy(F.col("__gm_key").desc()).rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("__gm_before", F.coalesce(F.sum("__gm_kn").over(over_keys), F.lit(0))).withColumn("group_rows", F.sum("__gm_kn").over(Window.partitionBy("__gm_group")))
    starts = counts.withColumn("__gm_in", F.coalesce(F.sum("__gm_n").over(within_key), F.lit(0))).join(keys, ["__gm_group", "__gm_key"])
    starts = starts.select(*piece, (F.col("__gm_in") + F.col("__gm_before")).alias("__gm_start"), "group_rows")
    local = F.row_number().over(Window.partitionBy(*piece).orderBy("__gm_md5", F.col(identifier)))
    ranked = rows.withColumn("__gm_local", local).join(starts, piece)
    return ranked.withColumn("rank", F.col("__gm_start") + F.col("__gm_local")).drop(*piece, "__gm_md5", "__gm_local", "__gm_start")

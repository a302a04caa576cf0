"""First-wins duplicates, without a window over groups that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: str, order: list[str], among: Column | None = None) -> DataFrame:
    """Of the rows with equal ``key`` the first in ``order``; rows with a null key all stay, but for rows equal in ``order`` too.

    Rows for which ``among`` isn't true neither stay nor win. It is part of the aggregation, not a filter, since a filter would be
    pushed below the projection and compute its expressions twice. A minimum by the order, combined on the map side, so a key that a third of the rows share meets as few rows as there are tasks.
    """
    place = F.struct(*order)
    alone = F.when(F.col(key).isNull(), place)
    entry = place if among is None else F.when(among, place)
    rows = df.groupBy(F.col(key).alias("__gm_key"), alone.alias("__gm_alone")).agg(F.min_by(F.struct(*df.columns), entry).alias("__gm_row"))
    return rows.where("__gm_row is not null").select("__gm_row.*")


def once(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first delivery of each key by ``order``. The literal rank lets Spark keep one row per key and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last()))
    return df.withColumn("__gm_rank", rank).where("__gm_rank = 1").drop("__gm_rank")


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """One row: distinct repeated keys, rows beyond the first, and the smallest 20 repeated keys joined by ``|``."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    smallest = counts.orderBy(key).limit(20).agg(F.array_join(F.array_sort(F.collect_list(key)), "|").alias("sample_keys"))
    totals = counts.agg(F.count("*").alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"))
    return totals.join(F.broadcast(smallest))  # one row each


def duplicate_groups(df: DataFrame, key: str, member: str) -> DataFrame:
    """(key, members, first_member) of every key with more than one distinct member."""
    return df.where(F.col(key).isNotNull()).select(key, member).distinct().groupBy(key).agg(F.count("*").alias("members"), F.min(member).alias("first_member")).where("members > 1")

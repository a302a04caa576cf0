"""Capping records per dominant contributor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import clean_source
from gritmill.llm.ranking import salted_rank
from gritmill.llm.store import saved


def quality_key(score: Column) -> Column:
    """Scores have four decimals, so 0..10000 keeps their order; null, NaN and what lies outside 0..1 is worse than any score: -1."""
    return F.coalesce(F.when(score.between(0, 1), F.round(score * 10_000).cast("long")), F.lit(-1).cast("long"))


def rank_contributors(df: DataFrame, contributor: Column, identifier: str, score: str, percent: int, max_count: int | None = None) -> DataFrame:
    """(identifier, contributor, score, rank, group_rows, allowed) of each distinct identifier of ``df``.

    ``allowed`` is the limit of a contributor: ``percent`` of all distinct identifiers, rounded down, and at most ``max_count``. Ranks
    go by quality, then by md5 of the identifier. A repeated identifier counts once, with its best score. Rows without an identifier
    or a contributor (null or empty after cleaning) can't be attributed: their contributor is null and never limited.
    """
    narrow = df.select(F.col(identifier).alias("identifier"), contributor.alias("contributor"), F.col(score).alias("score"))
    once = narrow.where("identifier is not null").groupBy("identifier").agg(F.min("contributor").alias("contributor"), F.max(F.struct(quality_key(F.col("score")).alias("key"), F.col("score").alias("score"))).alias("best"))
    # counts, ranks and the total need the narrow rows; the table itself is read once
    rows = saved(once.select("identifier", "contributor", "best.key", "best.score"))
    allowed = rows.count() * percent // 100
    allowed = allowed if max_count is None else min(allowed, max_count)
    ranked = salted_rank(rows, "contributor", "key", "identifier")
    return ranked.withColumn("allowed", F.when(F.col("contributor").isNotNull(), F.lit(allowed).cast("long"))).drop("key")


def cap_contributors(df: DataFrame, contributor: Column, identifier: str, score: str, percent: int, max_count: int | None = None) -> DataFrame:
    """The kept rows of ``rank_contributors``: those ranked within the limit, and all that have no contributor."""
    ranked = rank_contributors(df, contributor, identifier, score, percent, max_count)
    return ranked.where(F.col("allowed").isNull() | (F.col("rank") <= F.col("allowed")))


def cap_report(df: DataFrame, contributor: Column, identifier: str, score: str, percent: int, max_count: int | None = None) -> DataFrame:
    """Rows, kept and dropped rows per contributor."""
    ranked = rank_contributors(df, contributor, identifier, score, percent, max_count)
    kept = F.col("allowed").isNull() | (F.col("rank") <= F.col("allowed"))
    return ranked.groupBy("contributor").agg(
        F.count("*").alias("n_records"), F.count_if(kept).alias("n_kept"), F.count_if(~kept).alias("n_dropped"), F.max("allowed").alias("allowed")
    )


def unified_contributor() -> Column:
    return clean_source("source_id")

"""A sample whose shares match targets, by systematic unequal-probability sampling."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import clean_category
from gritmill.llm.ranking import salted_rank

MAX_BROADCAST_TARGETS = 100_000


def _key(dimension: Column, category: Column) -> Column:
    """Categories of different dimensions are different groups."""
    return F.concat(dimension, F.lit("\x01"), category)


def population(df: DataFrame, identifier: str, categories: dict[str, str]) -> DataFrame:
    """(identifier, key) of each distinct identifier and dimension; ``categories`` names the column of each dimension.

    Rows without an identifier or a category can't be sampled.
    """
    rows = df.select(F.col(identifier).cast("string").alias("identifier"), *[clean_category(c).alias(f"__gm_{i}") for i, c in enumerate(categories.values())])
    once = rows.where("identifier is not null").groupBy("identifier").agg(*[F.min(f"__gm_{i}").alias(f"__gm_{i}") for i in range(len(categories))])
    keys = F.array_compact(F.array(*[_key(F.lit(d), F.col(f"__gm_{i}")) for i, d in enumerate(categories)]))
    return once.select("identifier", F.explode(keys).alias("key"))


_PLAN = "key string, target_id long, dimension string, category string, wanted double, floor_rows long, available long, p double, base double, final long"


def _plan_dimension(rows: pd.DataFrame, start: float) -> pd.DataFrame:
    """Inclusion probabilities, running sums and final sizes of the targets of one dimension.

    Where a category has fewer rows than wanted, the others take its part in proportion to what they want. After the draw, whose
    sizes follow from the running sums, categories below their floor get rows and those with most rows beyond theirs give as many.
    """
    rows = rows.sort_values("key").reset_index(drop=True)
    wanted, have = rows["wanted"].fillna(0).clip(lower=0).to_numpy(float), rows["available"].to_numpy(float)
    size, scale = wanted.sum(), 1.0
    # the scarcest categories are used up first; the scale is what the rest needs
    by_need = sorted(range(len(rows)), key=lambda i: (have[i] / wanted[i] if wanted[i] > 0 else np.inf, rows["key"][i]))
    used, rest = 0.0, size
    for i in by_need:
        scale = (size - used) / rest if rest > 1e-9 else np.inf
        if wanted[i] <= 0 or scale * wanted[i] <= have[i]:
            break
        used, rest = used + have[i], rest - wanted[i]
    else:
        scale = np.inf
    scaled = np.array([0.0 if w <= 0 else min(h, scale * w) for w, h in zip(wanted, have)])
    p = np.array([x / h if h > 0 else 0.0 for x, h in zip(scaled, have)])
    base = start + np.concatenate([[0.0], np.cumsum(p * have)[:-1]])
    drawn = np.floor(np.round(base + have * p, 9)) - np.floor(np.round(base, 9))
    floor = np.minimum(rows["floor_rows"].to_numpy(float), have)
    final = np.maximum(drawn, floor)
    missing = float((final - drawn).sum())
    # whole categories give nothing, so that what is reported as unmet was all drawn
    room = np.where(have > drawn, drawn - floor, 0.0)
    for i in sorted(range(len(rows)), key=lambda i: (-room[i], rows["key"][i])):
        give = min(max(0.0, room[i]), missing)
        final[i] -= give
        missing -= give
    return rows.assign(p=p, base=base, final=final.astype("int64"))[[c.split()[0] for c in _PLAN.split(", ")]]


def draw(people: DataFrame, targets: DataFrame, seed: str = "42") -> DataFrame:
    """Ranked rows of the target categories with ``selected``, ``by_floor`` and their target.

    Dimensions are sampled apart, all in one pass. Within a category every row has the inclusion probability share * size / rows, with
    the parts of short categories spread over the others. Categories follow each other sorted, rows within them in random order (md5 of
    seed and identifier), and a row is drawn where the running sum of probabilities, after one random start, passes a whole number.
    Then floors are repaired in the same order, at the cost of the largest categories, so the size stays.
    """
    wanted = targets.select("target_id", "dimension", "category", _key(F.col("dimension"), clean_category("category")).alias("key"), (F.col("target_share") * F.col("sample_size")).alias("wanted"), F.coalesce("min_rows", F.lit(0)).alias("floor_rows"))
    wanted = wanted.where("key is not null").groupBy("key").agg(F.min(F.struct("target_id", "dimension", "category", "wanted", "floor_rows")).alias("t")).select("key", "t.*")
    sizes = people.groupBy("key").agg(F.count("*").alias("available"))
    sizes = wanted.join(sizes, "key", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    start = int(hashlib.sha1(seed.encode()).hexdigest()[:8], 16) / 4294967296.0
    # a dimension's targets are a list that somebody wrote
    plan = sizes.groupBy("dimension").applyInPandas(lambda rows: _plan_dimension(rows, start), _PLAN)
    # one row per target, so the targets' number, which is cheap to count, bounds it
    plan = F.broadcast(plan) if targets.limit(MAX_BROADCAST_TARGETS + 1).count() <= MAX_BROADCAST_TARGETS else plan
    ranked = salted_rank(people, "key", None, "identifier", seed=seed).drop("group_rows").join(plan, "key")
    # sums rounded to 9 digits, so that a mass that is a whole number crosses as often as it says
    at = lambda n: F.floor(F.round(F.col("base") + n * F.col("p"), 9)) - F.floor(F.round("base", 9))
    ranked = ranked.withColumns({"__gm_before": at(F.col("rank") - 1), "__gm_until": at(F.col("rank")), "__gm_drawn": at(F.col("available"))})
    crossed = F.col("__gm_until") > F.col("__gm_before")
    by_floor = ~crossed & (F.col("rank") - 1 - F.col("__gm_before") < F.col("final") - F.col("__gm_drawn"))
    ranked = ranked.withColumn("by_floor", by_floor).withColumn("selected", F.col("by_floor") | (crossed & (F.col("__gm_until") <= F.col("final"))))
    return ranked.drop("__gm_before", "__gm_until", "__gm_drawn", "base", "rank")


def sample(people: DataFrame, targets: DataFrame, seed: str = "42") -> DataFrame:
    return draw(people, targets, seed).where("selected").select("dimension", "identifier", "category", "by_floor")


def report(people: DataFrame, targets: DataFrame, seed: str = "42") -> DataFrame:
    """A row per target: wanted, available, selected and from_floor of the draw.

    ``capped``: all its rows were drawn and are fewer than wanted; ``below_floor``: fewer than the floor were drawn.
    """
    got = draw(people, targets, seed).groupBy("key").agg(F.count("*").alias("available"), F.count_if("selected").alias("selected"), F.count_if("by_floor").alias("from_floor"))
    rows = targets.withColumn("key", _key(F.col("dimension"), clean_category("category"))).join(got, "key", "left")
    counted = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("available", "selected", "from_floor")}
    wanted = F.col("target_share") * F.col("sample_size")
    return rows.withColumns(counted).select(
        "dimension", "category", "target_share", "min_rows", wanted.alias("wanted"), "available", "selected", "from_floor",
        F.coalesce((F.col("selected") == F.col("available")) & (F.col("selected") < wanted), F.lit(False)).alias("capped"), F.coalesce(F.col("selected") < F.col("min_rows"), F.lit(False)).alias("below_floor"),
    )

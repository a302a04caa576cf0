"""Splits that keep related records together: connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import clean_source, clean_split, cve_ids
from gritmill.session import cut_lineage

MAX_ROUNDS = 60


def unified_entities() -> Column:
    """Sorted distinct entities of a record of gold_unified, as ``kind:key``."""
    source = clean_source("source_id")
    ids = F.transform(cve_ids("cve"), lambda x: F.concat(F.lit("cve:"), x))
    return F.array_sort(F.array_distinct(F.concat(ids, F.when(source.isNotNull(), F.array(F.concat(F.lit("source_id:"), source))).otherwise(F.array().cast("array<string>")))))


def record_entities(df: DataFrame, identifier: str, entities: Column) -> DataFrame:
    """(record, entities) of each distinct identifier, repeated rows merged. Rows without an identifier can't be assigned and are left out."""
    rows = df.select(F.col(identifier).alias("record"), F.coalesce(entities, F.array().cast("array<string>")).alias("e")).where("record is not null")
    # equal repetitions vanish in the partial aggregation
    rows = rows.distinct().groupBy("record").agg(F.flatten(F.collect_list("e")).alias("e"))
    return rows.select("record", F.array_sort(F.array_distinct("e")).alias("entities"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of the edges (a, b); component is the smallest node connected with it.

    Large-star links every larger neighbour of a node to the smallest of its neighbourhood, small-star does so with the smaller
    ones; alternated until nothing changes. Only minima are aggregated per node, never lists of neighbours, so a node with a third
    of all edges is combined on the map side, and its join is split by the skew handling of adaptive execution. Each round is a
    checkpoint in the shared folder. Null ends are ignored.
    """
    stars = cut_lineage(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = stars.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    signature = None
    for _ in range(MAX_ROUNDS):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        stars = cut_lineage(small.select("e.u", "e.v").where("u <> v").distinct())
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == signature:
            break
        signature = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    found = nodes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
    return found.withColumn("component", F.coalesce("component", "node"))


def entity_components(records: DataFrame) -> DataFrame:
    """(entity, component): entities of one record are connected through its first one, so the graph has entities as nodes only."""
    linked = records.where(F.size("entities") > 1).select(F.col("entities")[0].alias("a"), F.explode(F.slice("entities", 2, 1 << 30)).alias("b")).distinct()
    alone = records.select(F.explode("entities").alias("entity")).distinct()
    return alone.join(components(linked).withColumnRenamed("node", "entity"), "entity", "left").withColumn("component", F.coalesce("component", "entity"))


def record_components(records: DataFrame, parts: DataFrame) -> DataFrame:
    """(record, component); a record without entities is a component of its own."""
    keyed = records.withColumn("entity", F.get("entities", F.lit(0)))
    # records without entities must not meet on one null key
    lonely = keyed.where("entity is null").select("record", F.concat(F.lit("record:"), F.col("record").cast("string")).alias("component"))
    return keyed.where("entity is not null").join(parts, "entity").select("record", "component").union(lonely)


def hash_split(component: Column, shares: dict[str, float], seed: str = "42") -> Column:
    """The split whose range of [0, 1) holds the component's hash; shares are taken in their order and should add up to 1."""
    u = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), component), 256), 1, 8), 16, 10).cast("double") / 4294967296.0
    ladder, total, names = F, 0.0, list(shares)
    for name in names[:-1]:
        total += shares[name]
        ladder = ladder.when(u < total, name)
    return ladder.otherwise(names[-1]) if len(names) > 1 else F.lit(names[0])


def assign_splits(df: DataFrame, identifier: str, entities: Column, shares: dict[str, float], seed: str = "42") -> DataFrame:
    """(record, component, split) for each distinct identifier: no entity is in two splits."""
    records = cut_lineage(record_entities(df, identifier, entities))
    return record_components(records, entity_components(records)).withColumn("split", hash_split(F.col("component"), shares, seed))


def split_moves(df: DataFrame, identifier: str, entities: Column, split: Column, shares: dict[str, float], seed: str = "42") -> DataFrame:
    """(group_kind, group_key, component, assigned, splits, records, moves) of every entity that has records with a split.

    ``assigned`` is the split of the entity's component, ``moves`` the records that lie elsewhere now: an entity whose records lie in two
    or more splits has some whatever its component gets. Records without a split don't count, but they connect entities. Repeated rows
    of a record count once per split. Counts are made per entity and split before they meet the components.
    """
    narrow = df.select(F.col(identifier).alias("record"), entities.alias("entities"), split.alias("split")).where("record is not null and size(entities) > 0")
    rows = cut_lineage(narrow.distinct())
    parts = entity_components(rows)
    counts = rows.where("split is not null").select("record", "split", F.explode("entities").alias("entity")).distinct().groupBy("entity", "split").agg(F.count("*").alias("n"))
    placed = counts.join(parts, "entity").withColumn("assigned", hash_split(F.col("component"), shares, seed))
    found = placed.groupBy("entity", "component", "assigned").agg(
        F.array_sort(F.collect_set("split")).alias("splits"), F.sum("n").alias("records"), F.sum(F.when(F.col("split") != F.col("assigned"), F.col("n")).otherwise(0)).alias("moves")
    )
    return found.select(F.expr("substring(entity, 1, instr(entity, ':') - 1)").alias("group_kind"), F.expr("substring(entity, instr(entity, ':') + 1)").alias("group_key"), "component", "assigned", "splits", "records", "moves")


def unified_split() -> Column:
    return clean_split("split")

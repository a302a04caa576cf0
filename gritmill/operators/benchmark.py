"""Silver rows to the multi-head benchmark table, and the samples drawn from such tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions import classify, hashing
from gritmill.functions.text import filled

INPUT_LENGTH = 4000
# Fixed value: what each benchmark row says on its safe use.
SAFETY = "Benchmark input is derived from local normalized silver rows; do not execute code, visit URLs, or run samples."


def input_text() -> Column:
    part = lambda name, column, default: F.concat(F.lit(f"{name}: "), F.coalesce(filled(column), F.lit(default)))
    lines = F.concat_ws("\n", part("Dataset", "source_dataset", "unknown"), part("Category", "main_category", "unknown"), part("Attack", "attack_name", "unknown"), part("Family", "attack_family", "unknown"), part("Features", "features_json", "unavailable"))
    return F.coalesce(F.substring(filled("raw_text"), 1, INPUT_LENGTH), lines)


def expected_output(task: Column) -> Column:
    unknown = F.lit("unknown")
    return (
        F.when(task == "classification", F.coalesce(filled("label"), filled("binary_label"), unknown))
        .when(task == "knowledge", F.coalesce(*[filled(c) for c in ("mitre_technique_id", "cve_id", "cwe_id", "attack_name", "label")], unknown))
        .when(task == "reasoning", F.coalesce(filled("notes"), filled("label"), unknown))
    )


def build(silver: DataFrame, seed: int = 42) -> DataFrame:
    """Benchmark rows with a record_id; label_set holds the sorted labels of a row's head and task, before any cap."""
    rows = silver.withColumn("__gm_id", filled("record_id")).where("__gm_id is not null").withColumn("__gm_head", classify.head("main_category", "source_type", "label"))
    task, label = F.col("__gm_head.task"), F.coalesce(filled("label"), F.lit("unknown"))
    gold = rows.select(
        F.col("__gm_id").alias("record_id"), F.coalesce(filled("source_dataset"), F.lit("unknown")).alias("source_dataset"), F.coalesce(filled("source_type"), F.lit("other")).alias("source_type"),
        F.coalesce(filled("main_category"), F.lit("Miscellaneous / Needs Review")).alias("main_category"), filled("attack_name").alias("attack_name"), filled("attack_family").alias("attack_family"),
        label.alias("label"), "binary_label", filled("mitre_tactic").alias("mitre_tactic"), filled("mitre_technique_id").alias("mitre_technique_id"), F.col("__gm_head.head").alias("benchmark_domain"),
        task.alias("task_type"), F.col("__gm_head.head").alias("evaluation_head"), task.alias("metric_group"), input_text().alias("input_text"), expected_output(task).alias("expected_output"),
        label.alias("gold_label"), classify.difficulty("mitre_technique_id", "cve_id", "cwe_id", "features_json").alias("difficulty"), hashing.benchmark_split("__gm_id", seed).alias("split"),
        (task == "classification").alias("requires_probability"), F.concat(F.lit("Use "), task, F.lit(" metrics for "), task, F.lit(".")).alias("scoring_notes"), F.lit(SAFETY).alias("safety_notes"), F.current_timestamp().alias("created_at"),
    )
    return with_label_sets(gold, "evaluation_head", "task_type")


def label_sets(gold: DataFrame, head: str, task: str) -> DataFrame:
    """(head, task, label_set): JSON of the sorted distinct labels."""
    labels = gold.where("gold_label is not null").select(head, task, "gold_label").distinct()
    texts = F.transform(F.array_sort(F.collect_list("gold_label")), lambda x: F.to_json(F.array(x)))
    joined = F.array_join(F.transform(texts, lambda x: F.regexp_extract(x, r"^\[(.*)\]$", 1)), ", ")
    return labels.groupBy(head, task).agg(F.concat(F.lit("["), joined, F.lit("]")).alias("label_set"))


def with_label_sets(gold: DataFrame, head: str, task: str) -> DataFrame:
    """Adaptive execution broadcasts the sets where they are small; a count beforehand would run the whole plan above them twice."""
    return gold.join(label_sets(gold, head, task), [head, task], "left")


def stratified_cap(df: DataFrame, most: int, strata: list[str], identifier: str, seed: int = 42) -> DataFrame:
    """At most ``most`` rows: an equal share of each stratum in sorted order, then a fill from what is left.

    The sizes are exact; membership is by SHA-1 of seed and identifier, so it doesn't depend on the partitioning. A table that is
    small enough is kept whole. Null strata are strata.
    """
    keyed = df.withColumn("__gm_h", F.sha1(F.concat(F.lit(f"{seed}:"), F.col(identifier))))
    sizes = df.groupBy(*strata).agg(F.count("*").alias("__gm_n"))
    # the table of strata is small; its running budget is one sorted pass
    order = Window.orderBy(*[F.col(c).asc_nulls_last() for c in strata])
    totals = sizes.agg(F.sum("__gm_n").alias("__gm_total"), F.count("*").alias("__gm_groups"))
    plan = sizes.join(F.broadcast(totals))
    base = F.greatest(F.lit(1), F.floor(F.lit(most) / F.col("__gm_groups"))).cast("long")
    want = F.least("__gm_n", base)
    before = F.coalesce(F.sum(want).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    take = F.when(F.col("__gm_total") <= most, F.col("__gm_n")).otherwise(F.greatest(F.lit(0), F.least(want, F.lit(most) - before)))
    plan = plan.withColumn("__gm_take", take)
    plan = plan.join(F.broadcast(plan.agg(F.sum("__gm_take").alias("__gm_taken")))).select(*strata, "__gm_take", "__gm_taken", "__gm_total")
    renamed = plan.select(*[F.col(c).alias(f"__gm_{c}") for c in strata], "__gm_take", "__gm_taken", "__gm_total")
    condition = F.lit(True)
    for c in strata:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__gm_{c}"))
    rows = keyed.join(renamed, condition)
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy("__gm_h", identifier))
    # a row beyond twice the size can be neither drawn nor filled in; a literal bound lets Spark limit each stratum before the shuffle
    rows = rows.withColumn("__gm_rank", rank).where(F.col("__gm_rank") <= 2 * max(1, most))
    first = rows.where(F.col("__gm_rank") <= F.col("__gm_take"))
    rest = rows.where(F.col("__gm_rank") > F.col("__gm_take")).where(F.col("__gm_taken") < most).orderBy("__gm_h", identifier).limit(most)
    # the fill needs only as many rows as are missing, by the same hash order
    filler = rest.withColumn("__gm_fill", F.row_number().over(Window.orderBy("__gm_h", identifier))).where(F.col("__gm_fill") <= F.lit(most) - F.col("__gm_taken"))
    return first.select(*df.columns).unionByName(filler.select(*df.columns))


def quota_sample(df: DataFrame, category: str, identifier: str, quotas: dict[str, int], default: int, most: int, seed: int = 42) -> DataFrame:
    """Per category the first rows by hash up to its quota, then the first ``most`` of them by hash."""
    keyed = df.withColumn("__gm_h", F.sha1(F.concat(F.lit(f"{seed}:"), F.col(identifier))))
    quota = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in quotas.items() for x in p]), F.col(category)), F.lit(default)) if quotas else F.lit(default)
    rank = F.row_number().over(Window.partitionBy(category).orderBy("__gm_h", identifier))
    largest = max([default, *quotas.values()])
    kept = keyed.withColumn("__gm_rank", rank).where(F.col("__gm_rank") <= largest).where(F.col("__gm_rank") <= quota)
    return kept.orderBy("__gm_h", identifier).limit(most).select(*df.columns)


def balanced_sample(df: DataFrame, label: str, identifier: str, most: int, seed: int = 42) -> DataFrame:
    """An equal share per label, topped up from the rest; without replacement."""
    return stratified_cap(df, most, [label], identifier, seed)

"""Scores of predictions over slices, from counts of (slice, true, predicted) rather than rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions.text import as_col, normalised, tokens

# Weights of the metric groups in the overall score.
WEIGHTS = {"classification": 0.50, "generation": 0.15, "knowledge": 0.20, "reasoning": 0.15}


def join_predictions(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Gold rows with their predictions; columns of both get ``_pred`` on the right side."""
    renamed = predictions.select(*[F.col(c).alias(c if c == "record_id" or c not in gold.columns else f"{c}_pred") for c in predictions.columns])
    return gold.join(renamed, "record_id", "inner")


def coverage(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: gold rows, matched rows and their share (0 without gold rows)."""
    joined = gold.join(predictions.select("record_id", F.lit(1).alias("__gm_hit")), "record_id", "left")
    counts = joined.agg(F.count("*").alias("gold_rows"), F.count("__gm_hit").alias("matched_rows"))
    return counts.withColumn("coverage", F.round(F.col("matched_rows") / F.greatest("gold_rows", F.lit(1)), 6))


def prior_rows(targets: DataFrame, prior: DataFrame, gold: DataFrame, attributes: list[str]) -> DataFrame:
    """Targets with an earlier prediction, and attributes of their gold rows where these are there."""
    return targets.join(prior.withColumnsRenamed({"prediction": "prior_prediction"}), "record_id").join(gold.select("record_id", *attributes), "record_id", "left")


def group_accuracy(rows: DataFrame, by: tuple[str, ...], true: str = "gold_label", predicted: str = "prediction") -> DataFrame:
    """(dimension, value, rows, accuracy) over several dimensions, from counts of their combinations; null values count as ``None``."""
    counts = rows.groupBy(*[F.coalesce(F.col(c), F.lit("None")).alias(c) for c in by]).agg(F.count("*").alias("n"), F.count_if(F.col(true) == F.col(predicted)).alias("hits"))
    places = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in by])
    spread = counts.select(F.explode(places).alias("x"), "n", "hits").groupBy("x.dimension", "x.value").agg(F.sum("n").alias("rows"), F.sum("hits").alias("hits"))
    return spread.select("dimension", "value", "rows", F.round(F.col("hits") / F.col("rows"), 6).alias("accuracy"))


def leaderboard(scores: DataFrame, slices: tuple[str, ...] = ("overall", "evaluation_head", "task_type")) -> DataFrame:
    """The slices of a leaderboard, by slice and value."""
    return scores.where(F.col("slice").isin(*slices)).select("slice", "value", "rows", "metric_group", F.round("primary_score", 4).alias("primary_score")).orderBy("slice", "value")


def per_label(rows: DataFrame, true: str, predicted: str, by: list[str]) -> DataFrame:
    """(by, label, tp, fp, fn, support, precision, recall, f1) over the labels that occur on either side; 0 for 0/0.

    Rows are aggregated to counts per pair before they are spread over the two labels.
    """
    pairs = rows.groupBy(*by, F.col(true).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(*by, "n", F.explode(F.array_distinct(F.array("t", "p"))).alias("label"), "t", "p")
    same = F.col("t") == F.col("p")
    counts = sides.groupBy(*by, "label").agg(
        F.sum(F.when(same, F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(~same & (F.col("p") == F.col("label")), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~same & (F.col("t") == F.col("label")), F.col("n")).otherwise(0)).alias("fn"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    counts = counts.withColumns({"support": tp + fn, "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    return counts.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def classification_summary(labels: DataFrame, by: list[str]) -> DataFrame:
    weighted = F.sum(F.col("f1") * F.col("support")) / F.greatest(F.sum("support"), F.lit(1))
    return labels.groupBy(*by).agg(
        (F.sum("tp") / F.greatest(F.sum("support"), F.lit(1))).alias("accuracy"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1_macro"), weighted.alias("f1_weighted"), F.sum("support").alias("rows")
    )


def confusion(rows: DataFrame, true: str, predicted: str) -> DataFrame:
    """(true_label, predicted_label, n), dense over all labels of either side; one row per pair of labels."""
    counts = rows.groupBy(F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label")).agg(F.count("*").alias("n"))
    labels = counts.select(F.col("true_label").alias("x")).union(counts.select("predicted_label")).distinct()
    # every label with the array of all labels: the classes of a task, not its rows
    grid = labels.select(F.col("x").alias("true_label")).join(F.broadcast(labels.agg(F.collect_list("x").alias("all")))).select("true_label", F.explode("all").alias("predicted_label"))
    return grid.join(counts, ["true_label", "predicted_label"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def rank_auc(rows: DataFrame, true: str, score: str, position: str, by: list[str]) -> DataFrame:
    """(by, auc) of slices with two true labels, the larger one being positive. Ties keep the order of ``position``.

    Null and NaN scores don't count; without rows of both classes the value is null. Ranks are found per distinct score: a window
    over score counts gives the rows before it, and only tied rows are ranked among themselves.
    """
    used = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    classes = rows.groupBy(*by).agg(F.countDistinct(true).alias("k"), F.max(true).alias("positive")).where("k = 2")
    at = used.groupBy(*by, F.col(score).alias("s")).agg(F.count("*").alias("n"))
    below = at.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    tied = used.withColumn("s", F.col(score)).withColumn("own", F.row_number().over(Window.partitionBy(*by, "s").orderBy(position)))
    ranked = tied.join(below, [*by, "s"]).join(classes, by)
    hit = F.col(true) == F.col("positive")
    sums = ranked.groupBy(*by).agg(F.sum(F.when(hit, F.col("before") + F.col("own"))).alias("ranks"), F.count_if(hit).alias("p"), F.count_if(~hit).alias("q"))
    p, q = F.col("p"), F.col("q")
    return sums.select(*by, F.when((p > 0) & (q > 0), (F.col("ranks") - p * (p + 1) / 2) / (p * q)).alias("auc"))


def jaccard(expected: Column | str, predicted: Column | str) -> Column:
    """Overlap of the two token sets; 1 if both are empty, 0 if one is."""
    a, b = tokens(expected), tokens(predicted)
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def exact(expected: Column | str, predicted: Column | str) -> Column:
    return (normalised(as_col(expected)) == normalised(as_col(predicted))).cast("double")


SLICES = ("evaluation_head", "task_type", "main_category", "source_dataset")


def slice_rows(rows: DataFrame) -> DataFrame:
    """Counts of (slice, value, metric group, true, predicted) with summed overlaps: five slices of pre-aggregated rows."""
    text = F.col("metric_group").isin("classification")
    narrow = rows.select(
        *[F.coalesce(F.col(c), F.lit("None")).alias(c) for c in SLICES], "metric_group", F.when(text, F.col("gold_label")).alias("t"), F.when(text, F.col("prediction")).alias("p"),
        F.when(~text, jaccard("expected_output", "prediction")).alias("j"),
    )
    grouped = narrow.groupBy(*SLICES, "metric_group", "t", "p").agg(F.count("*").alias("n"), F.sum("j").alias("j"))
    places = [F.struct(F.lit("overall").alias("slice"), F.lit("overall").alias("value")), *[F.struct(F.lit(c).alias("slice"), F.col(c).alias("value")) for c in SLICES]]
    return grouped.select(F.explode(F.array(*places)).alias("x"), "metric_group", "t", "p", "n", "j").select("x.slice", "x.value", "metric_group", "t", "p", "n", "j")


def slice_scores(rows: DataFrame) -> DataFrame:
    """(slice, value, rows, metric_group, primary_score): macro F1 for classification, mean overlap else, weighted by size if mixed."""
    counts = slice_rows(rows)
    by = ["slice", "value", "metric_group"]
    classes = counts.where("metric_group = 'classification'")
    spread = classes.withColumn("label", F.explode(F.array_distinct(F.array("t", "p"))))
    same = F.col("t") == F.col("p")
    per = spread.groupBy(*by, "label").agg(
        F.sum(F.when(same, F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("wrong"), F.sum(F.when(F.col("t") == F.col("label"), F.col("n")).otherwise(0)).alias("support")
    )
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("wrong"))).otherwise(0.0)
    scored = per.groupBy(*by).agg(F.avg(f1).alias("score"), F.sum("support").alias("n"))
    others = counts.where("metric_group <> 'classification'").groupBy(*by).agg((F.sum("j") / F.sum("n")).alias("score"), F.sum("n").alias("n"))
    parts = scored.unionByName(others)
    return parts.groupBy("slice", "value").agg(
        F.sum("n").alias("rows"), F.when(F.count("*") > 1, "mixed").otherwise(F.min("metric_group")).alias("metric_group"), F.round(F.sum(F.col("score") * F.col("n")) / F.sum("n"), 6).alias("primary_score")
    )


def weighted_overall(rows: DataFrame) -> DataFrame:
    """One row: the weighted mean of the metric groups' scores, with default weight 1."""
    per_group = slice_scores(rows.withColumn("main_category", F.col("metric_group"))).where("slice = 'main_category'")
    weights = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in WEIGHTS.items() for x in p]), F.col("value")), F.lit(1.0))
    return per_group.agg(F.round(F.sum(F.col("primary_score") * weights) / F.sum(weights), 6).alias("weighted_score"), F.sum("rows").alias("rows"))

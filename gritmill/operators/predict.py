"""Label sets, model responses and the deterministic local stub."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import as_col, filled, squeeze, truncate_middle


def parse_labels(value: Column | str) -> Column:
    """Labels of a JSON list, else of a text split at commas, semicolons, bars and line ends; empty for null."""
    text = filled(value)
    whole = F.try_parse_json(text)
    listed = F.when(text.startswith("["), F.try_variant_get(whole, "$", "array<string>"))
    # JSON that is no list is one label; what is no JSON is split, whatever it starts with
    parts = F.coalesce(listed, F.when(whole.isNotNull() & ~F.is_variant_null(whole), F.array(text)), F.split(text, r"[,\n|;]+"))
    return F.coalesce(F.filter(F.transform(parts, squeeze), lambda x: x != ""), F.array().cast("array<string>"))


def json_object(text: Column) -> Column:
    """The object in a response: the whole of it, else a fenced one, else from the first to the last brace; null if none parses."""
    whole = F.trim(text)
    fenced = F.regexp_extract(whole, r"(?is)```(?:json)?\s*(\{.*?\})\s*```", 1)
    greedy = F.regexp_extract(whole, r"(?s)(\{.*\})", 1)
    objects = [F.when(c.startswith("{") & F.try_variant_get(F.try_parse_json(c), "$", "map<string,variant>").isNotNull(), c) for c in (whole, fenced, greedy)]
    return F.coalesce(*objects)


def normalise_label(prediction: Column, labels: Column) -> Column:
    """One of the labels if the text equals it, contains it, or has all its tokens, in this order; else the text itself."""
    cleaned = squeeze(prediction)
    low = F.lower(cleaned)
    tokens = lambda x: F.regexp_extract_all(F.lower(x), F.lit(r"([a-z0-9_.:-]+)"), F.lit(1))
    first = lambda test: F.get(F.filter(labels, test), F.lit(0))
    return F.coalesce(
        first(lambda x: F.lower(x) == low),
        first(lambda x: low.contains(F.lower(x))),
        first(lambda x: (F.size(tokens(x)) > 0) & (F.size(F.array_except(tokens(x), tokens(low))) == 0)),
        cleaned,
    )


def _number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(-?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def parse_response(response: Column | str, task: Column | str, labels: Column) -> Column:
    """Struct (prediction, score, probability, confidence, explanation, raw_response) of a model's text."""
    text = F.coalesce(F.trim(as_col(response)), F.lit(""))
    found = json_object(text)
    value = lambda key: F.get_json_object(found, f"$.{key}")
    is_class = F.coalesce(as_col(task), F.lit("classification")) == "classification"
    named = F.coalesce(value("prediction"), value("label"), value("answer"), value("classification"), text)
    said = F.trim(F.coalesce(F.nullif(value("prediction"), F.lit("")), F.nullif(value("answer"), F.lit("")), F.nullif(value("output"), F.lit("")), text))
    prediction = F.when(is_class, normalise_label(named, labels)).otherwise(said)
    explanation = F.coalesce(value("explanation"), F.when(~is_class & (text != "") & (said != text), text))
    return F.struct(
        prediction.alias("prediction"), _number(value("score")).alias("score"), _number(value("probability")).alias("probability"), _number(value("confidence")).alias("confidence"),
        F.nullif(F.trim(explanation), F.lit("")).alias("explanation"), F.nullif(text, F.lit("")).alias("raw_response"),
    )


def stub_predictions(gold: DataFrame, model: str = "stub", seed: int = 42) -> DataFrame:
    """(record_id, prediction, confidence) by SHA-1 of seed, record and model; for tests of the whole chain without a model."""
    number = F.conv(F.substring(F.sha1(F.concat(F.lit(f"{seed}:"), F.col("record_id"), F.lit(f":{model}"))), 1, 8), 16, 10).cast("long")
    labels = parse_labels("label_set")
    picked = F.get(labels, (number % F.greatest(F.size(labels), F.lit(1))).cast("int"))
    task = F.coalesce(F.lower(F.trim("task_type")), F.lit("classification"))
    prediction = (
        F.when(task == "classification", F.coalesce(picked, filled("gold_label"), F.lit("unknown")))
        .when(task == "generation", "Safe benchmark placeholder response.")
        .when(task == "knowledge", "Defensive cybersecurity knowledge placeholder.")
        .otherwise("Defensive benchmark reasoning placeholder.")
    )
    confidence = F.when(task == "classification", F.round(0.5 + (number % 5000) / 10000, 4)).otherwise(F.round(0.55 + (number % 4000) / 10000, 4))
    return gold.where("record_id is not null").select("record_id", prediction.alias("prediction"), confidence.alias("confidence"))


PREDICTION_COLUMNS = ("record_id", "prediction")


def missing_columns(predictions: DataFrame) -> list[str]:
    """Columns that predictions must have and these lack."""
    return [c for c in PREDICTION_COLUMNS if c not in predictions.columns]


def output_rows(gold: DataFrame, results: DataFrame, model: str) -> DataFrame:
    """One row per prediction with the record's context: what an appended file holds."""
    context = [c for c in ("record_id", "evaluation_head", "task_type", "metric_group", "gold_label") if c in gold.columns]
    fields = [F.col(c) if c in results.columns else F.lit(None).cast("string").alias(c) for c in ("prediction", "score", "probability", "confidence", "explanation", "raw_response")]
    return gold.select(*context).join(results.select("record_id", *fields), "record_id").withColumns({"model": F.lit(model), "created_at": F.current_timestamp()})


def generate(gold: DataFrame, done: DataFrame | None, answer, most: int | None = None, order: str = "record_id") -> DataFrame:
    """Answers (``answer`` takes rows and gives predictions) of the first ``most`` rows by ``order`` that have none yet."""
    rows = pending(gold, done) if done is not None else gold
    return answer(rows if most is None else rows.orderBy(order).limit(most))


def pending(gold: DataFrame, done: DataFrame) -> DataFrame:
    """Rows without a prediction yet."""
    return gold.join(done.select("record_id").distinct(), "record_id", "left_anti")


def already_done(gold: DataFrame, done: DataFrame) -> DataFrame:
    return gold.join(done.select("record_id").distinct(), "record_id", "left_semi")


def prompt_rows(gold: DataFrame, most: int = 6000) -> DataFrame:
    """Long fields cut in their middle."""
    fields = [c for c in ("input_text", "expected_output", "features_json") if c in gold.columns]
    return gold.withColumns({c: truncate_middle(c, most) for c in fields})

"""Silver rows to the unified gold table: one projection, a filter and first-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions import classify, hashing
from gritmill.functions.text import clean_lines, clean_text, filled, identifiers, known, nfc, slug
from gritmill.operators.dedup import first_wins

# Columns that are kept as metadata.
METADATA = (
    "source_dataset", "source_type", "main_category", "attack_name", "attack_family", "binary_label", "severity_score", "platform",
    "language", "protocol", "ecosystem", "package_name", "source_file", "schema_version", "ingested_at",
)


def canonical(silver: DataFrame, columns: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Rows in the silver table's own form, sorted by record_id.

    The wanted columns in their order and types; empty texts are null, then defaults fill nulls; ``raw_text`` has composed characters and
    no control characters. Times as text are left to ``timestamps``.
    """
    out = []
    for name, kind in columns.items():
        value = F.col(name) if name in silver.columns else F.lit(None)
        if kind == "string":
            value = filled(value)
            value = nfc(clean_lines(value)) if name == "raw_text" else value
        value = value.cast(kind)
        if (defaults or {}).get(name) is not None:
            value = F.coalesce(value, F.lit(defaults[name]).cast(kind))
        out.append(value.alias(name))
    return silver.select(*out).orderBy("record_id")


def quality_score(text: Column, label: Column, has_identifier: Column, severity: Column) -> Column:
    """0..1: half, more for 40 and 200 characters, a label, an identifier and a severity, less for under 10 characters."""
    n = F.length(text)
    add = lambda condition, value: F.when(F.coalesce(condition, F.lit(False)), F.lit(value)).otherwise(F.lit(0.0))
    score = F.lit(0.5) + add(n >= 40, 0.15) + add(n >= 200, 0.10) + add(n < 10, -0.30) + add(F.lower(label) != "unknown", 0.10) + add(has_identifier, 0.10) + add(F.lower(severity) != "unknown", 0.05)
    return F.when(n > 0, F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 4)).otherwise(0.0)


def unify(silver: DataFrame, seed: int = 42) -> DataFrame:
    """Unified records of silver rows; rows without text (raw_text, else features_json) have a null normalized_text.

    collected_at is ingested_at, else timestamp. The order of rows for first-wins is (source_id, silver_id).
    """
    raw = F.coalesce(known("raw_text"), known("features_json"))
    rows = silver.withColumn("__gm_raw", F.when(~raw.isin("{}", "[]"), raw)).withColumn("__gm_source", slug("source_dataset"))
    rows = rows.withColumn("__gm_text", clean_text("__gm_raw"))
    text = F.col("__gm_text")
    rows = rows.withColumns(
        {
            "__gm_domain": classify.domain("__gm_source", "source_dataset", "main_category", "attack_name", "source_type"),
            "__gm_techniques": identifiers(text, "technique", F.col("mitre_technique_id")),
            "__gm_cves": identifiers(text, "cve", F.col("cve_id")),
            "__gm_silver": F.coalesce(known("record_id"), F.lit("row0")),
        }
    )
    category = F.coalesce(known("main_category"), F.col("__gm_domain"))
    label, severity = F.coalesce(known("label"), F.lit("unknown")), F.coalesce(known("severity"), F.lit("unknown"))
    has_identifier = known("cwe_id").isNotNull() | known("cve_id").isNotNull() | (F.size("__gm_techniques") > 0) | (F.size("__gm_cves") > 0)
    record_id = F.concat("__gm_source", F.lit("::"), hashing.fingerprint("__gm_source", "__gm_silver", "__gm_text"))
    entities = F.struct(
        F.nullif(F.col("__gm_cves"), F.array().cast("array<string>")).alias("cve_ids"),
        F.nullif(identifiers(text, "cwe", F.col("cwe_id")), F.array().cast("array<string>")).alias("cwe_ids"),
        F.nullif(identifiers(text, "url", F.col("url")), F.array().cast("array<string>")).alias("urls"),
        *[known(c).alias(c) for c in ("domain", "ip", "package_name", "ecosystem")],
    )
    features = F.when(~known("features_json").isin("{}", "[]"), F.trim("features_json"))
    # features are JSON text among strings, as they are if they don't parse
    metadata = F.map_filter(F.create_map(*[x for c in METADATA for x in (F.lit(c), known(c))], F.lit("features"), features), lambda _, v: v.isNotNull())
    return rows.select(
        record_id.alias("record_id"), F.col("__gm_silver").alias("silver_id"), F.col("__gm_source").alias("source_id"), F.coalesce(known("source_dataset"), F.col("__gm_source")).alias("source_name"),
        classify.source_url("__gm_source", "source_dataset").alias("source_url"), F.coalesce(known("license"), F.lit("unknown")).alias("source_license"),
        F.coalesce(known("ingested_at"), known("timestamp")).alias("collected_at"), F.col("__gm_domain").alias("domain"), category.alias("category"),
        F.coalesce(known("attack_family"), known("attack_name"), category).alias("subcategory"), classify.task_type("source_type", F.col("__gm_domain")).alias("task_type"),
        F.col("__gm_raw").alias("raw_text"), text.alias("normalized_text"), label.alias("label"), severity.alias("severity"), known("cwe_id").alias("cwe"), known("cve_id").alias("cve"),
        F.col("__gm_techniques").alias("mitre_attack_ids"), F.lit("en").alias("language"), entities.alias("entities"), metadata.alias("metadata"),
        F.current_timestamp().alias("processed_at"), quality_score(text, label, has_identifier, severity).alias("quality_score"), hashing.content_key(text).alias("dedup_hash"), hashing.unified_split(record_id, seed).alias("split"),
    )


def build(silver: DataFrame, min_quality: float = 0.5, seed: int = 42) -> DataFrame:
    """Unified gold: rows with text and enough quality, the first of each content in (source_id, silver_id) order.

    Rows of low quality don't reserve their content: the filter comes first.
    """
    good = F.col("normalized_text").isNotNull() & (F.col("quality_score") >= min_quality)
    return first_wins(unify(silver, seed), "dedup_hash", ["source_id", "silver_id"], good)


def stats(silver: DataFrame, min_quality: float = 0.5, seed: int = 42) -> DataFrame:
    """One row: scanned, dropped_empty, dropped_low_quality, duplicates_removed, kept, mean_quality of the kept (0 if none)."""
    rows = unify(silver, seed).select("source_id", "silver_id", "normalized_text", "quality_score", "dedup_hash")
    flags = rows.select("dedup_hash", "quality_score", F.col("normalized_text").isNull().alias("e"), (F.col("normalized_text").isNotNull() & (F.col("quality_score") < min_quality)).alias("l"), F.struct("source_id", "silver_id").alias("o"))
    good = ~F.col("e") & ~F.col("l")
    per = flags.groupBy("dedup_hash").agg(
        F.count("*").alias("n"), F.count_if("e").alias("e"), F.count_if("l").alias("l"), F.count_if(good).alias("g"), F.min_by(F.when(good, F.col("quality_score")), F.when(good, F.col("o"))).alias("q")
    )
    kept = F.count_if(F.col("g") > 0)
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scanned"), F.coalesce(F.sum("e"), F.lit(0)).alias("dropped_empty"), F.coalesce(F.sum("l"), F.lit(0)).alias("dropped_low_quality"),
        F.coalesce(F.sum(F.when(F.col("g") > 0, F.col("g") - 1)), F.lit(0)).alias("duplicates_removed"), kept.alias("kept"), F.coalesce(F.round(F.avg("q"), 4), F.lit(0.0)).alias("mean_quality"),
    )

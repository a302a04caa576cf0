"""Contracts as violation rows: one pass, one explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions.classify import DOMAIN_KEYWORDS
from gritmill.functions.text import filled, is_safe

# Fields that must be filled, names of splits, severities, labels.
UNIFIED_REQUIRED = ("record_id", "source_id", "domain", "category", "task_type", "split", "dedup_hash")
SPLITS = ("train", "val", "test")
SILVER_REQUIRED = ("record_id", "source_dataset", "source_type", "main_category", "label", "binary_label", "source_file", "license", "schema_version", "ingested_at")
SCHEMA_VERSION = "1.0.0"
LABELS = (
    "benign", "malicious", "phishing", "benign_url", "vulnerable_dependency", "vulnerable_code", "non_vulnerable_code", "malicious_package", "attack_technique", "attack_pattern",
    "vulnerability_advisory", "malicious_prompt", "benign_prompt", "jailbreak_prompt", "ai_security_risk", "exploit_incident", "intrusion", "anomaly", "unknown",
)
SEVERITIES = ("info", "low", "medium", "high", "critical", "unknown")


def violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, issue) of each check that is true; a null check is no violation."""
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))
    return df.select(F.col(key).alias("row_key"), F.explode(found).alias("issue"))


def repeated(df: DataFrame, key: str, column: str, issue: str) -> DataFrame:
    """(key, issue) for each value of ``column`` that more than one row has: the largest key stands for the group."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"), F.max(key).alias("row_key")).where("n > 1")
    return counts.select("row_key", F.lit(issue).alias("issue"))


def repeated_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """(row_key, position) of every row after the first of its key, counted from 2 in ``order``."""
    rows = df.where(F.col(key).isNotNull())
    many = rows.groupBy(key).agg(F.count("*").alias("__gm_n")).where("__gm_n > 1").select(key)
    # only keys that are there twice meet a window, which holds the deliveries of one key
    position = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.join(many, key, "left_semi").select(F.col(key).alias("row_key"), position.alias("position")).where("position > 1")


def emptiness(df: DataFrame, issue: str) -> DataFrame:
    """A row without key if there are no rows at all."""
    return df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("row_key"), F.lit(issue).alias("issue"))


def unified_issues(gold: DataFrame) -> DataFrame:
    """Issues of unified gold: missing columns, empty fields, no text, vocabularies, quality, repeated ids and hashes, an empty table."""
    lacking = [c for c in (*UNIFIED_REQUIRED, "raw_text", "normalized_text", "quality_score") if c not in gold.columns]
    if lacking:
        return gold.sparkSession.range(1).select(F.lit(None).cast("string").alias("row_key"), F.explode(F.array(*[F.lit(f"missing column {c}") for c in lacking])).alias("issue"))
    checks = {f"missing {c}": filled(c).isNull() for c in UNIFIED_REQUIRED}
    checks["no text"] = filled("raw_text").isNull() & filled("normalized_text").isNull()
    checks["unknown domain"] = ~F.coalesce(F.col("domain").isin(*DOMAIN_KEYWORDS, "miscellaneous"), F.lit(False))
    checks["unknown split"] = ~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))
    checks["quality outside 0..1"] = F.col("quality_score").isNull() | F.isnan("quality_score") | ~F.col("quality_score").between(0, 1)
    found = violations(gold, "record_id", checks).unionByName(emptiness(gold, "no records"))
    return found.unionByName(repeated(gold, "record_id", "record_id", "repeated record_id")).unionByName(repeated(gold.where(filled("dedup_hash").isNotNull()), "record_id", "dedup_hash", "repeated dedup_hash"))


def _not_utc(column: str, kind: str) -> Column:
    """Times as text need an offset of zero; times as instants are UTC."""
    text = filled(column)
    return F.lit(False) if kind == "timestamp" else text.isNotNull() & ~text.rlike(r"(?:Z|[+-]00:?00| UTC)$")


def silver_issues(silver: DataFrame) -> DataFrame:
    """Issues of a silver table: column order, empty fields, vocabularies, times without UTC, unsafe text, repeated ids."""
    kinds = dict(silver.dtypes)
    checks = {f"missing {c}": filled(F.col(c).cast("string")).isNull() for c in SILVER_REQUIRED}
    checks["schema version"] = F.col("schema_version") != SCHEMA_VERSION
    checks["unknown label"] = filled("label").isNotNull() & ~F.col("label").isin(*LABELS)
    checks["binary label"] = ~F.col("binary_label").isin(0, 1)
    checks["severity"] = filled("severity").isNotNull() & ~F.lower("severity").isin(*SEVERITIES)
    checks["score outside 0..10"] = ~F.isnan("severity_score") & ~F.col("severity_score").between(0, 10)
    checks["unsafe text"] = ~is_safe("raw_text")
    for c in ("timestamp", "ingested_at"):
        if c in kinds:
            checks[f"{c} without UTC"] = _not_utc(c, kinds[c])
    return violations(silver, "record_id", checks).unionByName(repeated(silver, "record_id", "record_id", "repeated record_id"))


def order_problems(columns: list[str], wanted: tuple[str, ...] | list[str]) -> list[str]:
    """Columns that are missing, too many, or in another order than wanted."""
    out = [f"missing column {c}" for c in wanted if c not in columns] + [f"extra column {c}" for c in columns if c not in wanted]
    return out or ([] if list(columns) == list(wanted) else ["columns in another order"])


def table_issues(df: DataFrame, rules: dict[str, dict], key: str = "record_id", safe: str | None = "is_safe_representation") -> DataFrame:
    """Issues by a contract of columns: ``nullable``, ``unique`` and ``values`` each, as in a schema file; and a flag that must be true."""
    lacking = [c for c in rules if c not in df.columns]
    if lacking:
        return df.sparkSession.range(1).select(F.lit(None).cast("string").alias("row_key"), F.explode(F.array(*[F.lit(f"missing column {c}") for c in lacking])).alias("issue"))
    checks = {f"missing {c}": F.col(c).isNull() for c, rule in rules.items() if not rule.get("nullable", True)}
    checks |= {f"invalid {c}": F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*[str(v) for v in rule["values"]]) for c, rule in rules.items() if rule.get("values")}
    if safe is not None and safe in df.columns:
        checks["unsafe row"] = ~F.coalesce(F.col(safe), F.lit(False))
    out = violations(df, key, checks)
    for c, rule in rules.items():
        out = out.unionByName(repeated(df, key, c, f"repeated {c}")) if rule.get("unique") else out
    return out


def aligned(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The wanted columns in their order and types; missing ones are null, others are left out."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])


def assert_valid(issues: DataFrame, shown: int = 20) -> None:
    first = issues.orderBy("row_key", "issue").limit(shown).collect()
    if first:
        raise ValueError("; ".join(f"{r.row_key}: {r.issue}" for r in first))


def manifest_problems(manifest: dict, written: int | None = None) -> list[str]:
    """Groups of a manifest whose counts don't add up to its total, and a total that isn't the number of rows written."""
    total = manifest.get("total_records", 0)
    wrong = [f"total is {total}, but {written} rows were written"] if written is not None and total != written else []
    return wrong + [f"{g} adds up to {sum(c.values())}, not {total}" for g, c in sorted(manifest.items()) if g.startswith("counts_by_") and isinstance(c, dict) and sum(c.values()) != total]

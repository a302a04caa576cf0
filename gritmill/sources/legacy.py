"""The older nineteen-column tables: six structured feeds, label mapping, redaction and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.hashing import legacy_split
from gritmill.functions.text import defang, is_safe, known, redact
from gritmill.operators.nested import as_list, member
from gritmill.sources.parsers import _column
from gritmill.sources.readers import scalar

MOST_FEATURES = 80


def compact_features(df: DataFrame, leave: tuple[str, ...]) -> Column:
    """JSON of the first MOST_FEATURES non-null columns, without those to leave and those that start with ``__``."""
    names = [c for c in df.columns if not c.startswith("__") and c.strip().lower() not in leave]
    if not names:
        return F.lit("{}")
    pairs = F.filter(F.array(*[F.struct(F.lit(c.strip()).alias("key"), df[f"`{c}`"].cast("string").alias("value")) for c in names]), lambda p: p.value.isNotNull())
    return F.to_json(F.map_from_entries(F.slice(pairs, 1, MOST_FEATURES)))


def _ladder(text: Column, steps: list[tuple[str, tuple]], default: tuple) -> Column:
    make = lambda t: F.struct(F.lit(t[0]).alias("category"), F.lit(t[1]).cast("string").alias("tactic"))
    out = F
    for pattern, to in steps:
        out = out.when(text.rlike(pattern), make(to))
    return out.otherwise(make(default))


def legacy_row(df: DataFrame, dataset: str, source_type: str, category: Column, attack: Column, label: Column, content: Column, key: Column, tactic: Column, license_note: str, **more: Column) -> DataFrame:
    """Canonical rows: content redacted and defanged, the split by the hash of the record's id."""
    record_id = F.concat(F.lit(f"{dataset}:"), F.coalesce(key, F.lit("")))
    safe = defang(redact(content))
    return df.select(
        record_id.alias("record_id"), F.lit(dataset).alias("source_dataset"), F.lit(source_type).alias("source_type"), category.alias("main_category"), attack.alias("attack_name"), label.alias("label"),
        F.when(label == "benign", 0).otherwise(1).cast("long").alias("binary_label"), tactic.alias("mitre_tactic"), more.get("technique", F.lit(None).cast("string")).alias("mitre_technique_id"), more.get("cwe", F.lit(None).cast("string")).alias("cwe_id"),
        more.get("cve", F.lit(None).cast("string")).alias("cve_id"), more.get("severity", F.lit(None).cast("string")).alias("severity"), safe.alias("raw_text_or_features"), F.lit(False).alias("is_synthetic"), is_safe(safe).alias("is_safe_representation"),
        F.lit(license_note).alias("license_note"), legacy_split(record_id).alias("split"),
    )


def cicids(df: DataFrame) -> DataFrame:
    kind = F.coalesce(known(F.coalesce(*[_column(df, c) for c in ("Label", "attack", "class")])), F.lit("unknown"))
    low = F.lower(kind)
    benign = low.isin("benign", "normal")
    to = _ladder(low, [("ddos|^dos ", ("denial_of_service", "Impact")), ("web attack|xss|sql", ("web_application_attack", "Initial Access")), ("patator|brute", ("credential_attack", "Credential Access"))], ("network_intrusion", "Initial Access"))
    return legacy_row(
        df, "cicids2017", "network_flow", F.when(benign, "network_intrusion").otherwise(to.category), F.when(benign, "Benign Flow").otherwise(kind), F.when(benign, "benign").otherwise("malicious"),
        compact_features(df, ("label", "attack", "class")), F.concat_ws(":", "__source_file", F.col("__row").cast("string")), F.when(~benign, to.tactic), "restricted:academic",
    )


def unsw(df: DataFrame) -> DataFrame:
    kind = F.coalesce(known(F.coalesce(_column(df, "attack_cat"), _column(df, "category"))), F.lit("unknown"))
    benign = F.coalesce(_column(df, "label").isin("0", "0.0"), F.lit(False)) | F.lower(kind).isin("normal", "benign")
    to = _ladder(F.lower(kind), [("dos", ("denial_of_service", "Impact")), ("backdoor|shellcode|worms", ("malware", "Execution")), ("recon|analysis", ("network_intrusion", "Discovery"))], ("network_intrusion", "Initial Access"))
    return legacy_row(
        df, "unsw_nb15", "network_flow", F.when(benign, "network_intrusion").otherwise(to.category), F.when(benign, "Benign Flow").otherwise(kind), F.when(benign, "benign").otherwise("malicious"),
        compact_features(df, ("label", "attack_cat", "category")), F.concat_ws(":", "__source_file", F.col("__row").cast("string")), F.when(~benign, to.tactic), "restricted:academic",
    )


def urls(df: DataFrame, dataset: str, attack: Column, key: Column) -> DataFrame:
    url = F.coalesce(*[_column(df, c) for c in ("url", "phish_detail_url", "phishing_url")], F.lit(""))
    label = "phishing" if dataset == "phishtank" else "malicious"
    return legacy_row(df, dataset, "url", F.lit("phishing_social_engineering" if dataset == "phishtank" else "malware"), attack, F.lit(label), F.concat_ws(" ", url, compact_features(df, ("url",))), key, F.lit("Initial Access"), "restricted:tos", technique=F.lit("T1566") if dataset == "phishtank" else F.lit(None).cast("string"))


def phishtank(df: DataFrame) -> DataFrame:
    return urls(df, "phishtank", F.lit("Phishing URL"), F.coalesce(_column(df, "phish_id"), _column(df, "id"), F.col("__row").cast("string")))


def urlhaus(df: DataFrame) -> DataFrame:
    return urls(df, "urlhaus", F.coalesce(_column(df, "threat"), _column(df, "tags"), F.lit("Malicious URL")), F.coalesce(_column(df, "id"), F.col("__row").cast("string")))


def nvd(d: DataFrame) -> DataFrame:
    """Documents (file, v) of either feed generation: severity from the metrics' words, the first CWE, a description in English first."""
    c = F.coalesce(member(d["v"], "cve"), d["v"])
    described = F.concat(as_list(member(c, "descriptions")), as_list(member(member(c, "description"), "description_data")))
    english = F.coalesce(scalar(F.get(F.filter(described, lambda x: scalar(x, "lang") == "en"), F.lit(0)), "value"), scalar(F.get(described, F.lit(0)), "value"), F.lit(""))
    metrics = F.lower(F.coalesce(F.to_json(member(d["v"], "metrics")), F.to_json(member(c, "metrics")), F.to_json(member(d["v"], "impact")), F.lit("")))
    severity = F.coalesce(F.get(F.filter(F.array(*[F.lit(x) for x in ("critical", "high", "medium", "low")]), lambda x: metrics.contains(x)), F.lit(0)), F.lit("unknown"))
    weak = F.coalesce(F.to_json(member(c, "weaknesses")), F.to_json(member(member(c, "problemtype"), "problemtype_data")), F.lit(""))
    cwe = F.nullif(F.substring(F.regexp_extract(weak, r"(CWE-[^\"'\\,]*)", 1), 1, 32), F.lit(""))
    cve = F.coalesce(scalar(c, "id"), scalar(c, "CVE_data_meta", "ID"))
    return legacy_row(d, "nvd", "advisory", F.lit("vulnerability"), cve, F.lit("vulnerable"), english, cve, F.lit(None).cast("string"), "NVD-Public-Domain", cwe=cwe, cve=cve, severity=severity)


def kev(d: DataFrame) -> DataFrame:
    rows = d.select(F.explode(as_list(F.coalesce(member(F.col("v"), "vulnerabilities"), F.col("v")))).alias("v"))
    v = F.col("v")
    cve = scalar(v, "cveID")
    content = F.concat_ws(" ", scalar(v, "vulnerabilityName"), scalar(v, "shortDescription"), scalar(v, "requiredAction"))
    return legacy_row(rows, "cisa_kev", "advisory", F.lit("vulnerability"), F.coalesce(scalar(v, "vulnerabilityName"), cve), F.lit("vulnerable"), content, cve, F.lit("Initial Access"), "CC0-1.0", cve=cve, severity=F.lit("critical"))


def smoke(spark) -> DataFrame:
    rows = [("a", "benign", "A harmless flow."), ("b", "malicious", "A flood of packets."), ("c", "phishing", "A link to a copied page.")]
    df = spark.createDataFrame(rows, "k string, l string, t string")
    return legacy_row(df, "smoke", "network_flow", F.lit("network_intrusion"), F.col("l"), F.col("l"), F.col("t"), F.col("k"), F.lit(None).cast("string"), "CC0-1.0")



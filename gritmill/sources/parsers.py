"""The twenty source parsers: documents or rows of a feed to the thirty silver columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gritmill.functions import classify
from gritmill.functions.hashing import module_record_id
from gritmill.functions.text import filled, host, strip
from gritmill.operators.dedup import first_wins
from gritmill.operators.nested import as_list, member, text_of
from gritmill.sources import readers
from gritmill.sources.readers import scalar

SCHEMA_VERSION = "1.0.0"
#: Columns of the silver table in their order.
SILVER = (
    "record_id source_dataset source_type main_category attack_name attack_family label binary_label mitre_tactic mitre_technique_id cwe_id cve_id severity severity_score "
    "platform language protocol ecosystem package_name url domain ip timestamp raw_text features_json source_file license notes schema_version ingested_at"
).split()
_TYPES = {"binary_label": "tinyint", "severity_score": "double", "ingested_at": "timestamp"}
FEATURE_BYTES = 8192


def features(**values: Column) -> Column:
    """JSON of the values in the order of their names, nulls included; null if it is longer than FEATURE_BYTES."""
    text = F.to_json(F.struct(*[values[k].alias(k) for k in sorted(values)]), {"ignoreNullFields": "false"})
    return F.when(F.octet_length(text) <= FEATURE_BYTES, text)


def first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def strings(value: Column) -> Column:
    """Texts of a list of scalars."""
    return F.filter(F.transform(as_list(value), text_of), lambda x: x.isNotNull())


def joined(*parts: Column) -> Column:
    return filled(F.array_join(F.array_compact(F.array(*parts)), "\n\n"))


def _score(v: Column, key: str) -> Column:
    return F.nullif(scalar(first(as_list(member(member(v, "metrics"), key))), "cvssData", "baseScore").try_cast("double"), F.lit(0.0))


def _first_cve(aliases: Column) -> Column:
    return first(F.filter(aliases, lambda x: x.startswith("CVE-")))


V = F.col


def mitre(d: DataFrame) -> dict[str, Column]:
    v = d["v"]
    known = F.filter(as_list(member(v, "external_references")), lambda r: scalar(r, "source_name") == "mitre-attack")
    ext = scalar(first(known), "external_id")
    tactics = F.array_join(F.filter(F.transform(as_list(member(v, "kill_chain_phases")), lambda k: scalar(k, "phase_name")), lambda x: x.isNotNull()), "|")
    detection = scalar(v, "x_mitre_detection")
    return {
        "key": F.coalesce(ext, scalar(v, "id")), "attack_name": scalar(v, "name"), "attack_family": F.when(ext.contains("."), F.substring_index(ext, ".", 1)), "label": F.lit("attack_technique"),
        "mitre_tactic": filled(tactics), "mitre_technique_id": ext, "platform": filled(F.array_join(strings(member(v, "x_mitre_platforms")), "|")),
        "raw_text": joined(scalar(v, "description"), F.concat(F.lit("Detection: "), filled(detection))),
        "keep": (scalar(v, "type") == "attack-pattern") & (F.coalesce(scalar(v, "revoked"), F.lit("false")) != "true") & (F.coalesce(scalar(v, "x_mitre_deprecated"), F.lit("false")) != "true"),
    }


def capec(d: DataFrame) -> dict[str, Column]:
    return {
        "key": F.coalesce(F.concat(F.lit("CAPEC-"), d["_ID"]), d["_Name"]), "attack_name": d["_Name"], "attack_family": d["_Abstraction"], "label": F.lit("attack_pattern"),
        "cwe_id": F.concat(F.lit("CWE-"), first(d["Related_Weaknesses.Related_Weakness._CWE_ID"])), "severity": classify.severity(d["_Typical_Severity"]),
        "raw_text": joined(d["Description"], d["Extended_Description"], F.array_join(d["Mitigations.Mitigation"], "\n")), "keep": ~F.coalesce(F.lower(d["_Status"]), F.lit("")).isin("deprecated", "obsolete"),
    }


CAPEC_XML = (
    "_ID string, _Name string, _Abstraction string, _Status string, Description string, Extended_Description string, Typical_Severity string, "
    "Related_Weaknesses struct<Related_Weakness: array<struct<_CWE_ID: string>>>, Mitigations struct<Mitigation: array<string>>"
)


def nvd(d: DataFrame) -> dict[str, Column]:
    v = F.coalesce(member(d["v"], "cve"), d["v"])
    cve = F.coalesce(scalar(v, "id"), scalar(v, "CVE_data_meta", "ID"))
    described = F.concat(as_list(member(v, "descriptions")), as_list(member(member(v, "description"), "description_data")))
    english = scalar(first(F.filter(described, lambda x: scalar(x, "lang") == "en")), "value")
    score = F.coalesce(_score(v, "cvssMetricV40"), _score(v, "cvssMetricV31"), _score(v, "cvssMetricV30"), _score(v, "cvssMetricV2"))
    weak = F.flatten(F.transform(as_list(member(v, "weaknesses")), lambda w: F.transform(as_list(member(w, "description")), lambda x: scalar(x, "value"))))
    cwes = F.filter(weak, lambda x: x.startswith("CWE-"))
    references = F.concat(as_list(member(v, "references")), as_list(member(member(v, "references"), "referenceData")))
    return {
        "key": F.coalesce(cve, F.substring(F.to_json(v), 1, 200)), "label": F.lit("vulnerability_advisory"), "cve_id": cve, "cwe_id": first(cwes), "severity": classify.severity(F.lit(None).cast("string"), score), "severity_score": score,
        "timestamp": F.coalesce(scalar(v, "published"), scalar(v, "publishedDate")), "raw_text": english, "url": first(F.filter(F.transform(references, lambda r: scalar(r, "url")), lambda x: x.isNotNull())), "features_json": features(cwe_ids=cwes),
    }


def _advisory(v: Column, identifier: Column, aliases: Column, severity: Column) -> dict[str, Column]:
    package = member(first(as_list(member(v, "affected"))), "package")
    return {
        "key": identifier, "attack_name": identifier, "label": F.lit("vulnerable_dependency"), "cve_id": _first_cve(aliases), "severity": classify.severity(severity), "ecosystem": scalar(package, "ecosystem"),
        "package_name": scalar(package, "name"), "raw_text": joined(filled(scalar(v, "summary")), filled(scalar(v, "details"))),
    }


def osv(d: DataFrame) -> dict[str, Column]:
    v = F.try_parse_json(d["text"])
    aliases = strings(member(v, "aliases"))
    out = _advisory(v, F.coalesce(scalar(v, "id"), d["name"]), aliases, scalar(v, "database_specific", "severity"))
    return out | {"timestamp": scalar(v, "modified"), "features_json": features(affected_versions=F.slice(as_list(member(v, "affected")), 1, 3), aliases=aliases), "keep": v.isNotNull()}


def ghsa(d: DataFrame) -> dict[str, Column]:
    v = d["v"]
    listed = F.concat(as_list(member(v, "aliases")), as_list(member(v, "identifiers")))
    aliases = F.filter(F.transform(listed, lambda a: F.coalesce(scalar(a, "value"), text_of(a))), lambda x: x.isNotNull())
    stem = F.regexp_extract(d["file"], r"([^/]+?)(?:\.[^./]*)?$", 1)
    identifier = F.coalesce(scalar(v, "id"), scalar(v, "ghsaId"), scalar(v, "ghsa_id"), stem)
    return _advisory(v, identifier, aliases, F.coalesce(scalar(v, "database_specific", "severity"), scalar(v, "severity"))) | {"features_json": features(aliases=aliases)}


def phishtank(d: DataFrame) -> dict[str, Column]:
    url = F.coalesce(filled(_column(d, "url")), filled(_column(d, "phish_detail_url")))
    return {"key": F.coalesce(filled(_column(d, "phish_id")), url), "label": F.lit("phishing"), "url": url, "domain": host(url), "timestamp": _column(d, "submission_time"), "keep": url.isNotNull()}


def balanced_urls(d: DataFrame) -> dict[str, Column]:
    url, binary = F.coalesce(scalar(d["v"], "text"), scalar(d["v"], "url")), F.coalesce(scalar(d["v"], "label").try_cast("int"), F.lit(0))
    return {"key": F.concat(url, F.lit(":"), binary), "label": F.when(binary == 1, "phishing").otherwise("benign_url"), "binary": binary, "url": url, "domain": host(url)}


def owasp_llm(d: DataFrame) -> dict[str, Column]:
    """Rows (file, code, context) of llm_risks."""
    return {"key": d["code"], "attack_name": d["code"], "label": F.lit("ai_security_risk"), "raw_text": d["context"]}


def llm_risks(pages: DataFrame) -> DataFrame:
    """The first place of each LLMnn in each file, with 200 characters before it and 1,800 after."""
    codes = pages.select("file", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\bLLM(?:0[1-9]|10)\b"), F.lit(0)))).alias("code"))
    # the place of the whole word, not of a longer one that begins with it
    at = F.regexp_instr("text", F.concat(F.lit(r"\b"), F.col("code"), F.lit(r"\b")))
    start = F.greatest(F.lit(1), at - 200)
    return codes.select("file", "code", F.col("text").substr(start, at - start + 1800).alias("context"))


def giskard(d: DataFrame) -> dict[str, Column]:
    jail = F.lower(F.coalesce(_column(d, "group"), F.lit(""))).contains("jailbreak")
    index = F.nullif(filled(_column(d, "index")), F.lit("0"))
    return {
        "key": F.coalesce(index, _column(d, "prompt")), "attack_name": F.when(jail, "jailbreak").otherwise("prompt_injection"), "attack_family": _column(d, "group"), "label": F.when(jail, "jailbreak_prompt").otherwise("malicious_prompt"),
        "language": _column(d, "language"), "raw_text": _column(d, "prompt"), "keep": filled(_column(d, "prompt")).isNotNull(),
    }


def lakera(d: DataFrame) -> dict[str, Column]:
    text = F.coalesce(_column(d, "text"), _column(d, "prompt"))
    return {"key": F.concat_ws(":", d["file"], d["row"].cast("string"), text), "attack_name": F.lit("prompt_injection"), "label": F.lit("malicious_prompt"), "raw_text": text, "features_json": features(similarity=_column(d, "similarity"))}


def hugging(d: DataFrame) -> dict[str, Column]:
    text = F.coalesce(filled(_column(d, "prompt")), filled(_column(d, "text")))
    benign = F.lower(F.coalesce(_column(d, "label"), F.lit("malicious"))).contains("benign")
    return {
        "key": F.concat_ws(":", d["file"], text), "attack_name": F.coalesce(filled(_column(d, "attack_category")), F.lit("prompt_injection")), "attack_family": _column(d, "context"), "label": F.when(benign, "benign_prompt").otherwise("malicious_prompt"),
        "binary": F.when(benign, 0).otherwise(1), "raw_text": text, "keep": text.isNotNull(),
    }


def hackaprompt(d: DataFrame) -> dict[str, Column]:
    text = F.coalesce(*[filled(_column(d, c)) for c in ("prompt", "text", "user_input")])
    return {"key": F.concat_ws(":", d["file"], d["row"].cast("string"), text), "attack_name": F.lit("prompt_injection"), "label": F.lit("malicious_prompt"), "raw_text": text, "keep": text.isNotNull()}


def smartbugs(d: DataFrame) -> dict[str, Column]:
    v = d["v"]
    found = as_list(member(v, "vulnerabilities"))
    kinds = F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: scalar(x, "category")), lambda x: x.isNotNull())))
    lines = F.flatten(F.transform(found, lambda x: strings(member(x, "lines"))))
    return {
        "key": scalar(v, "path"), "attack_name": filled(F.array_join(kinds, "|")), "label": F.lit("vulnerable_code"), "language": F.lit("solidity"), "raw_text": d["source_text"],
        "features_json": features(pragma=scalar(v, "pragma"), source=scalar(v, "source"), vulnerability_lines=lines, categories=kinds), "keep": d["source_text"].isNotNull(),
    }


def defihacklabs(d: DataFrame) -> dict[str, Column]:
    """Rows (file, v, cause): incidents with their root cause by name."""
    v, cause = d["v"], d["cause"]
    name, kind = F.coalesce(filled(scalar(v, "name")), F.lit("unknown")), F.coalesce(scalar(v, "type"), scalar(cause, "type"))
    return {
        "key": F.concat_ws("::", scalar(v, "date"), name, scalar(v, "chain")), "attack_name": name, "attack_family": kind, "label": F.lit("exploit_incident"), "timestamp": F.coalesce(scalar(v, "date"), scalar(cause, "date")),
        "platform": scalar(v, "chain"), "raw_text": joined(F.concat(F.lit("Incident: "), name), F.concat(F.lit("Type: "), kind), scalar(cause, "rootCause")),
        "features_json": features(lost=F.coalesce(scalar(v, "Lost"), scalar(cause, "Lost")), loss_type=scalar(v, "lossType"), contract=F.coalesce(scalar(v, "Contract"), scalar(cause, "Contract"))),
    }


def malmem(d: DataFrame) -> dict[str, Column]:
    name = d["Filename"]
    parts = F.split(name, "-", 3)
    benign = F.lower(first(parts)) == "benign"
    rest = {c: d[c] for c in d.columns if c not in ("Filename", "Class", "Category", "file", "row")}
    return {
        "key": name, "attack_family": F.when(~benign, first(parts)), "attack_name": F.when(~benign, F.get(parts, F.lit(1))), "label": F.when(benign, "benign").otherwise("malicious"), "binary": F.when(benign, 0).otherwise(1),
        "platform": F.lit("windows"), "raw_text": name, "features_json": features(**rest) if rest else F.lit(None).cast("string"), "keep": name.isNotNull(),
    }


def unsw(d: DataFrame) -> dict[str, Column]:
    binary = F.coalesce(_column(d, "label").try_cast("int"), F.lit(0))
    kind = filled(_column(d, "attack_cat"))
    rest = {c: d[c] for c in d.columns if c not in ("id", "attack_cat", "label", "file", "row")}
    flow = F.concat_ws(":", d["file"], d["id"])
    attack = F.when(F.lower(kind) != "normal", kind)
    return {
        "key": flow, "attack_name": attack, "attack_family": attack, "label": F.when(binary == 0, "benign").otherwise("intrusion"), "binary": binary, "protocol": _column(d, "proto"), "raw_text": F.concat(F.lit("UNSW-NB15 flow "), flow),
        "features_json": features(**rest) if rest else F.lit(None).cast("string"),
    }


def juliet(d: DataFrame) -> dict[str, Column]:
    base = F.regexp_extract(d["name"], r"([^/]+)$", 1)
    good = base.rlike(r"(?i)(^|[_-])good")
    cwe = F.nullif(F.regexp_extract(d["name"], r"CWE(\d+)", 1), F.lit(""))
    return {
        "key": d["name"], "attack_name": base, "label": F.when(good, "non_vulnerable_code").otherwise("vulnerable_code"), "binary": F.when(good, 0).otherwise(1), "cwe_id": F.concat(F.lit("CWE-"), cwe),
        "language": F.when(base.rlike(r"(?i)\.(cpp|hpp|cc)$"), "C++").otherwise("C"), "raw_text": d["text"],
    }


def owasp_benchmark(d: DataFrame) -> dict[str, Column]:
    bad = F.lower(F.trim(d["real_vulnerability"])) == "true"
    return {
        "key": d["test_name"], "attack_name": d["test_name"], "attack_family": d["category"], "label": F.when(bad, "vulnerable_code").otherwise("non_vulnerable_code"), "binary": F.when(bad, 1).otherwise(0),
        "cwe_id": F.concat(F.lit("CWE-"), d["cwe"].try_cast("int").cast("string")), "language": F.lit("java"), "raw_text": d["source_text"], "features_json": features(benchmark_category=d["category"], expected_vulnerable=bad),
    }


def crapi(d: DataFrame) -> dict[str, Column]:
    """Rows (file, title, body) of challenges."""
    return {"key": d["title"], "attack_name": d["title"], "label": F.lit("attack_pattern"), "raw_text": d["body"], "features_json": features(endpoint_count=d["endpoints"])}


def challenges(pages: DataFrame, endpoints: int = 0) -> DataFrame:
    """Sections under headings ``### Challenge n - title``."""
    marked = F.split(F.regexp_replace("text", r"(?m)^(###\s+Challenge\s+\d+\s*-)", "\x01$1"), "\x01")
    parts = pages.select("file", F.explode(marked).alias("body")).where(F.col("body").rlike(r"^###\s+Challenge\s+\d+"))
    return parts.select("file", strip(F.regexp_extract("body", r"^###\s+(Challenge\s+\d+\s*-[^\n]*)", 1)).alias("title"), strip("body").alias("body"), F.lit(endpoints).alias("endpoints"))


def endpoint_count(spec: Column) -> Column:
    """Operations of an OpenAPI document: members of each path that is an object."""
    paths = F.try_variant_get(spec, "$.paths", "map<string,variant>")
    sizes = F.transform(F.map_values(paths), lambda x: F.coalesce(F.size(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>"))), F.lit(0)))
    return F.aggregate(sizes, F.lit(0), lambda a, x: a + x)


def otrf(d: DataFrame) -> dict[str, Column]:
    v = d["v"]
    mappings = as_list(member(v, "attack_mappings"))
    technique = lambda m: F.concat(F.trim(scalar(m, "technique")), F.coalesce(F.concat(F.lit("."), filled(scalar(m, "sub-technique"))), F.lit("")))
    distinct = lambda x: filled(F.array_join(F.array_sort(F.array_distinct(x)), "|"))
    kinds = F.array_sort(F.array_distinct(F.filter(F.transform(as_list(member(v, "files")), lambda f: scalar(f, "type")), lambda x: x.isNotNull())))
    return {
        "key": F.coalesce(scalar(v, "id"), d["file"]), "attack_name": scalar(v, "title"), "attack_family": scalar(v, "type"), "label": F.lit("attack_technique"),
        "mitre_tactic": distinct(F.flatten(F.transform(mappings, lambda m: strings(member(m, "tactics"))))), "mitre_technique_id": distinct(F.filter(F.transform(mappings, technique), lambda x: x.isNotNull() & (x != ""))),
        "platform": filled(F.array_join(strings(member(v, "platform")), "|")), "timestamp": scalar(v, "creation_date"), "raw_text": scalar(v, "description"),
        "features_json": features(dataset_id=scalar(v, "id"), file_types=kinds, tags=strings(member(v, "tags"))), "notes": F.lit("Metadata only; the linked archives were not read."),
    }


def _column(d: DataFrame, name: str) -> Column:
    """A column by tolerant name (case, blanks and hyphens don't matter), else null."""
    plain = lambda x: x.strip().lower().replace(" ", "_").replace("-", "_")
    found = next((c for c in d.columns if plain(c) == plain(name)), None)
    return d[f"`{found}`"].cast("string") if found else F.lit(None).cast("string")


@dataclass(frozen=True)
class Module:
    name: str
    priority: int
    dataset: str
    source_type: str
    category: str
    license: str
    fields: Callable[[DataFrame], dict[str, Column]]
    #: Rows of an input folder, with ``file``.
    read: Callable[[SparkSession, str], DataFrame]


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of files with their number in the file, however the files were split.

    Blocks of a file are ordered by their first byte, rows within a block keep theirs; a block's rows are numbered by themselves and get
    the counts of the blocks before, so no task holds a whole file.
    """
    own = rows.columns
    block = rows.withColumns({"file": F.col("_metadata.file_path"), "__gm_block": F.col("_metadata.file_block_start"), "__gm_at": F.monotonically_increasing_id()})
    counts = block.groupBy("file", "__gm_block").agg(F.count("*").alias("__gm_n"))
    before = counts.withColumn("__gm_before", F.coalesce(F.sum("__gm_n").over(Window.partitionBy("file").orderBy("__gm_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = block.withColumn("__gm_in", F.row_number().over(Window.partitionBy("file", "__gm_block").orderBy("__gm_at")) - 1).join(before, ["file", "__gm_block"])
    return placed.withColumn("row", F.col("__gm_before") + F.col("__gm_in")).select(*[f"`{c}`" for c in own], "file", "row")


def _csvs(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.options(header=True, multiLine=True, escape='"', mode="DROPMALFORMED", recursiveFileLookup=True, pathGlobFilter="*.csv*").csv(path)
    return _numbered(rows)


def _zip_csv(spark: SparkSession, path: str) -> DataFrame:
    members = readers.zip_members(spark, path, r"UNSW_NB15.*\.csv$")
    header = F.regexp_extract("text", r"^([^\r\n]*)", 1)
    lines = members.select("name", header.alias("header"), F.posexplode(F.split("text", r"\r?\n")).alias("row", "line")).where("trim(line) <> '' and row > 0")
    # members may have different columns: each distinct header is a short list of names
    out = None
    for head in sorted(r.h for r in members.select(header.alias("h")).distinct().collect()):
        names = [c.strip().strip('"') for c in head.split(",")]
        parsed = F.from_csv(F.col("line"), F.lit(", ".join(f"`{c}` string" for c in names)))
        part = lines.where(F.col("header") == head).select(F.col("name").alias("file"), "row", parsed.alias("x")).select("file", "row", "x.*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], "file string, row int, id string")


def _juliet(spark: SparkSession, path: str) -> DataFrame:
    return readers.zip_members(spark, path, r"^(?!.*__MACOSX).*/testcases/.*\.(c|cpp|h|hpp)$")


def _smartbugs(spark: SparkSession, path: str) -> DataFrame:
    rows = readers.documents(spark, path, "vulnerabilities.json").withColumn("path", scalar(F.col("v"), "path"))
    return readers.with_sources(readers.texts(spark, path, "*.sol"), rows, "path", kept=False)


def _defihacklabs(spark: SparkSession, path: str) -> DataFrame:
    incidents = readers.documents(spark, path, "incidents.json").withColumn("name", scalar(F.col("v"), "name"))
    causes = readers.texts(spark, path, "rootcause*.json").select(F.explode(F.try_variant_get(F.try_parse_json("text"), "$", "map<string,variant>")).alias("name", "cause"))
    return incidents.join(causes, "name", "left")


def _owasp(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.options(comment="#", recursiveFileLookup=True, pathGlobFilter="expectedresults*.csv").schema("test_name string, category string, real_vulnerability string, cwe string").csv(path)
    rows = rows.withColumn("file", F.col("_metadata.file_path")).withColumn("java", F.concat("test_name", F.lit(".java")))
    return readers.with_sources(readers.texts(spark, path, "*.java"), rows, "java")


def _crapi(spark: SparkSession, path: str) -> DataFrame:
    spec = readers.texts(spark, path, "*openapi*.json").select(endpoint_count(F.try_parse_json("text")).alias("n")).first()
    return challenges(readers.texts(spark, path, "challenges.md"), spec.n if spec else 0)


def _advisories(spark: SparkSession, path: str) -> DataFrame:
    return readers.documents(spark, path, "*.json").unionByName(readers.yaml_documents(spark, path))


_THREAT, _AI, _PHISH = "Threat Intelligence, CVE, Advisory & Taxonomy", "AI, LLM & ML Security", "Phishing, Social Engineering & Fraud"
_SUPPLY, _CHAIN, _CODE = "Supply Chain & Open Source Package Security", "Cryptocurrency & Blockchain Attacks", "Vulnerable Code & Software Weaknesses"

MODULES = {
    m.name: m
    for m in (
        Module("cti_mitre_attack_stix", 1, "mitre_attack", "cti_taxonomy", _THREAT, "ATT&CK-Terms", mitre, lambda s, p: readers.documents(s, p, "*-attack.json")),
        Module("cti_capec_attack_patterns", 1, "capec", "cti_taxonomy", _THREAT, "CAPEC-Terms", capec, lambda s, p: readers.xml(s, p, "Attack_Pattern", CAPEC_XML).withColumn("_Typical_Severity", F.col("Typical_Severity")).withColumn("file", F.lit(p))),
        Module("advisory_nvd_cve", 1, "nvd_cve", "vulnerability_advisory", _THREAT, "NVD-Public-Domain", nvd, lambda s, p: readers.documents(s, p, "*.json")),
        Module("supply_chain_osv", 1, "osv", "package_metadata", _SUPPLY, "CC-BY-4.0", osv, lambda s, p: readers.zip_members(s, p, r"\.json$")),
        Module("supply_chain_github_advisory", 1, "github_advisory", "package_metadata", _SUPPLY, "CC-BY-4.0", ghsa, _advisories),
        Module("phishing_phishtank", 1, "phishtank", "url", _PHISH, "restricted:tos", phishtank, _csvs),
        Module("phishing_balanced_urls", 1, "balanced_urls", "url", _PHISH, "UNKNOWN", balanced_urls, lambda s, p: readers.documents(s, p, "*.json")),
        Module("ai_security_owasp_genai_top10", 1, "owasp_genai", "prompt_text", _AI, "CC-BY-SA-4.0", owasp_llm, lambda s, p: llm_risks(readers.texts(s, p, "*.{md,html,txt}"))),
        Module("ai_security_giskard_prompt_injections", 1, "giskard", "prompt_text", _AI, "Apache-2.0", giskard, _csvs),
        Module("ai_security_lakera_gandalf", 1, "lakera_gandalf", "prompt_text", _AI, "MIT", lakera, lambda s, p: _numbered(s.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(p))),
        Module("ai_security_huggingface_prompt_injection", 1, "hf_prompt_injection", "prompt_text", _AI, "UNKNOWN", hugging, _csvs),
        Module("ai_security_hackaprompt", 1, "hackaprompt", "prompt_text", _AI, "MIT", hackaprompt, _csvs),
        Module("blockchain_smartbugs_curated", 2, "smartbugs", "smart_contract_code", _CHAIN, "Apache-2.0", smartbugs, _smartbugs),
        Module("blockchain_defihacklabs_incidents", 2, "defihacklabs", "defi_incident", _CHAIN, "UNKNOWN", defihacklabs, _defihacklabs),
        Module("malware_cic_malmem_2022", 2, "cic_malmem_2022", "malware_features", "Malware & PE/Memory Features", "restricted:academic", malmem, _csvs),
        Module("network_unsw_nb15", 2, "unsw_nb15", "network_flow", "Network Intrusion & Traffic Attacks", "restricted:academic", unsw, _zip_csv),
        Module("vulnerable_code_sard_juliet", 3, "sard_juliet", "vulnerable_code", _CODE, "NIST-Public-Domain", juliet, _juliet),
        Module("web_owasp_benchmark", 3, "owasp_benchmark", "vulnerable_code", "Web Application Security", "GPL-2.0", owasp_benchmark, _owasp),
        Module("api_owasp_crapi", 3, "owasp_crapi", "api_request", "API Security", "Apache-2.0", crapi, _crapi),
        Module("host_otrf_security_datasets", 3, "otrf", "host_telemetry", "Endpoint, Host & Windows/Sysmon Telemetry", "MIT", otrf, lambda s, p: readers.yaml_documents(s, p).where(F.col("file").contains("_metadata/"))),
    )
}


def to_silver(rows: DataFrame, module: Module) -> DataFrame:
    """The thirty columns of a module's rows; record_id is the module and the SHA-1 of the row's key. binary_label is 1 unless said."""
    fields = module.fields(rows)
    keep = fields.pop("keep", F.lit(True))
    key, binary = fields.pop("key"), fields.pop("binary", F.lit(1))
    file = rows["file"] if "file" in rows.columns else F.lit(None).cast("string")
    fixed = {
        "record_id": module_record_id(module.name, F.coalesce(key, F.lit(""))), "source_dataset": F.lit(module.dataset), "source_type": F.lit(module.source_type), "main_category": F.lit(module.category),
        "binary_label": binary, "source_file": F.coalesce(file, F.lit(module.dataset)), "license": F.lit(module.license), "schema_version": F.lit(SCHEMA_VERSION), "ingested_at": F.current_timestamp(),
    }
    everything = fields | fixed
    columns = [everything.get(c, F.lit(None)).cast(_TYPES.get(c, "string")).alias(c) for c in SILVER]
    return rows.where(F.coalesce(keep, F.lit(False))).select(*columns)


def run_module(spark: SparkSession, name: str, path: str, most: int | None = None) -> DataFrame:
    """Silver rows of one source folder, one per record_id, sorted by it.

    Of several rows the first counts by file and content. With ``most``, as many rows as that are taken in the same order before
    duplicates go; by default all are.
    """
    module = MODULES[name]
    rows = to_silver(module.read(spark, path), module)
    order = ["source_file", "record_id", *[c for c in SILVER if c not in ("source_file", "record_id", "ingested_at")]]
    if most is not None:
        rows = rows.orderBy(*order).limit(most)
    return first_wins(rows, "record_id", order).orderBy("record_id")

"""Readers, parsers and sinks as queries: round trips of the tables through files, and small feeds of every module.

Files are written below the shared folder of spark.checkpoint.dir. The SQL of a feed states its silver rows by hand.
"""

from __future__ import annotations

import gzip
import io
import json
import os
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill import runner
from gritmill.operators import curate, dedup, inventory, validate
from gritmill.plans import sql
from gritmill.session import ensure_checkpoint_dir, table
from gritmill.sources import legacy, parsers, paths, readers, sinks


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/feed-{uuid.uuid4().hex}"


def _zip(**members: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return out.getvalue()


# -- round trips ----------------------------------------------------------------------------------------------------
_TEXTS = ("record_id", "source_id", "normalized_text", "cve", "metadata")


def jsonl_round_trip(spark, sf_dir):
    """JSON lines written and read again, nulls kept."""
    rows, path = table(spark, sf_dir, "gold_unified").select(*_TEXTS, "quality_score"), f"{_folder(spark)}/t.jsonl"
    sinks.write_table(rows.where(~F.isnan("quality_score") | F.col("quality_score").isNull()), path, "jsonl")
    return readers.read_table(spark, path, rows.schema)


def csv_round_trip(spark, sf_dir):
    """Gzipped CSV: quotes, line ends and commas within fields stay; empty strings are null, as in the format."""
    rows, path = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "title"), f"{_folder(spark)}/t.csv.gz"
    sinks.write_table(rows, path, "csv.gz")
    return readers.read_table(spark, path, "doc_id long, lang string, source string, title string")


def parquet_json_columns(spark, sf_dir):
    """Nested columns of unified gold as JSON text with sorted keys."""
    silver = dedup.once(table(spark, sf_dir, "silver_records"), "record_id", "ingested_at")
    path = f"{_folder(spark)}/t.parquet"
    gold = curate.unify(silver).select("silver_id", "metadata", "mitre_attack_ids")
    sinks.write_table(sinks.columnar(gold), path, "parquet")
    done = readers.read_table(spark, path)
    return done.select("silver_id", "mitre_attack_ids", F.array_join(F.sort_array(F.json_object_keys("metadata")), ",").alias("keys"), F.get_json_object("metadata", "$.source_type").alias("source_type"), F.get_json_object("metadata", "$.features").alias("features"))


def split_files(spark, sf_dir):
    """One folder of JSON lines per split."""
    path = _folder(spark)
    sinks.write_splits(table(spark, sf_dir, "sft_examples").distinct().select("example_id", "split", "task_type"), path)
    return spark.read.json(path).groupBy("split", "task_type").agg(F.count("*").alias("n"))


def appended_predictions(spark, sf_dir):
    path = f"{_folder(spark)}/p.jsonl"
    gold = table(spark, sf_dir, "gold_benchmark").select("record_id", "split", F.col("gold_label").alias("prediction")).distinct()
    for split in ("train", "test"):
        sinks.append_predictions(gold.where(F.col("split") == split), path)
    return readers.read_table(spark, path).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records"))


def silver_files(spark, sf_dir):
    """Parquet and gzipped CSV of one table, and what is refused beyond the row cap."""
    path = _folder(spark)
    silver = dedup.once(table(spark, sf_dir, "silver_records"), "record_id", "ingested_at")
    some = silver.where("main_category = 'API Security'")
    n = sinks.write_silver(some, path)
    try:
        sinks.write_silver(some, f"{path}-none", most=1)
        refused = False
    except sinks.RowCapExceeded:
        refused = True
    parts = spark.read.parquet(f"{path}/parquet").agg(F.count("*").alias("parquet_rows")), readers.csv(spark, f"{path}/csv").agg(F.count("*").alias("csv_rows"))
    return parts[0].join(parts[1]).withColumns({"n": F.lit(n), "refused": F.lit(refused)})


def union_of_tables(spark, sf_dir):
    """Tables with different columns by name, with their file."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("eval_items", "source_feeds", "sampling_targets")]
    return readers.load_tables(spark, paths).groupBy("__source_file").agg(F.count("*").alias("n"), F.count("suite").alias("suites"), F.count("zone").alias("zones"), F.sum("min_rows").alias("least"))


def projected_scan(spark, sf_dir):
    """Two columns of a table, the first rows by text."""
    return readers.read_table(spark, f"{sf_dir}/eval_items.parquet").select("suite", "text").orderBy("text").limit(20)


_TABLES = ("customer", "documents", "eval_items", "gold_benchmark", "gold_unified", "nvd_items", "orders", "part", "sampling_targets", "sft_examples", "silver_records", "source_feeds", "supplier")


def row_counts(spark, sf_dir):
    """Rows of files from their metadata, and what kind of table each is."""
    rows = [(name, readers.cheap_count(os.path.realpath(f"{sf_dir}/{name}.parquet")), readers.kind_of(table(spark, sf_dir, name).columns)) for name in _TABLES]
    return spark.createDataFrame(rows, "name string, n long, kind string")


def discovered(spark, sf_dir):
    """Tables of a folder by the ways to find them."""
    root = _folder(spark)
    for name in ("B src/t.csv", "B src/t.jsonl", "B src/t_metadata.json", "_x/t.csv", "a/_dedup/q.csv", "a/z.jsonl", "a/z.csv", "top.csv", "report.csv"):
        paths.put(spark, f"{root}/{name}", '{"status": "ok"}' if name.endswith("metadata.json") else "record_id\n1\n")
    local = paths.local(root)
    found = [("unified", f.source_id, f.path.rsplit("/", 1)[1]) for f in readers.discover(local)] + [("globs", os.path.basename(os.path.dirname(p)).lower().replace(" ", "_"), os.path.basename(p)) for p in readers.table_files(local, ("*/*",))]
    found += [("sidecar", readers.sidecar(f"{local}/B src").get("status"), "t_metadata.json")]
    paths.put(spark, f"{root}/silver_manifest.csv", "silver_module,output_path_parquet\na,a/z.jsonl\nb,none.parquet\n")
    found += [("manifest", "a", os.path.basename(p)) for p in readers.table_files(local)]
    return spark.createDataFrame(found, "way string, source string, file string")


def file_health(spark, sf_dir):
    """Flags, duplicates and folders of a small set of raw files."""
    root = _folder(spark)
    for name, content in {"nvd_cve/a.json": "x", "nvd_cve/b.JSON": "x", "nvd_cve/LICENSE": "l", "osv/run.sh": "y", "osv/part.crdownload": "z", "broken_set/q.csv": "q", "loose.csv": "x"}.items():
        paths.put(spark, f"{root}/{name}", content)
    files = inventory.listing(spark, root)
    local = paths.local(root)
    tables = inventory.health_tables(inventory.with_fingerprints(files, local))
    out = inventory.folder_inventory(files).select(F.lit("folder").alias("kind"), F.concat_ws(":", "dataset_folder", "source_type", "file_count", "total_size_bytes", "primary_file_types", F.col("license_known").cast("string"), F.col("has_suspicious_binaries").cast("string")).alias("item"))
    for name, df in tables.items():
        item = F.concat_ws(":", "path", *(["group_id"] if name == "duplicate_candidates" else []))
        out = out.unionByName(df.select(F.lit(name).alias("kind"), item.alias("item")))
    return out


# -- drivers --------------------------------------------------------------------------------------------------------
def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.once(table(spark, sf_dir, "silver_records"), "record_id", "ingested_at")


def _counted(spark: SparkSession, manifest: dict) -> DataFrame:
    rows = [("total", "", manifest["total_records"])] + [(g.removeprefix("counts_by_"), k, n) for g, counts in manifest.items() if g.startswith("counts_by_") for k, n in counts.items()]
    return spark.createDataFrame(rows, "dimension string, value string, n long")


def driver_unified(spark, sf_dir):
    """Unified gold through its driver: files, contract, manifest."""
    return _counted(spark, runner.build_unified(spark, _silver(spark, sf_dir), _folder(spark)))


def driver_benchmark(spark, sf_dir):
    return _counted(spark, runner.build_benchmark(spark, _silver(spark, sf_dir), _folder(spark), 400))


def driver_answers(spark, sf_dir):
    """Answers in two runs, the second of which goes on where the first stopped."""
    gold, out = dedup.once(table(spark, sf_dir, "gold_benchmark"), "record_id", "created_at"), _folder(spark)
    first = runner.predict_benchmark(spark, gold, out, most=100)
    last = runner.predict_benchmark(spark, gold, out)
    return spark.read.json(out).agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records")).withColumns({"first": F.lit(first), "last": F.lit(last)})


def driver_examples(spark, sf_dir):
    """Chat examples per split through their driver."""
    gold = dedup.once(table(spark, sf_dir, "gold_benchmark"), "record_id", "created_at")
    tidy = {c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))) for c in ("task_type", "evaluation_head", "metric_group")}
    counts = runner.prepare_examples(spark, gold.withColumns(tidy), _folder(spark), None)
    return spark.createDataFrame([(r["split"], r["rows"]) for r in counts["splits"]], "split string, n long")


def canonical_silver(spark, sf_dir):
    """Silver rows in their own form: empty texts null, composed characters, no control characters."""
    kinds = {c: parsers._TYPES.get(c, "string") for c in parsers.SILVER}
    done = curate.canonical(_silver(spark, sf_dir).drop("license"), kinds, {"license": "UNKNOWN", "severity": "unknown"})
    return done.withColumn("binary_label", F.col("binary_label").cast("int")).select("record_id", "raw_text", "severity", "license", "binary_label", "platform", "notes")


_RULES = {"record_id": {"nullable": False, "unique": True}, "source_type": {"nullable": False}, "severity": {"values": ["info", "low", "medium", "high", "critical", "unknown"]}, "binary_label": {"values": [0, 1]}, "platform": {"nullable": False}}


def contract_issues(spark, sf_dir):
    """Issues of silver_records by a contract of columns."""
    return validate.table_issues(table(spark, sf_dir, "silver_records"), _RULES).groupBy("issue").agg(F.count("*").alias("n"))


# -- feeds of the modules -------------------------------------------------------------------------------------------
_FEEDS: dict[str, dict[str, str | bytes]] = {
    "cti_mitre_attack_stix": {
        "enterprise-attack.json": json.dumps({"objects": [
            {"type": "attack-pattern", "id": "ap--1", "name": "Scan", "description": "Looks around.", "x_mitre_detection": "Watch.", "external_references": [{"source_name": "x"}, {"source_name": "mitre-attack", "external_id": "T1046.001"}], "kill_chain_phases": [{"phase_name": "discovery"}, {"phase_name": "recon"}], "x_mitre_platforms": ["Linux", "Windows"]},
            {"type": "attack-pattern", "id": "ap--2", "name": "Gone", "revoked": True}, {"type": "tool", "id": "t", "name": "no"}, {"type": "attack-pattern", "id": "ap--3", "name": "Bare", "description": "Only this."},
        ]}),
    },
    "cti_capec_attack_patterns": {
        "capec.xml": '<c:Catalog xmlns:c="u"><c:Attack_Pattern ID="7" Name="Blind" Abstraction="Detailed" Status="Draft"><c:Description>Guess.</c:Description><c:Typical_Severity>High</c:Typical_Severity><c:Related_Weaknesses><c:Related_Weakness CWE_ID="89"/><c:Related_Weakness CWE_ID="74"/></c:Related_Weaknesses><c:Mitigations><c:Mitigation>Bind.</c:Mitigation><c:Mitigation>Test.</c:Mitigation></c:Mitigations></c:Attack_Pattern>'
        '<c:Attack_Pattern ID="8" Name="Old" Abstraction="Meta" Status="Deprecated"><c:Description>x</c:Description></c:Attack_Pattern></c:Catalog>',
    },
    "advisory_nvd_cve": {
        "a.json": json.dumps({"vulnerabilities": [{"cve": {"id": "CVE-2020-1", "published": "2020-01-02", "descriptions": [{"lang": "es", "value": "no"}, {"lang": "en", "value": "Overflow."}], "metrics": {"cvssMetricV2": [{"cvssData": {"baseScore": 5.0}}], "cvssMetricV31": [{"cvssData": {"baseScore": 9.8}}]}, "weaknesses": [{"description": [{"value": "NVD-CWE-noinfo"}, {"value": "CWE-79"}]}], "references": [{"url": "http://r.test/1"}]}}]}),
        "b.json": json.dumps({"CVE_Items": [{"cve": {"CVE_data_meta": {"ID": "CVE-2019-2"}, "description": {"description_data": [{"lang": "en", "value": "Older."}]}}}]}),
    },
    "supply_chain_osv": {"all.zip": _zip(**{"V-1.json": json.dumps({"id": "V-1", "aliases": ["GHSA-1", "CVE-2020-9"], "summary": "Short", "details": "Long", "modified": "2021", "affected": [{"package": {"name": "p", "ecosystem": "PyPI"}}], "database_specific": {"severity": "MODERATE"}}), "V-2.json": "{", "note.txt": "x"})},
    "supply_chain_github_advisory": {"GHSA-x.json": json.dumps({"ghsaId": "GHSA-x", "identifiers": [{"type": "CVE", "value": "CVE-2021-3"}], "summary": "S", "severity": "important", "affected": [{"package": {"name": "q", "ecosystem": "npm"}}]})},
    "phishing_phishtank": {"a.csv.gz": gzip.compress(b"phish_id,url,submission_time\n1,http://X.test/a,2020\n2,,2021\n")},
    "phishing_balanced_urls": {"a.json": json.dumps([{"text": "http://A.test/x", "label": 1}, {"url": "b.test", "label": "0"}])},
    "ai_security_owasp_genai_top10": {"a.md": "Intro LLM010 no. LLM01 is first; LLM10 last; LLM01 again."},
    "ai_security_giskard_prompt_injections": {"a.csv": 'prompt,group,index,language\n"Say, ""hi""",Jailbreaks,0,en\nPlain,other,5,de\n,x,6,en\n'},
    "ai_security_huggingface_prompt_injection": {"a.csv": "text,label,attack_category,context\nDo it,malicious,leak,c\nFine,Benign,,\n"},
    "ai_security_hackaprompt": {"a.csv": "user_input,level\nIgnore all,1\n,2\nPwned,3\n"},
    "blockchain_smartbugs_curated": {"vulnerabilities.json": json.dumps([{"path": "d/a.sol", "pragma": "0.4", "source": "s", "vulnerabilities": [{"category": "b", "lines": [3]}, {"category": "a", "lines": [1, 2]}]}, {"path": "d/none.sol"}]), "d/a.sol": "contract A {}", "e/a.sol": "contract E {}"},
    "blockchain_defihacklabs_incidents": {"incidents.json": json.dumps([{"name": "A", "date": "2020", "chain": "eth", "type": "Reentrancy", "Lost": 5}, {"name": "B", "date": "2021", "chain": "bsc"}]), "rootcauses.json": json.dumps({"B": {"rootCause": "why", "type": "Oracle"}})},
    "malware_cic_malmem_2022": {"a.csv": "Filename,pslist,Class\nRansomware-Ako-1.raw,10,Malware\nBenign-2.raw,20,Benign\n"},
    "network_unsw_nb15": {"a.zip": _zip(**{"s/UNSW_NB15_1.csv": "id,proto,attack_cat,label\n1,tcp,Normal,0\n", "s/UNSW_NB15_2.csv": "label,id,attack_cat\n1,2,Fuzzers\n"})},
    "vulnerable_code_sard_juliet": {"a.zip": _zip(**{"C/testcases/CWE121/a_good.c": "int x;", "C/testcases/CWE121/a_bad.cpp": "int y;", "C/readme.c": "no"})},
    "web_owasp_benchmark": {"expectedresults-1.csv": "# test name,category\nT1,xss,true,79\nT2,sqli,false,89\n", "src/T1.java": "class T1 {}"},
    "api_owasp_crapi": {"challenges.md": "# t\n### Challenge 1 - One\nFirst.\n### Challenge 2 - Two\nSecond.", "crapi-openapi.json": json.dumps({"paths": {"/a": {"get": {}, "post": {}}, "/b": {"get": {}}}})},
    "host_otrf_security_datasets": {"_metadata/s.yaml": "id: S1\ntitle: T\ntype: atomic\ndescription: d\nplatform: [Windows]\nattack_mappings:\n- technique: T1003\n  sub-technique: '001'\n  tactics: [TA6]\n- technique: T1059\n  tactics: [TA2]\n"},
}
_SHOWN = "record_id label binary_label attack_name attack_family mitre_tactic mitre_technique_id cwe_id cve_id severity severity_score platform language protocol ecosystem package_name url domain timestamp raw_text".split()
#: By module: (key in SQL, values of columns that are not null); file-dependent keys name the file by ``{file}``.
_EXPECTED: dict[str, list[tuple[str, dict[str, object]]]] = {
    "cti_mitre_attack_stix": [
        ("'T1046.001'", {"label": "attack_technique", "attack_name": "Scan", "attack_family": "T1046", "mitre_tactic": "discovery|recon", "mitre_technique_id": "T1046.001", "platform": "Linux|Windows", "raw_text": "Looks around.\n\nDetection: Watch."}),
        ("'ap--3'", {"label": "attack_technique", "attack_name": "Bare", "raw_text": "Only this."}),
    ],
    "cti_capec_attack_patterns": [("'CAPEC-7'", {"label": "attack_pattern", "attack_name": "Blind", "attack_family": "Detailed", "cwe_id": "CWE-89", "severity": "high", "raw_text": "Guess.\n\nBind.\nTest."})],
    "advisory_nvd_cve": [
        ("'CVE-2020-1'", {"label": "vulnerability_advisory", "cve_id": "CVE-2020-1", "cwe_id": "CWE-79", "severity": "critical", "severity_score": 9.8, "url": "http://r.test/1", "timestamp": "2020-01-02", "raw_text": "Overflow."}),
        ("'CVE-2019-2'", {"label": "vulnerability_advisory", "cve_id": "CVE-2019-2", "severity": "unknown", "raw_text": "Older."}),
    ],
    "supply_chain_osv": [("'V-1'", {"label": "vulnerable_dependency", "attack_name": "V-1", "cve_id": "CVE-2020-9", "severity": "medium", "ecosystem": "PyPI", "package_name": "p", "timestamp": "2021", "raw_text": "Short\n\nLong"})],
    "supply_chain_github_advisory": [("'GHSA-x'", {"label": "vulnerable_dependency", "attack_name": "GHSA-x", "cve_id": "CVE-2021-3", "severity": "high", "ecosystem": "npm", "package_name": "q", "raw_text": "S"})],
    "phishing_phishtank": [("'1'", {"label": "phishing", "url": "http://X.test/a", "domain": "x.test", "timestamp": "2020"})],
    "phishing_balanced_urls": [("'http://A.test/x:1'", {"label": "phishing", "url": "http://A.test/x", "domain": "a.test"}), ("'b.test:0'", {"label": "benign_url", "binary_label": 0, "url": "b.test", "domain": "b.test"})],
    "ai_security_owasp_genai_top10": [
        ("'LLM01'", {"label": "ai_security_risk", "attack_name": "LLM01", "raw_text": "Intro LLM010 no. LLM01 is first; LLM10 last; LLM01 again."}),
        ("'LLM10'", {"label": "ai_security_risk", "attack_name": "LLM10", "raw_text": "Intro LLM010 no. LLM01 is first; LLM10 last; LLM01 again."}),
    ],
    "ai_security_giskard_prompt_injections": [
        ("'Say, \"hi\"'", {"label": "jailbreak_prompt", "attack_name": "jailbreak", "attack_family": "Jailbreaks", "language": "en", "raw_text": 'Say, "hi"'}),
        ("'5'", {"label": "malicious_prompt", "attack_name": "prompt_injection", "attack_family": "other", "language": "de", "raw_text": "Plain"}),
    ],
    "blockchain_smartbugs_curated": [("'d/a.sol'", {"label": "vulnerable_code", "attack_name": "a|b", "language": "solidity", "raw_text": "contract A {}"})],
    "blockchain_defihacklabs_incidents": [
        ("'2020::A::eth'", {"label": "exploit_incident", "attack_name": "A", "attack_family": "Reentrancy", "timestamp": "2020", "platform": "eth", "raw_text": "Incident: A\n\nType: Reentrancy"}),
        ("'2021::B::bsc'", {"label": "exploit_incident", "attack_name": "B", "attack_family": "Oracle", "timestamp": "2021", "platform": "bsc", "raw_text": "Incident: B\n\nType: Oracle\n\nwhy"}),
    ],
    "malware_cic_malmem_2022": [
        ("'Ransomware-Ako-1.raw'", {"label": "malicious", "attack_name": "Ako", "attack_family": "Ransomware", "platform": "windows", "raw_text": "Ransomware-Ako-1.raw"}),
        ("'Benign-2.raw'", {"label": "benign", "binary_label": 0, "platform": "windows", "raw_text": "Benign-2.raw"}),
    ],
    "network_unsw_nb15": [
        ("'s/UNSW_NB15_1.csv:1'", {"label": "benign", "binary_label": 0, "protocol": "tcp", "raw_text": "UNSW-NB15 flow s/UNSW_NB15_1.csv:1"}),
        ("'s/UNSW_NB15_2.csv:2'", {"label": "intrusion", "attack_name": "Fuzzers", "attack_family": "Fuzzers", "raw_text": "UNSW-NB15 flow s/UNSW_NB15_2.csv:2"}),
    ],
    "vulnerable_code_sard_juliet": [
        ("'C/testcases/CWE121/a_good.c'", {"label": "non_vulnerable_code", "binary_label": 0, "attack_name": "a_good.c", "cwe_id": "CWE-121", "language": "C", "raw_text": "int x;"}),
        ("'C/testcases/CWE121/a_bad.cpp'", {"label": "vulnerable_code", "attack_name": "a_bad.cpp", "cwe_id": "CWE-121", "language": "C++", "raw_text": "int y;"}),
    ],
    "web_owasp_benchmark": [
        ("'T1'", {"label": "vulnerable_code", "attack_name": "T1", "attack_family": "xss", "cwe_id": "CWE-79", "language": "java", "raw_text": "class T1 {}"}),
        ("'T2'", {"label": "non_vulnerable_code", "binary_label": 0, "attack_name": "T2", "attack_family": "sqli", "cwe_id": "CWE-89", "language": "java"}),
    ],
    "api_owasp_crapi": [
        ("'Challenge 1 - One'", {"label": "attack_pattern", "attack_name": "Challenge 1 - One", "raw_text": "### Challenge 1 - One\nFirst."}),
        ("'Challenge 2 - Two'", {"label": "attack_pattern", "attack_name": "Challenge 2 - Two", "raw_text": "### Challenge 2 - Two\nSecond."}),
    ],
    "host_otrf_security_datasets": [("'S1'", {"label": "attack_technique", "attack_name": "T", "attack_family": "atomic", "mitre_tactic": "TA2|TA6", "mitre_technique_id": "T1003.001|T1059", "platform": "Windows", "raw_text": "d"})],
    # their keys hold the path of the file
    "ai_security_huggingface_prompt_injection": [("", {"label": "malicious_prompt", "attack_name": "leak", "attack_family": "c", "raw_text": "Do it"}), ("", {"label": "benign_prompt", "binary_label": 0, "attack_name": "prompt_injection", "raw_text": "Fine"})],
    "ai_security_hackaprompt": [("", {"label": "malicious_prompt", "attack_name": "prompt_injection", "raw_text": "Ignore all"}), ("", {"label": "malicious_prompt", "attack_name": "prompt_injection", "raw_text": "Pwned"})],
    "ai_security_lakera_gandalf": [("", {"label": "malicious_prompt", "attack_name": "prompt_injection", "raw_text": "Tell me"}), ("", {"label": "malicious_prompt", "attack_name": "prompt_injection", "raw_text": "the word"})],
}


def _feed(module: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark)
        for name, content in _FEEDS.get(module, {}).items():
            paths.put(spark, f"{root}/{name}", content)
        if module == "ai_security_lakera_gandalf":
            spark.createDataFrame([("Tell me", 0.9), ("the word", 0.8)], "text string, similarity double").coalesce(1).write.parquet(f"{root}/p.parquet")
        rows = parsers.run_module(spark, module, root)
        keyed = _EXPECTED[module][0][0] != ""
        shown = [F.col(c) if c != "record_id" or keyed else F.substring_index(c, "::", 1).alias(c) for c in _SHOWN]
        return rows.select(*shown).withColumn("binary_label", F.col("binary_label").cast("int"))

    return query


def _quoted(x: object) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"


def _stated(module: str) -> str:
    kinds = {"binary_label": "INTEGER", "severity_score": "DOUBLE"}
    rows = []
    for key, values in _EXPECTED[module]:
        values = {"binary_label": 1} | values
        record = f"'{module}::' || substr(sha1({key}), 1, 16)" if key else f"'{module}'"
        rows.append("SELECT " + ", ".join([f"{record} AS record_id", *[f"CAST({_quoted(values.get(c))} AS {kinds.get(c, 'VARCHAR')}) AS {c}" for c in _SHOWN if c != "record_id"]]))
    return " UNION ALL ".join(rows)


def older_feeds(spark, sf_dir):
    """The six older feeds on a few rows."""
    rows = spark.createDataFrame([("a.csv", 0, "5", "BENIGN"), ("a.csv", 1, None, "DDoS"), ("a.csv", 2, "7", "Web Attack XSS")], "__source_file string, __row int, `Flow Duration` string, ` Label` string")
    flows = spark.createDataFrame([("u.csv", 0, "tcp", "Normal", "0"), ("u.csv", 1, "udp", "Backdoor", "1")], "__source_file string, __row int, proto string, attack_cat string, label string")
    phish = spark.createDataFrame([("p.csv", 0, "9", "http://a.test/x")], "__source_file string, __row int, phish_id string, url string")
    haus = spark.createDataFrame([("h.csv", 0, "3", "http://b.test", "malware_download")], "__source_file string, __row int, id string, url string, threat string")
    documents = lambda text: spark.createDataFrame([("f", text)], "file string, text string").select("file", F.try_parse_json("text").alias("v"))
    nvd = documents(json.dumps({"cve": {"id": "CVE-2020-1", "descriptions": [{"lang": "en", "value": "Text."}], "weaknesses": [{"description": [{"value": "CWE-79"}]}]}, "metrics": {"x": [{"baseSeverity": "HIGH"}]}}))
    kev = documents(json.dumps({"vulnerabilities": [{"cveID": "CVE-2021-2", "vulnerabilityName": "N", "shortDescription": "D", "requiredAction": "A"}]}))
    out = legacy.cicids(rows)
    for part in (legacy.unsw(flows), legacy.phishtank(phish), legacy.urlhaus(haus), legacy.nvd(nvd), legacy.kev(kev), legacy.smoke(spark)):
        out = out.unionByName(part)
    return out.select("record_id", "main_category", "attack_name", "label", F.col("binary_label").cast("int").alias("binary_label"), "mitre_tactic", "mitre_technique_id", "cwe_id", "cve_id", "severity", "raw_text_or_features", "is_safe_representation", "split")


_OLDER = (
    ("cicids2017:a.csv:0", "network_intrusion", "Benign Flow", "benign", 0, None, None, None, None, None, '{"Flow Duration":"5"}'),
    ("cicids2017:a.csv:1", "denial_of_service", "DDoS", "malicious", 1, "Impact", None, None, None, None, "{}"),
    ("cicids2017:a.csv:2", "web_application_attack", "Web Attack XSS", "malicious", 1, "Initial Access", None, None, None, None, '{"Flow Duration":"7"}'),
    ("unsw_nb15:u.csv:0", "network_intrusion", "Benign Flow", "benign", 0, None, None, None, None, None, '{"proto":"tcp"}'),
    ("unsw_nb15:u.csv:1", "malware", "Backdoor", "malicious", 1, "Execution", None, None, None, None, '{"proto":"udp"}'),
    ("phishtank:9", "phishing_social_engineering", "Phishing URL", "phishing", 1, "Initial Access", "T1566", None, None, None, 'hxxp://a[.]test/x {"phish_id":"9"}'),
    ("urlhaus:3", "malware", "malware_download", "malicious", 1, "Initial Access", None, None, None, None, 'hxxp://b[.]test {"id":"3","threat":"malware_download"}'),
    ("nvd:CVE-2020-1", "vulnerability", "CVE-2020-1", "vulnerable", 1, None, None, "CWE-79", "CVE-2020-1", "high", "Text[.]"),
    ("cisa_kev:CVE-2021-2", "vulnerability", "N", "vulnerable", 1, "Initial Access", None, None, "CVE-2021-2", "critical", "N D A"),
    ("smoke:a", "network_intrusion", "benign", "benign", 0, None, None, None, None, None, "A harmless flow[.]"),
    ("smoke:b", "network_intrusion", "malicious", "malicious", 1, None, None, None, None, None, "A flood of packets[.]"),
    ("smoke:c", "network_intrusion", "phishing", "phishing", 1, None, None, None, None, None, "A link to a copied page[.]"),
)
_OLDER_COLUMNS = "record_id main_category attack_name label binary_label mitre_tactic mitre_technique_id cwe_id cve_id severity raw_text_or_features".split()

QUERIES = {f.__name__: f for f in (jsonl_round_trip, csv_round_trip, parquet_json_columns, split_files, appended_predictions, silver_files, union_of_tables, projected_scan, row_counts, discovered, file_health, older_feeds, driver_unified, driver_benchmark, driver_answers, driver_examples, canonical_silver, contract_issues)}
QUERIES |= {f"feed_{module}": _feed(module) for module in _EXPECTED}

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_KNOWN = lambda c: f"(CASE WHEN lower(regexp_replace(CAST({c} AS VARCHAR), '^{_WS}+|{_WS}+$', '', 'g')) NOT IN ('', 'nan', 'none', '<na>', 'null') THEN regexp_replace(CAST({c} AS VARCHAR), '^{_WS}+|{_WS}+$', '', 'g') END)"
_META = "attack_family attack_name binary_label ecosystem features ingested_at language main_category package_name platform protocol schema_version severity_score source_dataset source_file source_type".split()
_FEATURES = f"CASE WHEN {_KNOWN('features_json')} NOT IN ('{{}}', '[]') THEN trim(features_json) END"
_KEYS = ", ".join(f"CASE WHEN {_FEATURES if c == 'features' else _KNOWN(c)} IS NOT NULL THEN '{c}' END" for c in _META)
SQL = {f"feed_{module}": _stated(module) for module in _EXPECTED} | {
    "jsonl_round_trip": f"SELECT {', '.join(_TEXTS)}, quality_score FROM gold_unified WHERE quality_score IS NULL OR NOT isnan(quality_score)",
    "csv_round_trip": "SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, nullif(title, '') AS title FROM documents",
    "parquet_json_columns": f"""WITH s AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY ingested_at) AS rn FROM silver_records) WHERE rn = 1),
      t AS (SELECT *, nullif(trim(regexp_replace(CASE WHEN coalesce({_KNOWN('raw_text')}, {_KNOWN('features_json')}) NOT IN ('{{}}', '[]') THEN coalesce({_KNOWN('raw_text')}, {_KNOWN('features_json')}) END, '{_WS}+', ' ', 'g')), '') AS txt FROM s),
      q AS (SELECT *, list_sort(list_distinct(list_concat(coalesce(list_transform(regexp_extract_all(txt, '\\bT\\d{{4}}(?:\\.\\d{{3}})?\\b'), lambda i: upper(i)), []::VARCHAR[]), CASE WHEN {_KNOWN('mitre_technique_id')} IS NULL THEN []::VARCHAR[] ELSE [upper({_KNOWN('mitre_technique_id')})] END))) AS tq FROM t)
      SELECT coalesce({_KNOWN('record_id')}, 'row0') AS silver_id, '[' || array_to_string(list_transform(tq, lambda i: '"' || i || '"'), ',') || ']' AS mitre_attack_ids, array_to_string(list_filter([{_KEYS}], lambda k: k IS NOT NULL), ',') AS keys, {_KNOWN('source_type')} AS source_type, {_FEATURES} AS features FROM q""",
    "split_files": "SELECT split, task_type, count(*) AS n FROM (SELECT DISTINCT * FROM sft_examples) GROUP BY ALL",
    "appended_predictions": "SELECT split, count(*) AS n, count(DISTINCT record_id) AS records FROM (SELECT DISTINCT record_id, split, gold_label FROM gold_benchmark WHERE split IN ('train', 'test')) GROUP BY split",
    "silver_files": "SELECT count(DISTINCT record_id) AS parquet_rows, count(DISTINCT record_id) AS csv_rows, count(DISTINCT record_id)::INTEGER AS n, count(DISTINCT record_id) > 1 AS refused FROM (SELECT record_id, main_category, row_number() OVER (PARTITION BY record_id ORDER BY ingested_at) AS rn FROM silver_records) WHERE rn = 1 AND main_category = 'API Security'",
    "union_of_tables": "SELECT 'eval_items.parquet' AS __source_file, count(*) AS n, count(suite) AS suites, 0::BIGINT AS zones, NULL::BIGINT AS least FROM eval_items UNION ALL SELECT 'source_feeds.parquet', count(*), 0, count(zone), NULL FROM source_feeds UNION ALL SELECT 'sampling_targets.parquet', count(*), 0, 0, sum(min_rows)::BIGINT FROM sampling_targets",
    "projected_scan": "SELECT suite, text FROM eval_items ORDER BY text LIMIT 20",
    "row_counts": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, '{ {'sft_examples': 'sft', 'gold_benchmark': 'gold', 'gold_unified': 'unified', 'silver_records': 'silver'}.get(n, 'unknown')}' AS kind FROM {n}" for n in _TABLES),
    "discovered": "SELECT * FROM (VALUES ('unified', 'b_src', 't.jsonl'), ('unified', 'a', 'z.jsonl'), ('unified', 'top', 'top.csv'), ('globs', 'b_src', 't.jsonl'), ('globs', 'a', 'z.jsonl'), ('globs', '_x', 't.csv'), ('sidecar', 'ok', 't_metadata.json'), ('manifest', 'a', 'z.jsonl')) t(way, source, file)",
    "file_health": "SELECT * FROM (VALUES ('folder', 'nvd_cve:vulnerability_advisory:3:3:.json|<none>:true:false'), ('folder', 'osv:package_metadata:2:2:.crdownload|.sh:false:true'), ('duplicate_candidates', 'loose.csv:1'), ('duplicate_candidates', 'nvd_cve/a.json:1'), ('duplicate_candidates', 'nvd_cve/b.JSON:1'), ('incomplete_downloads', 'osv/part.crdownload'), ('non_dataset_items', 'broken_set/q.csv'), ('loose_files_needing_review', 'loose.csv'), ('suspicious_binaries', 'osv/run.sh')) t(kind, item)",
    "older_feeds": "SELECT *, true AS is_safe_representation, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, ('0x' || substr(sha256(record_id), 1, 8))::BIGINT / 4294967295.0 AS u FROM (VALUES " + ", ".join("(" + ", ".join(_quoted(x) for x in row) + ")" for row in _OLDER) + f") t({', '.join(_OLDER_COLUMNS)}))",
}
SQL["older_feeds"] = SQL["older_feeds"].replace("SELECT *, true AS", f"SELECT {', '.join(_OLDER_COLUMNS)}, true AS")
_DIMS = {"domain": "domain", "split": "split", "label": "label", "source": "source_id", "category": "category"}
_HEADS = {"head": "evaluation_head", "task": "task_type", "split": "split", "label": "gold_label"}


def _manifest(name: str, dimensions: dict[str, str]) -> str:
    return " UNION ALL ".join([f"SELECT 'total' AS dimension, '' AS value, count(*) AS n FROM {name}", *[f"SELECT '{d}', coalesce({c}, 'None'), count(*) FROM {name} GROUP BY 2" for d, c in dimensions.items()]])


SQL |= {
    "driver_unified": f"WITH {sql.UNIFIED} {_manifest('g', _DIMS)}",
    "driver_benchmark": f"WITH {sql.BENCH}, {sql.capped('b', ['evaluation_head', 'task_type', 'main_category', 'gold_label'], 'record_id', 400)} {_manifest('kept', _HEADS)}",
    "driver_answers": "SELECT count(DISTINCT record_id) AS n, count(DISTINCT record_id) AS records, 100 AS first, count(DISTINCT record_id)::INTEGER AS last FROM gold_benchmark",
    "driver_examples": f"WITH {sql.SFT} SELECT sp AS split, count(*) AS n FROM p6 WHERE reason IS NULL GROUP BY 1",
    "canonical_silver": f"""WITH {sql.SILVER} SELECT {sql.filled('record_id')} AS record_id, nullif(nfc_normalize({sql.strip(f"regexp_replace({sql.filled('raw_text')}, '[^\\PC\\n\\t]', '', 'g')")}), '') AS raw_text,
      coalesce({sql.filled('severity')}, 'unknown') AS severity, 'UNKNOWN' AS license, binary_label::INTEGER AS binary_label, {sql.filled('platform')} AS platform, {sql.filled('notes')} AS notes FROM s0""",
    "contract_issues": """WITH i AS (SELECT 'missing record_id' AS issue FROM silver_records WHERE record_id IS NULL UNION ALL SELECT 'missing source_type' FROM silver_records WHERE source_type IS NULL UNION ALL SELECT 'missing platform' FROM silver_records WHERE platform IS NULL
      UNION ALL SELECT 'invalid severity' FROM silver_records WHERE severity NOT IN ('info', 'low', 'medium', 'high', 'critical', 'unknown') UNION ALL SELECT 'invalid binary_label' FROM silver_records WHERE binary_label NOT IN (0, 1)
      UNION ALL SELECT 'repeated record_id' FROM silver_records WHERE record_id IS NOT NULL GROUP BY record_id HAVING count(*) > 1) SELECT issue, count(*) AS n FROM i GROUP BY 1""",
}

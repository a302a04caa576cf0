"""Inventories of raw files and of normalised modules, as DataFrames over file listings and metadata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions import classify

# Folders to pass over, endings of executable content, the endings counted as such per folder, sizes of large items.
IGNORED = ("venv", ".venv", "__pycache__", "node_modules", ".cache", ".ipynb_checkpoints", ".git")
SUSPICIOUS = (".exe", ".dll", ".so", ".elf", ".apk", ".bin", ".sh", ".ps1", ".bat", ".cmd", ".sol", ".js")
BINARIES = (".exe", ".dll", ".so", ".elf", ".apk", ".bin", ".sh", ".js")
LARGE_FILE, LARGE_FOLDER, WHOLE_HASH, EDGE = 1024**3, 5 * 1024**3, 500 * 1024**2, 1024**2
# Source type and category by words in a folder's name, in the order in which they are tried.
CATEGORIES = (
    (("nvd",), "vulnerability_advisory", "Threat Intelligence, CVE, Advisory & Taxonomy"),
    (("mitre", "capec"), "cti_taxonomy", "Threat Intelligence, CVE, Advisory & Taxonomy"),
    (("github_advisory", "osv"), "package_metadata", "Supply Chain & Open Source Package Security"),
    (("phish",), "phishing_url", "Phishing, Social Engineering & Fraud"),
    (("huggingface_ai_security",), "prompt_text", "AI, LLM & ML Security"),
    (("prompt", "gandalf", "giskard", "genai"), "prompt_text", "AI, LLM & ML Security"),
    (("smartbugs", "defi"), "smart_contract_code", "Cryptocurrency & Blockchain Attacks"),
)
# Module and priority of each raw folder.
PLAN = {
    "mitre_attack_stix": ("cti_mitre_attack_stix", 1), "github_advisory_database": ("supply_chain_github_advisory", 1), "osv": ("supply_chain_osv", 1), "nvd_cve": ("advisory_nvd_cve", 1),
    "phishtank": ("phishing_phishtank", 1), "phishing_balanced_urls": ("phishing_balanced_urls", 1), "owasp_genai_top10": ("ai_security_owasp_genai_top10", 1),
    "giskard_prompt_injections": ("ai_security_giskard_prompt_injections", 1), "huggingface_ai_security": ("ai_security_lakera_gandalf", 1), "huggingface": ("ai_security_huggingface_prompt_injection", 1),
    "ai_security_prompt_injection": ("ai_security_hackaprompt", 1), "smartbugs_curated": ("blockchain_smartbugs_curated", 2), "defihacklabs_incident_explorer": ("blockchain_defihacklabs_incidents", 2),
    "otrf_security_datasets": ("host_otrf_security_datasets", 3), "owasp_api_security": ("api_owasp_crapi", 3), "owasp_benchmark": ("web_owasp_benchmark", 3),
    "2017-10-01-juliet-test-suite-for-c-cplusplus-v1-3.zip": ("vulnerable_code_sard_juliet", 3),
}


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, size_bytes) of all files below a folder, by metadata only; paths are relative to it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size_bytes"))
    prefix = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return found.withColumn("path", F.expr("url_decode(replace(path, '+', '%2B'))")).withColumn("path", F.substring_index(F.concat(F.lit("\x01"), F.replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), F.lit(prefix), F.lit("\x01"))), "\x01", -1))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))


def is_ignored(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.exists(parts, lambda p: p.isin(*IGNORED) | F.lower(p).contains("broken"))


def with_fingerprints(files: DataFrame, root: str) -> DataFrame:
    """Adds ``hash`` and ``hash_method``: SHA-256 of the whole file, or of the first and last MiB and the size beyond 500 MiB.

    Executors read the files in pieces from a path that all of them share; a file that can't be read has no hash.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, size in zip(batch["path"], batch["size_bytes"]):
                digest, whole = hashlib.sha256(), size <= WHOLE_HASH
                try:
                    with open(f"{root}/{path}", "rb") as file:
                        if whole:
                            while block := file.read(EDGE):
                                digest.update(block)
                        else:
                            digest.update(file.read(EDGE))
                            file.seek(size - EDGE)
                            digest.update(file.read(EDGE) + str(size).encode())
                    out.append((path, size, digest.hexdigest(), "full" if whole else "partial"))
                except OSError:
                    out.append((path, size, None, "unreadable"))
            yield pd.DataFrame(out, columns=["path", "size_bytes", "hash", "hash_method"])

    return files.select("path", "size_bytes").mapInPandas(run, "path string, size_bytes long, hash string, hash_method string")


def input_hash(fingerprints: DataFrame) -> str:
    """One hash of a module's input files: equal if paths, sizes and contents are. Collects one row."""
    line = F.concat_ws("\x00", "path", F.col("size_bytes").cast("string"), F.coalesce("hash", F.lit("")))
    # order does not matter, so partial results of executors are combined: sum of 60-bit prefixes and their count
    row = fingerprints.agg(F.sum(F.conv(F.substring(F.sha2(line, 256), 1, 15), 16, 10).cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).first()
    return hashlib.sha256(f"{row.s}:{row.n}".encode()).hexdigest()


def duplicate_files(fingerprints: DataFrame) -> DataFrame:
    """Files that share size and hash, with a dense ``group_id`` in the order of the groups' first paths."""
    groups = fingerprints.where("hash is not null").groupBy("size_bytes", "hash").agg(F.count("*").alias("n"), F.min("path").alias("first")).where("n > 1")
    # numbers without one task over all groups: places within ranges of first paths, then the sizes of the ranges before
    ordered = groups.orderBy("first").select("size_bytes", "hash", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    starts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("low"))
    before = starts.alias("a").join(starts.alias("b"), F.col("b.part") < F.col("a.part"), "left").groupBy("a.part", "a.low").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    numbered = ordered.join(F.broadcast(before), "part").select("size_bytes", "hash", (F.col("place") - F.col("low") + F.col("before") + 1).alias("group_id"))
    return fingerprints.join(numbered, ["size_bytes", "hash"]).select("path", "size_bytes", "hash", "hash_method", "group_id")


def health_tables(fingerprints: DataFrame) -> dict[str, DataFrame]:
    """The six tables of a check of raw files: duplicates, partial downloads, ignored paths, loose, suspicious and large items."""
    ignored, partial = is_ignored(F.col("path")), F.col("path").endswith(".crdownload")
    usable = fingerprints.where(~ignored & ~partial)
    folder = usable.where(F.col("path").contains("/")).groupBy(F.substring_index("path", "/", 1).alias("path")).agg(F.sum("size_bytes").alias("size_bytes"))
    large = usable.where(F.col("size_bytes") > LARGE_FILE).select("path", F.lit("file").alias("kind"), "size_bytes").unionByName(folder.where(F.col("size_bytes") > LARGE_FOLDER).select("path", F.lit("folder").alias("kind"), "size_bytes"))
    return {
        "duplicate_candidates": duplicate_files(usable),
        "incomplete_downloads": fingerprints.where(~ignored & partial).select("path", F.lit("partial_download").alias("reason")),
        "non_dataset_items": fingerprints.where(ignored).select("path", F.lit("ignored_path").alias("reason")),
        "loose_files_needing_review": usable.where(~F.col("path").contains("/") & (F.col("path") != ".gitkeep")).select("path", "size_bytes", F.lit("root_level_file").alias("reason")),
        "suspicious_binaries": usable.where(suffix(F.col("path")).isin(*SUSPICIOUS)).select("path", "size_bytes", suffix(F.col("path")).alias("extension")),
        "large_items": large,
    }


def guess_category(name: Column) -> Column:
    """Struct (source_type, main_category) by a folder's name."""
    low = F.lower(name)
    make = lambda kind, category: F.struct(F.lit(kind).alias("source_type"), F.lit(category).alias("main_category"))
    ladder = F
    for words, kind, category in CATEGORIES:
        hit = F.lit(False)
        for word in words:
            hit = hit | low.contains(word)
        ladder = ladder.when(hit | (low == "huggingface") if words == ("huggingface_ai_security",) else hit, make(kind, category))
    return ladder.otherwise(make("other", "Miscellaneous / Needs Review"))


def folder_inventory(files: DataFrame) -> DataFrame:
    """One row per raw folder: guesses by name, files, bytes, endings, sample paths, licence files and what needs review."""
    rows = files.where(F.col("path").contains("/") & ~is_ignored(F.col("path"))).withColumns({"dataset_folder": F.substring_index("path", "/", 1), "name": F.substring_index("path", "/", -1), "ending": F.coalesce(F.nullif(suffix(F.col("path")), F.lit("")), F.lit("<none>"))})
    per = rows.groupBy("dataset_folder").agg(
        F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_size_bytes"), F.array_join(F.slice(F.array_sort(F.collect_set("ending")), 1, 12), "|").alias("primary_file_types"),
        F.bool_or(F.lower("name").contains("license")).alias("license_known"), F.bool_or(F.col("name").endswith(".crdownload")).alias("has_partial_downloads"), F.bool_or(F.col("ending").isin(*BINARIES)).alias("has_suspicious_binaries"),
        F.min("path").alias("sample_file_path"),
    )
    return per.withColumn("g", guess_category(F.col("dataset_folder"))).select("dataset_folder", F.replace("dataset_folder", F.lit("_"), F.lit(" ")).alias("detected_dataset_name"), "g.source_type", "g.main_category", *[c for c in per.columns if c != "dataset_folder"])


def category_index(inventory: DataFrame) -> DataFrame:
    return inventory.select("dataset_folder", "source_type", "main_category")


def module_plan(inventory: DataFrame) -> DataFrame:
    """The module that each folder goes to; folders without one need review."""
    plan = F.try_element_at(F.create_map(*[x for k, (m, p) in PLAN.items() for x in (F.lit(k), F.struct(F.lit(m).alias("module"), F.lit(p).alias("priority")))]), F.col("dataset_folder"))
    rows = inventory.withColumn("p", plan)
    return rows.select(
        "dataset_folder", F.coalesce("p.module", F.concat(F.lit("needs_review_"), "dataset_folder")).alias("planned_silver_module"), F.col("main_category").alias("planned_category"),
        F.when(F.col("p").isNotNull(), "implemented").otherwise("not_started").alias("normalizer_status"), F.coalesce("p.priority", F.lit(3)).alias("priority"),
        F.when(F.col("p").isNull(), "deferred_priority").otherwise("").alias("blocker_reason"), F.coalesce(F.col("p.module") == "supply_chain_osv", F.lit(False)).alias("requires_extraction"),
    )


def module_manifest(silver: DataFrame) -> DataFrame:
    """One row per module of a silver table (the part of record_id before ``::``): rows, label counts, licence and its class, status."""
    module = F.substring_index("record_id", "::", 1)
    pairs = silver.groupBy(module.alias("silver_module"), "label").agg(
        F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("source_dataset", "source_type", "main_category", "license", "schema_version")], F.count_if(F.col("binary_label") == 1).alias("attacks"), F.count_if(F.col("binary_label") == 0).alias("harmless")
    )
    one = pairs.groupBy("silver_module").agg(
        F.sum("n").alias("row_count"), *[F.min(c).alias(c) for c in ("source_dataset", "source_type", "main_category", "license", "schema_version")], F.sum("attacks").alias("attacks"), F.sum("harmless").alias("harmless"),
        # a module names few labels
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("label", F.lit("null")).alias("key"), F.col("n").alias("value")))))).alias("label_distribution"),
    )
    return one.withColumns({"license_compatibility": classify.license_class("license"), "status": F.when(F.col("row_count") > 0, "ok").otherwise("skipped")})


def by_status(manifest: DataFrame, *status: str) -> DataFrame:
    return manifest.where(F.col("status").isin(*status))


def rows_by_category(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("main_category").agg(F.sum("row_count").alias("row_count"), F.count("*").alias("modules"))

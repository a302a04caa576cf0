"""Drivers from a folder of inputs to a folder of outputs, as the command line runs them."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.operators import benchmark, curate, evaluate, inventory, predict, reports, sft, validate
from gritmill.sources import parsers, paths, readers, sinks


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    paths.put(spark, path, json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False, default=str))


def silver_tables(spark: SparkSession, root: str) -> DataFrame:
    """All tables below a folder of normalised modules, by name."""
    return readers.load_tables(spark, readers.table_files(paths.local(root)))


def run_modules(spark: SparkSession, raw: str, out: str, names: Iterable[str] | None = None, force: bool = False, dry: bool = False, most: int | None = None) -> list[dict]:
    """Normalises modules in the order of their priority; one that fails is logged and the others go on.

    A module whose inputs have the hash of its last good run is passed over unless ``force``; ``dry`` says what would run. Results are
    ``out/module/module.parquet`` with metadata beside; every step is a line of ``out/_events``, a failure one of ``out/_errors`` too.
    """
    done = []
    for module in sorted((parsers.MODULES[n] for n in (names or parsers.MODULES)), key=lambda m: (m.priority, m.name)):
        folder, table, start = f"{raw}/{module.name}", f"{out}/{module.name}/{module.name}.parquet", time.time()
        event: dict = {"module": module.name, "priority": module.priority}
        if not paths.exists(spark, folder):
            event |= {"status": "blocked", "notes": "no input"}
        elif dry:
            event |= {"status": "planned"}
        else:
            try:
                digest = inventory.input_hash(inventory.with_fingerprints(inventory.listing(spark, folder), paths.local(folder)))
                known = readers.sidecar(paths.local(f"{out}/{module.name}"))
                if not force and known.get("input_hash") == digest and known.get("status") == "ok" and paths.exists(spark, table):
                    event |= {"status": "unchanged", "row_count": known.get("row_count")}
                else:
                    rows = parsers.run_module(spark, module.name, folder, most)
                    sinks.write_table(rows, table, "parquet")
                    n = spark.read.parquet(table).count()
                    event |= {"status": "ok" if n else "skipped", "row_count": n, "input_hash": digest, "license": module.license, "source_dataset": module.dataset, "main_category": module.category}
                    _write_json(spark, f"{out}/{module.name}/{module.name}_metadata.json", event)
            except Exception as problem:  # noqa: BLE001 - one feed must not stop the others
                event |= {"status": "failed", "notes": str(problem)[:500]}
        event["duration_seconds"] = round(time.time() - start, 3)
        if not dry:
            for log in ("_events", *(["_errors"] if event["status"] == "failed" else [])):
                sinks.log_event(spark, f"{out}/{log}", event)
        done.append(event)
    return done


def build_unified(spark: SparkSession, silver: DataFrame, out: str, min_quality: float = 0.5, seed: int = 42) -> dict:
    """Unified gold as JSON lines and Parquet, with manifest and card; raises if the result breaks its contract."""
    sinks.write_table(curate.build(silver, min_quality, seed), f"{out}/parquet", "parquet")
    gold = spark.read.parquet(f"{out}/parquet")
    sinks.write_table(gold, f"{out}/jsonl", "jsonl")
    validate.assert_valid(validate.unified_issues(gold))
    manifest = reports.manifest(gold, {"domain": "domain", "split": "split", "label": "label", "source": "source_id", "category": "category"}, seed)
    problems = validate.manifest_problems(manifest, gold.count())
    if problems:
        raise ValueError("; ".join(problems))
    _write_json(spark, f"{out}/manifest.json", manifest)
    paths.put(spark, f"{out}/card.md", reports.card(manifest, "Unified gold"))
    return manifest


def build_benchmark(spark: SparkSession, silver: DataFrame, out: str, most: int = 100_000, seed: int = 42) -> dict:
    """The benchmark table, capped over its strata, with its manifest."""
    gold = benchmark.stratified_cap(benchmark.build(silver, seed), most, ["evaluation_head", "task_type", "main_category", "gold_label"], "record_id", seed)
    sinks.write_table(gold, f"{out}/parquet", "parquet")
    kept = spark.read.parquet(f"{out}/parquet")
    manifest = reports.manifest(kept, {"head": "evaluation_head", "task": "task_type", "split": "split", "label": "gold_label"}, seed)
    sinks.write_benchmark(kept, out, manifest, ("csv",))
    return manifest


def predict_benchmark(spark: SparkSession, gold: DataFrame, out: str, model: str = "stub", answer: Callable[[DataFrame], DataFrame] | None = None, most: int | None = None) -> int:
    """Appends answers of rows that have none in ``out`` yet; the stub answers unless a function is given. Returns the rows there."""
    done = spark.read.json(out).select("record_id") if paths.exists(spark, out) else None
    results = predict.generate(gold, done, answer or (lambda rows: predict.stub_predictions(rows, model)), most)
    sinks.append_predictions(predict.output_rows(gold, results, model), out)
    return spark.read.json(out).count()


def evaluate_benchmark(gold: DataFrame, predictions: DataFrame, out: str) -> dict:
    """Scores of all slices, the leaderboard, coverage and the weighted score."""
    lacking = predict.missing_columns(predictions)
    if lacking:
        raise ValueError(f"predictions lack {lacking}")
    joined = evaluate.join_predictions(gold, predictions.select("record_id", "prediction"))
    scores = evaluate.slice_scores(joined)
    sinks.write_table(scores, f"{out}/scores", "csv")
    payload = {**evaluate.coverage(gold, predictions).first().asDict(), **evaluate.weighted_overall(joined).first().asDict(), "leaderboard": [r.asDict() for r in evaluate.leaderboard(scores).collect()]}
    _write_json(gold.sparkSession, f"{out}/evaluation.json", payload)
    return payload


def prepare_examples(spark: SparkSession, gold: DataFrame, out: str, most: int | None = 50_000, seed: int = 42) -> dict:
    """Chat examples per split as JSON lines, removed rows, and a report."""
    judged = sft.judged(gold, ["record_id"], seed=seed)
    examples = sft.prepared(judged)
    if most is not None:
        examples = benchmark.stratified_cap(examples, most, ["split", "task_type", "evaluation_head"], "example_id", seed)
    sinks.write_splits(examples, f"{out}/splits")
    sinks.write_table(sft.removed(judged), f"{out}/removed", "csv")
    kept = spark.read.json(f"{out}/splits")
    flags = judged.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("rows"))
    counts = {"flags": flags, "reasons": sft.removed(judged).groupBy("reason").agg(F.count("*").alias("rows")), "splits": kept.groupBy("split").agg(F.count("*").alias("rows")), "targets": reports.top_values(judged, "answer", 25)}
    collected = {name: [r.asDict() for r in df.orderBy(df.columns[0]).collect()] for name, df in counts.items()}
    paths.put(spark, f"{out}/report.md", reports.sft_report(collected))
    return collected


def build_manifest(silver: DataFrame, out: str) -> list[dict]:
    rows = [r.asDict() for r in inventory.module_manifest(silver).orderBy("silver_module").collect()]
    _write_json(silver.sparkSession, f"{out}/silver_manifest.json", {"modules": rows})
    paths.put(silver.sparkSession, f"{out}/silver_report.md", reports.silver_report(rows))
    return rows


def preflight(spark: SparkSession, raw: str, out: str) -> dict[str, int]:
    """The tables of the check of raw files, the inventory of folders, the plan of modules; returns their sizes."""
    files = inventory.listing(spark, raw)
    folders = inventory.folder_inventory(files)
    tables = inventory.health_tables(inventory.with_fingerprints(files, paths.local(raw))) | {"bronze_inventory": folders, "category_index": inventory.category_index(folders), "silver_normalization_plan": inventory.module_plan(folders)}
    for name, df in tables.items():
        sinks.write_table(df, f"{out}/{name}", "csv")
    return {name: df.count() for name, df in tables.items()}

"""python -m gritmill COMMAND --help"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from gritmill import runner
from gritmill.sources import readers


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> object:
    parser = argparse.ArgumentParser(prog="gritmill", description="Curation of security text corpora")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *paths: str) -> None:
        command = commands.add_parser(name, help=text)
        for path in paths:
            command.add_argument(path)

    add("preflight", "check and list raw files", "raw", "out")
    add("normalize", "raw feeds to silver tables", "raw", "out")
    add("unified", "silver tables to unified gold", "silver", "out")
    add("benchmark", "silver tables to the benchmark", "silver", "out")
    add("manifest", "manifest and report of silver tables", "silver", "out")
    add("predict", "answers of the local stub", "gold", "out")
    add("evaluate", "scores of predictions", "gold", "predictions", "out")
    add("sft", "benchmark to chat examples", "gold", "out")
    for name in ("normalize", "benchmark", "predict", "sft"):
        commands.choices[name].add_argument("--most", type=int, help="rows at most")
    commands.choices["normalize"].add_argument("--module", action="append")
    commands.choices["normalize"].add_argument("--force", action="store_true")
    commands.choices["normalize"].add_argument("--dry-run", action="store_true")
    commands.choices["unified"].add_argument("--min-quality", type=float, default=0.5)
    for name in ("unified", "benchmark", "sft"):
        commands.choices[name].add_argument("--seed", type=int, default=42)
    a = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName("gritmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    table = lambda path: readers.read_table(spark, path)
    capped = {"most": a.most} if getattr(a, "most", None) is not None else {}
    result = {
        "preflight": lambda: runner.preflight(spark, a.raw, a.out),
        "normalize": lambda: runner.run_modules(spark, a.raw, a.out, a.module, a.force, a.dry_run, a.most),
        "unified": lambda: runner.build_unified(spark, runner.silver_tables(spark, a.silver), a.out, a.min_quality, a.seed),
        "benchmark": lambda: runner.build_benchmark(spark, runner.silver_tables(spark, a.silver), a.out, seed=a.seed, **capped),
        "manifest": lambda: runner.build_manifest(runner.silver_tables(spark, a.silver), a.out),
        "predict": lambda: runner.predict_benchmark(spark, table(a.gold), a.out, **capped),
        "evaluate": lambda: runner.evaluate_benchmark(table(a.gold), table(a.predictions), a.out),
        "sft": lambda: runner.prepare_examples(spark, table(a.gold), a.out, seed=a.seed, **capped),
    }[a.command]()
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()

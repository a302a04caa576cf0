"""The data side of training: schedules, subsets, checkpoints, bounds; no tensors."""

from __future__ import annotations

import re
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions.text import filled
from gritmill.operators import benchmark

# Tokens of an answer unless asked for otherwise, and those of tasks other than classification.
DEFAULT_OUTPUT, LONG_OUTPUT = 128, 256
# Rows of the named samples.
SAMPLES = {"10k": 10_000, "50k": 50_000, "100k": 100_000}


def learning_rate(step: Column, base: float, steps: int, warmup: float = 0.03, kind: str = "cosine") -> Column:
    """Rate at a step: linear up to the end of the warm-up, then by cosine or linearly down to zero, or constant."""
    first = int(steps * warmup)
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (step - first) / F.lit(max(1, steps - first))))
    after = F.lit(float(base))
    if steps > first and kind in ("cosine", "linear"):
        after = base * 0.5 * (1 + F.cos(F.lit(3.141592653589793) * part)) if kind == "cosine" else base * (1 - part)
    return F.when(step <= first, base * step / F.lit(float(first))).otherwise(after) if first > 0 else after


def schedule(spark: SparkSession, base: float, steps: int, warmup: float = 0.03, kind: str = "cosine") -> DataFrame:
    return spark.range(1, steps + 1).select(F.col("id").alias("step"), learning_rate(F.col("id"), base, steps, warmup, kind).alias("rate"))


def output_tokens(task: Column | str, asked: int = DEFAULT_OUTPUT) -> Column:
    """Bound of an answer's tokens: what was asked for, else by the task."""
    task = F.col(task) if isinstance(task, str) else task
    return F.lit(max(1, asked)) if asked != DEFAULT_OUTPUT else F.when(task == "classification", DEFAULT_OUTPUT).otherwise(LONG_OUTPUT)


def subset(gold: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` rows with an id and an input, mixed over head, task, category and label; without an answer the label, else unknown, stands in."""
    strata = [c for c in ("evaluation_head", "task_type", "main_category", "gold_label") if c in gold.columns]
    answers = [filled(c) for c in ("expected_output", "gold_label") if c in gold.columns]
    rows = gold.where("record_id is not null and input_text is not null").withColumn("expected_output", F.coalesce(*answers, F.lit("unknown")))
    return benchmark.stratified_cap(rows, most, strata, "record_id", seed) if strata else rows.orderBy("record_id").limit(most)


def without_training(evaluation: DataFrame, training: DataFrame, key: str = "example_id") -> DataFrame:
    """The evaluation rows that training doesn't have."""
    return evaluation.join(training.select(key).distinct(), key, "left_anti")


def checkpoints(folder: str | Path) -> list[Path]:
    """Folders ``checkpoint-N`` by their number."""
    found = [(int(m[1]), p) for p in Path(folder).glob("checkpoint-*") if p.is_dir() and (m := re.fullmatch(r"checkpoint-(\d+)", p.name))]
    return [p for _, p in sorted(found)]


def prune_checkpoints(folder: str | Path, keep: int) -> list[str]:
    """Removes all but the latest ``keep`` checkpoints and returns what went; nothing for 0."""
    stale = checkpoints(folder)[:-keep] if keep > 0 else []
    for path in stale:
        shutil.rmtree(path)
    return [str(p) for p in stale]

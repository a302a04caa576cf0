"""Queries of the curation operators over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions import classify, hashing, text
from gritmill.operators import benchmark, curate, dedup, evaluate, inventory, predict, reports, sft, training, validate
from gritmill.operators.nested import parse_document
from gritmill.plans import sql
from gritmill.session import table
from gritmill.sources import parsers
from gritmill.streaming import events

SEED = 42


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.once(table(spark, sf_dir, "silver_records"), "record_id", "ingested_at")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.once(table(spark, sf_dir, "gold_benchmark"), "record_id", "created_at")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


UNIFIED = ("record_id", "source_id", "source_url", "source_license", "domain", "category", "subcategory", "task_type", "normalized_text", "label", "severity", "cwe", "cve", "quality_score", "dedup_hash", "split")


def unified_gold(spark, sf_dir):
    return curate.build(_silver(spark, sf_dir), seed=SEED).select(*UNIFIED, F.array_join("mitre_attack_ids", "|").alias("techniques"), F.array_join("entities.cve_ids", "|").alias("cve_ids"), F.array_join("entities.cwe_ids", "|").alias("cwe_ids"))


def gold_counts(spark, sf_dir):
    return reports.grouped_counts(curate.build(_silver(spark, sf_dir), seed=SEED), ["domain", "task_type", "label", "severity", "split", "source_id"])


def gold_stats(spark, sf_dir):
    return curate.stats(_silver(spark, sf_dir), seed=SEED)


def text_cleaning(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", text.clean_text("text").alias("cleaned"), hashing.content_key(F.coalesce("text", F.lit(""))).alias("content_key"), text.slug("source").alias("source_slug"))


def text_safety(spark, sf_dir):
    return _documents(spark, sf_dir).where("text is not null").select("doc_id", text.redact("text").alias("redacted"), text.defang("text").alias("defanged"), text.is_safe("text").alias("safe"))


def text_tokens(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.size(text.tokens("text")).alias("n_tokens"), text.truncate_middle("text", 200).alias("shortened"), F.array_join(F.array_sort(text.tokens(F.substring("title", 1, 200))), " ").alias("title_tokens"))


def identifier_extraction(spark, sf_dir):
    rows = table(spark, sf_dir, "gold_unified").select("record_id", "normalized_text", "cve", "cwe").distinct()
    joined = lambda kind, explicit=None: F.array_join(text.identifiers("normalized_text", kind, explicit), "|")
    return rows.select("record_id", joined("cve", F.col("cve")).alias("cves"), joined("cwe", F.col("cwe")).alias("cwes"), joined("technique").alias("techniques"), joined("url").alias("urls"))


def host_extraction(spark, sf_dir):
    rows = table(spark, sf_dir, "gold_unified").select("source_url").union(table(spark, sf_dir, "silver_records").select("url")).where("source_url is not null").distinct()
    return rows.select(F.col("source_url").alias("url"), text.host("source_url").alias("host"), text.defang_for_log("source_url").alias("logged"))


def hash_splits(spark, sf_dir):
    rows = table(spark, sf_dir, "silver_records").select("record_id").distinct()
    return rows.select("record_id", hashing.unified_split("record_id").alias("unified"), hashing.benchmark_split("record_id").alias("benchmark"), hashing.legacy_split("record_id").alias("legacy"), hashing.sft_split("record_id").alias("sft"), hashing.module_record_id("silver", "record_id").alias("module_id"))


def classification_rules(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    head = classify.head("main_category", "source_type", "label")
    domain = classify.domain(text.slug("source_dataset"), "source_dataset", "main_category", "attack_name", "source_type")
    return rows.select(
        "record_id", domain.alias("domain"), classify.task_type("source_type", domain).alias("task_type"), head.getField("head").alias("head"), head.getField("task").alias("head_task"),
        classify.difficulty("mitre_technique_id", "cve_id", "cwe_id", "features_json").alias("difficulty"), classify.severity("severity", F.col("severity_score")).alias("severity_class"),
        classify.binary_label("label").alias("binary_class"), classify.license_class("license").alias("license_class"), classify.source_url(text.slug("source_dataset"), "source_dataset").alias("published_at"),
    )


def duplicates_summary(spark, sf_dir):
    return dedup.duplicate_report(table(spark, sf_dir, "gold_unified"), "record_id")


def duplicate_contents(spark, sf_dir):
    rows = table(spark, sf_dir, "gold_unified").select("record_id", hashing.content_key("normalized_text").alias("content_key"))
    return dedup.duplicate_groups(rows, "content_key", "record_id")


def exact_dedup(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", hashing.content_key("text").alias("content_key"))
    return dedup.first_wins(rows, "content_key", ["doc_id"])


def benchmark_gold(spark, sf_dir):
    return benchmark.build(_silver(spark, sf_dir)).withColumn("binary_label", F.col("binary_label").cast("int")).drop("created_at")


STRATA = ["evaluation_head", "task_type", "main_category", "gold_label"]


def stratified_rows(spark, sf_dir):
    gold = benchmark.build(_silver(spark, sf_dir))
    return benchmark.stratified_cap(gold, 500, STRATA, "record_id").select("record_id", *STRATA)


def balanced_rows(spark, sf_dir):
    return benchmark.balanced_sample(_silver(spark, sf_dir).select("record_id", "label"), "label", "record_id", 400)


QUOTAS = {"API Security": 5, "Mobile Security": 3}


def quota_rows(spark, sf_dir):
    return benchmark.quota_sample(_silver(spark, sf_dir).select("record_id", "main_category"), "main_category", "record_id", QUOTAS, 40, 300)


def _clean_gold(spark, sf_dir):
    gold = _gold(spark, sf_dir)
    tidy = {c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))) for c in ("task_type", "evaluation_head", "metric_group")}
    return gold.withColumns(tidy)


def stub_predictions(spark, sf_dir):
    return predict.stub_predictions(_clean_gold(spark, sf_dir))


def _scored(spark, sf_dir):
    gold = _clean_gold(spark, sf_dir)
    return evaluate.join_predictions(gold, predict.stub_predictions(gold))


def joined_predictions(spark, sf_dir):
    return _scored(spark, sf_dir).select("record_id", "evaluation_head", "task_type", "gold_label", "prediction", "confidence", F.round(evaluate.jaccard("expected_output", "prediction"), 6).alias("overlap"), evaluate.exact("gold_label", "prediction").alias("exact"))


def classification_report(spark, sf_dir):
    rows = _scored(spark, sf_dir).where("metric_group = 'classification'")
    return evaluate.per_label(rows, "gold_label", "prediction", ["evaluation_head"]).select("evaluation_head", "label", "tp", "fp", "fn", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def classification_summary(spark, sf_dir):
    rows = _scored(spark, sf_dir).where("metric_group = 'classification'")
    done = evaluate.classification_summary(evaluate.per_label(rows, "gold_label", "prediction", ["evaluation_head"]), ["evaluation_head"])
    return done.select("evaluation_head", "rows", F.round("accuracy", 6).alias("accuracy"), *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_macro", "f1_weighted")])


def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_scored(spark, sf_dir).where("metric_group = 'classification'"), "gold_label", "prediction")


def rank_auc(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("truth", F.when(F.col("binary_label") == 1, "attack").otherwise("benign"))
    return evaluate.rank_auc(rows, "truth", "confidence", "record_id", ["evaluation_head"]).withColumn("auc", F.round("auc", 6))


def slice_scores(spark, sf_dir):
    return evaluate.slice_scores(_scored(spark, sf_dir))


def weighted_overall(spark, sf_dir):
    return evaluate.weighted_overall(_scored(spark, sf_dir))


def variant_comparison(spark, sf_dir):
    gold = _clean_gold(spark, sf_dir).where("metric_group = 'classification'")
    scores = None
    for model in ("stub", "other", "third"):
        rows = evaluate.join_predictions(gold, predict.stub_predictions(gold, model))
        part = rows.groupBy("evaluation_head").agg(F.round(F.avg((F.col("gold_label") == F.col("prediction")).cast("int")), 6).alias("accuracy")).withColumn("model", F.lit(model))
        scores = part if scores is None else scores.unionByName(part)
    return reports.variant_deltas(scores, "model", "stub", "accuracy", ["evaluation_head"])


def resume_pending(spark, sf_dir):
    gold = _gold(spark, sf_dir).select("record_id", "split")
    done = gold.where("split = 'train'").select("record_id")
    counts = lambda df, name: df.groupBy("split").agg(F.count("*").alias("n")).withColumn("state", F.lit(name))
    return counts(predict.pending(gold, done), "pending").unionByName(counts(predict.already_done(gold, done), "done"))


def parsed_responses(spark, sf_dir):
    rows = table(spark, sf_dir, "sft_examples").select("example_id", "task_type", "target_json").distinct()
    answer = predict.parse_response("target_json", "task_type", F.array(*[F.lit(x) for x in ("benign", "malicious", "phishing", "unknown")]))
    return rows.select("example_id", answer.getField("prediction").alias("prediction"), answer.getField("explanation").alias("explanation"))


def chat_turns(spark, sf_dir):
    rows = table(spark, sf_dir, "sft_examples").select("example_id", F.from_json("messages_json", "array<struct<content:string,role:string>>").alias("m")).dropDuplicates(["example_id"])
    parts = sft.split_last_answer(F.col("m"))
    return rows.select("example_id", F.size("m").alias("turns"), F.size(parts.getField("context")).alias("context_turns"), parts.getField("answer").alias("answer"))


def _judged(spark, sf_dir):
    return sft.judged(_clean_gold(spark, sf_dir), ["record_id"])


def sft_flags(spark, sf_dir):
    return sft.flagged(_clean_gold(spark, sf_dir)).select(F.explode("flags").alias("flag"), "task_type").groupBy("flag", "task_type").agg(F.count("*").alias("n"))


def sft_prepared(spark, sf_dir):
    return sft.prepared(_judged(spark, sf_dir)).drop("messages")


def sft_parts(spark, sf_dir):
    examples = table(spark, sf_dir, "sft_examples").dropDuplicates(["example_id"])
    return sft.split_train_eval(examples).groupBy("split", "part").agg(F.count("*").alias("n"))


def sft_removed(spark, sf_dir):
    return sft.removed(_judged(spark, sf_dir)).groupBy("split", "reason", "task_type").agg(F.count("*").alias("n"))


def cross_source_overlap(spark, sf_dir):
    rows = table(spark, sf_dir, "silver_records").select("record_id", text.clean_source("source_dataset").alias("source_id"), F.explode(text.cve_ids("cve_id")).alias("cve"))
    return reports.cross_source_overlap(rows, "cve", "source_id", "record_id")


def coverage_report(spark, sf_dir):
    return reports.grouped_counts(table(spark, sf_dir, "silver_records"), ["source_type", "label", "binary_label", "severity", "license", "platform"])


def null_counts(spark, sf_dir):
    df = table(spark, sf_dir, "silver_records")
    return reports.null_counts(df, df.columns)


def stability_stats(spark, sf_dir):
    return reports.stability(table(spark, sf_dir, "events"), "event_type", "event_id", "value")


def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return events.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.max("k").alias("largest"))


def validation_issues(spark, sf_dir):
    gold = validate.unified_issues(table(spark, sf_dir, "gold_unified")).select(F.lit("gold_unified").alias("table_name"), "issue")
    silver = validate.silver_issues(table(spark, sf_dir, "silver_records")).select(F.lit("silver_records").alias("table_name"), "issue")
    return gold.unionByName(silver).groupBy("table_name", "issue").agg(F.count("*").alias("n"))


def majority_baseline(spark, sf_dir):
    return reports.majority(_gold(spark, sf_dir), "main_category", "gold_label", "record_id")


def top_targets(spark, sf_dir):
    return reports.top_values(_gold(spark, sf_dir), "expected_output", 25)


def heading_sections(spark, sf_dir):
    return reports.sections(_documents(spark, sf_dir), "doc_id", "text")


def label_mapping(spark, sf_dir):
    rows = _silver(spark, sf_dir).select("record_id", classify.mapped_label("label").alias("m"))
    return rows.select("record_id", "m.label", "m.binary_label", "m.attack_family")


def coverage(spark, sf_dir):
    gold = _clean_gold(spark, sf_dir)
    return evaluate.coverage(gold, predict.stub_predictions(gold.where("split = 'train'")))


def group_accuracy(spark, sf_dir):
    return evaluate.group_accuracy(_scored(spark, sf_dir), ("evaluation_head", "task_type", "main_category", "difficulty"))


def prior_predictions(spark, sf_dir):
    gold = _clean_gold(spark, sf_dir)
    targets = gold.where("split <> 'train'").select("record_id", "expected_output")
    prior = predict.stub_predictions(gold, "other").select("record_id", "prediction")
    return evaluate.prior_rows(targets, prior, gold, ["evaluation_head", "difficulty"])


def leaderboard(spark, sf_dir):
    return evaluate.leaderboard(evaluate.slice_scores(_scored(spark, sf_dir)))


def learning_rates(spark, sf_dir):
    parts = [training.schedule(spark, 2e-4, 500, 0.06, kind).withColumn("kind", F.lit(kind)) for kind in ("cosine", "linear", "constant")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("rate", F.round(F.col("rate") * 1e6, 6))


def output_bounds(spark, sf_dir):
    return _clean_gold(spark, sf_dir).groupBy("task_type").agg(F.max(training.output_tokens("task_type")).alias("bound"), F.max(training.output_tokens("task_type", 64)).alias("asked"))


def repeated_rows(spark, sf_dir):
    return validate.repeated_rows(table(spark, sf_dir, "gold_unified"), "record_id", "processed_at")


def module_manifest(spark, sf_dir):
    return inventory.module_manifest(_silver(spark, sf_dir))


def category_rows(spark, sf_dir):
    return inventory.rows_by_category(inventory.by_status(inventory.module_manifest(_silver(spark, sf_dir)), "ok"))


def folder_plan(spark, sf_dir):
    """Categories and modules guessed for the names of sources as if they were folders."""
    names = table(spark, sf_dir, "source_feeds").select(F.col("source_id").alias("dataset_folder")).unionByName(spark.createDataFrame([(k,) for k in sorted(inventory.PLAN)], "dataset_folder string"))
    guessed = names.withColumn("g", inventory.guess_category(F.col("dataset_folder"))).select("dataset_folder", "g.source_type", "g.main_category")
    return inventory.module_plan(guessed).join(inventory.category_index(guessed), "dataset_folder")


def gold_subset(spark, sf_dir):
    return training.subset(_clean_gold(spark, sf_dir), 150).select("record_id", "evaluation_head", "task_type", "main_category", "gold_label", "expected_output")


def named_sample(spark, sf_dir):
    """The named sample of 10,000 rows: the whole table where it is smaller."""
    return benchmark.balanced_sample(_silver(spark, sf_dir).select("record_id", "label"), "label", "record_id", training.SAMPLES["10k"])


def evaluation_pool(spark, sf_dir):
    examples = table(spark, sf_dir, "sft_examples").select("example_id", "split", "task_type").distinct()
    return training.without_training(examples, examples.where("split = 'train'")).groupBy("split", "task_type").agg(F.count("*").alias("n"))


def file_names(spark, sf_dir):
    return _silver(spark, sf_dir).select("source_dataset").distinct().select("source_dataset", text.file_name("source_dataset").alias("file_name"))


def nvd_silver(spark, sf_dir):
    """Items of nvd_items through the parser of that feed."""
    rows = table(spark, sf_dir, "nvd_items").select(F.col("source_file").alias("file"), parse_document(F.col("raw")).alias("v")).where("v is not null")
    done = parsers.to_silver(rows, parsers.MODULES["advisory_nvd_cve"])
    return done.select("record_id", "label", "cve_id", "cwe_id", "severity", F.round("severity_score", 2).alias("severity_score"), "url", "raw_text", "main_category", "license", "source_file").distinct()


QUERIES = {
    f.__name__: f
    for f in (
        unified_gold, gold_counts, gold_stats, text_cleaning, text_safety, text_tokens, identifier_extraction, host_extraction, hash_splits, classification_rules, duplicates_summary,
        duplicate_contents, exact_dedup, benchmark_gold, stratified_rows, balanced_rows, quota_rows, stub_predictions, joined_predictions, classification_report, classification_summary,
        confusion_matrix, rank_auc, slice_scores, weighted_overall, variant_comparison, resume_pending, parsed_responses, chat_turns, sft_flags, sft_prepared, sft_parts, sft_removed,
        label_mapping, coverage, group_accuracy, prior_predictions, leaderboard, learning_rates, output_bounds, repeated_rows, module_manifest, category_rows, folder_plan, gold_subset, named_sample,
        evaluation_pool, file_names, nvd_silver, cross_source_overlap, coverage_report, null_counts, stability_stats, json_extract, validation_issues, majority_baseline, top_targets, heading_sections,
    )
}
SQL = sql.SQL


def event_windows(spark, sf_dir):
    return events.windowed_counts(table(spark, sf_dir, "events")).withColumn("start", F.unix_timestamp("start"))


def event_sessions(spark, sf_dir):
    return events.sessions(table(spark, sf_dir, "events")).withColumns({"start": F.unix_timestamp("start"), "end": F.unix_timestamp("end")})


QUERIES |= {"event_windows": event_windows, "event_sessions": event_sessions}

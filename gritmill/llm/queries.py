"""Queries of the problems on training corpora, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions.text import clean_source
from gritmill.llm import capping, encoding, leaks, overlap, pairs, sampling, sentences, splits
from gritmill.session import cut_lineage, table

#: Limit of a contributor, in percent of all distinct records.
CAP_PERCENT = 6
SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "gold_unified")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = capping.cap_report(_gold(spark, sf_dir), capping.unified_contributor(), "record_id", "quality_score", CAP_PERCENT)
    return report.where("contributor is not null and n_dropped > 0").select(F.col("contributor").alias("source_id"))


def p1_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = capping.cap_contributors(_gold(spark, sf_dir), capping.unified_contributor(), "record_id", "quality_score", CAP_PERCENT)
    return kept.select(F.col("identifier").alias("record_id"), F.col("contributor").alias("source_id"), F.col("rank").alias("source_rank"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = capping.cap_report(_gold(spark, sf_dir), capping.unified_contributor(), "record_id", "quality_score", CAP_PERCENT)
    return report.withColumnRenamed("contributor", "source_id")


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_moves(_gold(spark, sf_dir), "record_id", splits.unified_entities(), splits.unified_split(), SHARES)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups some of whose records must move and some not, or from two splits."""
    return _moves(spark, sf_dir).where("moves > 0 and (moves < records or size(splits) > 1)").select("group_kind", "group_key")


def p2_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moves(spark, sf_dir).withColumn("splits", F.array_join("splits", "|"))


def p2_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = splits.assign_splits(_gold(spark, sf_dir), "record_id", splits.unified_entities(), SHARES)
    return done.withColumnRenamed("record", "record_id")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reached shares: one component may hold more records than a split should."""
    done = splits.assign_splits(_gold(spark, sf_dir), "record_id", splits.unified_entities(), SHARES)
    per = done.groupBy("component", "split").agg(F.count("*").alias("n")).groupBy("split").agg(F.sum("n").alias("records"), F.count("*").alias("components"), F.max("n").alias("largest_component"))
    shares = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("split"), F.lit(v).alias("wanted_share")) for k, v in SHARES.items()])).alias("x")).select("x.*")
    reached = cut_lineage(per)
    total = reached.agg(F.sum("records").alias("total"))
    counted = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("records", "components", "largest_component")}
    return shares.join(reached, "split", "left").withColumns(counted).join(F.broadcast(total)).select(  # one row
        "split", "records", "components", "largest_component", "wanted_share", F.coalesce(F.round(F.col("records") / F.col("total"), 6), F.lit(0.0)).alias("reached_share")
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defective(table(spark, sf_dir, "gold_benchmark"), table(spark, sf_dir, "sft_examples"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_found(spark, sf_dir).groupBy("table_name", "defect").agg(F.count("*").alias("pairs"))


def _overlaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return overlap.overlaps(_gold(spark, sf_dir), "record_id", "normalized_text", splits.unified_split(), "source_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlap.record_pairs(*_overlaps(spark, sf_dir))
    return found.select(F.least("e_record", "t_record").alias("record_id_a"), F.greatest("e_record", "t_record").alias("record_id_b")).distinct()


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs and evaluation records per split and clean source, counted from classes."""
    per_record = overlap.evaluation_counts(*_overlaps(spark, sf_dir)).withColumn("source_id", clean_source("extra"))
    return per_record.groupBy(F.col("side").alias("split"), "source_id").agg(F.sum("pairs").alias("pairs"), F.count("*").alias("records"), F.round(F.avg("coverage"), 4).alias("mean_coverage"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its class and the number of near-same classes on the other side."""
    return overlap.class_members(*_overlaps(spark, sf_dir)).withColumnRenamed("record", "record_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that leaked, with the number of documents."""
    found = p9_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))
    return found.join(table(spark, sf_dir, "eval_items").select("item_id", "suite"), "item_id").select("suite", "item_id", "documents")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return sentences.split_sentences(documents, "doc_id", "text", sentences.fit(documents, "doc_id", "text"))


def p10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and their mean length per source."""
    spans = p10_found(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("units"), F.sum(F.col("end_at") - F.col("start_at")).alias("points"))
    rows = table(spark, sf_dir, "documents").select("doc_id", clean_source("source").alias("source")).join(spans, "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("documents"), F.sum("units").alias("units"), F.round(F.sum("points") / F.sum("units"), 3).alias("mean_length"))


#: (dimension, table, column)
DIMENSIONS = (("main_category", "silver_records", "main_category"), ("evaluation_head", "gold_benchmark", "evaluation_head"), ("task_type", "gold_benchmark", "task_type"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in dict.fromkeys(n for _, n, _ in DIMENSIONS):
        rows = sampling.population(table(spark, sf_dir, name), "record_id", {d: c for d, n, c in DIMENSIONS if n == name})
        out = rows if out is None else out.unionByName(rows)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_report(spark, sf_dir).where("capped or below_floor").select("dimension", "category")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.report(_people(spark, sf_dir), table(spark, sf_dir, "sampling_targets"))


def p6_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(_people(spark, sf_dir), table(spark, sf_dir, "sampling_targets")).withColumnRenamed("identifier", "record_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", offsets=True)


QUERIES = {
    "p1_found": p1_found, "p1_capped": p1_capped, "p1_report": p1_report,
    "p2_found": p2_found, "p2_moves": p2_moves, "p2_splits": p2_splits, "p2_report": p2_report,
    "p3_found": p3_found, "p3_report": p3_report,
    "p4_found": p4_found, "p4_report": p4_report, "p4_classes": p4_classes,
    "p6_found": p6_found, "p6_report": p6_report, "p6_sample": p6_sample,
    "p8_ids": p8_ids, "p8_offsets": p8_offsets,
    "p9_found": p9_found, "p9_report": p9_report,
    "p10_found": p10_found, "p10_counts": p10_counts,
}

_SOURCE = "nullif(trim(regexp_replace(lower(source_id), '[^a-z0-9]+', '_', 'g'), '_'), '')"
_ONCE = f"""once AS (
  SELECT record_id, min({_SOURCE}) AS source_id,
         max(CASE WHEN quality_score BETWEEN 0 AND 1 AND NOT isnan(quality_score) THEN CAST(round(quality_score * 10000) AS BIGINT) ELSE -1 END) AS k
  FROM gold_unified WHERE record_id IS NOT NULL GROUP BY record_id),
ranked AS (
  SELECT record_id, source_id, row_number() OVER (PARTITION BY source_id ORDER BY k DESC, md5(record_id), record_id) AS r,
         ((SELECT count(*) FROM once) * {CAP_PERCENT}) // 100 AS allowed
  FROM once)"""
_CATEGORY = "nullif(lower(trim(regexp_replace({0}, '\\s+', ' ', 'g'))), '')"


def _counts(name: str, column: str, dimension: str) -> str:
    return f"SELECT '{dimension}' AS dimension, {_CATEGORY.format(column)} AS k, count(DISTINCT record_id) AS n FROM {name} GROUP BY 2"


SQL = {
    "p1_found": f"WITH {_ONCE} SELECT source_id FROM ranked WHERE source_id IS NOT NULL GROUP BY source_id HAVING count(*) > max(allowed)",
    "p1_capped": f"WITH {_ONCE} SELECT record_id, source_id, r AS source_rank FROM ranked WHERE source_id IS NULL OR r <= allowed",
    "p1_report": f"""WITH {_ONCE} SELECT source_id, count(*) AS n_records, count(*) FILTER (source_id IS NULL OR r <= allowed) AS n_kept,
      count(*) FILTER (source_id IS NOT NULL AND r > allowed) AS n_dropped, max(CASE WHEN source_id IS NOT NULL THEN allowed END) AS allowed FROM ranked GROUP BY source_id""",
}

_SPLIT = "CASE WHEN lower(trim(split, E' \\t\\n\\r')) = 'validation' THEN 'val' ELSE nullif(lower(trim(split, E' \\t\\n\\r')), '') END"
_HASHED = "CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < (0.8::DOUBLE + 0.1::DOUBLE) THEN 'val' ELSE 'test' END"
#: Components by label propagation over (entity, first entity of the record).
_COMPONENTS = f"""WITH RECURSIVE g AS (SELECT DISTINCT record_id, {_SOURCE} AS source_id, cve, {_SPLIT} AS s FROM gold_unified WHERE record_id IS NOT NULL),
e AS (SELECT record_id, 'source_id:' || source_id AS entity, s FROM g WHERE source_id IS NOT NULL
  UNION SELECT record_id, 'cve:' || regexp_replace(i, '(?i)CVE[^0-9]+(\\d{{4}})[^0-9]+(\\d+)', 'CVE-\\1-\\2'), s
  FROM (SELECT record_id, s, unnest(regexp_extract_all(cve, '(?i)CVE[^0-9A-Za-z]{{1,3}}\\d{{4}}[^0-9A-Za-z]{{1,3}}\\d{{1,19}}')) AS i FROM g)),
f AS (SELECT record_id, min(entity) AS first FROM e GROUP BY 1),
l AS (SELECT DISTINCT entity AS x, first AS y FROM e JOIN f USING (record_id) UNION SELECT first, entity FROM e JOIN f USING (record_id)),
cc(x, c) USING KEY (x) AS (SELECT DISTINCT entity, entity FROM e
  UNION SELECT l.x, min(p.c) FROM cc AS p JOIN l ON l.y = p.x JOIN recurring.cc AS q ON q.x = l.x WHERE p.c < q.c GROUP BY l.x),
h AS (SELECT x, c, {_HASHED} AS assigned FROM (SELECT x, c, ('0x' || substr(sha256('42:' || c), 1, 8))::BIGINT / 4294967296.0 AS u FROM cc)),
mv AS (SELECT x, c, assigned, list_sort(list(DISTINCT s)) AS splits, count(*) AS records, count(*) FILTER (s <> assigned) AS moves FROM (SELECT DISTINCT record_id, entity AS x, s FROM e WHERE s IS NOT NULL) JOIN h USING (x) GROUP BY ALL),
rs AS (SELECT g.record_id, coalesce(cc.c, 'record:' || g.record_id) AS component FROM (SELECT DISTINCT record_id FROM g) g LEFT JOIN f USING (record_id) LEFT JOIN cc ON cc.x = f.first),
sp AS (SELECT record_id, component, {_HASHED} AS split FROM (SELECT *, ('0x' || substr(sha256('42:' || component), 1, 8))::BIGINT / 4294967296.0 AS u FROM rs))"""
_KIND, _NAME = "split_part(x, ':', 1)", "substr(x, strpos(x, ':') + 1)"
SQL |= {
    "p2_found": f"{_COMPONENTS} SELECT {_KIND} AS group_kind, {_NAME} AS group_key FROM mv WHERE len(splits) > 1",
    "p2_moves": f"{_COMPONENTS} SELECT {_KIND} AS group_kind, {_NAME} AS group_key, c AS component, assigned, array_to_string(splits, '|') AS splits, records, moves FROM mv",
    "p2_splits": f"{_COMPONENTS} SELECT * FROM sp",
    "p2_report": f"""{_COMPONENTS}, n AS (SELECT component, split, count(*) AS n FROM sp GROUP BY ALL), w AS (SELECT * FROM (VALUES ('train', 0.8::DOUBLE), ('val', 0.1::DOUBLE), ('test', 0.1::DOUBLE)) t(split, wanted_share))
      SELECT w.split, coalesce(sum(n), 0)::BIGINT AS records, count(n) AS components, coalesce(max(n), 0) AS largest_component, any_value(wanted_share) AS wanted_share, round(coalesce(sum(n), 0) / (SELECT count(*) FROM sp), 6)::DOUBLE AS reached_share
      FROM w LEFT JOIN n USING (split) GROUP BY w.split""",
}


def _draw(dimension: str, name: str, column: str) -> str:
    return f"""(WITH pop AS (SELECT record_id, min({_CATEGORY.format(column)}) AS k FROM {name} WHERE record_id IS NOT NULL GROUP BY 1),
  rk AS (SELECT record_id, k, row_number() OVER (PARTITION BY k ORDER BY md5('42' || record_id), record_id) AS r FROM pop WHERE k IS NOT NULL),
  av AS (SELECT k, count(*) AS n FROM rk GROUP BY k),
  tg AS (SELECT {_CATEGORY.format('category')} AS k, min_by(category, target_id) AS category, min_by(target_share * sample_size, target_id) AS wanted, min_by(coalesce(min_rows, 0), target_id) AS least_rows
    FROM sampling_targets WHERE dimension = '{dimension}' GROUP BY 1),
  t0 AS (SELECT tg.*, coalesce(n, 0)::DOUBLE AS n FROM tg LEFT JOIN av USING (k)),
  t1 AS (SELECT *, sum(wanted) OVER () AS size, sum(n) OVER w - n AS used, sum(wanted) OVER () - (sum(wanted) OVER w - wanted) AS rest, row_number() OVER w AS place FROM t0 WINDOW w AS (ORDER BY n / wanted, k ROWS UNBOUNDED PRECEDING)),
  sc AS (SELECT coalesce(min_by((size - used) / rest, place) FILTER ((size - used) / rest * wanted <= n), 'infinity'::DOUBLE) AS c FROM t1),
  pl AS (SELECT k, category, wanted, least_rows, n, CASE WHEN n > 0 THEN least(n, c * wanted) / n ELSE 0 END AS p FROM t0, sc),
  bs AS (SELECT *, ('0x' || substr(sha1('42'), 1, 8))::BIGINT / 4294967296.0 + coalesce(sum(p * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM pl),
  d0 AS (SELECT *, floor(round(base + n * p, 9)) - floor(round(base, 9)) AS drawn, least(least_rows, n) AS lowest FROM bs),
  d1 AS (SELECT *, sum(greatest(lowest - drawn, 0)) OVER () AS missing, CASE WHEN n > drawn THEN greatest(drawn - lowest, 0) ELSE 0 END AS room FROM d0),
  d2 AS (SELECT *, greatest(drawn, lowest) - greatest(0, least(room, missing - (sum(room) OVER (ORDER BY room DESC, k ROWS UNBOUNDED PRECEDING) - room))) AS final FROM d1),
  cr AS (SELECT rk.record_id, rk.k, category, r, drawn, final, floor(round(base + r * p, 9)) - floor(round(base, 9)) AS until, floor(round(base + (r - 1) * p, 9)) - floor(round(base, 9)) AS before FROM rk JOIN d2 USING (k)),
  fl AS (SELECT *, until <= before AND r - 1 - before < final - drawn AS by_floor FROM cr)
  SELECT '{dimension}' AS dimension, record_id, k, category, until > before AND until <= final AS crossed, by_floor FROM fl)"""


_DRAWN = "dr AS (" + " UNION ALL ".join(f"SELECT * FROM {_draw(d, n, c)}" for d, n, c in DIMENSIONS) + ")"
SQL |= {
    "p6_sample": f"WITH {_DRAWN} SELECT dimension, record_id, category, by_floor FROM dr WHERE crossed OR by_floor",
    "p6_report": f"""WITH {_DRAWN}, c AS ({' UNION ALL '.join(_counts(n, c, d) for d, n, c in DIMENSIONS)}), s AS (SELECT dimension, k, count(*) FILTER (crossed OR by_floor) AS selected, count(*) FILTER (by_floor) AS from_floor FROM dr GROUP BY ALL)
      SELECT t.dimension, t.category, t.target_share, t.min_rows, t.target_share * t.sample_size AS wanted, coalesce(c.n, 0) AS available, coalesce(s.selected, 0) AS selected, coalesce(s.from_floor, 0) AS from_floor,
      coalesce(s.selected, 0) = coalesce(c.n, 0) AND coalesce(s.selected, 0) < t.target_share * t.sample_size AS capped, coalesce(s.selected, 0) < t.min_rows AS below_floor
      FROM sampling_targets t LEFT JOIN c ON c.dimension = t.dimension AND c.k = {_CATEGORY.format('t.category')} LEFT JOIN s ON s.dimension = t.dimension AND s.k = {_CATEGORY.format('t.category')}""",
}
SQL["p6_found"] = f"SELECT dimension, category FROM ({SQL['p6_report']}) WHERE capped OR below_floor"

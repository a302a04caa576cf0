"""Queries of the general data problems (5 and 7), over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.functions.text import clean_source
from gritmill.operators import nested, timestamps
from gritmill.session import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows of nvd_items and silver_records. Positions make rows of a parent distinct; deliveries of a record_id count once."""
    items = nested.flatten_nvd(table(spark, sf_dir, "nvd_items"))
    return items.unionByName(nested.flatten_features(table(spark, sf_dir, "silver_records")))


def p5_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per structural variant."""
    items = nested.nvd_documents(table(spark, sf_dir, "nvd_items")).select(F.lit("nvd_items").alias("parent_table"), "variant")
    features = nested.feature_documents(table(spark, sf_dir, "silver_records")).select(F.lit("silver_records").alias("parent_table"), "variant")
    return items.unionByName(features).groupBy("parent_table", F.coalesce("variant", F.lit("broken")).alias("variant")).agg(F.count("*").alias("records"))


def p5_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct inferred shapes of the feature documents with their variant."""
    return nested.shapes(nested.feature_documents(table(spark, sf_dir, "silver_records")))


def p5_subtypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, records and distinct parent rows of every subtype table."""
    rows = nested.nvd_elements(table(spark, sf_dir, "nvd_items")).unionByName(nested.feature_elements(table(spark, sf_dir, "silver_records")))
    per_record = rows.groupBy("parent_table", "child", "parent_key", "parent_row_key").agg(F.count("*").alias("n"))
    per_record = per_record.groupBy("parent_table", "child", "parent_key").agg(F.sum("n").alias("n"), F.count("*").alias("parents"))
    return per_record.groupBy("parent_table", "child").agg(F.sum("n").alias("n"), F.count("*").alias("records"), F.sum("parents").alias("parents"))


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.feed_times(table(spark, sf_dir, "silver_records"), table(spark, sf_dir, "gold_unified"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(spark, sf_dir).where(F.col("value").isNotNull() & ~F.col("value").rlike(timestamps.PLAIN_UTC))
    # the clean source decides; should two deliveries differ in it, the smaller one counts
    rows = rows.groupBy("table_name", "record_id", "value").agg(F.min(clean_source("source")).alias("source"))
    done = timestamps.normalise_timestamps(rows, "value", "source", table(spark, sf_dir, "source_feeds"))
    return done.where("utc_micros is not null").select("table_name", "record_id", "utc_micros")


def p7_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and time_status, over all values."""
    done = timestamps.normalise_timestamps(_times(spark, sf_dir), "value", "source", table(spark, sf_dir, "source_feeds"))
    return done.groupBy("table_name", "time_status").agg(F.count("*").alias("n"), F.min("utc_micros").cast("string").alias("first_micros"), F.max("utc_micros").cast("string").alias("last_micros"))


QUERIES = {"p5_found": p5_found, "p5_variants": p5_variants, "p5_shapes": p5_shapes, "p5_subtypes": p5_subtypes, "p7_found": p7_found, "p7_status": p7_status}


def _decoded(x: str) -> str:
    """JSON of a text, of the text that it encodes, or null."""
    inner = f"json_extract_string({x}, '$')"
    return f"(CASE WHEN json_valid({x}) THEN CASE WHEN json_type({x}) = 'VARCHAR' THEN CASE WHEN json_valid({inner}) THEN {inner}::JSON END ELSE {x}::JSON END END)"


def _list(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN []::JSON[] WHEN json_type({x}) = 'ARRAY' THEN CAST({x} AS JSON[]) ELSE [{x}] END)"


def _spread(name: str, source: str, value: str) -> str:
    """A table of elements with their path, from the element or document ``x`` of ``source``."""
    place = "(generate_subscripts(l, 1) - 1)::VARCHAR"
    return f"{name} AS (SELECT k, v, r, CASE WHEN p = '' THEN {place} ELSE p || '.' || {place} END AS p, unnest(l) AS x FROM (SELECT k, v, r, p, {_list(value)} AS l FROM {source}))"


_AT = "json_extract(x, '$.{}')".format
_CHILDREN = f"""n0 AS (SELECT item_id, {_decoded('cve')} AS own, {_decoded('raw')} AS r FROM nvd_items),
n1 AS (SELECT item_id::VARCHAR AS k, r, CASE WHEN json_type(own) = 'OBJECT' AND len(json_keys(own)) > 0 THEN own WHEN json_type(r, '$.cve') = 'VARCHAR' THEN {_decoded("json_extract_string(r, '$.cve')")} ELSE json_extract(r, '$.cve') END AS v FROM n0),
n AS (SELECT k, v, r, '' AS p, v AS x FROM n1 WHERE json_type(v) = 'OBJECT'),
{_spread('ds', 'n', f"coalesce({_AT('descriptions')}, {_AT('description.description_data')})")},
{_spread('we', 'n', f"coalesce({_AT('weaknesses')}, {_AT('problemtype.problemtype_data')})")}, {_spread('wd', 'we', _AT('description'))},
{_spread('rf', 'n', f"CASE WHEN json_type(v, '$.CVE_data_meta') IS NULL THEN {_AT('references')} ELSE {_AT('references.reference_data')} END")}, {_spread('tg', 'rf', _AT('tags'))},
{_spread('cf', 'n', _AT('configurations'))}, {_spread('cn', 'cf', _AT('nodes'))}, {_spread('cm', 'cn', _AT('cpeMatch'))},
o AS (SELECT k, v, r, p, r AS x FROM n WHERE json_type(v, '$.CVE_data_meta') IS NOT NULL),
{_spread('nd', 'o', _AT('configurations.nodes'))}, {_spread('om', 'nd', _AT('cpe_match'))}, {_spread('oc', 'nd', _AT('children'))}, {_spread('cc', 'oc', _AT('cpe_match'))},
f0 AS (SELECT DISTINCT record_id AS k, {_decoded('features_json')} AS v FROM silver_records WHERE length(trim(features_json)) > 2),
f AS (SELECT k, v, NULL::JSON AS r, '' AS p, v AS x FROM f0 WHERE json_type(v) = 'OBJECT'),
{_spread('cw', 'f', _AT('cwe_ids'))}, {_spread('af', 'f', _AT('affected'))}, {_spread('rg', 'af', _AT('ranges'))}, {_spread('ev', 'rg', _AT('events'))},
ek AS (SELECT k, p, x, unnest(json_keys(x)) AS key FROM ev WHERE json_type(x) = 'OBJECT'),
ch AS (SELECT 'nvd_items' AS parent_table, k AS parent_key, 'description' AS child, p AS child_path, json_extract_string(x, '$.lang') AS child_value FROM ds
  UNION ALL SELECT 'nvd_items', k, 'weakness', p, json_extract_string(x, '$.value') FROM wd UNION ALL SELECT 'nvd_items', k, 'reference', p, json_extract_string(x, '$.url') FROM rf
  UNION ALL SELECT 'nvd_items', k, 'reference_tag', p, json_extract_string(x, '$') FROM tg UNION ALL SELECT 'nvd_items', k, 'cpe', p, json_extract_string(x, '$.criteria') FROM cm
  UNION ALL SELECT 'nvd_items', k, 'cpe', p, json_extract_string(x, '$.cpe23Uri') FROM om UNION ALL SELECT 'nvd_items', k, 'cpe', p, json_extract_string(x, '$.cpe23Uri') FROM cc
  UNION ALL SELECT 'silver_records', k, 'cwe', p, json_extract_string(x, '$') FROM cw UNION ALL SELECT 'silver_records', k, 'affected', p, json_extract_string(x, '$.package.name') FROM af
  UNION ALL SELECT 'silver_records', k, 'range_event', p, key || '=' || json_extract_string(x, '$."' || key || '"') FROM ek)"""
_ANY = lambda keys: "(" + " OR ".join(f"json_type(v, '$.{k}') IS NOT NULL" for k in keys) + ")"
SQL: dict[str, str] = {
    "p5_found": f"WITH {_CHILDREN} SELECT * FROM ch WHERE child_value IS NOT NULL",
    "p5_variants": f"""WITH {_CHILDREN}, t AS (SELECT 'nvd_items' AS parent_table, CASE WHEN v IS NULL THEN 'broken' WHEN json_type(v, '$.id') IS NOT NULL THEN 'item_2' WHEN json_type(v, '$.CVE_data_meta') IS NOT NULL THEN 'item_1' ELSE 'other' END AS variant FROM n1
      UNION ALL SELECT 'silver_records', CASE WHEN v IS NULL THEN 'broken' WHEN {_ANY(('cwe_ids', 'affected'))} THEN 'advisory' WHEN {_ANY(('sections', 'imports', 'packer', 'sha1', 'entropy'))} THEN 'executable'
        WHEN {_ANY(('src', 'dst', 'sport', 'dport', 'proto', 'sbytes', 'dbytes'))} THEN 'flow' WHEN json_type(v) = 'ARRAY' THEN 'list' ELSE 'other' END FROM f0)
      SELECT parent_table, variant, count(*) AS records FROM t GROUP BY ALL""",
}

def _rows(parent_table: str, child: str, source: str, nested: bool, condition: str = "true") -> str:
    above = "regexp_replace(p, '\\.?[0-9]+$', '')" if nested else "''"
    return f"SELECT '{parent_table}' AS parent_table, '{child}' AS child, k, '{source}' || {above} AS above FROM {source} WHERE {condition}"


_NEW, _OLD = "json_type(v, '$.CVE_data_meta') IS NULL", "json_type(v, '$.CVE_data_meta') IS NOT NULL"
_EXECUTABLE, _FLOW = _ANY(("sections", "imports", "packer", "sha1", "entropy")), _ANY(("src", "dst", "sport", "dport", "proto", "sbytes", "dbytes"))
_SUBTYPES = " UNION ALL ".join(
    [_rows("nvd_items", c, t, nested) for c, t, nested in (("description", "ds", False), ("weakness_entry", "we", False), ("weakness", "wd", True), ("reference", "rf", False), ("reference_tag", "tg", True), ("configuration", "cf", False), ("node", "cn", True), ("cpe", "cm", True), ("node", "nd", False), ("cpe", "om", True), ("child_node", "oc", True), ("cpe_of_child", "cc", True), ("metric", "m31", False), ("metric_3", "m30", False))]
    + [_rows("silver_records", c, t, nested) for c, t, nested in (("cwe", "cw", False), ("alias", "al", False), ("affected", "af", False), ("version", "vs", True), ("range", "rg", True), ("range_event", "ek", True), ("section", "sc", False), ("section_flag", "sf", True), ("import", "im", False))]
    + [_rows("silver_records", "executable", "f", False, _EXECUTABLE), _rows("silver_records", "flow", "f", False, f"{_FLOW} AND NOT {_EXECUTABLE}")]
)
SQL["p5_subtypes"] = f"""WITH {_CHILDREN}, {_spread('m31', 'n', _AT('metrics.cvssMetricV31'))}, {_spread('m30', 'n', _AT('metrics.cvssMetricV30'))}, {_spread('al', 'f', _AT('aliases'))}, {_spread('vs', 'af', _AT('versions'))}, {_spread('sc', 'f', _AT('sections'))},
  {_spread('sf', 'sc', _AT('flags'))}, {_spread('im', 'f', _AT('imports'))}, st AS ({_SUBTYPES})
  SELECT parent_table, child, count(*) AS n, count(DISTINCT k) AS records, count(DISTINCT k || '/' || above) AS parents FROM st GROUP BY ALL"""


_ZONES = {"UTC": 0, "GMT": 0, "UT": 0, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "BST": 1, "IST": 5.5, "JST": 9, "KST": 9, "SGT": 8, "AEST": 10, "AEDT": 11, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
_HOURS = "CASE upper(ab) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _ZONES.items()) + " END"
_CLEAN = "nullif(trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_'), '')"
_PLAIN = "['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%Y/%m/%d %H:%M', '%Y.%m.%d %H:%M', '%Y%m%dT%H%M%S', '%a, %d %b %Y %H:%M:%S', '%d %b %Y %H:%M:%S', '%d %b %Y %H:%M', '%b %d, %Y %I:%M %p']"
_DMY, _MDY = "['%d/%m/%Y %H:%M', '%d.%m.%Y %H:%M', '%d/%m/%Y %I:%M %p']", "['%m/%d/%Y %H:%M', '%m.%d.%Y %H:%M', '%m/%d/%Y %I:%M %p']"
_TIMES = f"""f AS (SELECT {_CLEAN.format('source_id')} AS src, min(zone) AS zone, min(date_order) AS date_order FROM source_feeds GROUP BY 1),
a AS (SELECT 'silver_records' AS table_name, record_id, {_CLEAN.format('source_dataset')} AS src, "timestamp" AS value FROM silver_records
  UNION ALL SELECT 'gold_unified', record_id, {_CLEAN.format('source_id')}, collected_at FROM gold_unified),
b AS (SELECT a.*, regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS v, coalesce(f.zone, 'UTC') AS feed_zone, coalesce(f.date_order, 'YMD') AS o FROM a LEFT JOIN f USING (src)),
c AS (SELECT *, regexp_matches(v, '^-?\\d{{1,19}}(\\.\\d+)?$') AND NOT regexp_matches(v, '^(19|20)\\d{{6}}$') AS is_number, regexp_replace(v, '\\[[^\\]]*\\]$', '') AS s1, regexp_extract(v, '\\[([A-Za-z_]+/[A-Za-z_/]+)\\]$', 1) AS z1 FROM b),
d AS (SELECT *, coalesce(nullif(regexp_extract(s1, '\\s([A-Za-z_]+/[A-Za-z_/]+)$', 1), ''), nullif(z1, ''), feed_zone) AS zone, regexp_replace(s1, '\\s[A-Za-z_]+/[A-Za-z_/]+$', '') AS s2 FROM c),
e AS (SELECT *, CASE WHEN regexp_matches(s2, ':\\d\\d|[Tt]\\d{{6}}') THEN regexp_extract(s2, '\\d\\s*([Zz]|[+-]\\d{{2}}:?\\d{{2}})$', 1) ELSE '' END AS off, regexp_extract(s2, '\\d\\s+([A-Za-z]{{2,5}})$', 1) AS ab0 FROM d),
g AS (SELECT *, CASE WHEN upper(ab0) IN ('AM', 'PM') THEN '' ELSE ab0 END AS ab FROM e),
h AS (SELECT *, trim(left(s2, length(s2) - length(off) - length(ab))) AS s3 FROM g),
i AS (SELECT *, regexp_extract(s3, ':\\d\\d[.,](\\d+)$', 1) AS frac, regexp_replace(regexp_replace(s3, '(:\\d\\d)[.,]\\d+$', '\\1'), '(\\d)t(\\d)', '\\1T\\2') AS s4 FROM h),
j AS (SELECT *, coalesce(try_strptime(s4, {_PLAIN}), CASE WHEN o = 'MDY' THEN try_strptime(s4, {_MDY}) ELSE try_strptime(s4, {_DMY}) END) AS ts FROM i WHERE NOT is_number OR v IS NULL),
k AS (SELECT *, CASE WHEN frac = '' THEN 0 ELSE rpad(left(frac, 6), 6, '0')::BIGINT END AS us,
  CASE WHEN upper(off) = 'Z' THEN 0 WHEN off <> '' THEN CASE left(off, 1) WHEN '-' THEN -1 ELSE 1 END * (substr(off, 2, 2)::BIGINT * 60 + right(off, 2)::BIGINT) * 60000000 WHEN ab <> '' THEN ({_HOURS} * 3600000000)::BIGINT END AS shift FROM j),
l AS (SELECT *, CASE WHEN shift IS NULL AND ab = '' THEN epoch_us(timezone(zone, ts)) END AS later FROM k),
m AS (SELECT *, timezone(zone, make_timestamptz(later - 3600000000)) = ts AS twice, timezone(zone, make_timestamptz(later)) <> ts AS never FROM l),
n AS (SELECT table_name, record_id, value, src, CASE WHEN ts IS NULL THEN NULL WHEN shift IS NOT NULL THEN epoch_us(ts) - shift + us WHEN twice THEN later - 3600000000 + us ELSE later + us END AS utc_micros, coalesce(twice, false) AS twice, coalesce(never, false) AS never FROM m
  UNION ALL SELECT table_name, record_id, value, src, CASE WHEN abs(w) < 100000000000 THEN w * 1000000 + rpad(left(fr, 6), 6, '0')::BIGINT WHEN abs(w) < 100000000000000 THEN w * 1000 + rpad(left(fr, 3), 3, '0')::BIGINT ELSE w END, false, false
  FROM (SELECT *, split_part(v, '.', 1)::BIGINT AS w, coalesce(split_part(v, '.', 2), '') AS fr FROM c WHERE is_number)),
t AS (SELECT *, CASE WHEN utc_micros IS NULL THEN 'none' WHEN twice THEN 'ambiguous' WHEN never THEN 'nonexistent' ELSE 'exact' END AS time_status FROM n)"""
SQL |= {
    "p7_found": f"WITH {_TIMES} SELECT DISTINCT table_name, record_id, utc_micros FROM t WHERE utc_micros IS NOT NULL AND NOT regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\+00:00$')",
    "p7_status": f"WITH {_TIMES} SELECT table_name, time_status, count(*) AS n, CAST(min(utc_micros) AS VARCHAR) AS first_micros, CAST(max(utc_micros) AS VARCHAR) AS last_micros FROM t GROUP BY ALL",
}

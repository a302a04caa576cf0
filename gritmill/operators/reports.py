"""Counts and summaries over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import strip


def grouped_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, value, n) of each column; nulls are a value of their own. One pre-aggregation serves all columns."""
    base = df.groupBy(*columns).agg(F.count("*").alias("n"))
    places = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return base.select(F.explode(places).alias("x"), "n").groupBy("x.dimension", "x.value").agg(F.sum("n").alias("n"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls, rows): nulls and NaN per column."""
    kinds = dict(df.dtypes)
    missing = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(missing(c)).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])).alias("x"), "rows").select("x.column", "x.nulls", "rows")


def cross_source_overlap(df: DataFrame, key: str, source: str, identifier: str) -> DataFrame:
    """(key, sources, records): keys that more than one source names, with sorted distinct lists joined by ``|``."""
    rows = df.where(F.col(key).isNotNull() & F.col(source).isNotNull()).select(key, source, identifier).distinct()
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    shared = rows.groupBy(key).agg(F.countDistinct(source).alias("k")).where("k > 1").select(key)
    return rows.join(shared, key, "left_semi").groupBy(key).agg(joined(source).alias("sources"), F.countDistinct(identifier).alias("n_records"))


def stability(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """First, last, least, largest, mean, median and population deviation per group, and the values over the spike limit.

    A spike is larger than four medians, the median plus five, and one.
    """
    base = df.groupBy(by).agg(
        F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"), F.min(value).alias("least"), F.max(value).alias("largest"), F.round(F.avg(value), 6).alias("mean"),
        F.round(F.median(value), 6).alias("median"), F.round(F.stddev_pop(value), 6).alias("deviation"),
    )
    limit = F.greatest(4 * F.col("median"), F.col("median") + 5, F.lit(1.0))
    spikes = df.join(base.select(by, limit.alias("limit")), by).where(F.col(value) > F.col("limit")).groupBy(by).agg(F.count("*").alias("spikes"))
    return base.join(spikes, by, "left").withColumn("spikes", F.coalesce("spikes", F.lit(0)))


def top_values(df: DataFrame, column: str, most: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(column).asc_nulls_last()).limit(most)


def majority(df: DataFrame, by: str, label: str, position: str) -> DataFrame:
    """The most frequent label per group; of equally frequent ones the first seen by ``position``."""
    counts = df.where(F.col(label).isNotNull()).groupBy(by, label).agg(F.count("*").alias("n"), F.min(position).alias("p"))
    best = counts.groupBy(by).agg(F.min(F.struct((-F.col("n")).alias("n"), "p", F.col(label).alias("label"))).alias("x"), F.sum("n").alias("rows"))
    return best.select(by, F.col("x.label").alias("label"), F.round(-F.col("x.n") / F.col("rows"), 6).alias("share"))


def variant_deltas(scores: DataFrame, variant: str, baseline: str, value: str, by: list[str]) -> DataFrame:
    """Each variant's value, the baseline's and their difference."""
    base = scores.where(F.col(variant) == baseline).select(*by, F.col(value).alias("baseline"))
    return scores.join(base, by, "left").withColumn("delta", F.round(F.col(value) - F.col("baseline"), 6))


def sections(df: DataFrame, identifier: str, text: str, heading: str = r"(?m)^#{1,6}[^\S\n]+[^\n]+$") -> DataFrame:
    """(identifier, section, title, length) of the parts that start at headings; the part before the first heading is section 0."""
    clean = F.regexp_replace(F.col(text), "\r\n", "\n")
    # a mark no text holds stands before each heading, so one split gives all sections
    marked = F.split(F.regexp_replace(clean, f"({heading})", "\x01$1"), "\x01")
    rows = df.where(F.col(text).isNotNull()).select(F.col(identifier), F.posexplode(marked).alias("section", "body")).where("trim(body) <> ''")
    title = F.when(F.col("body").startswith("#"), strip(F.regexp_extract("body", r"^#{1,6}([^\n]*)", 1)))
    return rows.select(identifier, "section", title.alias("title"), F.length("body").alias("length"))


def manifest(df: DataFrame, columns: dict[str, str], seed: int) -> dict:
    """Totals and counts of a gold table as a JSON-able dict, collected from one aggregation."""
    counts: dict = {f"counts_by_{name}": {} for name in columns}
    names = {c: name for name, c in columns.items()}
    for r in grouped_counts(df, list(columns.values())).collect():
        counts[f"counts_by_{names[r.dimension]}"][str(r.value)] = r.n
    first = next(iter(counts.values()), {})
    return {"total_records": sum(first.values()), "seed": seed, **{k: dict(sorted(v.items())) for k, v in counts.items()}}


def markdown_table(rows: list[dict], columns: list[str]) -> str:
    """Rows as a Markdown table; bars are escaped, line ends become blanks."""
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"| {' | '.join(columns)} |", f"| {' | '.join('---' for _ in columns)} |"]
    return "\n".join(lines + [f"| {' | '.join(cell(r.get(c)) for c in columns)} |" for r in rows])


def silver_report(manifest_rows: list[dict], overlaps: int = 0) -> str:
    """Markdown report of module rows (see inventory.module_manifest): status, rows by category, licences, overlaps."""
    by_category: dict = {}
    for r in manifest_rows:
        by_category[r["main_category"]] = by_category.get(r["main_category"], 0) + r["row_count"]
    section = lambda title, rows, columns: f"## {title}\n\n{markdown_table(rows, columns) if rows else 'None'}\n"
    parts = [
        "# Silver Layer Report\n",
        section("Module Status", manifest_rows, ["silver_module", "status", "row_count", "license", "license_compatibility"]),
        section("Skipped or Blocked Modules", [r for r in manifest_rows if r["status"] in ("skipped", "blocked")], ["silver_module", "status"]),
        section("Rows by Category", [{"main_category": k, "row_count": n} for k, n in sorted(by_category.items(), key=str)], ["main_category", "row_count"]),
        section("Labels", manifest_rows, ["silver_module", "label_distribution"]),
        section("Excluded from Public Release", [r for r in manifest_rows if str(r["license_compatibility"]).startswith("restricted")], ["source_dataset", "license"]),
        f"## Cross-Source Overlap\n\n- identifiers named by several sources: {overlaps}\n",
    ]
    return "\n".join(parts)


def sft_report(counts: dict[str, list[dict]]) -> str:
    """Markdown report of prepared examples from collected counts: name of the table to its rows."""
    return "# Chat Examples\n\n" + "\n".join(f"## {name}\n\n{markdown_table(rows, list(rows[0]) if rows else ['none'])}\n" for name, rows in counts.items())


def card(manifest_: dict, title: str) -> str:
    """Markdown summary of a manifest."""
    lines = [f"# {title}", "", f"- records: {manifest_['total_records']}", f"- seed: {manifest_['seed']}"]
    for group, counts in manifest_.items():
        if group.startswith("counts_by_"):
            lines += ["", f"## {group.removeprefix('counts_by_')}", "", "| value | records |", "| --- | ---: |"]
            lines += [f"| {k.replace('|', chr(92) + '|')} | {n} |" for k, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    return "\n".join(lines) + "\n"

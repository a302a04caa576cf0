import json

import pandas as pd
import pytest
from brute_nested import feature_rows, nvd_rows
from brute_times import read
from pyspark.sql import functions as F

from gritmill.operators import nested, timestamps

D = "/root/testdata/sf0.001/"


def test_flatten_equals_brute_force(spark):
    items, silver = pd.read_parquet(D + "nvd_items.parquet"), pd.read_parquet(D + "silver_records.parquet").drop_duplicates("record_id")
    want = {x for r in items.itertuples() for x in nvd_rows(r.item_id, r.cve, r.raw)} | {x for r in silver.itertuples() for x in feature_rows(r.record_id, r.features_json)}
    got = nested.flatten_nvd(spark.read.parquet(D + "nvd_items.parquet")).unionByName(nested.flatten_features(spark.read.parquet(D + "silver_records.parquet"))).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_flatten_odd_items(spark):
    v2 = {"id": "x", "descriptions": {"lang": "en", "value": "a"}, "weaknesses": None, "references": [{"url": "u", "tags": "t"}, {"url": None}, 5]}
    rows = [
        (1, json.dumps(v2), None, "extra"),
        (2, None, json.dumps(json.dumps({"cve": v2})), None),
        (3, "{", "{", None),
        (4, "", json.dumps({"cve": "text"}), None),
        (5, "[1]", None, None),
        (6, "{}", json.dumps({"cve": v2}), None),
        (None, json.dumps(v2), None, None),
        (1, json.dumps(v2), None, "extra"),
    ]
    df = spark.createDataFrame(rows, "item_id long, cve string, raw string, parent_key string")
    got = sorted((tuple(r) for r in nested.flatten_nvd(df.drop("parent_key")).collect()), key=str)
    assert got == sorted((tuple(r) for r in nested.flatten_nvd(df).collect()), key=str)
    one = [("description", "0", "en"), ("reference", "0", "u"), ("reference_tag", "0.0", "t")]
    assert sorted(r[2:] for r in got if r[1] == "1") == sorted(one * 2)
    assert sorted(r[2:] for r in got if r[1] == "2") == sorted(r[2:] for r in got if r[1] == "6") == one
    assert sorted(r[2:] for r in got if r[1] is None) == one
    assert not [r for r in got if r[1] in ("3", "4", "5")]
    assert nested.flatten_nvd(df.limit(0)).count() == 0


def test_subtype_tables(spark):
    """Typed tables, parent links that resolve, rows for elements without content."""
    items, silver = spark.read.parquet(D + "nvd_items.parquet"), spark.read.parquet(D + "silver_records.parquet")
    for rows in (nested.nvd_elements(items), nested.feature_elements(silver)):
        keys = rows.select("row_key", "parent_row_key", "parent_table", "parent_key").cache()
        assert keys.count() == keys.select("row_key").distinct().count() > 0
        records = keys.select(F.concat_ws("/", "parent_table", "parent_key").alias("row_key")).distinct()
        known = keys.select("row_key").union(records).distinct().withColumnRenamed("row_key", "above")
        assert keys.join(known, F.col("parent_row_key") == F.col("above"), "left_anti").count() == 0
    odd = {"id": "x", "references": [{"tags": ["a"]}, {"url": None}], "weaknesses": [{}], "configurations": {"operator": "AND", "nodes": {"negate": True, "cpeMatch": {"criteria": "c", "vulnerable": False}}}}
    df = spark.createDataFrame([(1, json.dumps(odd), None)], "item_id long, cve string, raw string")
    tag, references = nested.nvd_table(df, "reference_tag").collect(), {r.row_key: r.url for r in nested.nvd_table(df, "reference").collect()}
    assert [(r.tag, references[r.parent_row_key]) for r in tag] == [("a", None)] and len(references) == 2
    assert [(r.criteria, r.vulnerable) for r in nested.nvd_table(df, "cpe").collect()] == [("c", False)]
    assert nested.nvd_table(df, "weakness_entry").count() == 1 and nested.nvd_table(df, "node").first().negate is True
    flows = nested.feature_table(silver, "flow")
    assert dict(flows.dtypes)["dport"] == "int" and flows.where("dport is not null").count() > 0
    assert nested.feature_table(silver, "section").where("rsize > 0").count() > 0
    assert nested.shapes(nested.feature_documents(silver)).where("variant = 'executable'").count() > 1


FEEDS = [("ny_feed", "America/New_York", "MDY"), ("berlin_feed", "Europe/Berlin", "DMY"), ("berlin_feed", "Europe/Berlin", "DMY"), (None, "Asia/Tokyo", "YMD")]


@pytest.mark.parametrize(
    ("value", "source", "status"),
    [
        ("2021-03-14T02:30:00", "NY feed", "nonexistent"),
        ("2021-11-07 01:30:00", "ny-feed", "ambiguous"),
        ("03/04/2022 05:06", "ny_feed", "exact"),
        ("03.04.2022 05:06", "Berlin Feed", "exact"),
        ("2022-02-29", "ny_feed", "none"),
        ("1999-12-31", "ny_feed", "exact"),
        ("Mar 6, 2021 12:10 AM", "x", "exact"),
        ("1658122398.8569999", "x", "exact"),
        ("1850-07-01 12:00:00", "ny_feed", "exact"),
        ("1916-06-01 12:00:00", "berlin_feed", "exact"),
        ("2475-07-01 12:00:00", "ny_feed", "exact"),
        ("9998-07-01 12:00:00", "ny_feed", "exact"),
        ("1658122398856999912", "x", "exact"),
        ("-86400.25", "x", "exact"),
        ("2024-05-20 08:07:26 America/New_York", "x", "exact"),
        ("2024-05-20T08:07:26.123456789-03:30", "x", "exact"),
        ("2024-05-20 24:07:26", "x", "none"),
        ("soon", None, "none"),
        ("   ", "x", "none"),
        (None, None, "none"),
        ("9" * 5000, "x", "none"),
    ],
)
def test_time_forms(spark, value, source, status):
    df = spark.createDataFrame([(value, source, "kept")], "value string, source string, utc_micros string")
    feeds = spark.createDataFrame(FEEDS, "source_id string, zone string, date_order string")
    rows = timestamps.normalise_timestamps(df, "value", "source", feeds).collect()
    clean = "".join(c if c.isalnum() else "_" for c in (source or "").lower())
    zone, order = {a: (b, c) for a, b, c in FEEDS}.get(clean, ("UTC", "YMD"))
    assert len(rows) == 1 and rows[0].time_status == status
    assert rows[0].utc_micros == (read(value, zone, order) if status != "none" else None)


def test_times_equal_brute_force(spark):
    feeds = {r.source_id: (r.zone, r.date_order) for r in pd.read_parquet(D + "source_feeds.parquet").itertuples()}
    rows = timestamps.feed_times(spark.read.parquet(D + "silver_records.parquet"), spark.read.parquet(D + "gold_unified.parquet"))
    done = timestamps.normalise_timestamps(rows, "value", "source", spark.read.parquet(D + "source_feeds.parquet"))
    assert done.count() == rows.count()
    for r in done.withColumn("s", timestamps.clean_source("source")).collect():
        assert r.utc_micros == read(r.value, *feeds.get(r.s, ("UTC", "YMD"))), r
    assert timestamps.normalise_timestamps(rows.limit(0), "value", "source", spark.read.parquet(D + "source_feeds.parquet").where(F.lit(False))).count() == 0

"""Decoding, normalising and enriching raw articles."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newslens.operators import articles as ops
from newslens.sources import articles as src
from newslens.sources import feeds

RAW = ("id", "title", "body", "url", "source", "source_category", "language", "timestamp", "gdelt_tone")


def test_malformed_messages_become_nulls_and_fall_out(spark):
    rows = [('{"id":"1","title":"T","gdelt_tone":1.5,"other":3}',), ("{broken",), ("[]",), ('{"id":"2"}',), ('{"id":"3","title":""}',), (None,)]
    decoded = src.decode(spark.createDataFrame(rows, "value string"))
    assert decoded.columns == list(RAW)
    assert decoded.count() == 6
    assert [r.id for r in ops.valid(decoded).collect()] == ["1"]


def test_enrich_defaults_for_null_and_empty(spark):
    now = datetime(2024, 1, 30, 12)
    rows = [
        ("1", "t", None, None, None, None, None, None, None),
        ("2", "t", "", "", "", "", "", "", 0.0),
        ("3", "t", "b", "u", "s", "c", "fr", "2024-01-02T03:04:05.5+00:00", -2.5),
        ("4", "t", "b", "u", "s", "c", "fr", "not a date", 1.0),
    ]
    raw = spark.createDataFrame(rows, src.RAW_SCHEMA)
    got = {r.id: r for r in src.enrich(raw, now).withColumn("ts", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.S")).collect()}
    for i in ("1", "2"):
        assert (got[i].body, got[i].url, got[i].source, got[i].source_category, got[i].language) == ("", "", "", "unknown", "en")
        assert got[i].gdelt_tone == 0.0 and got[i].ts == "2024-01-30 12:00:00.0"
    assert (got["3"].source_category, got["3"].gdelt_tone, got["3"].ts) == ("c", -2.5, "2024-01-02 03:04:05.5")
    assert got["4"].ts == "2024-01-30 12:00:00.0"


def test_feed_entries(spark):
    rows = [("AFP", i, f"t{i}", "s" * 600, f"l{i}") for i in range(1, 26)] + [("Nowhere", 1, None, None, None)]
    entries = spark.createDataFrame(rows, "feed string, position int, title string, summary string, link string")
    got = feeds.normalise_feed(entries, feeds.feed_registry(spark), F.lit("now")).collect()
    afp = [r for r in got if r.source == "AFP"]
    assert len(afp) == 20 and {len(r.body) for r in afp} == {500}
    assert {(r.language, r.source_category, r.gdelt_tone) for r in afp} == {("fr", "reliable", 0.0)}
    other = next(r for r in got if r.source == "Nowhere")
    assert (other.title, other.body, other.url, other.language, other.source_category) == ("", "", "", "en", "reliable")
    assert other.id == hashlib.md5(b"").hexdigest()


def test_feed_registry(spark):
    assert feeds.feed_registry(spark).count() == 12
    assert feeds.feed_registry(spark, (("X", "u", "fr", "suspicious"),)).filter("category = 'suspicious'").count() == 1


def test_gdelt_records(spark):
    rows = [("u", "t", "20240101", "d.org", "Spanish", t) for t in (None, "", "abc", "-2.5", "3")] + [(None, None, None, None, None, None)]
    got = feeds.normalise_gdelt(spark.createDataFrame(rows, "url string, title string, seendate string, domain string, language string, tone string"), F.lit("x")).collect()
    assert [r.gdelt_tone for r in got[:5]] == [0.0, 0.0, 0.0, -2.5, 3.0]
    assert {(r.language, r.source, r.body, r.source_category) for r in got[:5]} == {("sp", "d.org", "20240101", "gdelt")}
    assert (got[5].language, got[5].source, got[5].title, got[5].body) == ("en", "gdelt", "", "")


def test_dedup_keeps_one_row_per_id(spark):
    df = spark.createDataFrame([("a", i, f"body {i}") for i in range(500, 0, -1)] + [("b", 7, "x"), (None, 9, "y"), (None, 8, "z")], "id string, pos long, body string")
    found = src.dedup_ingest(df, order=["pos"])
    assert sorted((r.id or "", r.pos, r.body) for r in found.collect()) == [("", 8, "z"), ("a", 1, "body 1"), ("b", 7, "x")]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        src.dedup_ingest(df)


def test_published_messages_decode_again(spark, tmp_path):
    df = spark.createDataFrame([("1", "té", "b", "u", "s", "c", "fr", "2024", 1.5)], src.RAW_SCHEMA)
    src.publish(df, "json", path=str(tmp_path / "topic"))
    assert src.decode(spark.read.json(str(tmp_path / "topic"))).collect() == df.collect()


@pytest.mark.parametrize("call", [
    lambda d, n: ops.recent(d, 201), lambda d, n: ops.virality(d, n, 169), lambda d, n: ops.recent(d, -1),
])
def test_limits(spark, call):
    df = spark.createDataFrame([("1", datetime(2024, 1, 1))], "id string, processed_at timestamp")
    with pytest.raises(ValueError):
        call(df, datetime(2024, 1, 1))


def test_time_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = ops.since(df, datetime(2024, 1, 30), 5, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-29T19:00" in plan


def test_first_entries_of_each_scrape(spark):
    rows = [("AFP", s, i, f"t{s}-{i}") for s in range(2) for i in range(30)] + [("RFI", 0, i, f"r{i}") for i in range(3)]
    entries = spark.createDataFrame(rows, "feed string, scrape int, entry int, title string").selectExpr("*", "'' summary", "title link").repartition(6)
    got = feeds.normalise_feed(entries, feeds.feed_registry(spark), F.lit("now"), order=["entry"])
    assert {r.title for r in got.collect()} == {f"t{s}-{i}" for s in range(2) for i in range(20)} | {"r0", "r1", "r2"}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()

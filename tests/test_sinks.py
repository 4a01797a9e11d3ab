"""Batch folders, last write per id, compaction, versions, exports."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newslens.operators.search import score_hits
from newslens.plans.storage import folders
from newslens.sources import sinks

SCHEMA = "id string, title string, timestamp timestamp, processed_at timestamp, p_fake double"


def batch(spark, rows):
    return spark.createDataFrame([(i, t, datetime(2024, 1, d), datetime(2024, 1, d, 5), p) for i, t, d, p in rows], SCHEMA)


def view(spark, root):
    return sorted((r.id, r.title) for r in sinks.current_articles(spark, root).collect())


def test_last_write_wins_and_replays_change_nothing(spark, tmp_path):
    root = str(tmp_path / "articles")
    assert sinks.current_articles(spark, root) is None
    first, second = batch(spark, [("a", "old", 1, 0.1), ("b", "b", 1, 0.2)]), batch(spark, [("a", "new", 2, 0.3), ("a", "newer", 3, 0.3), ("c", "c", 2, 0.4)])
    report = sinks.upsert_report(sinks.current_articles(spark, root), first).first()
    assert (report.inserts, report.updates) == (2, 0)
    sinks.upsert_articles(first, 0, root)
    report = sinks.upsert_report(sinks.current_articles(spark, root), second).first()
    assert (report.inserts, report.updates) == (1, 1)
    sinks.upsert_articles(second, 1, root)
    want = [("a", "newer"), ("b", "b"), ("c", "c")]
    assert view(spark, root) == want
    sinks.upsert_articles(second, 1, root)
    assert view(spark, root) == want


def test_compaction_keeps_the_view(spark, tmp_path):
    root = str(tmp_path / "articles")
    for n in range(4):
        sinks.upsert_articles(batch(spark, [("hot", f"t{n}", n + 1, 0.1), (f"id{n}", "x", n + 1, 0.2)]), n, root)
    before = view(spark, root)
    sinks.compact_articles(spark, root, 1)
    assert view(spark, root) == before
    sinks.compact_articles(spark, root, 2)
    assert view(spark, root) == before
    sinks.upsert_articles(batch(spark, [("id0", "late", 9, 0.2)]), 4, root)
    assert ("id0", "late") in view(spark, root) and len(view(spark, root)) == len(before)
    base = spark.read.parquet(f"{root}/base/data/version=2")
    assert "processed_date" in base.columns and base.select("id").distinct().count() == base.count()


def test_the_base_is_not_moved_or_sorted(spark, tmp_path):
    root = str(tmp_path / "articles")
    for n in range(3):
        sinks.upsert_articles(batch(spark, [(f"id{i}", f"t{n}", n + 1 + i % 3, 0.1) for i in range(n, 40, n + 1)]), n, root)
    before = view(spark, root)
    sinks.compact_articles(spark, root, 1, buckets=5)
    assert view(spark, root) == before
    # another session knows nothing of the buckets
    other = spark.newSession()
    spark.sql(f"DROP TABLE {sinks._table_name(f'{root}/base/data/version=1')}")
    assert sorted((r.id, r.title) for r in sinks.current_articles(other, root).collect()) == before
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = sinks.current_articles(other, root)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortAggregate" not in plan and "SortMergeJoin" not in plan.split("Union")[0]
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line or "SelectedBucketsCount" in line)
    join = next(i for i, line in enumerate(lines) if "ShuffledHashJoin" in line)
    assert join < scan and not any("Exchange" in line or "Sort " in line for line in lines[join:scan])


def test_the_base_has_a_file_a_bucket_and_more_buckets_as_it_grows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "articles")
    day = "make_timestamp(2024, 1, 1, 0, 0, 0) + make_dt_interval(CAST(id AS INT))"  # a row a day
    rows = spark.range(400).selectExpr("CAST(id AS STRING) AS id", "md5(CAST(id AS STRING)) AS title", f"{day} AS processed_at")
    sinks.upsert_articles(rows, 0, root, ["processed_at"])
    sinks.compact_articles(spark, root, 0, buckets=2)
    assert len(spark.read.parquet(f"{root}/base/data/version=0").inputFiles()) == 2
    monkeypatch.setattr(sinks, "BUCKET_BYTES", 4096)
    sinks.upsert_articles(rows.filter("id < 100"), 1, root, ["processed_at"])
    sinks.compact_articles(spark, root, 1, buckets=2)
    base = spark.read.parquet(f"{root}/base/data/version=1")
    assert len(base.inputFiles()) > 2 and base.select("processed_date").distinct().count() == 400
    assert sorted(r.id for r in sinks.current_articles(spark, root).collect()) == sorted(str(i) for i in range(400))


def test_an_attempt_without_its_marker_is_written_anew(spark, tmp_path):
    root = str(tmp_path / "articles")
    sinks.upsert_articles(batch(spark, [("a", "x", 1, 0.1)]), 0, root)
    batch(spark, [("z", "broken", 1, 0.1)]).write.parquet(f"{root}/base/data/version=0")
    sinks.compact_articles(spark, root, 0)
    sinks.compact_articles(spark, root, 0)
    assert view(spark, root) == [("a", "x")]


def test_an_unannounced_version_is_not_read(spark, tmp_path):
    root = str(tmp_path / "weights")
    assert sinks.latest_weights(spark, root) is None
    sinks.publish_weights(spark.range(3), root, 100)
    spark.range(9).write.parquet(f"{root}/data/version=200")
    assert sinks.latest_weights(spark, root).count() == 3
    sinks.publish_weights(spark.range(5), root, 200)
    assert sinks.latest_weights(spark, root).count() == 5


def test_drift_alert_sink(spark, tmp_path):
    alerts = spark.createDataFrame([(7, 0.55, (True, False, True))], "_batch_id int, composite_score double, signals struct<ADWIN:boolean,KSWIN:boolean,PageHinkley:boolean>")
    for _ in range(2):
        sinks.write_drift_alerts(alerts, 7, str(tmp_path / "drift"))
    rows = sinks.read_batches(spark, str(tmp_path / "drift/rows")).collect()
    assert len(rows) == 1 and rows[0].batch_id == 7
    (message,) = spark.read.text(str(tmp_path / "drift/messages")).select("value").collect()
    assert json.loads(message.value) == {"_batch_id": 7, "composite_score": 0.55, "signals": {"ADWIN": True, "KSWIN": False, "PageHinkley": True}}


def test_postings_of_batches(spark, tmp_path):
    df = spark.createDataFrame([("1", "A a b", "")], "id string, title string, body string")
    sinks.write_postings(df, 0, str(tmp_path / "index"))
    rows = {r.term: (r.field, r.tf, r.dl) for r in sinks.read_batches(spark, str(tmp_path / "index/postings")).collect()}
    assert rows == {"a": ("title", 2, 3), "b": ("title", 1, 3)}


def test_a_search_sees_only_the_newest_text_of_an_article(spark, tmp_path):
    root = str(tmp_path / "index")
    assert sinks.current_index(spark, root) is None
    for n, rows in enumerate([[("1", "old words", "x"), ("2", "old", "y")], [("1", "new words", "")]]):
        sinks.write_postings(spark.createDataFrame(rows, "id string, title string, body string"), n, root)
    index = sinks.current_index(spark, root)
    assert sorted(r.id for r in score_hits(index, "old").collect()) == ["2"]
    assert sorted(r.id for r in score_hits(index, "new words").collect()) == ["1"]
    assert sorted(tuple(r) for r in index.lengths.collect()) == [("1", "title", 2), ("2", "body", 1), ("2", "title", 1)]


def test_merged_segments_give_the_same_index(spark, tmp_path):
    root = str(tmp_path / "index")
    batches = [[("1", "old words", "x"), ("2", "old", "y z"), ("3", "kept", "words")], [("1", "new words", "")], [("4", "late", "words"), ("2", "newer", "y")]]
    facts = lambda index: (sorted(map(tuple, index.postings.select("id", "field", "term", "tf").collect())), sorted(map(tuple, index.lengths.select("id", "field", "dl").collect())))
    found = lambda index, query, fuzzy: sorted((r.id, round(r.score, 9)) for r in score_hits(index, query, fuzzy).collect())
    for n, rows in enumerate(batches):
        sinks.write_postings(spark.createDataFrame(rows, "id string, title string, body string"), n, root)
        apart = sinks.current_index(spark, root)
        want = facts(apart), [found(apart, q, f) for q in ("words", "old new", "newre wrods") for f in (False, True)]
        if n == 1:
            sinks.compact_index(spark, root, 1)
            merged = sinks.current_index(spark, root)
            assert (facts(merged), [found(merged, q, f) for q in ("words", "old new", "newre wrods") for f in (False, True)]) == want
            plan = merged.postings.filter("term = 'words'")._jdf.queryExecution().executedPlan().toString()
            assert "PushedFilters" in plan and "Aggregate" not in plan and "Join" not in plan
    sinks.compact_index(spark, root, 2)
    sinks.compact_index(spark, root, 2)
    merged = sinks.current_index(spark, root)
    assert (facts(merged), [found(merged, q, f) for q in ("words", "old new", "newre wrods") for f in (False, True)]) == want


def test_what_a_merge_replaced_can_be_discarded(spark, tmp_path):
    root = str(tmp_path / "index")
    batches = [[("1", "old words", "x"), ("2", "old", "y z")], [("1", "new words", "")], [("4", "late", "words"), ("2", "newer", "y")], [("5", "last", "words")]]
    held = lambda: [n for name in ("fields", "postings", "lengths", "terms") for n in folders(spark, f"{root}/{name}") if n.startswith("batch")] + [n for n in folders(spark, f"{root}/base/data") if n.startswith("version")]
    found = lambda: [sorted((r.id, round(r.score, 9)) for r in score_hits(sinks.current_index(spark, root), q, f).collect()) for q in ("words", "old new", "newre wrods") for f in (False, True)]
    for n, rows in enumerate(batches):
        sinks.write_postings(spark.createDataFrame(rows, "id string, title string, body string"), n, root)
        want = found()
        sinks.discard_merged(spark, root)
        if n in (1, 2):
            sinks.compact_index(spark, root, n)
            sinks.discard_merged(spark, root)
            assert held() == [f"version={n}"]
        assert found() == want
    assert held() == ["batch_id=3"] * 4 + ["version=2"]


def test_an_article_without_words_left_is_no_longer_found(spark, tmp_path):
    root = str(tmp_path / "index")
    for n, title in enumerate(["words", ""]):
        sinks.write_postings(spark.createDataFrame([("1", title, "")], "id string, title string, body string"), n, root)
    assert score_hits(sinks.current_index(spark, root), "words").count() == 0
    sinks.compact_index(spark, root, 1)
    assert sinks.current_index(spark, root).postings.count() == 0


def test_alert_history(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for day in range(1, 5):
        row = [("warning", "t", "m", "fake_rate", 50.0 + day, datetime(2024, 1, day))]
        sinks.append_alerts(spark.createDataFrame(row, "severity string, title string, message string, metric string, value double, timestamp timestamp"), path, day)
    assert [r.value for r in sinks.recent_alerts(spark, path, 3).collect()] == [54.0, 53.0, 52.0]


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b", c\nd', (True,), [1, 2])], "id string, title string, signals struct<ADWIN:boolean>, xs array<int>")
    sinks.export_csv(df, ["title", "signals", "xs"], str(tmp_path / "out"))
    back = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path / "out")).collect()
    assert [tuple(r) for r in back] == [('a "b", c\nd', '{"ADWIN":true}', "[1,2]")]


@pytest.mark.parametrize("n", [50, 3])
def test_a_repeated_id_is_reduced_before_the_shuffle(spark, n):
    df = spark.range(0, 10_000, 1, n).select(F.lit("same").alias("id"), F.col("id").alias("v"))
    assert sinks.last_per_id(df, ["v"]).collect() == [("same", 9999)]
    plan = sinks.last_per_id(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan

"""Streams over file sources: decoding, dedup, monitoring, and the two jobs end to end."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.functions.sequential import Settings
from newslens.operators import drift, model
from newslens.operators.articles import valid
from newslens.operators.detectors import detect
from newslens.operators.search import search
from newslens.sources import articles as src
from newslens.sources import sinks
from newslens.streaming import jobs
from newslens.streaming.monitor import monitor_stream

START = datetime(2024, 1, 1)


def drain(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert query.exception() is None
    return df.sparkSession.table(name)


def land(folder, number, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{number:03d}.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")


def article(i, minute=0, **more):
    return {"id": f"{i:05d}", "title": f"title {i}", "body": "b", "url": "u", "source": f"s{i % 2}", "timestamp": (START + timedelta(minutes=minute)).isoformat(), **more}


def test_json_files_as_article_stream(spark, tmp_path):
    land(tmp_path, 0, [article(1), {"id": "2"}, {"id": "3", "title": ""}])
    land(tmp_path, 1, [article(4, gdelt_tone=-1.5)])
    got = drain(valid(src.read_articles(spark, "json", path=str(tmp_path), maxFilesPerTrigger="1")), "raw_articles")
    assert sorted(r.id for r in got.collect()) == ["00001", "00004"]
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in src.RAW_SCHEMA}


def test_stream_dedup_remembers_ids(spark, tmp_path):
    land(tmp_path, 0, [article(1), article(1), article(2)])
    land(tmp_path, 1, [article(1, 10), article(3, 10)])
    raw = src.read_articles(spark, "json", path=str(tmp_path), maxFilesPerTrigger="1")
    timed = raw.withColumn("at", F.to_timestamp("timestamp"))
    assert sorted(r.id for r in drain(src.dedup_ingest(timed, "at"), "deduped").collect()) == ["00001", "00002", "00003"]
    with pytest.raises(ValueError):
        src.dedup_ingest(timed)


MONITORED = ["message_index", "adwin", "kswin", "page_hinkley", "composite_score", "drift_active", "drift_confirmed", "is_edge",
             "recommended_lr", "confidence_mean_last100", "total_drift_events"]


def test_stream_and_batch_monitor_agree(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 2400
    levels = np.repeat(rng.choice([0.1, 0.5, 0.9], n // 200), 200)
    p = np.clip(levels + rng.normal(0, 0.05, n), 0, 1)
    rows = [(f"{i:05d}", "hot" if i % 4 else "cold", START + timedelta(seconds=i), float(p[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, key string, processed_at timestamp, p_fake double")
    for k in range(6):
        part = df.filter((F.col("id").cast("int") >= k * 400) & (F.col("id").cast("int") < (k + 1) * 400))
        part.repartition(1).write.mode("append").parquet(str(tmp_path / "scores"))
    s = Settings(ph_threshold=0.2, kswin_alpha=0.3)  # alarms often enough to coincide
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "scores"))
    got = drain(monitor_stream(stream, ["processed_at", "id"], "key", settings=s), "monitored").select("id", *MONITORED).orderBy("id").collect()
    order = ["processed_at", "id"]
    want = drift.drift_state(detect(df, order, ["key"], settings=s), order, ["key"]).select("id", *MONITORED).orderBy("id").collect()
    assert len(got) == len(want) == n
    assert any(r.is_edge for r in want) and any(r.adwin for r in want) and any(r.kswin for r in want) and any(r.page_hinkley for r in want)
    for g, w in zip(got, want):
        assert g.confidence_mean_last100 == pytest.approx(w.confidence_mean_last100, abs=1.01e-4)
        assert g.asDict() | {"confidence_mean_last100": 0} == w.asDict() | {"confidence_mean_last100": 0}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    job = jobs.Job(root=str(base / "root"), sync_every=2, reservoir_rows=30, files_per_trigger=1)
    incoming = base / "in"
    land(incoming, 0, [article(i) for i in range(20)] + [{"id": "bad", "title": ""}])
    land(incoming, 1, [article(i, 5) for i in range(15, 40)])

    def score(df):
        p = F.when(F.col("source") == "s1", 0.9).otherwise(0.2)
        return df.withColumn("p_fake", p).withColumn("is_fake", (p > 0.5).cast("int")).withColumn("confidence", F.greatest(p, 1 - p))

    def run(scorer):
        for start in (
            lambda: jobs.start_scoring(spark, job, "json", score=scorer, once=True, path=str(incoming), maxFilesPerTrigger="1"),
            lambda: jobs.start_monitoring(spark, job, once=True),
        ):
            query = start()
            query.awaitTermination(300)
            assert query.exception() is None

    run(score)
    return job, incoming, run


def test_articles_are_stored_once(spark, finished):
    job, _, _ = finished
    rows = sinks.current_articles(spark, job.at("articles")).collect()
    assert sorted(r.id for r in rows) == [f"{i:05d}" for i in range(40)]
    assert {r.language for r in rows} == {"en"} and {r.source_category for r in rows} == {"unknown"}
    assert all(r.drift_active is False and r.drift_score == 0.0 for r in rows)


def test_stored_articles_can_be_searched(spark, finished):
    job, _, _ = finished
    index = sinks.current_index(spark, job.at("index"))
    found = search(index, sinks.current_articles(spark, job.at("articles")), "title 7", 1).collect()
    assert [r.id for r in found] == ["00007"]


def test_learning_state(spark, finished):
    job, _, _ = finished
    steps = sinks.read_batches(spark, job.at("steps")).orderBy("step").collect()
    assert [r.step for r in steps] == list(range(1, len(steps) + 1)) and len(steps) >= 2
    assert steps[0].loss == pytest.approx(0.6931, abs=1e-3) and steps[0].lr == 1e-5
    assert sum(r.examples for r in steps) == 40
    last = spark.read.parquet(f"{job.at('reservoir')}/batch_id={steps[-1].batch_id}")
    assert last.count() == 30
    assert sinks.latest_weights(spark, job.at("weights")) is not None


def test_a_repeated_batch_changes_nothing(spark, finished):
    job, _, _ = finished
    steps = sinks.read_batches(spark, job.at("steps")).orderBy("step").collect()
    weights = sorted(spark.read.parquet(f"{job.at('learner')}/batch_id={steps[-1].batch_id}").collect())
    batch = sinks.current_articles(spark, job.at("articles")).limit(5)
    batch = batch.withColumn("message_index", F.lit(1).cast("long")).withColumn("recommended_lr", F.lit(1e-5))
    jobs.learn(spark, job, batch, steps[-1].batch_id + 1)
    once = spark.read.parquet(f"{job.at('learner')}/batch_id={steps[-1].batch_id + 1}").orderBy("feature").collect()
    jobs.learn(spark, job, batch, steps[-1].batch_id + 1)
    assert spark.read.parquet(f"{job.at('learner')}/batch_id={steps[-1].batch_id + 1}").orderBy("feature").collect() == once
    assert sorted(spark.read.parquet(f"{job.at('learner')}/batch_id={steps[-1].batch_id}").collect()) == weights


def test_a_restart_takes_only_new_files_and_scores_with_published_weights(spark, finished):
    job, incoming, run = finished
    land(incoming, 2, [article(i, 9) for i in range(38, 45)])
    run(None)
    rows = sinks.current_articles(spark, job.at("articles")).collect()
    assert sorted(r.id for r in rows) == [f"{i:05d}" for i in range(45)]
    assert {r.id: r.p_fake for r in rows}["00044"] not in (0.9, 0.2)


def test_articles_without_id_and_late_ones_are_kept(spark, tmp_path):
    job = jobs.Job(str(tmp_path / "job"))
    records = [{**article(1), "id": None}, {**article(2), "id": ""}, {**article(3), "id": None}, article(4)]
    land(tmp_path / "in", 0, records)
    for start in (lambda: jobs.start_scoring(spark, job, "json", once=True, path=str(tmp_path / "in")), lambda: jobs.start_monitoring(spark, job, once=True)):
        query = start()
        query.awaitTermination(300)
        assert query.exception() is None
    rows = sinks.current_articles(spark, job.at("articles"))
    assert sorted(r.title for r in rows.collect()) == ["title 1", "title 2", "title 3", "title 4"]
    # a row that the monitor never sees, for it is older than all it remembers
    late = spark.read.parquet(f"{job.at('scored')}/batch_id=0").filter("title = 'title 4'").withColumns({"id": F.lit("late"), "title": F.lit("late one")})
    jobs.store_arrivals(job, late, 7)
    rows = sinks.current_articles(spark, job.at("articles"))
    assert rows.count() == 5 and rows.filter("id = 'late'").count() == 1
    found = search(sinks.current_index(spark, job.at("index")), rows, "late one", 1).collect()
    assert [r.id for r in found] == ["late"]


def test_graceful_stop(spark, tmp_path):
    land(tmp_path / "in", 0, [article(i) for i in range(3)])
    seen = []
    raw = src.read_articles(spark, "json", path=str(tmp_path / "in"))
    query = raw.writeStream.foreachBatch(lambda df, n: seen.append(df.count())).option("checkpointLocation", str(tmp_path / "cp")).start()
    jobs.stop_gracefully(query)
    assert sum(seen) == 3 and not query.isActive


def test_kafka_options_are_passed_on(spark):
    """No connector is installed here; Spark must at least look for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        src.read_articles(spark, "kafka", **{"kafka.bootstrap.servers": "b:1", "subscribe": "t"})


def test_weights_for_an_empty_start(spark):
    df = spark.createDataFrame([("1", "t", "b")], "id string, title string, body string")
    assert model.score_with_weights(df, model.empty_weights(spark)).first().p_fake == 0.5

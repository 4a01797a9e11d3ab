"""Notification groups: wait, interval, repeat, and the stream against the batch."""

from datetime import datetime, timedelta

import pytest

from newslens.operators import notifications as ops

T0 = datetime(2024, 1, 1)
SCHEMA = "alertname string, uid string, tick timestamp, state string"


def states(spark, rows):
    return spark.createDataFrame([(g, u, T0 + timedelta(seconds=60 * m), "Alerting" if on else "Normal") for g, u, m, on in rows], SCHEMA)


def told(df):
    return sorted((r.alertname, (r.sent_at - T0).total_seconds() / 60, r.kind, tuple(r.firing), tuple(r.resolved)) for r in df.collect())


def minutes(name, uid, on, upto):
    return [(name, uid, m, any(a <= m < b for a, b in on)) for m in range(upto)]


def test_wait_interval_and_repeat(spark):
    rows = minutes("g", "a", [(5, 140)], 200) + minutes("g", "b", [(7, 9), (12, 30)], 200)
    assert told(ops.grouped_notifications(states(spark, rows))) == [
        ("g", 5.5, "firing", ("a",), ()),
        ("g", 15.5, "firing", ("a", "b"), ()),  # b at 10 is over again and never told of
        ("g", 30.5, "firing", ("a",), ("b",)),
        ("g", 90.5, "repeat", ("a",), ()),
        ("g", 140.5, "resolved", (), ("a",)),
    ]


def test_a_group_ends_and_comes_back(spark):
    rows = minutes("g", "a", [(1, 3), (4, 6), (20, 21)], 40) + minutes("h", "x", [(39, 40)], 40)
    assert told(ops.grouped_notifications(states(spark, rows))) == [
        ("g", 1.5, "firing", ("a",), ()),  # the look at 6.5 finds it over, though it stopped and fired in between
        ("g", 6.5, "resolved", (), ("a",)),
        ("g", 20.5, "firing", ("a",), ()),
        ("g", 25.5, "resolved", (), ("a",)),
    ]


def test_other_times_and_no_rows(spark):
    rows = minutes("g", "a", [(0, 10)], 12)
    timing = ops.Timing(wait=90, interval=120, repeat=240)
    assert told(ops.grouped_notifications(states(spark, rows), timing=timing)) == [
        ("g", 1.5, "firing", ("a",), ()), ("g", 5.5, "repeat", ("a",), ()), ("g", 9.5, "repeat", ("a",), ()),
    ]
    assert told(ops.grouped_notifications(states(spark, rows).limit(0))) == []


@pytest.mark.parametrize("files", [1, 7])
def test_the_stream_equals_the_batch(spark, tmp_path, files):
    rows = minutes("g", "a", [(5, 33), (50, 150)], 180) + minutes("g", "b", [(7, 60)], 180) + minutes("h", "c", [(3, 12)], 100) + minutes("clock", "z", [], 180)
    whole = states(spark, rows)
    for n in range(files):
        low, high = T0 + timedelta(minutes=180 * n // files), T0 + timedelta(minutes=180 * (n + 1) // files)
        whole.filter((whole.tick >= low) & (whole.tick < high)).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    # time moves on beyond the last tick
    states(spark, [("clock", "z", 400, False), ("clock", "z", 401, False)]).write.parquet(str(tmp_path / "in/z0"))
    states(spark, [("clock", "z", 402, False)]).write.parquet(str(tmp_path / "in/z1"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    sent = ops.notification_stream(source)
    query = sent.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    limit = T0 + timedelta(minutes=179)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert told(got.filter(got.sent_at <= limit)) == told(ops.grouped_notifications(whole))
    assert told(got)[-1][2] in ("firing", "resolved", "repeat") and got.count() > 5

"""Drift hold, edges and alert payloads against a literal loop."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslens.operators import drift as ops

START = datetime(2024, 1, 1)


def frame(spark, votes, key="all"):
    rows = [(key, START + timedelta(seconds=i), f"{i:06d}", 0.25 + 0.5 * (i % 2), bool(a), bool(k), bool(p), i // 50) for i, (a, k, p) in enumerate(votes)]
    return spark.createDataFrame(rows, "key string, processed_at timestamp, id string, p_fake double, adwin boolean, kswin boolean, page_hinkley boolean, batch int")


def loop(votes, hold):
    out, active, confirmed, since, events, seen = [], False, False, 0, 0, []
    for i, (a, k, p) in enumerate(votes):
        score = 0.45 * a + 0.35 * k + 0.20 * p
        seen = [*seen, 0.25 + 0.5 * (i % 2)][-100:]
        edge = False
        if score >= 0.5:
            edge = not active
            events += edge
            active, confirmed, since = True, score >= 0.8, 0
        else:
            since += 1
            if since > hold:
                active = confirmed = False
        out.append((i + 1, round(score, 4), active, confirmed, edge, events, round(sum(seen) / len(seen), 4)))
    return pd.DataFrame(out, columns=["message_index", "composite_score", "drift_active", "drift_confirmed", "is_edge", "total_drift_events", "confidence_mean_last100"])


@pytest.mark.parametrize("block_rows", [100, 128, 100_000])
def test_state_equals_the_loop(spark, block_rows):
    rng = np.random.default_rng(1)
    votes = (rng.random((1500, 3)) < [0.05, 0.05, 0.1]).tolist()
    want = loop(votes, 40)
    got = ops.drift_state(frame(spark, votes), ["processed_at", "id"], ["key"], hold=40, block_rows=block_rows)
    got = got.toPandas().sort_values("message_index").reset_index(drop=True)
    assert 3 < want["is_edge"].sum()
    for column in want:
        assert got[column].tolist() == want[column].tolist(), column
    assert got["recommended_lr"].tolist() == [5e-5 if a else 1e-5 for a in want["drift_active"]]


def test_hold_of_a_thousand_rows(spark):
    votes = [(1, 0, 1) if i == 9 else (0, 0, 0) for i in range(1100)]
    state = ops.drift_state(frame(spark, votes), ["processed_at", "id"], ["key"])
    on = [r.message_index for r in state.filter("drift_active").select("message_index").collect()]
    assert sorted(on) == list(range(10, 1011))
    edges = ops.drift_edges(state).collect()
    assert len(edges) == 1 and edges[0].message_index == 10 and edges[0].score == 0.65
    assert edges[0].signals.asDict() == {"ADWIN": 1.0, "KSWIN": 0.0, "PageHinkley": 1.0}


def test_payloads_and_stats(spark):
    votes = [(1, 1, 0) if i in (60, 61) else (0, 0, 1) if i == 149 else (0, 0, 0) for i in range(200)]
    state = ops.drift_state(frame(spark, votes), ["processed_at", "id"])
    alerts = ops.alert_payloads(state, "batch").orderBy("_batch_id").collect()
    assert [r._batch_id for r in alerts] == [1, 2, 3]
    assert [r.messages_total for r in alerts] == [100, 150, 200]
    # The stored score is that of the batch's last row, though drift stays on.
    assert [r.composite_score for r in alerts] == [0.0, 0.2, 0.0]
    assert all(r.drift_confirmed and r.total_drift_events == 1 and r.recommended_lr == 5e-5 for r in alerts)
    assert alerts[1].signals.asDict() == {"ADWIN": False, "KSWIN": False, "PageHinkley": True}
    stats = ops.monitor_stats(state).first()
    assert (stats.messages_total, stats.drift_active, stats.current_lr) == (200, True, 5e-5)
    assert ops.drift_eval(state, 60).first().asDict() == {"flagged": 140, "rows_after": 140, "first_flagged": 61}


ALERT = "timestamp timestamp, _batch_id int, composite_score double, drift_confirmed boolean, signals struct<ADWIN:boolean,KSWIN:boolean,PageHinkley:boolean>"


def test_alert_queries(spark):
    rows = [(START + timedelta(hours=i), i, [0.0, 0.55, 1.0][i % 3], i % 2 == 0, (i % 2 == 0, None, True)) for i in range(130)]
    rows.append((START + timedelta(hours=130), 130, 0.2, False, None))
    alerts = spark.createDataFrame(rows, ALERT)
    stats = ops.drift_stats(alerts).first()
    assert (stats.total_events, stats.confirmed_events, stats.last_event._batch_id) == (131, 65, 130)
    assert stats.confirmation_rate == 49.62
    assert [r._batch_id for r in ops.recent_drift(alerts, 3).collect()] == [130, 129, 128]
    with pytest.raises(ValueError):
        ops.recent_drift(alerts, 101)
    flat = ops.unpack_signals(ops.recent_drift(alerts, 2)).collect()
    assert [(r.adwin, r.kswin, r.ph) for r in flat] == [(0, 0, 0), (0, 0, 1)]
    down = ops.cumulative_signals(alerts).orderBy(F.desc("timestamp")).collect()
    assert len(down) == 100 and (down[0].ph_cumulative, down[-1].ph_cumulative) == (0, 99)
    up = ops.cumulative_signals(alerts, ascending=True).orderBy("timestamp").collect()
    assert (up[0].ph_cumulative, up[-1].ph_cumulative) == (1, 99)


def test_no_alerts(spark):
    empty = spark.createDataFrame([], ALERT)
    stats = ops.drift_stats(empty).first()
    assert (stats.total_events, stats.confirmation_rate, stats.last_event) == (0, 0.0, None)

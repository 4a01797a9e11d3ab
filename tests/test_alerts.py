"""Alert rules, their states over time, and notifications."""

from datetime import datetime, timedelta

import pytest

from newslens.operators import alerts as ops

NOW = datetime(2024, 1, 30)
T0 = datetime(2024, 1, 1, 12)


def evaluate(spark, fake_rate, score):
    stats = spark.createDataFrame([(fake_rate,)], "fake_rate double")
    rows = [] if score is None else [(T0, 1, 0.99), (T0 + timedelta(minutes=1), 2, score)]
    drift = spark.createDataFrame(rows, "timestamp timestamp, messages_total long, composite_score double")
    return {r.metric: (r.severity, r.message) for r in ops.evaluate_alerts(stats, drift, NOW).collect()}


@pytest.mark.parametrize("rate,want", [
    (39.99, None), (40.0, ("warning", "Taux actuel : 40.0% (seuil : 40.0%)")), (69.9, ("warning", "Taux actuel : 69.9% (seuil : 40.0%)")),
    (70.0, ("critical", "Taux actuel : 70.0% (seuil : 70.0%)")),
])
def test_fake_rate(spark, rate, want):
    assert evaluate(spark, rate, None).get("fake_rate") == want


@pytest.mark.parametrize("score,want", [
    (None, None), (0.2, None), (0.35, ("warning", "Score : 0.350 (seuil avertissement : 0.3)")), (0.5, ("critical", "Score : 0.500 (seuil critique : 0.5)")),
])
def test_newest_drift_score(spark, score, want):
    assert evaluate(spark, 0.0, score).get("drift_score") == want


def test_counts_and_light(spark):
    rows = spark.createDataFrame([("critical",), ("critical",), ("warning",)], "severity string")
    assert {r.severity: r.alerts for r in ops.alert_counts(rows).collect()} == {"critical": 2, "warning": 1}
    light = lambda v: ops.indicator(spark.createDataFrame([(v,)], "fake_rate double")).first().light
    assert [light(v) for v in (39.0, 40.0, 70.0)] == ["🟢", "🟡", "🔴"]


def test_rules_table(spark):
    rows = ops.rules_table(spark).collect()
    assert [r.threshold for r in rows] == ["> 40%", "> 70%", "> 0.30", "> 0.50", "< 70%"]
    assert [r.delay for r in rows] == ["5 min", "5 min", "2 min", "1 min", "10 min"]


def ticks(spark, rows):
    out = [(u, T0 + timedelta(minutes=m), v, b, h) for u, m, v, b, h in rows]
    return spark.createDataFrame(out, "uid string, tick timestamp, value double, breached boolean, hold_minutes int")


def test_hold_is_broken_by_missing_data(spark):
    pattern = [False, True, True, True, None, True, True, True, True, False]
    rows = [("a", m, None if b is None else 1.0, b, 2) for m, b in enumerate(pattern)] + [("b", m, 1.0, True, 0) for m in range(2)]
    got = ops.alert_states(ticks(spark, rows)).orderBy("uid", "tick").collect()
    assert [r.state for r in got if r.uid == "a"] == [
        "Normal", "Pending", "Pending", "Alerting", "NoData", "Pending", "Pending", "Alerting", "Alerting", "Normal",
    ]
    assert [r.state for r in got if r.uid == "b"] == ["Alerting", "Alerting"]


def test_notifications_repeat_hourly_and_resolve(spark):
    rows = [("a", m, 1.0, 5 <= m < 140, 1) for m in range(150)] + [("b", m, 1.0, m < 3, 0) for m in range(10)]
    sent = ops.notifications(ops.alert_states(ticks(spark, rows)))
    got = [(r.uid, int((r.tick - T0).total_seconds() // 60), r.kind) for r in sent.orderBy("uid", "tick").collect()]
    assert got == [("a", 6, "firing"), ("a", 66, "repeat"), ("a", 126, "repeat"), ("a", 140, "resolved"), ("b", 0, "firing"), ("b", 3, "resolved")]


def test_a_tick_sees_the_newest_bucket_of_its_range(spark):
    rows = [(T0 + timedelta(minutes=m), d, f, c) for m, d, f, c in [(0, 0.0, 0, 0.9), (4, 0.55, 1, 0.6), (5, 0.2, 0, 0.8), (6, None, 1, 0.8), (30, 1.0, 1, 0.6)]]
    df = spark.createDataFrame(rows, "processed_at timestamp, drift_score double, is_fake int, confidence double")
    got = {(r.uid, int((r.tick - T0).total_seconds() // 60)): r for r in ops.windowed_alerts(df).collect()}
    drift = lambda m: (got["alert-drift-detecte", m].value, got["alert-drift-detecte", m].breached)
    assert drift(1) == (0.0, False)
    assert drift(5) == (0.55, True)
    assert drift(6) == (0.2, False)
    assert drift(12) == (None, None)  # nothing in the last five minutes
    assert drift(31) == (1.0, True)
    fakes = got["alert-moderate-fake-rate", 7]
    assert fakes.value == 0.5 and fakes.breached
    # The confidence rule looks back ten minutes.
    assert got["alert-low-confidence", 14].value == pytest.approx(0.8) and got["alert-low-confidence", 14].breached is False
    assert got["alert-low-confidence", 31].breached is True
    assert got["alert-low-confidence", 25].value is None


def test_titles(spark):
    df = spark.createDataFrame([("alert-high-fake-rate",)], "uid string")
    row = ops.rule_titles(df).first()
    assert row.alertname.startswith("Taux de Désinformation Critique") and row.severity == "critical"

"""Alerts, rules, states and notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.drift_queries import ALERTS, alerts
from catalog.views import NOW, SCORED, scored_events, stamp, stamp_sql
from newslens.operators import alerts as ops
from newslens.operators.articles import global_stats
from newslens.operators.notifications import grouped_notifications

ACTIVE = (
    ALERTS
    + """, stats AS (SELECT round(sum(is_fake) * 1e0 / count(*) * 100, 2) AS fake_rate FROM scored),
vals AS (SELECT 'fake_rate' AS metric, fake_rate AS value FROM stats
  UNION ALL SELECT 'drift_score', arg_max(composite_score, timestamp) FROM alerts),
active AS (
  SELECT 'critical' AS severity, 'Taux de désinformation critique' AS title,
    printf('Taux actuel : %.1f%% (seuil : 70.0%%)', value) AS message, * FROM vals WHERE metric = 'fake_rate' AND value >= 70
  UNION ALL SELECT 'warning', 'Taux de désinformation élevé', printf('Taux actuel : %.1f%% (seuil : 40.0%%)', value), *
    FROM vals WHERE metric = 'fake_rate' AND value >= 40 AND value < 70
  UNION ALL SELECT 'critical', 'Concept Drift confirmé', printf('Score : %.3f (seuil critique : 0.5)', value), *
    FROM vals WHERE metric = 'drift_score' AND value >= 0.5
  UNION ALL SELECT 'warning', 'Concept Drift détecté', printf('Score : %.3f (seuil avertissement : 0.3)', value), *
    FROM vals WHERE metric = 'drift_score' AND value >= 0.3 AND value < 0.5)"""
)


def stats(spark, sf):
    return global_stats(scored_events(spark, sf), alerts(spark, sf), NOW)


def active(spark, sf):
    return ops.evaluate_alerts(stats(spark, sf), alerts(spark, sf), NOW)


@register(
    "evaluate_alerts",
    f"WITH {ACTIVE} SELECT severity, title, message, metric, value, '2024-01-30 00:00:00.000000' AS timestamp FROM active",
)
def evaluate_alerts(spark, sf):
    return active(spark, sf).withColumn("timestamp", stamp("timestamp"))


@register("alert_counts", f"WITH {ACTIVE} SELECT severity, count(*) AS alerts FROM active GROUP BY 1")
def alert_counts(spark, sf):
    return ops.alert_counts(active(spark, sf))


@register(
    "alert_severity_rank",
    f"WITH {ACTIVE} SELECT metric, CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS severity_num FROM active",
)
def alert_severity_rank(spark, sf):
    return active(spark, sf).select("metric", ops.severity_rank(F.col("severity")).alias("severity_num"))


@register(
    "indicator",
    f"""WITH {ACTIVE} SELECT fake_rate, CASE WHEN fake_rate >= 70 THEN '🔴' WHEN fake_rate >= 40 THEN '🟡' ELSE '🟢' END AS light FROM stats""",
)
def indicator(spark, sf):
    return ops.indicator(stats(spark, sf))


_RULES = ", ".join(
    f"('{r.uid}', '{r.metric}', {str(r.above).lower()}, {r.threshold}e0, {r.range_minutes}, {r.hold_minutes})" for r in ops.RULES
)

# Each tick looks straight at the rows of its range, without the per-minute step.
TICKS = (
    SCORED
    + f""", rules(uid, metric, above, threshold, span, hold) AS (VALUES {_RULES}),
ends AS (SELECT date_trunc('minute', min(processed_at)) AS a, date_trunc('minute', max(processed_at)) AS b FROM scored),
minutes AS (SELECT unnest(range(a + INTERVAL 1 MINUTE, b + INTERVAL 2 MINUTE, INTERVAL 1 MINUTE)) AS tick FROM ends),
spans AS (SELECT DISTINCT span FROM rules),
seen AS (
  SELECT s.span, date_trunc('minute', e.processed_at) + INTERVAL 1 MINUTE * k.k AS tick,
    time_bucket(INTERVAL '5 minutes', e.processed_at) AS bucket, e.drift_score, e.is_fake, e.confidence
  FROM scored e, spans s, (SELECT unnest(range(1, 11)) AS k) k WHERE k.k <= s.span),
per AS (SELECT span, tick, bucket, max(drift_score) AS max_drift_score, avg(is_fake) AS avg_is_fake, avg(confidence) AS avg_confidence
  FROM seen GROUP BY 1, 2, 3),
newest AS (SELECT span, tick, arg_max(max_drift_score, bucket) AS max_drift_score, arg_max(avg_is_fake, bucket) AS avg_is_fake,
  arg_max(avg_confidence, bucket) AS avg_confidence FROM per GROUP BY 1, 2),
vals AS (SELECT uid, m.tick, hold, above, threshold, CASE metric WHEN 'max_drift_score' THEN max_drift_score
    WHEN 'avg_is_fake' THEN avg_is_fake ELSE avg_confidence END AS value
  FROM minutes m CROSS JOIN rules r LEFT JOIN newest n ON n.tick = m.tick AND n.span = r.span),
ticks AS (SELECT uid, tick, hold, value, CASE WHEN above THEN value > threshold ELSE value < threshold END AS breached FROM vals),
runs AS (SELECT *, sum(CASE WHEN breached IS DISTINCT FROM prev OR prev_tick IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY uid ORDER BY tick) AS run
  FROM (SELECT *, lag(breached) OVER w AS prev, lag(tick) OVER w AS prev_tick FROM ticks WINDOW w AS (PARTITION BY uid ORDER BY tick))),
states AS (SELECT uid, tick, value, CASE WHEN breached IS NULL THEN 'NoData' WHEN NOT breached THEN 'Normal'
    WHEN date_diff('minute', min(tick) OVER (PARTITION BY uid, run), tick) >= hold THEN 'Alerting' ELSE 'Pending' END AS state FROM runs)"""
)


def ticks(spark, sf):
    return ops.windowed_alerts(scored_events(spark, sf))


@register(
    "windowed_alerts",
    f"WITH {TICKS} SELECT uid, {stamp_sql('tick')}, round(value, 6) AS value, breached FROM ticks",
)
def windowed_alerts(spark, sf):
    return rounded(ticks(spark, sf).drop("hold_minutes").withColumn("tick", stamp("tick")), "value")


@register("alert_states", f"WITH {TICKS} SELECT uid, {stamp_sql('tick')}, state FROM states")
def alert_states(spark, sf):
    return ops.alert_states(ticks(spark, sf)).select("uid", stamp("tick"), "state")


@register(
    "notifications",
    f"""WITH {TICKS}, f AS (SELECT *, state = 'Alerting' AS firing, coalesce(lag(state) OVER (PARTITION BY uid ORDER BY tick) = 'Alerting', false) AS before FROM states),
r AS (SELECT *, sum((firing AND NOT before)::INT) OVER (PARTITION BY uid ORDER BY tick) AS run FROM f),
k AS (SELECT uid, tick, CASE WHEN firing AND NOT before THEN 'firing' WHEN NOT firing AND before THEN 'resolved'
  WHEN firing AND date_diff('minute', min(tick) FILTER (WHERE firing) OVER (PARTITION BY uid, run), tick) % 60 = 0 THEN 'repeat' END AS kind FROM r)
SELECT uid, {stamp_sql('tick')}, kind FROM k WHERE kind IS NOT NULL""",
)
def notifications(spark, sf):
    return ops.notifications(ops.alert_states(ticks(spark, sf))).withColumn("tick", stamp("tick"))


_TITLES = " ".join(f"WHEN '{r.uid}' THEN '{r.title}'" for r in ops.RULES)
_SEVERITIES = " ".join(f"WHEN '{r.uid}' THEN '{r.severity}'" for r in ops.RULES)


def _groups_sql(name: str, cases: str, wait: int = 30, interval: int = 5, repeat: int = 60) -> str:
    """Every group walked minute by minute with a list fold: the look of a minute sees its tick."""
    look = f"(a.on AND (e.t - a.start) % {interval} = 0) OR (NOT a.on AND e.f <> '')"
    told = "CASE WHEN a.on THEN a.told ELSE '' END"
    kind = f"""CASE WHEN NOT ({look}) THEN '' WHEN e.f = '' THEN 'resolved' WHEN e.f <> ({told}) THEN 'firing'
      WHEN e.t - a.sent >= {repeat} THEN 'repeat' ELSE '' END"""
    return f"""WITH {TICKS}, marked AS (
  SELECT CASE uid {cases} END AS {name}, tick, coalesce(string_agg(uid, ',' ORDER BY uid) FILTER (WHERE state = 'Alerting'), '') AS f FROM states GROUP BY 1, 2),
walked AS (
  SELECT {name}, list_reduce(list({{'t': date_diff('minute', TIMESTAMP '2000-01-01', tick), 'f': f, 'on': false, 'start': CAST(0 AS BIGINT), 'sent': CAST(0 AS BIGINT),
      'told': '', 'out': CAST([] AS STRUCT(t BIGINT, kind VARCHAR, f VARCHAR, before VARCHAR)[])}} ORDER BY tick),
    LAMBDA a, e: {{'t': e.t, 'f': e.f, 'on': CASE WHEN {look} THEN e.f <> '' ELSE a.on END, 'start': CASE WHEN NOT a.on AND e.f <> '' THEN e.t ELSE a.start END,
      'sent': CASE WHEN ({kind}) IN ('firing', 'repeat') THEN e.t ELSE a.sent END, 'told': CASE WHEN {look} THEN e.f ELSE a.told END,
      'out': CASE WHEN ({kind}) <> '' THEN list_append(a.out, {{'t': e.t, 'kind': {kind}, 'f': e.f, 'before': {told}}}) ELSE a.out END}},
    {{'t': CAST(0 AS BIGINT), 'f': '', 'on': false, 'start': CAST(0 AS BIGINT), 'sent': CAST(0 AS BIGINT), 'told': '',
      'out': CAST([] AS STRUCT(t BIGINT, kind VARCHAR, f VARCHAR, before VARCHAR)[])}}).out AS out
  FROM marked GROUP BY 1),
sent AS (SELECT {name}, unnest(out) AS o FROM walked),
-- a look follows its tick by the wait, so that of the last tick has not taken place
told AS (SELECT {name}, TIMESTAMP '2000-01-01' + to_minutes(o.t) + INTERVAL {wait} SECOND AS sent_at, o.kind AS kind, o.f AS firing,
    list_aggregate(list_filter(string_split(o.before, ','), LAMBDA u: u <> '' AND NOT list_contains(string_split(o.f, ','), u)), 'string_agg', ',') AS over FROM sent)
SELECT {name}, {stamp_sql('sent_at')}, kind, firing, coalesce(over, '') AS resolved FROM told WHERE sent_at <= (SELECT max(tick) FROM states)"""


def _told(spark, sf, group):
    states = ops.rule_titles(ops.alert_states(ticks(spark, sf)))
    sent = grouped_notifications(states, [group])
    return sent.select(group, stamp("sent_at"), "kind", F.array_join("firing", ",").alias("firing"), F.array_join("resolved", ",").alias("resolved"))


@register("notification_groups", _groups_sql("alertname", _TITLES))
def notification_groups(spark, sf):
    return _told(spark, sf, "alertname")


@register("notification_groups_by_severity", _groups_sql("severity", _SEVERITIES))
def notification_groups_by_severity(spark, sf):
    return _told(spark, sf, "severity")

"""Drift state, edges and alerts, and what is asked of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.views import NOW, NOW_SQL, SCORED, scored_events, stamp, stamp_sql
from newslens.functions import scores
from newslens.operators import articles
from newslens.operators import drift as ops

ORDER = ["processed_at", "id"]

STATE = (
    SCORED
    + """, numbered AS (
  SELECT *, row_number() OVER (ORDER BY processed_at, id) AS message_index,
    0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT AS composite FROM scored),
held AS (
  SELECT *, max(CASE WHEN composite >= 0.5 THEN message_index END) OVER upto AS hit,
    max(CASE WHEN composite >= 0.8 THEN message_index END) OVER upto AS sure,
    round(avg(p_fake) OVER (ORDER BY message_index ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 4) AS mean100
  FROM numbered WINDOW upto AS (ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
flagged AS (
  SELECT * EXCLUDE (drift_active), coalesce(message_index - hit <= 1000, false) AS drift_active,
    coalesce(message_index - hit <= 1000 AND sure = hit, false) AS drift_confirmed FROM held),
edged AS (
  SELECT *, drift_active AND NOT coalesce(lag(drift_active) OVER (ORDER BY message_index), false) AS is_edge FROM flagged),
state AS (
  SELECT *, round(composite, 4) AS composite_score, CASE WHEN drift_active THEN 5e-5 ELSE 1e-5 END AS recommended_lr,
    CAST(sum(is_edge::INT) OVER (ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_drift_events
  FROM edged)"""
)

ALERTS = (
    STATE
    + """, alerts AS (
  SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%d %H') AS _batch_id, processed_at AS timestamp, composite_score,
    adwin, kswin, page_hinkley, drift_confirmed, recommended_lr, message_index AS messages_total, mean100, total_drift_events
  FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', processed_at) ORDER BY message_index DESC) AS rn FROM state)
  WHERE rn = 1 AND drift_active)"""
)


def state(spark, sf):
    narrow = scored_events(spark, sf).select("id", "processed_at", "p_fake", "adwin", "kswin", "page_hinkley")
    return ops.drift_state(narrow, ORDER)


def alerts(spark, sf):
    hourly = state(spark, sf).withColumn("hour", F.date_format("processed_at", "yyyy-MM-dd HH"))
    return ops.alert_payloads(hourly, "hour")


@register(
    "message_index",
    f"""WITH {SCORED} SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY processed_at, id) AS message_index FROM scored""",
)
def message_index(spark, sf):
    return ops.message_index(scored_events(spark, sf).select("id", "source", "processed_at"), ORDER, ["source"]).drop("processed_at")


@register(
    "last100_mean",
    f"""WITH {SCORED}, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY processed_at, id) AS message_index FROM scored)
SELECT id, source, message_index, round(avg(p_fake) OVER (PARTITION BY source ORDER BY message_index
  ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 4) AS confidence_mean_last100 FROM n""",
)
def last100_mean(spark, sf):
    indexed = ops.message_index(scored_events(spark, sf).select("id", "source", "processed_at", "p_fake"), ORDER, ["source"])
    return ops.last_mean(indexed, ["source"]).drop("processed_at", "p_fake")


@register(
    "drift_state",
    f"""WITH {STATE} SELECT id, message_index, composite_score, drift_active, drift_confirmed, is_edge, recommended_lr,
  mean100 AS confidence_mean_last100, total_drift_events FROM state""",
)
def drift_state(spark, sf):
    return state(spark, sf).select(
        "id", "message_index", "composite_score", "drift_active", "drift_confirmed", "is_edge",
        "recommended_lr", "confidence_mean_last100", "total_drift_events",
    )


@register(
    "composite_scores",
    f"""WITH {SCORED} SELECT id, round(0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT, 4) AS composite,
  0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT >= 0.8 AS confirmed FROM scored""",
)
def composite_scores(spark, sf):
    exact = scores.composite(F.col("adwin"), F.col("kswin"), F.col("page_hinkley"))
    return scored_events(spark, sf).select(
        "id", F.round(exact, 4).alias("composite"), (exact >= scores.CONFIRM_THRESHOLD).alias("confirmed")
    )


@register(
    "drift_edges",
    f"""WITH {STATE} SELECT {stamp_sql('processed_at').replace('AS processed_at', 'AS timestamp')}, message_index, composite_score AS score,
  adwin::INT::DOUBLE AS adwin, kswin::INT::DOUBLE AS kswin, page_hinkley::INT::DOUBLE AS page_hinkley FROM state WHERE is_edge""",
)
def drift_edges(spark, sf):
    return ops.drift_edges(state(spark, sf)).select(
        stamp("timestamp"), "message_index", "score", F.col("signals.ADWIN").alias("adwin"),
        F.col("signals.KSWIN").alias("kswin"), F.col("signals.PageHinkley").alias("page_hinkley"),
    )


@register(
    "monitor_stats",
    f"""WITH {STATE} SELECT message_index AS messages_total, composite_score, drift_active, drift_confirmed, total_drift_events,
  recommended_lr AS current_lr FROM state ORDER BY message_index DESC LIMIT 1""",
)
def monitor_stats(spark, sf):
    return ops.monitor_stats(state(spark, sf))


_ALERT = """_batch_id, composite_score, drift_confirmed, recommended_lr, messages_total,
  mean100 AS confidence_mean_last100, total_drift_events, adwin::INT AS adwin, kswin::INT AS kswin, page_hinkley::INT AS ph"""


def _flat(df):
    return ops.unpack_signals(df).drop("signals").withColumn("timestamp", stamp("timestamp"))


@register("drift_alerts", f"WITH {ALERTS} SELECT {_ALERT}, {stamp_sql('timestamp')} FROM alerts")
def drift_alerts(spark, sf):
    return _flat(alerts(spark, sf))


@register(
    "recent_drift",
    f"""WITH {ALERTS} SELECT {_ALERT}, {stamp_sql('timestamp')} FROM (SELECT * FROM alerts ORDER BY timestamp DESC, _batch_id LIMIT 20)""",
)
def recent_drift(spark, sf):
    return _flat(ops.recent_drift(alerts(spark, sf), 20))


@register(
    "drift_stats",
    f"""WITH {ALERTS} SELECT count(*) AS total_events, count(*) FILTER (WHERE drift_confirmed) AS confirmed_events,
  round(count(*) FILTER (WHERE drift_confirmed) * 1e0 / count(*) * 100, 2) AS confirmation_rate,
  arg_max(messages_total, timestamp) AS last_messages_total, arg_max(composite_score, timestamp) AS last_score,
  {stamp_sql('max(timestamp)').split(' AS ')[0]} AS last_timestamp FROM alerts""",
)
def drift_stats(spark, sf):
    return ops.drift_stats(alerts(spark, sf)).select(
        "total_events", "confirmed_events", "confirmation_rate",
        F.col("last_event.messages_total").alias("last_messages_total"),
        F.col("last_event.composite_score").alias("last_score"),
        F.date_format("last_event.timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_timestamp"),
    )


@register(
    "drift_summary",
    f"""WITH {ALERTS} SELECT count(*) AS events, count(*) FILTER (WHERE drift_confirmed) AS confirmed,
  round(avg(composite_score), 6) AS mean_score, max(composite_score) AS max_score
FROM (SELECT * FROM alerts ORDER BY timestamp DESC, _batch_id LIMIT 100)""",
)
def drift_summary(spark, sf):
    return rounded(ops.drift_summary(alerts(spark, sf)), "mean_score")


_UPTO = "OVER (ORDER BY timestamp DESC, _batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register(
    "cumulative_signals",
    f"""WITH {ALERTS} SELECT _batch_id, {stamp_sql('timestamp')}, CAST(sum(adwin::INT) {_UPTO} AS BIGINT) AS adwin_cumulative,
  CAST(sum(kswin::INT) {_UPTO} AS BIGINT) AS kswin_cumulative, CAST(sum(page_hinkley::INT) {_UPTO} AS BIGINT) AS ph_cumulative
FROM (SELECT * FROM alerts ORDER BY timestamp DESC, _batch_id LIMIT 100)""",
)
def cumulative_signals(spark, sf):
    return ops.cumulative_signals(alerts(spark, sf)).withColumn("timestamp", stamp("timestamp"))


@register(
    "alert_texts",
    f"""WITH {ALERTS} SELECT _batch_id, CASE WHEN drift_confirmed THEN '⚠️ CONFIRMÉ' ELSE '🔔 Détecté' END AS confirmed_text FROM alerts""",
)
def alert_texts(spark, sf):
    return ops.present_alerts(alerts(spark, sf)).select("_batch_id", "confirmed_text")


@register(
    "drift_eval",
    f"""WITH {STATE} SELECT count(*) FILTER (WHERE message_index > 500 AND drift_active) AS flagged,
  count(*) FILTER (WHERE message_index > 500) AS rows_after,
  min(message_index) FILTER (WHERE message_index > 500 AND drift_active) AS first_flagged FROM state""",
)
def drift_eval(spark, sf):
    return ops.drift_eval(state(spark, sf), 500)


@register(
    "global_stats",
    f"""WITH {ALERTS}
SELECT count(*) AS total_articles, CAST(sum(is_fake) AS BIGINT) AS fake_articles,
  CAST(sum(1 - is_fake) AS BIGINT) AS real_articles,
  round(sum(is_fake) * 1e0 / count(*) * 100, 2) AS fake_rate,
  (SELECT count(*) FROM alerts) AS drift_events,
  count(*) FILTER (WHERE processed_at >= {NOW_SQL} - INTERVAL 1 HOUR) AS articles_last_hour
FROM scored""",
)
def global_stats(spark, sf):
    return articles.global_stats(scored_events(spark, sf), alerts(spark, sf), NOW)

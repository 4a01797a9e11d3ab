"""Article statistics, trends, histograms and lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.views import ARTICLES, LABELLED, NOW, NOW_SQL, SCORED, SPACE, articles, scored_events, stamp, stamp_sql
from newslens.functions import scores, text
from newslens.operators import articles as ops


def rounded(df, *columns, digits=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@register(
    "virality",
    f"""WITH {SCORED}
SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%dT%H') AS hour, count(*) AS total,
  CAST(sum(is_fake) AS BIGINT) AS fakes, round(avg(confidence), 6) AS avg_confidence,
  round(sum(is_fake) * 1e0 / count(*) * 100, 1) AS fake_pct
FROM scored WHERE processed_at >= {NOW_SQL} - INTERVAL 168 HOUR GROUP BY 1""",
)
def virality(spark, sf):
    trend = ops.virality(scored_events(spark, sf), NOW, 168)
    return rounded(ops.virality_pct(trend), "avg_confidence")


@register(
    "virality_24h",
    f"""WITH {SCORED}
SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%dT%H') AS hour, count(*) AS total,
  CAST(sum(is_fake) AS BIGINT) AS fakes, round(avg(confidence), 6) AS avg_confidence
FROM scored WHERE processed_at >= {NOW_SQL} - INTERVAL 24 HOUR GROUP BY 1""",
)
def virality_24h(spark, sf):
    return rounded(ops.virality(scored_events(spark, sf), NOW, 24), "avg_confidence")


@register(
    "valid_articles",
    f"WITH {ARTICLES} SELECT seq, id, title FROM articles WHERE title IS NOT NULL AND title <> ''",
)
def valid_articles(spark, sf):
    return ops.valid(articles(spark, sf)).select("seq", "id", "title")


_FILTERED = """id, title, body, url, source, language, is_fake, round(confidence, 6) AS confidence,
  round(p_fake, 6) AS p_fake, drift_score, drift_active"""


def _filtered(df):
    return rounded(df.withColumn("processed_at", stamp("processed_at")), "confidence", "p_fake")


@register(
    "filter_articles",
    f"""WITH {SCORED} SELECT {_FILTERED}, {stamp_sql('processed_at')}
FROM scored WHERE is_fake = 1 AND source = 'error' AND confidence >= 0.7""",
)
def filter_articles(spark, sf):
    return _filtered(
        ops.filter_articles(scored_events(spark, sf), fake_only=True, source="error", min_confidence=0.7)
    )


@register(
    "filter_both_flags",
    f"""WITH {SCORED} SELECT {_FILTERED}, {stamp_sql('processed_at')} FROM scored WHERE is_fake = 0""",
)
def filter_both_flags(spark, sf):
    return _filtered(ops.filter_articles(scored_events(spark, sf), fake_only=True, real_only=True))


@register(
    "filter_drift_active",
    f"""WITH {SCORED} SELECT {_FILTERED}, {stamp_sql('processed_at')} FROM scored WHERE drift_active""",
)
def filter_drift_active(spark, sf):
    return _filtered(ops.filter_articles(scored_events(spark, sf), drift_only=True))


@register(
    "filtered_page",
    f"""WITH {SCORED} SELECT {_FILTERED}, {stamp_sql('processed_at')}
FROM (SELECT * FROM scored WHERE is_fake = 0 ORDER BY processed_at DESC, id LIMIT 50)""",
)
def filtered_page(spark, sf):
    return _filtered(ops.newest(ops.filter_articles(scored_events(spark, sf), real_only=True), 50))


@register(
    "since_hours",
    f"""WITH {SCORED} SELECT id, source, {stamp_sql('processed_at')} FROM scored
WHERE processed_at >= {NOW_SQL} - INTERVAL 6 HOUR""",
)
def since_hours(spark, sf):
    return ops.since(scored_events(spark, sf), NOW, 6).select("id", "source", stamp("processed_at"))


@register(
    "recent_articles",
    f"""WITH {SCORED} SELECT id, source, is_fake, {stamp_sql('processed_at')}
FROM (SELECT * FROM scored ORDER BY processed_at DESC, id LIMIT 50)""",
)
def recent_articles(spark, sf):
    return ops.recent(scored_events(spark, sf), 50).select("id", "source", "is_fake", stamp("processed_at"))


@register(
    "recent_fakes",
    f"""WITH {SCORED} SELECT id, source, is_fake, {stamp_sql('processed_at')}
FROM (SELECT * FROM scored WHERE is_fake = 1 ORDER BY processed_at DESC, id LIMIT 200)""",
)
def recent_fakes(spark, sf):
    return ops.recent(scored_events(spark, sf), 200, True).select("id", "source", "is_fake", stamp("processed_at"))


@register(
    "latest_table",
    f"""WITH {SCORED} SELECT {stamp_sql('processed_at')}, title, source, is_fake, round(confidence, 6) AS confidence, id
FROM scored""",
)
def latest_table(spark, sf):
    shown = ops.latest_table(scored_events(spark, sf).drop("seq", "adwin", "kswin", "page_hinkley"))
    return rounded(shown.withColumn("processed_at", stamp("processed_at")), "confidence")


@register(
    "present_articles",
    f"""WITH {SCORED} SELECT id, CASE is_fake WHEN 1 THEN '🔴 FAKE' WHEN 0 THEN '🟢 RÉEL' END AS status,
  CASE is_fake WHEN 1 THEN 'FAKE' WHEN 0 THEN 'REEL' END AS export_status,
  substring(title, 1, 70) AS short_title, source,
  printf('%.1f', round(confidence * 100, 1)) || '%' AS confidence_text,
  printf('%.1f', round(p_fake * 100, 1)) || '%' AS p_fake_text, language
FROM scored""",
)
def present_articles(spark, sf):
    return ops.present(scored_events(spark, sf))


@register("distinct_sources", f"WITH {ARTICLES} SELECT DISTINCT source FROM articles")
def distinct_sources(spark, sf):
    return ops.sources(articles(spark, sf))


@register(
    "page_metrics",
    f"""WITH {SCORED} SELECT count(*) AS shown, CAST(sum(is_fake) AS BIGINT) AS fakes,
  CAST(sum(1 - is_fake) AS BIGINT) AS reals, round(avg(confidence) * 100, 6) AS mean_confidence_pct,
  round(sum(is_fake) * 1e0 / count(*) * 100, 6) AS fake_rate FROM scored""",
)
def page_metrics(spark, sf):
    return rounded(ops.page_metrics(scored_events(spark, sf)), "mean_confidence_pct", "fake_rate")


@register(
    "terms_is_fake",
    f"WITH {SCORED} SELECT is_fake, count(*) AS doc_count FROM scored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2",
)
def terms_is_fake(spark, sf):
    return ops.terms(scored_events(spark, sf), "is_fake", 2)


@register(
    "top_fake_sources",
    f"""WITH {SCORED} SELECT source, count(*) AS doc_count FROM scored WHERE is_fake = 1
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_fake_sources(spark, sf):
    return ops.terms(scored_events(spark, sf).filter("is_fake = 1"), "source", 10)


@register(
    "articles_by_source",
    f"""WITH {LABELLED} SELECT source, count(label) AS total, CAST(sum(label) AS BIGINT) AS fakes,
  CAST(count(label) - sum(label) AS BIGINT) AS reals FROM labelled GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def articles_by_source(spark, sf):
    from catalog.views import labelled

    return ops.by_source(labelled(spark, sf).withColumnRenamed("label", "is_fake"), 10)


@register("articles_by_language", f"WITH {ARTICLES} SELECT language, count(*) AS articles FROM articles GROUP BY 1")
def articles_by_language(spark, sf):
    return ops.by_language(articles(spark, sf))


@register(
    "p_fake_histogram",
    f"""WITH {SCORED} SELECT is_fake, CAST(least(floor(p_fake * 30), 29) AS INTEGER) AS bin, count(*) AS articles
FROM scored GROUP BY 1, 2""",
)
def p_fake_histogram(spark, sf):
    return ops.histogram(scored_events(spark, sf), "p_fake", 30, by="is_fake")


_STOP = ", ".join("'" + w + "'" for w in text.STOP_WORDS)


@register(
    "word_frequencies",
    f"""WITH {ARTICLES}, w AS (
  SELECT replace(trim(unnest(regexp_split_to_array(lower(title), '[{SPACE}]+')), '.,;:!?"''()[]{{}}'), '''', '') AS word
  FROM articles)
SELECT word, count(*) AS frequency FROM w WHERE length(word) > 3 AND word NOT IN ({_STOP})
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
)
def word_frequencies(spark, sf):
    return ops.word_frequencies(articles(spark, sf), 30)


def _spine(step: str) -> str:
    return f"""spine AS (SELECT unnest(range(min(bucket), max(bucket) + INTERVAL {step}, INTERVAL {step})) AS bucket FROM counts)"""


@register(
    "date_histogram_counts",
    f"""WITH {SCORED}, counts AS (
  SELECT time_bucket(INTERVAL '5 minutes', processed_at) AS bucket, count(*) AS articles,
    CAST(sum(is_fake) AS BIGINT) AS fakes, CAST(sum(1 - is_fake) AS BIGINT) AS reals FROM scored GROUP BY 1),
{_spine("'5 minutes'")}
SELECT {stamp_sql('s.bucket')}, coalesce(articles, 0) AS articles, coalesce(fakes, 0) AS fakes, coalesce(reals, 0) AS reals
FROM spine s LEFT JOIN counts c ON s.bucket = c.bucket""",
)
def date_histogram_counts(spark, sf):
    counted = ops.date_histogram(
        scored_events(spark, sf), "5 minutes", ops.count_metrics(), zero=["articles", "fakes", "reals"]
    )
    return counted.withColumn("bucket", stamp("bucket"))


_PANEL = """avg(is_fake) AS fake_ratio, avg(confidence) AS avg_confidence, max(drift_score) AS max_drift_score,
    max(CAST(drift_active AS INTEGER)) AS max_drift_active"""


@register(
    "metric_histogram",
    f"""WITH {SCORED}, counts AS (
  SELECT time_bucket(INTERVAL '15 minutes', processed_at) AS bucket, {_PANEL} FROM scored GROUP BY 1),
{_spine("'15 minutes'")}
SELECT {stamp_sql('s.bucket')}, round(fake_ratio, 6) AS fake_ratio, round(avg_confidence, 6) AS avg_confidence,
  max_drift_score, max_drift_active, round(fake_ratio * 100, 6) AS fake_percent
FROM spine s LEFT JOIN counts c ON s.bucket = c.bucket""",
)
def metric_histogram(spark, sf):
    shown = ops.metric_histogram(scored_events(spark, sf), "15 minutes").withColumn("bucket", stamp("bucket"))
    return rounded(shown, "fake_ratio", "avg_confidence", "fake_percent")


@register(
    "last_not_null",
    f"""WITH {SCORED}, counts AS (
  SELECT time_bucket(INTERVAL '15 minutes', processed_at) AS bucket, {_PANEL} FROM scored GROUP BY 1)
SELECT round(arg_max(fake_ratio, bucket), 6) AS fake_ratio, round(arg_max(avg_confidence, bucket), 6) AS avg_confidence,
  arg_max(max_drift_score, bucket) AS max_drift_score, arg_max(max_drift_active, bucket) AS max_drift_active
FROM counts""",
)
def last_not_null(spark, sf):
    names = ["fake_ratio", "avg_confidence", "max_drift_score", "max_drift_active"]
    buckets = ops.metric_histogram(scored_events(spark, sf), "15 minutes")
    return rounded(ops.last_not_null(buckets, names), "fake_ratio", "avg_confidence")


def _band_sql(column: str, steps) -> str:
    cases = " ".join(f"WHEN {column} >= {bound}e0 THEN '{name}'" for bound, name in reversed(steps[1:]))
    return f"CASE WHEN {column} IS NULL THEN NULL {cases} ELSE '{steps[0][1]}' END"


@register(
    "status_panels",
    f"""WITH {SCORED}, counts AS (
  SELECT time_bucket(INTERVAL '1 hour', processed_at) AS bucket, count(*) AS articles, sum(is_fake) AS fakes, {_PANEL}
  FROM scored GROUP BY 1),
reduced AS (
  SELECT CAST(sum(articles) AS BIGINT) AS total, CAST(sum(fakes) AS BIGINT) AS fakes,
    arg_max(fake_ratio, bucket) AS fake_ratio, arg_max(max_drift_score, bucket) AS drift_score,
    avg(avg_confidence) AS mean_confidence, arg_max(max_drift_active, bucket) AS drift_active FROM counts)
SELECT total, fakes, round(fake_ratio, 6) AS fake_ratio, drift_score, round(mean_confidence, 6) AS mean_confidence, drift_active,
  {_band_sql('total', scores.TOTAL_BANDS)} AS total_colour,
  {_band_sql('fakes', scores.FAKE_COUNT_BANDS)} AS fakes_colour,
  {_band_sql('fake_ratio', scores.FAKE_RATE_BANDS)} AS fake_ratio_colour,
  {_band_sql('fake_ratio * 100', scores.FAKE_RATE_BANDS)} AS fake_percent_colour,
  {_band_sql('drift_score', scores.DRIFT_BANDS)} AS drift_colour,
  {_band_sql('mean_confidence', scores.CONFIDENCE_BANDS)} AS confidence_colour,
  CASE drift_active WHEN 0 THEN 'NON' WHEN 1 THEN 'OUI' END AS drift_active_text
FROM reduced""",
)
def status_panels(spark, sf):
    return rounded(ops.status_panels(scored_events(spark, sf)), "fake_ratio", "mean_confidence")


@register(
    "threshold_bands",
    f"""WITH {SCORED} SELECT id, {_band_sql('drift_score', scores.DRIFT_BANDS)} AS drift_colour,
  {_band_sql('confidence', scores.CONFIDENCE_BANDS)} AS confidence_colour,
  {_band_sql('p_fake * 100', scores.FAKE_RATE_BANDS)} AS fake_rate_colour,
  CASE WHEN drift_active THEN 'OUI' ELSE 'NON' END AS drift_active_text,
  CASE WHEN drift_active THEN 'red' ELSE 'green' END AS drift_active_colour
FROM scored""",
)
def threshold_bands(spark, sf):
    active = F.col("drift_active").cast("int")
    return scored_events(spark, sf).select(
        "id",
        scores.band(F.col("drift_score"), scores.DRIFT_BANDS).alias("drift_colour"),
        scores.band(F.col("confidence"), scores.CONFIDENCE_BANDS).alias("confidence_colour"),
        scores.band(F.col("p_fake") * 100, scores.FAKE_RATE_BANDS).alias("fake_rate_colour"),
        scores.value_map(active, scores.DRIFT_ACTIVE_LABELS).alias("drift_active_text"),
        scores.value_map(active, scores.DRIFT_ACTIVE_COLOURS).alias("drift_active_colour"),
    )


@register(
    "schema_violations",
    """SELECT rule, count(*) AS rows FROM (
  SELECT unnest([CASE WHEN props IS NULL THEN 'title_missing' END,
    CASE WHEN value / 100 > 1 THEN 'confidence_range' END,
    CASE WHEN (value - 20) / 100 < 0 OR (value - 20) / 100 > 1 THEN 'p_fake_range' END,
    CASE WHEN user_id % 3 > 1 THEN 'is_fake_range' END, 'is_fake_type']) AS rule FROM events)
WHERE rule IS NOT NULL GROUP BY 1""",
)
def schema_violations(spark, sf):
    from catalog.views import table

    raw = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("props").alias("title"),
        (F.col("user_id") % 3).alias("is_fake"),
        (F.col("value") / 100).alias("confidence"),
        ((F.col("value") - 20) / 100).alias("p_fake"),
        F.col("ts").alias("processed_at"),
    )
    return ops.violation_counts(raw)

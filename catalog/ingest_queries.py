"""Decoding, normalisation, enrichment, deduplication and publishing of raw articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.views import ARTICLES, NOW, SCORED, articles, scored_events, table
from newslens.functions import scores, text
from newslens.sources import articles as src
from newslens.sources import feeds

FIELDS = "id, title, body, url, source, source_category, language, timestamp, gdelt_tone"


def raw_articles(spark, sf):
    """Documents as raw stream records, some fields missing or empty."""
    return articles(spark, sf).select(
        "id",
        F.when(F.col("n_chars") % 11 != 0, F.col("title")).alias("title"),
        "body",
        F.when(F.col("n_chars") % 7 != 0, F.col("url")).otherwise("").alias("url"),
        F.when(F.col("n_chars") % 5 != 0, F.col("source")).alias("source"),
        F.when(F.col("n_chars") % 3 == 0, "reliable").when(F.col("n_chars") % 3 == 1, "").alias("source_category"),
        F.when(F.col("n_chars") % 2 == 0, F.col("language")).alias("language"),
        F.when(F.col("n_chars") % 4 == 0, "2024-01-05T10:20:30").when(F.col("n_chars") % 4 == 1, "").alias("timestamp"),
        F.when(F.col("n_chars") % 6 != 0, (F.col("n_chars") % 9) / 2.0).cast("float").alias("gdelt_tone"),
    )


RAW = (
    ARTICLES
    + """, raw AS (
  SELECT id, CASE WHEN n_chars % 11 <> 0 THEN title END AS title, body,
    CASE WHEN n_chars % 7 <> 0 THEN url ELSE '' END AS url,
    CASE WHEN n_chars % 5 <> 0 THEN source END AS source,
    CASE n_chars % 3 WHEN 0 THEN 'reliable' WHEN 1 THEN '' END AS source_category,
    CASE WHEN n_chars % 2 = 0 THEN language END AS language,
    CASE n_chars % 4 WHEN 0 THEN '2024-01-05T10:20:30' WHEN 1 THEN '' END AS timestamp,
    CASE WHEN n_chars % 6 <> 0 THEN CAST((n_chars % 9) / 2.0e0 AS FLOAT) END AS gdelt_tone
  FROM articles)"""
)


@register("decode_articles", f"WITH {RAW} SELECT {FIELDS} FROM raw")
def decode_articles(spark, sf):
    messages = raw_articles(spark, sf).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    return src.decode(messages)


@register(
    "decode_malformed",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE k IS NULL) AS without_k, CAST(sum(k) AS BIGINT) AS total_k FROM (
  SELECT CASE WHEN user_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events)""",
)
def decode_malformed(spark, sf):
    from pyspark.sql import types as T

    cut = F.when(F.col("user_id") % 10 == 0, F.expr("substring(props, 1, 3)")).otherwise(F.col("props"))
    schema = T.StructType([T.StructField("k", T.LongType())])
    decoded = src.decode(table(spark, sf, "events").select(cut.alias("value")), schema)
    return decoded.agg(
        F.count("*").alias("rows"), F.count_if(F.col("k").isNull()).alias("without_k"), F.sum("k").alias("total_k")
    )


@register(
    "enrich_articles",
    f"""WITH {RAW} SELECT id, title, body, url, coalesce(source, '') AS source,
  coalesce(nullif(source_category, ''), 'unknown') AS source_category, coalesce(language, 'en') AS language,
  CASE WHEN timestamp <> '' THEN '2024-01-05 10:20:30' ELSE '2024-01-30 00:00:00' END AS timestamp,
  coalesce(CAST(gdelt_tone AS DOUBLE), 0e0) AS gdelt_tone, '2024-01-30 00:00:00' AS processed_at FROM raw""",
)
def enrich_articles(spark, sf):
    done = src.enrich(raw_articles(spark, sf), NOW)
    for c in ("timestamp", "processed_at"):
        done = done.withColumn(c, F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss"))
    return done


_FEEDS = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in feeds.RELIABLE_FEEDS)


@register(
    "normalise_feed",
    f"""WITH {ARTICLES}, registry(name, url, lang, category) AS (VALUES {_FEEDS}),
names AS (SELECT name, row_number() OVER () - 1 AS i FROM registry),
entries AS (SELECT a.*, coalesce(n.name, a.source) AS feed, (seq // 20) % 25 + 1 AS position
  FROM articles a LEFT JOIN names n ON a.source = 'src' || n.i)
SELECT md5(e.url || e.title) AS id, title, substring(body, 1, 500) AS body, e.url, e.feed AS source,
  coalesce(category, 'reliable') AS source_category, coalesce(lang, 'en') AS language,
  '2024-01-30T00:00:00' AS timestamp, 0e0 AS gdelt_tone
FROM entries e LEFT JOIN registry r ON e.feed = r.name WHERE position <= 20""",
)
def normalise_feed(spark, sf):
    feed = F.col("source")
    for i, row in enumerate(feeds.RELIABLE_FEEDS):
        feed = F.when(F.col("source") == f"src{i}", row[0]).otherwise(feed)
    entries = articles(spark, sf).select(
        feed.alias("feed"),
        (F.floor(F.col("seq") / 20) % 25 + 1).alias("position"),
        "title",
        F.col("body").alias("summary"),
        F.col("url").alias("link"),
    )
    return feeds.normalise_feed(entries, feeds.feed_registry(spark), F.lit("2024-01-30T00:00:00"))


@register(
    "first_feed_entries",
    f"""WITH {ARTICLES}, registry(name, url, lang, category) AS (VALUES {_FEEDS}),
names AS (SELECT name, row_number() OVER () - 1 AS i FROM registry),
entries AS (SELECT a.*, coalesce(n.name, a.source) AS feed, row_number() OVER (PARTITION BY a.source, seq // 700 ORDER BY seq DESC) AS place
  FROM articles a LEFT JOIN names n ON a.source = 'src' || n.i)
SELECT md5(e.url || e.title) AS id, title, substring(body, 1, 500) AS body, e.url, e.feed AS source,
  coalesce(category, 'reliable') AS source_category, coalesce(lang, 'en') AS language,
  '2024-01-30T00:00:00' AS timestamp, 0e0 AS gdelt_tone
FROM entries e LEFT JOIN registry r ON e.feed = r.name WHERE place <= 20""",
)
def first_feed_entries(spark, sf):
    """Entries as they were scraped, newest first, without a number of their own."""
    feed = F.col("source")
    for i, row in enumerate(feeds.RELIABLE_FEEDS):
        feed = F.when(F.col("source") == f"src{i}", row[0]).otherwise(feed)
    entries = articles(spark, sf).select(
        feed.alias("feed"), F.floor(F.col("seq") / 700).alias("scrape"), (-F.col("seq")).alias("entry"),
        "title", F.col("body").alias("summary"), F.col("url").alias("link"),
    )
    return feeds.normalise_feed(entries, feeds.feed_registry(spark), F.lit("2024-01-30T00:00:00"), order=["entry"])


@register(
    "normalise_gdelt",
    f"""WITH {ARTICLES} SELECT md5(concat(CASE WHEN n_chars % 13 <> 0 THEN url END, title)) AS id, title,
  source AS body, CASE WHEN n_chars % 13 <> 0 THEN url ELSE '' END AS url,
  CASE WHEN n_chars % 2 = 0 THEN source ELSE 'gdelt' END AS source, 'gdelt' AS source_category,
  CASE language WHEN 'en' THEN 'en' WHEN 'es' THEN 'sp' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'ge' END AS language,
  '2024-01-30T00:00:00' AS timestamp,
  CASE n_chars % 5 WHEN 3 THEN -2.5e0 WHEN 4 THEN CAST(n_chars AS DOUBLE) ELSE 0e0 END AS gdelt_tone
FROM articles""",
)
def normalise_gdelt(spark, sf):
    names = {"es": "Spanish", "fr": "French", "de": "German"}
    kind = F.col("n_chars") % 5
    records = articles(spark, sf).select(
        F.when(F.col("n_chars") % 13 != 0, F.col("url")).alias("url"),
        "title",
        F.col("source").alias("seendate"),
        F.when(F.col("n_chars") % 2 == 0, F.col("source")).alias("domain"),
        scores.value_map(F.col("language"), names).alias("language"),
        F.when(kind == 1, "").when(kind == 2, "abc").when(kind == 3, "-2.5")
        .when(kind == 4, F.col("n_chars").cast("string")).alias("tone"),
    )
    return feeds.normalise_gdelt(records, F.lit("2024-01-30T00:00:00"))


@register("content_ids", f"WITH {ARTICLES} SELECT seq, id FROM articles")
def content_ids(spark, sf):
    return articles(spark, sf).select("seq", text.content_id(F.col("url"), F.col("title")).alias("id"))


@register(
    "dedup_ingest",
    f"""WITH {ARTICLES} SELECT id, seq, title, body, source FROM articles
WHERE seq = (SELECT min(b.seq) FROM articles b WHERE b.id = articles.id)""",
)
def dedup_ingest(spark, sf):
    return src.dedup_ingest(articles(spark, sf), order=["seq"]).select("id", "seq", "title", "body", "source")


@register(
    "keyed_messages",
    f"""WITH {ARTICLES} SELECT id AS key, CAST(json_object('id', id, 'seq', seq, 'title', title, 'body', body, 'url', url,
  'source', source, 'language', language, 'n_chars', n_chars) AS VARCHAR) AS value FROM articles""",
)
def keyed_messages(spark, sf):
    return src.keyed_json(articles(spark, sf), ["id", "seq", "title", "body", "url", "source", "language", "n_chars"])


@register(
    "sanitise_scores",
    f"""WITH {SCORED}, odd AS (SELECT id, CASE seq % 6 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE
  WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN -p_fake WHEN 4 THEN 1 + p_fake ELSE p_fake END AS p FROM scored)
SELECT id, round(CASE WHEN p IS NULL OR isnan(p) OR isinf(p) THEN 0.5e0 ELSE greatest(0e0, least(1e0, p)) END, 6) AS score FROM odd""",
)
def sanitise_scores(spark, sf):
    kind, p = F.col("seq") % 6, F.col("p_fake")
    odd = F.when(kind == 1, float("nan")).when(kind == 2, float("inf")).when(kind == 3, -p).when(kind == 4, 1 + p).when(kind == 5, p)
    return rounded(scored_events(spark, sf).select("id", scores.sanitise(odd).alias("score")), "score")


@register(
    "scores_from_logits",
    """WITH z AS (SELECT md5(CAST(event_id AS VARCHAR)) AS id, value - 20 AS a,
  CASE WHEN user_id % 4 = 0 THEN value - 20 ELSE user_id / 10.0e0 - value END AS b FROM events),
e AS (SELECT id, exp(a - greatest(a, b)) AS x, exp(b - greatest(a, b)) AS y FROM z)
SELECT id, CASE WHEN y > x THEN 1 ELSE 0 END AS label, round(greatest(x, y) / (x + y), 6) AS confidence,
  round(y / (x + y), 6) AS p_fake FROM e""",
)
def scores_from_logits(spark, sf):
    a = F.col("value") - 20
    b = F.when(F.col("user_id") % 4 == 0, a).otherwise(F.col("user_id") / 10.0 - F.col("value"))
    out = table(spark, sf, "events").select(
        F.md5(F.col("event_id").cast("string")).alias("id"), scores.from_logits(F.array(a, b)).alias("s")
    )
    return rounded(out.select("id", "s.*"), "confidence", "p_fake")

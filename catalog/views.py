"""Articles, scores and alerts seen in the given tables, for Spark and for the check SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions import scores, text

NOW = datetime(2024, 1, 30, 0, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-30 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a scored article. The detector votes are thresholds on its score, so that
    every query that reads them can be checked; the detectors have their own queries."""
    p, user = F.col("p_fake"), F.col("user_id")
    events = table(spark, sf_dir, "events").select(
        F.md5(F.col("event_id").cast("string")).alias("id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("processed_at"),
        (F.col("value") / (F.col("value") + 20.0)).alias("p_fake"),
        F.concat(F.lit("User "), user.cast("string"), F.lit(" "), F.col("event_type")).alias("title"),
        F.col("props").alias("body"),
        F.concat(F.lit("https://news.example/"), F.col("event_id").cast("string")).alias("url"),
        F.when(user % 2 == 0, "fr").otherwise("en").alias("language"),
        "user_id",
    )
    votes = (p > 0.94) & (user % 3 != 0), (p > 0.94) & (user % 2 == 0), p > 0.93
    exact = scores.composite(*votes)
    return events.select(
        *[c for c in events.columns if c != "user_id"],
        F.when(p > 0.5, 1).otherwise(0).alias("is_fake"),
        F.greatest(p, 1 - p).alias("confidence"),
        *[vote.alias(name) for vote, name in zip(votes, ("adwin", "kswin", "page_hinkley"))],
        F.round(exact, 4).alias("drift_score"),
        (F.round(exact, 4) >= scores.DRIFT_THRESHOLD).alias("drift_active"),
    )


SCORED = """scored AS (
  SELECT *, round(0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT, 4) AS drift_score,
    0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT >= 0.5 AS drift_active
  FROM (
    SELECT *, CASE WHEN p_fake > 0.5 THEN 1 ELSE 0 END AS is_fake, greatest(p_fake, 1 - p_fake) AS confidence,
      p_fake > 0.94 AND user_id % 3 <> 0 AS adwin, p_fake > 0.94 AND user_id % 2 = 0 AS kswin, p_fake > 0.93 AS page_hinkley
    FROM (
      SELECT md5(CAST(event_id AS VARCHAR)) AS id, event_id AS seq, event_type AS source, ts AS processed_at,
        value / (value + 20.0e0) AS p_fake, 'User ' || user_id || ' ' || event_type AS title, props AS body,
        'https://news.example/' || event_id AS url,
        CASE WHEN user_id % 2 = 0 THEN 'fr' ELSE 'en' END AS language, user_id
      FROM events)))"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as an article: first line as title, the rest as body, whole texts."""
    docs = table(spark, sf_dir, "documents")
    split_at = F.instr("text", "\n")
    title = F.when(split_at > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text"))
    body = F.when(split_at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit(""))
    return docs.select(
        F.col("doc_id").alias("seq"),
        title.alias("title"),
        body.alias("body"),
        F.concat(F.lit("https://news.example/"), F.col("source")).alias("url"),
        "source",
        F.col("lang").alias("language"),
        "n_chars",
    ).withColumn("id", text.content_id(F.col("url"), F.col("title")))


ARTICLES = r"""articles AS (
  SELECT *, md5(concat(url, title)) AS id FROM (
    SELECT doc_id AS seq,
      CASE WHEN instr(text, chr(10)) > 0 THEN substring(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
      CASE WHEN instr(text, chr(10)) > 0 THEN substring(text, instr(text, chr(10)) + 1) ELSE '' END AS body,
      concat('https://news.example/', source) AS url, source, lang AS language, n_chars
    FROM documents))"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a known label; ``score`` is a fixed pseudo score for the metrics."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"), F.col("toxic").alias("label"))
    return (
        articles(spark, sf_dir)
        .join(labels, "seq")
        .filter(F.col("label").isNotNull())
        .withColumn("score", (F.col("n_chars") % 97) / 97.0)
        .withColumn("prediction", F.when(F.col("score") > 0.5, 1).otherwise(0))
    )


LABELLED = (
    ARTICLES
    + """, labelled AS (
  SELECT a.*, l.toxic AS label, (a.n_chars % 97) / 97.0e0 AS score,
    CASE WHEN (a.n_chars % 97) / 97.0e0 > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM articles a JOIN labels l ON a.seq = l.doc_id WHERE l.toxic IS NOT NULL)"""
)

SPACE = r"\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\p{Z}"


def stamp(column: str):
    """Timestamps are compared as text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column.split('.')[-1]}"

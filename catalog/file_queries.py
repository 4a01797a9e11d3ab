"""Round trips: what the file operators write and read back, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.drift_queries import ALERTS, alerts
from catalog.views import ARTICLES, articles, stamp, stamp_sql
from newslens.operators.corpus import stratified_split
from newslens.plans.storage import materialise, scratch_path
from newslens.sources import corpora, sinks



def pairs(spark, sf):
    """Articles with a label that follows from their number."""
    return articles(spark, sf).withColumn("label", (F.col("seq") % 2).cast("int"))


@register(
    "corpus_csv",
    f"WITH {ARTICLES} SELECT title, nullif(body, '') AS body, CAST(seq % 2 AS INTEGER) AS label, 'news' AS source FROM articles WHERE title <> ''",
)
def corpus_csv(spark, sf):
    path = scratch_path(spark, "corpus-csv")
    pairs(spark, sf).select("title", F.col("body").alias("text"), "label").write.options(**corpora.CSV).csv(path)
    return corpora.harmonise_articles(corpora.read_corpus_csv(spark, path), "news")


@register(
    "corpus_discovered",
    f"WITH {ARTICLES} SELECT title, body, CAST(1 AS INTEGER) AS label, 'found' AS source FROM articles WHERE title <> ''",
)
def corpus_discovered(spark, sf):
    path = scratch_path(spark, "corpus-discovered")
    named = pairs(spark, sf).select("seq", F.col("title").alias("News_Title"), F.col("url").alias("link"), F.col("body").alias("Content"))
    named.write.options(**corpora.CSV).csv(path)
    (found,) = corpora.read_labelled_csvs(spark, {path: 1, f"{path}-missing": 0}, "found")
    return found


@register(
    "corpus_liar",
    f"""WITH {ARTICLES} SELECT title, coalesce(source, '') AS body, CAST(CASE seq % 3 WHEN 2 THEN 0 ELSE 1 END AS INTEGER) AS label, 'liar' AS source FROM articles""",
)
def corpus_liar(spark, sf):
    path = scratch_path(spark, "corpus-liar")
    label = F.element_at(F.array(F.lit("false"), F.lit("pants-fire"), F.lit("true")), (F.col("seq") % 3).cast("int") + 1)
    filled = {"id": F.col("id"), "label": label, "statement": F.col("title"), "context": F.col("source")}
    rows = articles(spark, sf).select(*[filled.get(c, F.lit("x")).alias(c) for c in corpora.LIAR_COLUMNS])
    rows.write.options(**corpora.CSV | {"header": False, "sep": "\t"}).csv(path)
    return corpora.harmonise_liar(corpora.read_liar(spark, path))


@register(
    "corpus_splits",
    f"""WITH {ARTICLES}, kept AS (SELECT title, body, CAST(seq % 2 AS INTEGER) AS label, source FROM articles WHERE title <> '')
SELECT title, nullif(body, '') AS body, label, source FROM kept""",
)
def corpus_splits(spark, sf):
    """Every row of a split corpus comes back from one of its three folders."""
    path = scratch_path(spark, "splits")
    rows = materialise(pairs(spark, sf).filter("title <> ''"), "split-corpus")
    corpora.write_splits(stratified_split(rows, tie=["seq"]), path)
    folders = [corpora.read_corpus_csv(spark, f"{path}/split={s}") for s in ("train", "val", "test")]
    merged = folders[0].unionByName(folders[1]).unionByName(folders[2])
    return merged.select("title", "body", F.col("label").cast("int").alias("label"), "source")


def two_batches(spark, sf):
    """Two overlapping batches: the second rewrites every third article and adds some."""
    rows = articles(spark, sf).withColumn("id", F.col("seq").cast("string")).withColumn("processed_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 3600))
    first = rows.filter("seq % 5 <> 0").withColumn("version", F.lit(1))
    second = rows.filter("seq % 3 = 0 or seq % 5 = 0").withColumn("version", F.lit(2))
    columns = ["id", "title", "body", "url", "source", "language", "processed_at", "version"]
    return first.select(*columns), second.select(*columns)


STORED = f"""WITH {ARTICLES}, stored AS (
  SELECT CAST(seq AS VARCHAR) AS id, title, body, url, source, language, CASE WHEN seq % 3 = 0 OR seq % 5 = 0 THEN 2 ELSE 1 END AS version FROM articles)"""


def stored(spark, sf, compact):
    root = scratch_path(spark, "store")
    for number, batch in enumerate(two_batches(spark, sf)):
        sinks.upsert_articles(batch, number, root, ["processed_at"])
        if compact and number == 0:
            sinks.compact_articles(spark, root, 0, buckets=2)
    # a batch that is written again changes nothing
    sinks.upsert_articles(two_batches(spark, sf)[1], 1, root, ["processed_at"])
    return sinks.current_articles(spark, root).drop("processed_at")


@register("stored_articles", f"{STORED} SELECT * FROM stored")
def stored_articles(spark, sf):
    return stored(spark, sf, False)


@register("compacted_articles", f"{STORED} SELECT * FROM stored")
def compacted_articles(spark, sf):
    return stored(spark, sf, True)


@register(
    "upsert_counts",
    """SELECT count(*) FILTER (WHERE doc_id % 5 = 0) AS inserts, count(*) FILTER (WHERE doc_id % 5 <> 0) AS updates
FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0""",
)
def upsert_counts(spark, sf):
    root = scratch_path(spark, "store")
    first, second = two_batches(spark, sf)
    sinks.upsert_articles(first, 0, root, ["processed_at"])
    return sinks.upsert_report(sinks.current_articles(spark, root), second)


@register(
    "stored_lengths",
    rf"""WITH {ARTICLES}, t AS (SELECT CAST(seq AS VARCHAR) AS id, unnest([{{'field': 'title', 'n': len(regexp_extract_all(lower(title), '[\p{{L}}\p{{N}}]+'))}},
  {{'field': 'body', 'n': len(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+'))}}]) AS f FROM articles)
SELECT id, f.field AS field, CAST(f.n AS INTEGER) AS dl FROM t WHERE f.n > 0""",
)
def stored_lengths(spark, sf):
    """The index of two batches, the second of which repeats half of the first, read back."""
    root = scratch_path(spark, "index")
    rows = articles(spark, sf).select(F.col("seq").cast("string").alias("id"), "title", "body")
    sinks.write_postings(rows, 0, root)
    sinks.write_postings(rows.filter("id % 2 = 0"), 1, root)
    index = sinks.current_index(spark, root)
    from_postings = index.postings.groupBy("id", "field").agg(F.sum("tf").cast("int").alias("dl"))
    return from_postings.join(index.lengths, ["id", "field", "dl"], "left_semi")


_MESSAGE = "timestamp timestamp, composite_score double, drift_confirmed boolean, messages_total long, total_drift_events long"


@register(
    "alert_messages",
    f"WITH {ALERTS} SELECT {stamp_sql('timestamp')}, composite_score, drift_confirmed, messages_total, total_drift_events FROM alerts",
)
def alert_messages(spark, sf):
    """Drift alerts as they were sent, decoded from their JSON messages."""
    root = scratch_path(spark, "drift-alerts")
    sinks.write_drift_alerts(alerts(spark, sf), 0, root)
    sent = spark.read.text(f"{root}/messages/batch_id=0").select(F.from_json("value", _MESSAGE).alias("m")).select("m.*")
    return sent.withColumn("timestamp", stamp("timestamp")).withColumn("composite_score", F.round("composite_score", 4))


@register(
    "alert_history",
    """SELECT 'm' || event_id AS metric, CASE WHEN user_id % 2 = 0 THEN 'warning' ELSE 'critical' END AS severity
FROM events ORDER BY ts DESC, metric, severity LIMIT 100""",
)
def alert_history(spark, sf):
    path = scratch_path(spark, "alert-history")
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("metric"),
        F.when(F.col("user_id") % 2 == 0, "warning").otherwise("critical").alias("severity"),
        F.col("ts").alias("timestamp"),
        "event_id",
    )
    for number in range(2):
        sinks.append_alerts(rows.filter(F.col("event_id") % 2 == number).drop("event_id"), path, number)
    sinks.append_alerts(rows.filter(F.col("event_id") % 2 == 1).drop("event_id"), path, 1)
    return sinks.recent_alerts(spark, path).select("metric", "severity")


@register(
    "exported_csv",
    f"WITH {ARTICLES} SELECT id, title, nullif(body, '') AS body, CAST(n_chars AS VARCHAR) AS n_chars FROM articles WHERE title <> ''",
)
def exported_csv(spark, sf):
    path = scratch_path(spark, "export")
    sinks.export_csv(articles(spark, sf).filter("title <> ''"), ["id", "title", "body", "n_chars"], path)
    return corpora.read_corpus_csv(spark, path)

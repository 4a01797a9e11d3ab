"""Corpus preparation and statistics over the labelled articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.views import ARTICLES, LABELLED, SPACE, articles, labelled, table
from newslens.functions import text
from newslens.operators import corpus as ops
from newslens.plans.storage import materialise
from newslens.sources import corpora

WORD = r"\p{L}\p{N}_"


def clean_sql(column: str) -> str:
    return (
        f"substring(trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(coalesce({column}, ''), "
        f"'http[^{SPACE}]+', '[URL]', 'g'), '@[{WORD}]+', '[USER]', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), "
        f"'[{SPACE}]+', ' ', 'g'), ' '), 1, 2000)"
    )


CORPUS = (
    LABELLED
    + f""", cleaned AS (
  SELECT seq, id, source, label, {clean_sql('title')} AS title, {clean_sql('body')} AS body FROM labelled),
corpus AS (SELECT * FROM cleaned WHERE length(title) > 5),
deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY seq) AS rn FROM corpus) WHERE rn = 1)"""
)

SPLIT = (
    CORPUS
    + """, n AS (SELECT label, count(*) AS c FROM deduped GROUP BY 1),
kept AS (SELECT *, sum(c) OVER () - ceil(sum(c) OVER () * 0.1e0) AS k FROM n),
kept2 AS (SELECT *, c * 1e0 / sum(c) OVER () * k AS ideal FROM kept),
kept3 AS (SELECT *, floor(ideal) + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, label) <= k - sum(floor(ideal)) OVER () THEN 1 ELSE 0 END AS tv FROM kept2),
fit AS (SELECT *, k - ceil(k * 0.111e0) AS f FROM kept3),
fit2 AS (SELECT *, tv * 1e0 / sum(tv) OVER () * f AS ideal2 FROM fit),
sizes AS (SELECT label, c, tv, floor(ideal2) + CASE WHEN row_number() OVER (ORDER BY ideal2 - floor(ideal2) DESC, label) <= f - sum(floor(ideal2)) OVER () THEN 1 ELSE 0 END AS train FROM fit2),
split AS (SELECT d.*, CASE WHEN r <= c - tv THEN 'test' WHEN r <= c - train THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|42'), id, seq) AS r FROM deduped) d JOIN sizes USING (label))"""
)


def cleaned(spark, sf):
    return ops.clean_corpus(labelled(spark, sf).select("seq", "id", "source", "label", "title", "body"))


def deduped(spark, sf):
    return ops.dedup_title(cleaned(spark, sf), ["seq"])


def split(spark, sf):
    return ops.stratified_split(materialise(deduped(spark, sf), "corpus"), tie=["seq"])


@register(
    "score_texts",
    f"WITH {ARTICLES} SELECT seq, substring(title, 1, 200) || ' [SEP] ' || substring(body, 1, 100) AS model_input FROM articles",
)
def score_texts(spark, sf):
    return articles(spark, sf).select("seq", text.score_text(F.col("title"), F.col("body")).alias("model_input"))


@register("train_texts", f"WITH {ARTICLES} SELECT seq, title || ' [SEP] ' || substring(body, 1, 100) AS model_input FROM articles")
def train_texts(spark, sf):
    return articles(spark, sf).select("seq", text.train_text(F.col("title"), F.col("body")).alias("model_input"))


@register("clean_texts", f"SELECT doc_id AS seq, {clean_sql('text')} AS cleaned FROM documents")
def clean_texts(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select(F.col("doc_id").alias("seq"), text.clean_text(F.col("text")).alias("cleaned"))


@register("clean_pages", f"SELECT page_id, {clean_sql('html')} AS cleaned FROM pages")
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


_VERDICT = "CASE n_chars % 5 WHEN 0 THEN 'true' WHEN 1 THEN ' mostly-true ' WHEN 2 THEN 'pants-fire' WHEN 3 THEN 'half-true' END"


@register(
    "liar_corpus",
    f"""WITH {ARTICLES} SELECT title, body, CASE WHEN n_chars % 5 IN (0, 1, 3) THEN 0 ELSE 1 END AS label, 'liar' AS source
FROM articles""",
)
def liar_corpus(spark, sf):
    verdict = F.expr(_VERDICT)
    rows = articles(spark, sf).select(verdict.alias("label"), F.col("title").alias("statement"), F.col("body").alias("context"))
    return corpora.harmonise_liar(rows)


def _union(spark, sf):
    rows = articles(spark, sf).select("title", "body", "language", "n_chars", F.col("body").alias("text"), (F.col("n_chars") % 2).alias("label"))
    frames = [
        corpora.harmonise_articles(rows.filter("language = 'en'"), "welfake"),
        corpora.harmonise_articles(rows.filter("language = 'fr'"), "isot", 1),
        corpora.harmonise_liar(
            rows.filter("language = 'de'").select(F.expr(_VERDICT).alias("label"), F.col("title").alias("statement"), F.col("body").alias("context"))
        ),
        corpora.harmonise_discovered(rows.filter("language = 'es'").select("title", "text"), 0, "fakenewsnet"),
    ]
    return ops.build_corpus(frames)


UNION = (
    ARTICLES
    + """, merged AS (
  SELECT title, body, CAST(CASE language WHEN 'en' THEN n_chars % 2 WHEN 'fr' THEN 1 WHEN 'es' THEN 0
      WHEN 'de' THEN CASE WHEN n_chars % 5 IN (0, 1, 3) THEN 0 ELSE 1 END END AS INTEGER) AS label,
    CASE language WHEN 'en' THEN 'welfake' WHEN 'fr' THEN 'isot' WHEN 'de' THEN 'liar' WHEN 'es' THEN 'fakenewsnet' END AS source
  FROM articles)"""
)


@register("build_corpus", f"WITH {UNION} SELECT * FROM merged")
def build_corpus(spark, sf):
    return _union(spark, sf).drop("corpus_order")


@register("corpus_label_counts", f"WITH {UNION} SELECT label, source, count(*) AS rows FROM merged GROUP BY 1, 2")
def corpus_label_counts(spark, sf):
    return ops.label_source_counts(_union(spark, sf))


@register("clean_corpus", f"WITH {CORPUS} SELECT seq, title, body, label FROM corpus")
def clean_corpus(spark, sf):
    return cleaned(spark, sf).select("seq", "title", "body", "label")


@register("dedup_title", f"WITH {CORPUS} SELECT seq, id, source, label, title FROM deduped")
def dedup_title(spark, sf):
    return deduped(spark, sf).drop("body")


@register(
    "dedup_title_documents",
    f"""WITH {ARTICLES} SELECT seq, title FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY seq) AS rn FROM articles) WHERE rn = 1""",
)
def dedup_title_documents(spark, sf):
    return ops.dedup_title(articles(spark, sf).select("seq", "title"), ["seq"])


@register(
    "dedup_report",
    f"""WITH {ARTICLES} SELECT count(*) AS rows_before, count(DISTINCT title) AS rows_after,
  count(*) - count(DISTINCT title) AS removed FROM articles""",
)
def dedup_report(spark, sf):
    return ops.dedup_report(articles(spark, sf))


@register("stratified_split", f"WITH {SPLIT} SELECT seq, label, split FROM split")
def stratified_split(spark, sf):
    return split(spark, sf).select("seq", "label", "split")


@register(
    "class_distribution",
    f"""WITH {SPLIT} SELECT split, label, count(*) AS rows,
  round(count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY split) * 100, 1) AS percent FROM split GROUP BY 1, 2""",
)
def class_distribution(spark, sf):
    return ops.class_distribution(split(spark, sf))


@register(
    "split_sizes",
    f"""WITH {SPLIT} SELECT label, CAST(train AS BIGINT) AS train, CAST(tv - train AS BIGINT) AS val, CAST(c - tv AS BIGINT) AS test FROM sizes""",
)
def split_sizes(spark, sf):
    return ops.split_sizes(deduped(spark, sf)).select(
        "label", *[F.col(c).cast("long").alias(c) for c in ("train", "val", "test")]
    )


@register(
    "source_label_crosstab",
    f"""WITH {CORPUS} SELECT source, count(*) FILTER (WHERE label = 0) AS real, count(*) FILTER (WHERE label = 1) AS fake
FROM deduped GROUP BY 1""",
)
def source_label_crosstab(spark, sf):
    return ops.source_label_crosstab(deduped(spark, sf))


@register(
    "describe_title_length",
    f"""WITH {LABELLED} SELECT label, count(length(title)) AS count, round(avg(length(title)), 6) AS mean,
  round(stddev_samp(length(title)), 6) AS std, CAST(min(length(title)) AS INTEGER) AS min,
  round(quantile_cont(length(title), 0.25), 6) AS q25, round(quantile_cont(length(title), 0.5), 6) AS q50,
  round(quantile_cont(length(title), 0.75), 6) AS q75, CAST(max(length(title)) AS INTEGER) AS max FROM labelled GROUP BY 1""",
)
def describe_title_length(spark, sf):
    lengths = labelled(spark, sf).select("label", F.char_length("title").alias("title_len"))
    return rounded(ops.describe_by(lengths, "title_len", "label"), "mean", "std", "q25", "q50", "q75")


@register(
    "length_histogram",
    f"""WITH {LABELLED}, l AS (SELECT label, least(length(body), 500) AS n FROM labelled),
m AS (SELECT *, min(n) OVER (PARTITION BY label) AS lo, max(n) OVER (PARTITION BY label) AS hi FROM l)
SELECT label, CAST(coalesce(least(floor((n - lo) * 50 * 1e0 / nullif(hi - lo, 0)), 49), 25) AS INTEGER) AS bin, count(*) AS rows
FROM m GROUP BY 1, 2""",
)
def length_histogram(spark, sf):
    return ops.length_histogram(labelled(spark, sf), "body")


@register(
    "corpus_summary",
    f"""WITH {CORPUS} SELECT count(*) AS examples, round(avg(label) * 100, 6) AS fake_rate_pct,
  count(DISTINCT source) AS n_sources, round(avg(length(title)), 6) AS mean_title_chars,
  round(avg(length(body)), 6) AS mean_body_chars FROM deduped""",
)
def corpus_summary(spark, sf):
    return rounded(ops.corpus_summary(deduped(spark, sf)), "fake_rate_pct", "mean_title_chars", "mean_body_chars")


@register("corpus_sources", f"WITH {CORPUS} SELECT DISTINCT source FROM deduped")
def corpus_sources(spark, sf):
    return ops.corpus_sources(deduped(spark, sf))


@register(
    "class_weights",
    f"WITH {LABELLED} SELECT round(avg(label), 6) AS weight_real, round(1 - avg(label), 6) AS weight_fake FROM labelled",
)
def class_weights(spark, sf):
    return rounded(ops.class_weights(labelled(spark, sf)), "weight_real", "weight_fake")

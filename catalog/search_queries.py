"""Tokens, postings, ranked and fuzzy search over the articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import _STOP, rounded
from catalog.views import ARTICLES, SPACE, articles, stamp, stamp_sql, table
from newslens.functions import text
from newslens.operators import search as ops
from newslens.plans.storage import materialise, scratch_path, shuffles_discarded
from newslens.sources import sinks

QUERY = "the thention vipa eau"
FUZZY = "thentian eauouon the"

DOCS = (
    ARTICLES
    + r""", docs AS (SELECT CAST(seq AS VARCHAR) AS id, title, body, source, language, url,
    TIMESTAMP '2023-11-14 22:13:20' + to_hours(seq) AS processed_at,
    CASE WHEN (n_chars % 97) / 97.0e0 > 0.5 THEN 1 ELSE 0 END AS is_fake,
    greatest((n_chars % 97) / 97.0e0, 1 - (n_chars % 97) / 97.0e0) AS confidence, (n_chars % 97) / 97.0e0 AS p_fake FROM articles),
f AS (SELECT id, 'title' AS field, regexp_extract_all(lower(title), '[\p{L}\p{N}]+') AS t FROM docs
  UNION ALL SELECT id, 'body', regexp_extract_all(lower(body), '[\p{L}\p{N}]+') FROM docs),
fields AS (SELECT id, field, t, len(t) AS dl FROM f WHERE len(t) > 0),
postings AS (SELECT id, field, term, dl, count(*) AS tf FROM (SELECT id, field, dl, unnest(t) AS term FROM fields) GROUP BY ALL)"""
)


def _weights(query: str, fuzzy: bool) -> str:
    """DuckDB counts edits of bytes, so each accented letter of the texts is first written as
    one capital, which lower-cased terms never hold."""
    parts = []
    for word in query.split():
        k = 0 if not fuzzy or len(word) <= 2 else 1 if len(word) <= 5 else 2
        distance = f"levenshtein(translate(term, 'ßäçèéêíñóöü', 'ABCDEFGHIJK'), '{word}')"
        parts.append(f"CASE WHEN {distance} <= {k} THEN 1 - {distance} * 1e0 / least(length(term), {len(word)}) ELSE 0 END")
    return " + ".join(parts)


def _scored(query: str, fuzzy: bool) -> str:
    return (
        DOCS
        + f""", w AS (SELECT *, {_weights(query, fuzzy)} AS weight FROM postings),
hits AS (SELECT * FROM w WHERE weight > 0),
freq AS (SELECT field, term, count(*) AS df FROM hits GROUP BY 1, 2),
stats AS (SELECT field, count(*) AS n, avg(dl) AS adl FROM fields GROUP BY 1),
parts AS (SELECT h.id, h.field, sum(weight * ln(1 + (n - df + 0.5e0) / (df + 0.5e0)) * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / adl)))
    * max(CASE h.field WHEN 'title' THEN 3e0 ELSE 1e0 END) AS s
  FROM hits h JOIN freq q ON h.field = q.field AND h.term = q.term JOIN stats t ON h.field = t.field GROUP BY 1, 2),
scored AS (SELECT id, round(max(s), 6) AS score FROM parts GROUP BY 1)"""
    )


def docs(spark, sf):
    p = (F.col("n_chars") % 97) / 97.0
    return articles(spark, sf).select(
        F.col("seq").cast("string").alias("id"), "title", "body", "source", "language", "url",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 3600).alias("processed_at"),
        F.when(p > 0.5, 1).otherwise(0).alias("is_fake"), F.greatest(p, 1 - p).alias("confidence"), p.alias("p_fake"),
    )


_stored: dict[tuple[str, str], ops.Index] = {}


def index(spark, sf):
    """The stored index of the tables, written by the first query of a session that needs it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _stored:
        built = ops.build_index(docs(spark, sf).select("id", "title", "body"))
        _stored[key] = ops.store_index(built, scratch_path(spark, "index"))
    return _stored[key]


@register(
    "tokens",
    r"""SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents) GROUP BY 1""",
)
def tokens(spark, sf):
    documents = table(spark, sf, "documents")
    words = documents.select(F.explode(text.tokens(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count("*").alias("n"))


@register("postings", f"WITH {DOCS} SELECT id, field, term, tf, CAST(dl AS INTEGER) AS dl FROM postings")
def postings(spark, sf):
    return index(spark, sf).postings


@register(
    "search",
    f"""WITH {_scored(QUERY, False)}, best AS (SELECT * FROM scored ORDER BY score DESC, id LIMIT 20)
SELECT id, title, source, language, is_fake, round(confidence, 6) AS confidence, round(p_fake, 6) AS p_fake, url, body, score, {stamp_sql("processed_at")}
FROM best JOIN docs USING (id)""",
)
def search(spark, sf):
    found = ops.search(index(spark, sf), docs(spark, sf), QUERY, 20)
    return rounded(found.withColumn("processed_at", stamp("processed_at")), "confidence", "p_fake")


@register("search_scores", f"WITH {_scored(QUERY, False)} SELECT id, score FROM scored")
def search_scores(spark, sf):
    return rounded(ops.score_hits(index(spark, sf), QUERY), "score")


def segments(spark, sf):
    """An index that came about in three batches, the first two of which were merged: texts were
    replaced before and after, and are what ``docs`` has in the end."""
    root = scratch_path(spark, "segments")
    rows, number = docs(spark, sf).select("id", "title", "body"), F.col("id").cast("int")
    early = rows.withColumn("body", F.when(number % 3 == 0, F.concat("title", F.lit(" replaced the text"))).otherwise(F.col("body")))
    early = early.withColumn("title", F.when(number % 4 == 0, F.lit("an old title")).otherwise(F.col("title")))
    for n, batch in enumerate((early.filter(number % 2 == 0), early.filter(number % 2 == 1).unionByName(rows.filter(number % 6 == 0)), rows.filter((number % 3 == 0) | (number % 4 == 0)))):
        sinks.write_postings(batch, n, root)
        if n == 1:
            sinks.compact_index(spark, root, 1)
            sinks.discard_merged(spark, root)
    return root


@register("segment_scores", f"WITH {_scored(QUERY, False)} SELECT id, score FROM scored")
def segment_scores(spark, sf):
    return rounded(ops.score_hits(sinks.current_index(spark, segments(spark, sf)), QUERY), "score")


@register("segment_scores_merged", f"WITH {_scored(FUZZY, True)} SELECT id, score FROM scored")
def segment_scores_merged(spark, sf):
    """Fuzzy scores before the last merge, which must not change them, and after it."""
    root = segments(spark, sf)
    with shuffles_discarded(spark):
        before = materialise(ops.score_hits(sinks.current_index(spark, root), FUZZY, fuzzy=True), "segment-scores")
    sinks.compact_index(spark, root, 2)
    sinks.discard_merged(spark, root)
    after = ops.score_hits(sinks.current_index(spark, root), FUZZY, fuzzy=True)
    return rounded(after.withColumnRenamed("score", "_score").join(before, "id").filter("abs(_score - score) < 1e-9").drop("_score"), "score")


@register("search_total", f"WITH {_scored(QUERY, False)} SELECT count(*) AS total FROM scored")
def search_total(spark, sf):
    return ops.total_hits(index(spark, sf), QUERY)


@register(
    "search_fuzzy",
    f"""WITH {_scored(FUZZY, True)}, best AS (SELECT s.* FROM scored s JOIN docs d USING (id) WHERE d.is_fake = 1 ORDER BY score DESC, id LIMIT 50)
SELECT id, title, source, language, is_fake, round(confidence, 6) AS confidence, round(p_fake, 6) AS p_fake, url, body, score, {stamp_sql("processed_at")}
FROM best JOIN docs USING (id)""",
)
def search_fuzzy(spark, sf):
    found = ops.search(index(spark, sf), docs(spark, sf), FUZZY, 50, fuzzy=True, is_fake=1)
    return rounded(found.withColumn("processed_at", stamp("processed_at")), "confidence", "p_fake")


@register("search_fuzzy_scores", f"WITH {_scored(FUZZY, True)} SELECT id, score FROM scored")
def search_fuzzy_scores(spark, sf):
    return rounded(ops.score_hits(index(spark, sf), FUZZY, fuzzy=True), "score")


_RESULTS = f"{_scored(QUERY, False)}, results AS (SELECT * FROM scored JOIN docs USING (id) ORDER BY score DESC, id LIMIT 50)"


def results(spark, sf):
    return ops.search(index(spark, sf), docs(spark, sf), QUERY, 50)


@register(
    "search_metrics",
    f"""WITH {_RESULTS} SELECT count(*) AS shown, CAST(sum(is_fake) AS BIGINT) AS fakes, CAST(sum(1 - is_fake) AS BIGINT) AS reals,
  round(avg(confidence) * 100, 6) AS mean_confidence_pct, round(sum(is_fake) * 1e0 / count(*) * 100, 6) AS fake_rate FROM results""",
)
def search_metrics(spark, sf):
    return rounded(ops.result_metrics(results(spark, sf)), "mean_confidence_pct", "fake_rate")


@register(
    "search_words",
    f"""WITH {_RESULTS}, words AS (
  SELECT replace(trim(unnest(regexp_split_to_array(lower(title), '[{SPACE}]+')), '.,;:!?"''()[]{{}}'), '''', '') AS word FROM results)
SELECT word, count(*) AS frequency FROM words WHERE length(word) > 3 AND word NOT IN ({_STOP}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def search_words(spark, sf):
    return ops.result_words(results(spark, sf))


@register(
    "search_ranks",
    f"""WITH {_RESULTS} SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank, id, score, round(p_fake, 6) AS p_fake, is_fake,
  round(confidence, 6) AS confidence FROM results""",
)
def search_ranks(spark, sf):
    return rounded(ops.ranked_scores(results(spark, sf)), "p_fake", "confidence")

"""The registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import ann, bpe, language, odd_sketch, packing, quality_net, quality_rules, repair, secrets, simhash, surrogates, toxicity, whitening
from newslens.llm.common import held_out, labelled_sample
from newslens.plans.ordered import join_on

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Stands in for the secret of a real run.
SURROGATE_KEY = "surrogate key of the registered queries"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache
def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(VOCABULARY)


def quality_model(spark: SparkSession, sf_dir: str) -> quality_net.Network:
    """Fitted on labels outside the held-out fold of op3."""
    rows = labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", (3, 1), quality_net.SAMPLE)
    return quality_net.fit(rows)


@register
def op1_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op3_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 3, 1))
    scored = quality_net.score(docs, quality_model(spark, sf_dir), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op4_bpe_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code_digests(table(spark, sf_dir, "documents"), vocabulary())


@register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


@register
def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = surrogates.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY, ["doc_id"])
    spans = F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string")))
    return done.select("doc_id", "text", F.size("entities").cast("bigint").alias("n_entities"), F.array_join(spans, ",").alias("entities"))


@register
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = held_out("doc_id", 4, 2)
    model = language.fit(language.sample(docs, ~fold))
    return language.predict(docs.withColumn("held_out", fold), model, ["doc_id", "held_out"])


@register
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"_rules.{n}" for n in names])


@register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", (4, 2), toxicity.SAMPLE))
    scored = toxicity.score(docs.withColumn("held_out", held_out("doc_id", 4, 2)), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@register
def op11_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))


@register
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    planned, rows = repair.repair(repair.damaged(talks))
    found = join_on(planned, repair.digests(rows), ["conv_id"])
    every = join_on(talks.select("conv_id").distinct(), found, ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


ORACLES["op9_quality_rules"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents
), split AS (
  SELECT rid, doc_id, body,
    list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), places AS (
  SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2
), windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM places
), twice AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows
), repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY rid
), line AS (
  SELECT rid, unnest(lines) AS s FROM split
), facts AS (
  SELECT rid, s, lower(s) AS low,
    length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g')) AS solid,
    length(regexp_replace(s, '[^#*$%&|<>]', '', 'g')) AS symbols,
    length(regexp_replace(s, '[^!]', '', 'g')) AS marks,
    length(regexp_replace(s, '[^.,;:!?]', '', 'g')) AS stops,
    length(regexp_replace(s, '[^|]', '', 'g')) AS bars,
    len(list_filter(regexp_split_to_array(s, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM line
), failed AS (
  SELECT rid, sum(solid) AS lost FROM facts
  WHERE symbols * 100 > solid * 10 OR marks * 3 > words OR (stops = 0 AND words >= 30)
    OR bars >= 3 OR (words <= 8 AND regexp_matches(low, '(^|[^a-z])(home|menu|log ?in|sign ?up|sign ?in|next page|previous page|read more|share this|skip to content|site ?map|contact us)([^a-z]|$)'))
    OR regexp_matches(low, 'licen[sc]ed under|all rights reserved|copyright|spdx-license|cookie policy|privacy policy|terms of (use|service)|enable javascript|javascript is disabled|subscribe to our newsletter|lorem ipsum')
  GROUP BY rid
), counts AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(f.lost, 0) AS lost_chars
  FROM split LEFT JOIN repeated r USING (rid) LEFT JOIN failed f USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars * 100 <= word_chars * 30 AS kept,
  CAST(lost_chars AS BIGINT) AS lost_chars
FROM counts
"""

"""Ranked full-text search over an index of postings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.functions import inverted, text
from newslens.operators.articles import MAX_SEARCH, check_limit, page_metrics, word_frequencies
from newslens.plans.storage import shuffles_discarded, stored

# Fixed values.
FIELD_BOOST = {"title": 3.0, "body": 1.0}
K1, B = 1.2, 0.75
MIN_QUERY = 2
RESULT_COLUMNS = ("id", "title", "source", "language", "is_fake", "confidence", "p_fake", "processed_at", "url", "body")
RESULT_WORDS = 15


@dataclass(frozen=True)
class Index:
    """``postings`` (id, field, term, tf, dl) and ``lengths`` (id, field, dl) of non-empty fields;
    of a stored index also its dictionary ``terms`` (field, term, df) and ``stats`` (field, docs,
    avg_dl), which are worked out from the others where they are missing. ``names`` (field, term) are
    the terms of an index of several segments; a term may be in dead articles only. ``fields`` (id,
    field, dl, words) are what an index is stored from: the fields' words, joined by a space."""

    postings: DataFrame
    lengths: DataFrame
    terms: DataFrame | None = None
    stats: DataFrame | None = None
    names: DataFrame | None = None
    fields: DataFrame | None = None

    def dictionary(self) -> DataFrame:
        return dictionary(self.postings) if self.terms is None else self.terms

    def field_stats(self) -> DataFrame:
        """One row per field of FIELD_BOOST."""
        return field_stats(self.lengths) if self.stats is None else self.stats


def dictionary(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_stats(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("field").agg(F.count("*").alias("docs"), F.avg("dl").alias("avg_dl"))


def field_tokens(df: DataFrame) -> DataFrame:
    fields = [F.struct(F.lit(f).alias("field"), text.tokens(F.col(f)).alias("tokens")) for f in FIELD_BOOST]
    return (
        df.select("id", F.explode(F.array(*fields)).alias("f"))
        .select("id", "f.field", "f.tokens", F.size("f.tokens").alias("dl"))
        .filter(F.col("dl") > 0)
    )


def build_index(df: DataFrame) -> Index:
    """Index of articles whose ids are unique. All tokens of a field sit in one input row, so
    they are counted there and nothing is shuffled."""
    return index_of(field_tokens(df).select("id", "field", "dl", F.concat_ws(" ", "tokens").alias("words")))


def index_of(fields: DataFrame) -> Index:
    """Index of the words of fields; no word has a space in it."""
    counted = fields.select("id", "field", "dl", F.explode(text.counts(F.split("words", " "))).alias("c"))
    postings = counted.select("id", "field", F.col("c.value").alias("term"), F.col("c.n").alias("tf"), "dl")
    return Index(postings, fields.select("id", "field", "dl"), fields=fields)


def by_term(lists: DataFrame) -> DataFrame:
    """Postings of ``inverted`` blocks, clustered by term for writing: a search then prunes row groups by
    their min and max. Packed blocks of many postings are dealt, one part to a task, which sorts their
    postings; the id in the bounds of the parts lets a term that occurs everywhere span many files."""
    return inverted.postings(lists.repartitionById(lists.schema["part"].metadata["parts"], F.col("part")))


def sorted_terms(terms: DataFrame) -> DataFrame:
    return terms.repartitionByRange("term").sortWithinPartitions("term")


def write_index(fields: DataFrame, place: Callable[[str], str], mode: str = "error") -> None:
    """Write the tables of an index of ``fields`` to where ``place`` has them: the fields, postings clustered by
    term, lengths and dictionary. Texts are tokenised once, with the fields. No table's shuffle files
    are left when the next is written."""
    spark = fields.sparkSession

    def put(df: DataFrame, name: str) -> DataFrame:
        with shuffles_discarded(spark):
            df.write.mode(mode).option("compression", "zstd").parquet(place(name))
        return spark.read.schema(df.schema).parquet(place(name))

    kept = put(fields, "fields")
    lists = inverted.inverted(kept, inverted.bounds(kept))
    postings = put(by_term(lists).withColumn("id", F.col("id").cast(kept.schema["id"].dataType)), "postings")
    put(sorted_terms(dictionary(postings)), "terms")
    put(kept.select("id", "field", "dl"), "lengths")


def read_index(spark: SparkSession, path: str) -> Index:
    """An index that ``store_index`` wrote."""
    return Index(**{name: spark.read.parquet(f"{path}/{name}") for name in ("postings", "lengths", "terms", "stats", "fields")})


def store_index(index: Index, path: str) -> Index:
    """Write an index of fields and read it back: fields, postings clustered by term, dictionary,
    lengths, statistics."""
    write_index(index.fields, lambda name: f"{path}/{name}")
    spark = index.fields.sparkSession
    with shuffles_discarded(spark):
        stored(field_stats(spark.read.parquet(f"{path}/lengths")), f"{path}/stats")
    return read_index(spark, path)


def query_terms(df: DataFrame, query: str) -> Counter:
    """Terms of a query and how often each occurs, tokenised like the articles."""
    if len(query) < MIN_QUERY:
        raise ValueError(f"a query needs at least {MIN_QUERY} characters")
    return Counter(df.sparkSession.range(1).select(text.tokens(F.lit(query))).first()[0])


def allowed_edits(term: str) -> int:
    """No edit up to 2 characters, one up to 5, two beyond."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def _matched_terms(terms_table: DataFrame, terms: Counter, fuzzy: bool) -> DataFrame:
    """Dictionary entries that the query matches, with a ``weight``: the term's count in the
    query, for a fuzzy match lowered by its share of edits. Edits are counted on distinct
    terms only. The query is a handful of literals, so the match is a filter inside the scan."""
    term = F.col("term")
    if not fuzzy:
        weight = F.lit(0.0)
        for word, count in terms.items():
            weight = F.when(term == word, F.lit(float(count))).otherwise(weight)
        return terms_table.filter(term.isin(*terms)).withColumn("weight", weight)

    def weight_of(word: str, count: int) -> Column:
        most = allowed_edits(word)
        edits = F.levenshtein(term, F.lit(word), most)
        close = (F.abs(F.char_length(term) - len(word)) <= most) & (edits >= 0)
        similarity = 1 - edits / F.least(F.char_length(term), F.lit(len(word)))
        return F.when(close, F.lit(float(count)) * similarity).otherwise(F.lit(0.0))

    weight = F.lit(0.0)
    for word, count in terms.items():
        weight = weight + weight_of(word, count)
    return terms_table.withColumn("weight", weight).filter(F.col("weight") > 0)


def _hits(index: Index, terms: Counter, fuzzy: bool) -> DataFrame:
    """Postings of the matched terms with weight and df."""
    if fuzzy and index.names is not None:
        # the names are matched first; only postings of matched terms are counted
        hits = index.postings.join(_matched_terms(index.names, terms, True), ["field", "term"])
        return hits.join(dictionary(hits), ["field", "term"])
    matched = _matched_terms(index.dictionary(), terms, fuzzy)
    if fuzzy:
        return index.postings.join(matched, ["field", "term"])
    # at most two rows per query term; the filter on the literals prunes the postings' row groups
    return index.postings.filter(F.col("term").isin(*terms)).join(F.broadcast(matched), ["field", "term"])


def score_hits(index: Index, query: str, fuzzy: bool = False) -> DataFrame:
    """(id, score) of every matching article: BM25 summed over terms per field, times the
    field's boost, the best field counting."""
    terms = query_terms(index.postings, query)
    if not terms:
        return index.postings.select("id", F.lit(0.0).alias("score")).limit(0)
    fields = F.broadcast(index.field_stats())  # one row per field of FIELD_BOOST
    c = F.col
    idf = F.log(1 + (c("docs") - c("df") + 0.5) / (c("df") + 0.5))
    saturation = c("tf") * (K1 + 1) / (c("tf") + K1 * (1 - B + B * c("dl") / c("avg_dl")))
    part = c("weight") * idf * saturation
    sums = [F.sum(F.when(c("field") == field, part)) * boost for field, boost in FIELD_BOOST.items()]
    return _hits(index, terms, fuzzy).join(fields, "field").groupBy("id").agg(F.greatest(*sums).alias("score"))


def search(
    index: Index,
    articles: DataFrame,
    query: str,
    limit: int = 20,
    *,
    fuzzy: bool = False,
    is_fake: int | None = None,
    digits: int = 6,
) -> DataFrame:
    """The best ``limit`` articles. Scores are compared at ``digits`` decimals, ties by id."""
    check_limit("limit", limit, MAX_SEARCH)
    scored = score_hits(index, query, fuzzy).withColumn("score", F.round("score", digits))
    if is_fake is not None:
        scored = scored.join(articles.filter(F.col("is_fake") == is_fake).select("id"), "id", "left_semi")
    best = scored.orderBy(F.desc("score"), "id").limit(limit)
    found = [tuple(r) for r in best.select("id", "score").collect()]  # at most 100 rows
    session = articles.sparkSession
    ranked = session.createDataFrame(found, best.select("id", "score").schema)
    shown = articles.select(*RESULT_COLUMNS).filter(F.col("id").isin([i for i, _ in found]))
    return shown.join(F.broadcast(ranked), "id").orderBy(F.desc("score"), "id")


def total_hits(index: Index, query: str, fuzzy: bool = False) -> DataFrame:
    """Exact number of matching articles."""
    terms = query_terms(index.postings, query)
    return _hits(index, terms, fuzzy).agg(F.countDistinct("id").alias("total"))


def ranked_scores(results: DataFrame) -> DataFrame:
    """Rank against p_fake, for a result list of at most 100 rows."""
    place = Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "id")
    return results.select(F.row_number().over(place).alias("rank"), "id", "score", "p_fake", "is_fake", "confidence")


def result_words(results: DataFrame, n: int = RESULT_WORDS) -> DataFrame:
    return word_frequencies(results, n)


def result_metrics(results: DataFrame) -> DataFrame:
    return page_metrics(results)

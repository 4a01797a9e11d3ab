"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet to the session's shared folder and reads it back as the next stage's documents.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import packing, quality_net, quality_rules, simhash, surrogates
from newslens.llm.common import map_texts, unused
from newslens.llm.queries import SURROGATE_KEY, quality_model, vocabulary
from newslens.plans.storage import discard, materialise, scratch_path, stored


def with_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, n_chars counted anew where there is such a column."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    return df.select(*columns)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    into = unused(docs.columns, "_rules")
    judged = quality_rules.apply_rules(docs, into=into).filter(f"{into}.kept")
    return with_text(judged.withColumn("text", F.col(f"{into}.cleaned")), docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labels of the tables, gives 0.5 or more."""
    into = unused(docs.columns, "score")
    scored = quality_net.score(docs, quality_model(spark, sf_dir), docs.columns, into=into)
    return scored.filter(F.col(into) >= 0.5).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row: that of the smallest id, of rows with one id the
    smallest by their values. A group without any id keeps its smallest row; groups with the same
    smallest id count as one.

    Rows whose id no other row has are told by it. For the others, and those without id, the
    fingerprint is worked out again beside the row.
    """
    groups = materialise(simhash.grouped(docs, words=4, max_bits=4), "pipeline-groups")
    twice = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    gone = groups.filter("doc_id <> component_id").select("doc_id").unionByName(twice)
    once = docs.filter("doc_id is not null").join(gone, "doc_id", "left_anti").select(*docs.columns)
    rest = docs.join(twice, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.filter("doc_id is null"))
    columns = ["doc_id", *[c for c in docs.columns if c not in ("doc_id", "text")], "text"]
    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    marked = map_texts(rest, columns, f"{ddl}, `{(fp := unused(columns, '_fp'))}` bigint", lambda: lambda *v: [*v, [simhash.fingerprint(t, 4) for t in v[-1]]])
    row = F.min(F.struct(*["doc_id", *[c for c in docs.columns if c != "doc_id"]])).alias("row")
    # one row of each id and fingerprint before the join, so that copies do not meet in it
    rows = marked.groupBy(F.col("doc_id").alias("id"), F.col(fp).alias("fp")).agg(row)
    # groups has a row for each document: it is not sent to all, however few bytes it is stored in
    first = rows.hint("merge").join(groups.select("fp", "component_id", "class").distinct(), "fp").filter(F.col("id").eqNullSafe(F.col("component_id")))
    of_group = F.when(F.col("component_id").isNull(), F.col("class"))
    kept = first.groupBy("component_id", of_group.alias("class")).agg(F.min("row").alias("row"))
    return once.unionByName(kept.select("row.*").select(*docs.columns))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by surrogates."""
    others = [c for c in docs.columns if c != "text"]
    done = surrogates.pseudonymise(docs, SURROGATE_KEY, others, into=unused(docs.columns, "entities"))
    return with_text(done, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("pii_surrogates", pii_stage),
    ("packing", packing_stage),
]

#: SQL cannot state the network, the surrogates or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = stored(stage(spark, docs, sf_dir), path)
        if last:
            discard(spark, last)  # the stage that read it is written
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)

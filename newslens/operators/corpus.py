"""Corpus preparation: union, cleaning, title dedup, stratified split, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions import text
from newslens.plans.ordered import first_per_key
from newslens.plans.sampling import hash_key, split_by_rank
from newslens.sources.records import PLACE

# Fixed values.
MIN_TITLE = 5
TEST_SHARE, VAL_SHARE, SEED = 0.10, 0.111, 42
LENGTH_CLIP, LENGTH_BINS = 500, 50


def build_corpus(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all corpora. ``corpus_order`` keeps the order of corpora and of rows in them: of
    frames read with their places that of the files, however these were split; of others that of
    their partitions."""
    if not frames:
        raise ValueError("no corpus could be read")
    numbered = []
    for i, frame in enumerate(frames):
        known = set(PLACE) <= set(frame.columns)
        row = [F.col(c) for c in PLACE] if known else [F.lit("").alias(PLACE[0]), F.monotonically_increasing_id().alias(PLACE[1])]
        placed = frame.withColumn("corpus_order", F.struct(F.lit(i).alias("corpus"), row[0].alias("file"), row[1].alias("row")))
        numbered.append(placed.drop(*PLACE))
    merged = numbered[0]
    for frame in numbered[1:]:
        merged = merged.unionByName(frame)
    return merged


def min_title(df: DataFrame, shortest: int = MIN_TITLE) -> DataFrame:
    return df.filter(F.col("title").isNotNull() & (F.char_length("title") > shortest))


def clean_corpus(df: DataFrame) -> DataFrame:
    cleaned = df.withColumn("title", text.clean_text(F.col("title"))).withColumn("body", text.clean_text(F.col("body")))
    return min_title(cleaned)


def dedup_title(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per title in ``order``, which must be unique within a title."""
    return first_per_key(df, "title", order)


def dedup_report(before: DataFrame) -> DataFrame:
    """Rows before and after title dedup, from one pass over titles only."""
    per_title = before.groupBy("title").agg(F.count("*").alias("n"))
    return per_title.agg(
        F.sum("n").alias("rows_before"), F.count("*").alias("rows_after"), F.sum(F.col("n") - 1).alias("removed")
    )


def _largest_remainder(sizes: DataFrame, group: str, count: str, draws: Column, name: str) -> DataFrame:
    """Share ``draws`` among the groups in proportion to ``count``; one row per group."""
    everything = Window.partitionBy(F.lit(0))
    ideal = F.col(count) / F.sum(count).over(everything) * draws
    shared = sizes.withColumn("_floor", F.floor(ideal)).withColumn("_rest", ideal - F.floor(ideal))
    spare = draws - F.sum("_floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("_rest"), group))
    shared = shared.withColumn(name, F.col("_floor") + F.when(place <= spare, 1).otherwise(0))
    return shared.drop("_floor", "_rest")


def split_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    """Train, validation and test rows per class: 10 % test, then 11.1 % of the rest."""
    everything = Window.partitionBy(F.lit(0))
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(everything)
    sizes = sizes.withColumn("_kept", total - F.ceil(total * TEST_SHARE))
    sizes = _largest_remainder(sizes, label, "n", F.col("_kept"), "_train_val")
    sizes = sizes.withColumn("_fit", F.col("_kept") - F.ceil(F.col("_kept") * VAL_SHARE))
    sizes = _largest_remainder(sizes, label, "_train_val", F.col("_fit"), "train")
    return sizes.select(
        label, "train", (F.col("_train_val") - F.col("train")).alias("val"), (F.col("n") - F.col("_train_val")).alias("test")
    )


def stratified_split(df: DataFrame, label: str = "label", id_column: str = "id", seed: int = SEED, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``split``. Sizes per class are exact; members are chosen by a seeded hash of the id.

    ``df`` is read several times, so pass a stored corpus. A class that holds most rows is
    not gathered: only the hash buckets at the two cut ranks are sorted.
    """
    cuts = split_sizes(df, label).select(label, F.col("test").alias("cut0"), (F.col("test") + F.col("val")).alias("cut1"))
    keyed = df.withColumn("_key", hash_key([id_column], seed))
    return split_by_rank(keyed, label, "_key", cuts, ("test", "val", "train"), [id_column, *tie]).drop("_key")


# Statistics -------------------------------------------------------------------------------------


def source_label_crosstab(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("source")
        .agg(F.count_if(F.col("label") == 0).alias("real"), F.count_if(F.col("label") == 1).alias("fake"))
        .orderBy("source")
    )


def label_source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "source").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "label", "source")


def class_distribution(df: DataFrame) -> DataFrame:
    counts = df.groupBy("split", "label").agg(F.count("*").alias("rows"))
    whole = F.sum("rows").over(Window.partitionBy("split"))
    return counts.withColumn("percent", F.round(F.col("rows") / whole * 100, 1))


def describe_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and linear quartiles. The exact percentile keeps
    one counter per distinct value, which for text lengths is a bounded number."""
    quartiles = F.percentile(column, [0.25, 0.5, 0.75])
    return (
        df.groupBy(by)
        .agg(
            F.count(column).alias("count"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("std"),
            F.min(column).alias("min"),
            quartiles.alias("_q"),
            F.max(column).alias("max"),
        )
        .select(
            by, "count", "mean", "std", "min",
            F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max",
        )
    )


def length_histogram(df: DataFrame, column: str, by: str = "label") -> DataFrame:
    """Length histogram per class, lengths clipped at 500. The 50 equal bins of a class span
    its own smallest to largest clipped length; the last bin is closed. A single length
    falls in the middle bin."""
    clipped = df.select(by, F.least(F.char_length(text.or_empty(F.col(column))), F.lit(LENGTH_CLIP)).alias("len"))
    counts = clipped.groupBy(by, "len").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(by)
    low, high = F.min("len").over(whole), F.max("len").over(whole)
    position = F.floor((F.col("len") - low) * LENGTH_BINS / F.nullif(high - low, F.lit(0)))
    slot = F.coalesce(F.least(position, F.lit(LENGTH_BINS - 1)), F.lit(LENGTH_BINS // 2)).cast("int")
    return counts.withColumn("bin", slot).groupBy(by, "bin").agg(F.sum("n").alias("rows")).orderBy(by, "bin")


def corpus_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("examples"),
        (F.avg("label") * 100).alias("fake_rate_pct"),
        F.countDistinct("source").alias("n_sources"),
        F.avg(F.char_length("title")).alias("mean_title_chars"),
        F.avg(F.char_length(text.or_empty(F.col("body")))).alias("mean_body_chars"),
    )


def corpus_sources(df: DataFrame) -> DataFrame:
    return df.select("source").distinct().orderBy("source")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Each class is weighted with the share of the other one."""
    return df.agg(
        F.avg((F.col(label) == 1).cast("double")).alias("weight_real"),
        F.avg((F.col(label) == 0).cast("double")).alias("weight_fake"),
    )

"""Exact selections by the rank of a uniform hash, without sorting the whole table.

A uniform hash falls into 65,536 prefix buckets of equal expected size. Counting them
places every rank in one bucket, so only that bucket's rows ever need ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4


def hash_key(columns: Sequence[str], salt: int | str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(salt))))


def bottom_k(df: DataFrame, key: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the smallest hash ``key``.

    Rows beyond the bucket that holds rank ``k`` are filtered out in the scan, so the
    final ordered limit sees about k + n/65,536 rows however large the table is.
    """
    # a null key ranks before all others
    prefix = F.coalesce(F.substring(key, 1, PREFIX), F.lit(""))
    counts = df.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"))
    upto = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") >= k)
        .agg(F.min("prefix").alias("prefix"))
        .first()
    )
    if last is not None and last["prefix"] is not None:
        df = df.filter(prefix <= last["prefix"])
    return df.orderBy(key, *tie).limit(k)


def split_by_rank(df: DataFrame, group: str, key: str, cuts: DataFrame, names: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Add ``split``: rows of ``group`` ranked by hash ``key`` get ``names[0]`` up to rank
    ``cut0``, ``names[1]`` up to ``cut1``, and ``names[2]`` beyond.

    ``cuts`` has one row per group with ``cut0`` <= ``cut1``: few groups, whose cuts go to all tasks, so
    that whole rows stay where they are but for the buckets at the cuts. ``df`` is read three times.
    """
    rows = df.withColumn("_prefix", F.substring(key, 1, PREFIX))
    counts = rows.groupBy(group, "_prefix").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(cuts, group)
    inside = lambda cut: (F.col("_before") < F.col(cut)) & (F.col(cut) <= F.col("_before") + F.col("_n"))
    edges = placed.groupBy(group).agg(
        *[F.first(cut).alias(cut) for cut in ("cut0", "cut1")],
        *[F.coalesce(F.max(F.when(inside(c), F.col("_prefix"))), F.lit("")).alias(f"_edge{i}") for i, c in enumerate(("cut0", "cut1"))],
        *[F.max(F.when(inside(c), F.col("_before"))).alias(f"_base{i}") for i, c in enumerate(("cut0", "cut1"))],
    )
    known = rows.join(F.broadcast(edges), group)
    on_edge = (F.col("_prefix") == F.col("_edge0")) | (F.col("_prefix") == F.col("_edge1"))
    sure = known.filter(~on_edge).withColumn(
        "split",
        F.when(F.col("_prefix") < F.col("_edge0"), names[0])
        .when(F.col("_prefix") < F.col("_edge1"), names[1])
        .otherwise(names[2]),
    )
    within = Window.partitionBy(group, "_prefix").orderBy(key, *tie)
    base = F.when(F.col("_prefix") == F.col("_edge0"), F.col("_base0")).otherwise(F.col("_base1"))
    ranked = known.filter(on_edge).withColumn("_rank", F.row_number().over(within) + base)
    edge = ranked.withColumn(
        "split",
        F.when(F.col("_rank") <= F.col("cut0"), names[0]).when(F.col("_rank") <= F.col("cut1"), names[1]).otherwise(names[2]),
    )
    columns = [*df.columns, "split"]
    return sure.select(columns).unionByName(edge.select(columns))

"""Ordered computations that never put a whole sequence into one task.

A sequence is first sorted across the cluster and numbered 1..n per key; then every
running or sliding quantity is computed inside blocks of a fixed number of
consecutive rows and corrected with what the earlier blocks carry in. A key that
holds a third of all rows is thus as parallel as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.plans.storage import materialise

BLOCK_ROWS = 100_000

_COMBINE = {
    "sum": lambda carried, local: F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0)),
    "max": lambda carried, local: F.greatest(carried, local),
    "min": lambda carried, local: F.least(carried, local),
}
_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key."""
    names = {c: f"_right_{i}" for i, c in enumerate(on)}
    renamed = right.withColumnsRenamed(names)
    match = F.lit(True)
    for c, other in names.items():
        match = match & F.col(c).eqNullSafe(F.col(other))
    return left.join(renamed, match, how).drop(*names.values())


def with_index(df: DataFrame, order: Sequence[str], key: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """Number the rows of each ``key`` 1..n in ``order`` (which must be total).

    One range-partitioned sort, written once; the numbering itself needs only the
    row counts per (sorted part, key), a table as small as the number of parts.
    """
    keys = list(key)
    ranked = df.orderBy(*keys, *order).withColumn("_pos", F.monotonically_increasing_id())
    stored = materialise(ranked, "sorted").withColumn("_part", F.shiftright("_pos", 33))
    sizes = stored.groupBy(*keys, "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return join_on(stored, offsets, [*keys, "_part"]).select(*df.columns, (F.col("_pos") + F.col("_shift")).alias(name))


def block_of(idx: Column, rows: int = BLOCK_ROWS) -> Column:
    return F.floor((idx - 1) / F.lit(rows))


def running(
    df: DataFrame,
    key: Sequence[str],
    aggs: dict[str, tuple],
    *,
    idx: str = "idx",
    sliding: dict[str, tuple[Column, int]] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add running and sliding columns to a numbered frame.

    ``aggs``: name -> (``sum``|``max``|``min``, column[, inclusive]) over rows 1..idx of the
    key, or 1..idx-1 when ``inclusive`` is False. ``sliding``: name -> (aggregate, rows) over
    the last ``rows`` rows. All windows share one shuffle by (key, block). ``df`` is read
    twice, so pass a stored or cheap frame.
    """
    keys, sliding = list(key), sliding or {}
    lookback = max([rows - 1 for _, rows in sliding.values()], default=0)
    staged = with_halo(df, lookback, idx=idx, block_rows=block_rows) if lookback else (
        df.withColumn("block", block_of(F.col(idx), block_rows)).withColumn("halo", F.lit(False))
    )
    spec = {name: (given[0], given[1], given[2] if len(given) > 2 else True) for name, given in aggs.items()}
    if spec:
        totals = df.groupBy(*keys, block_of(F.col(idx), block_rows).alias("block")).agg(
            *[_AGGREGATE[kind](column).alias(f"_tot_{name}") for name, (kind, column, _) in spec.items()]
        )
        earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("block")
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(
            *keys,
            "block",
            *[_AGGREGATE[kind](f"_tot_{name}").over(earlier).alias(f"_carry_{name}") for name, (kind, _, _) in spec.items()],
        )
        staged = join_on(staged, carried, [*keys, "block"], "left")
    rows = Window.partitionBy(*keys, "block").orderBy(idx)
    added = []
    for name, (kind, column, inclusive) in spec.items():
        frame = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
        local = _AGGREGATE[kind](F.when(~F.col("halo"), column)).over(frame)
        added.append(_COMBINE[kind](F.col(f"_carry_{name}"), local).alias(name))
    for name, (aggregate, size) in sliding.items():
        added.append(aggregate.over(rows.rowsBetween(1 - size, Window.currentRow)).alias(name))
    return staged.select(*df.columns, "halo", *added).filter(~F.col("halo")).drop("halo")


def with_halo(df: DataFrame, lookback: int, *, idx: str = "idx", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``block`` and ``halo``; each block also gets the ``lookback`` rows before it, marked halo.

    Windows over (key, block) may then look back ``lookback`` rows; drop halo rows afterwards.
    """
    if lookback > block_rows:
        raise ValueError("lookback must not exceed block_rows")
    home = block_of(F.col(idx), block_rows)
    near_end = F.pmod(F.col(idx) - 1, F.lit(block_rows)) >= block_rows - lookback
    blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        df.withColumn("_home", home)
        .withColumn("block", F.explode(blocks))
        .withColumn("halo", F.col("block") != F.col("_home"))
        .drop("_home")
    )


#: What the content of a row may add to its place, below the order.
_TIE = 1 << 60


def _place(df: DataFrame, order: Sequence[str], last: bool) -> Column:
    """Where a row stands: by ``order``, nulls behind all others, then by a hash of its values.

    One order of whole numbers or times makes a number, so the smallest place is found by
    hashing; other orders make a struct."""
    tie = F.pmod(F.xxhash64(*df.columns), F.lit(_TIE))
    kind = df.schema[order[0]].dataType
    if len(order) == 1 and isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        moment = F.col(order[0])
        if isinstance(kind, T.DateType):
            moment = F.unix_date(moment)
        elif not isinstance(kind, T.IntegralType):
            moment = F.unix_micros(moment.cast("timestamp"))
        moment = moment.cast("decimal(38,0)")
        known = (-moment if last else moment) * F.lit(_TIE).cast("decimal(19,0)")
        # beyond any number of 64 bits, so a null stands behind the others
        behind = F.lit(str((1 << 64) * _TIE)).cast("decimal(38,0)")
        return F.coalesce(known.cast("decimal(38,0)"), behind) + tie.cast("decimal(19,0)")
    known = [x for c in order for x in (F.col(c).isNotNull() if last else F.col(c).isNull(), F.col(c))]
    return F.struct(*known, -tie if last else tie)


def first_per_key(df: DataFrame, key: str, order: Sequence[str], last: bool = False) -> DataFrame:
    """Exactly one row of every key: the first in ``order``, or the last.

    A null in the order stands behind all other rows. Of rows at one place the one with the
    smallest hash of its values stays, of equal rows one. A null key is one key. The place is
    found with one narrow row per key and task before the shuffle; whole rows are only filtered by
    it, and equal ones are told apart where the filter has left them. Columns must be comparable:
    no maps.
    """
    names = {"key": F.coalesce(F.col(key).cast("string"), F.lit("")), "null": F.col(key).isNull(), "place": _place(df, order, last)}
    hidden = {n: f"_first_{n}" for n in names}
    placed = df.select("*", *[c.alias(hidden[n]) for n, c in names.items()])
    best = F.max if last and isinstance(placed.schema[hidden["place"]].dataType, T.StructType) else F.min
    first = placed.groupBy(hidden["key"], hidden["null"]).agg(best(hidden["place"]).alias(hidden["place"]))
    return placed.join(first, list(hidden.values()), "left_semi").dropDuplicates().select(*df.columns)

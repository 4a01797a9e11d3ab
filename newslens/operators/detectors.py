"""Change detection over stored score sequences.

``adwin_cuts``, ``kswin_blocks``, ``kswin_alarms`` and ``page_hinkley_first`` answer for whole
sequences of any length with every part of a sequence worked on in parallel. ``detect`` is the
monitor of all three detectors with resets; the window of ADWIN and the sums of Page-Hinkley
depend on everything before, so it walks each sequence for them, in bounded slices, all
sequences side by side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions import scores
from newslens.functions.sequential import (
    ADWIN_DELTA,
    KSWIN_ALPHA,
    KSWIN_RECENT,
    KSWIN_WINDOW,
    PH_DELTA,
    PH_FORGETTING,
    PH_MIN_ROWS,
    PH_THRESHOLD,
    DetectorState,
    Settings,
    kswin_changes,
    run_adwin,
    run_page_hinkley,
    spaced,
)
from newslens.plans.ordered import BLOCK_ROWS, block_of, join_on, running, with_halo, with_index
from newslens.plans.storage import materialise, scratch_path

ADWIN_BUCKET_ROWS = 50
SLICE_ROWS = 1_000_000
#: Blocks whose maps of states one task composes.
GROUP_BLOCKS = 256


def _scores(df: DataFrame, order: Sequence[str], key: Sequence[str], value: str) -> DataFrame:
    """Only what a detector needs: key, row number, sanitised score."""
    indexed = with_index(df.select(*key, *dict.fromkeys([*order, value])), order, key)
    return indexed.select(*key, "idx", scores.sanitise(F.col(value)).alias("x"))


def adwin_cuts(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    value: str = "p_fake",
    *,
    delta: float = ADWIN_DELTA,
    bucket_rows: int = ADWIN_BUCKET_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every cut between buckets of ``bucket_rows`` rows, with the difference of the means on
    either side and the bound it must exceed to be a change."""
    keys, c = list(key), F.col
    buckets = (
        _scores(df, order, keys, value)
        .groupBy(*keys, (block_of(c("idx"), bucket_rows) + 1).alias("bucket"))
        .agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(c("x") * c("x")).alias("q"))
    )
    buckets = materialise(buckets, "adwin-buckets")
    upto = running(buckets, keys, {"n0": ("sum", c("n")), "s0": ("sum", c("s"))}, idx="bucket", block_rows=block_rows)
    whole = buckets.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    upto = upto.drop("n", "s", "q")
    # Without a key, whole is a single row.
    one = F.lit(1).alias("_one")
    sides = join_on(upto.select("*", one), whole.select("*", one), [*keys, "_one"])
    n1 = c("n") - c("n0")
    harmonic = 1 / c("n0") + 1 / n1
    log_term = F.log(2 * F.log(c("n")) / F.lit(delta))
    variance = F.greatest(c("q") / c("n") - (c("s") / c("n")) * (c("s") / c("n")), F.lit(0.0))
    return (
        sides.filter(n1 > 0)
        .withColumn("gap", F.abs(c("s0") / c("n0") - (c("s") - c("s0")) / n1))
        .withColumn("bound", F.sqrt(2 * harmonic * variance * log_term) + F.lit(2.0) / 3 * harmonic * log_term)
        .select(*keys, c("n0").alias("cut"), "gap", "bound", (c("gap") > c("bound")).alias("changed"))
    )


def adwin_summary(cuts: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Per sequence: cuts tested, cuts that are changes, and the strongest of them."""
    excess = F.when(F.col("changed"), F.struct(F.col("gap") - F.col("bound"), -F.col("cut")))
    return cuts.groupBy(*key).agg(
        F.count("*").alias("cuts"), F.count_if("changed").alias("changes"), F.max_by("cut", excess).alias("strongest_cut")
    )


def kswin_blocks(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    value: str = "p_fake",
    *,
    alpha: float = KSWIN_ALPHA,
) -> DataFrame:
    """Per block of 100 rows, the Kolmogorov-Smirnov distance between its newest 33 rows and
    the 67 before, against the critical distance. An incomplete last block is not tested."""
    keys, c = list(key), F.col
    old = KSWIN_WINDOW - KSWIN_RECENT
    rows = _scores(df, order, keys, value).select(
        *keys, block_of(c("idx"), KSWIN_WINDOW).alias("window_index"), "x",
        (F.pmod(c("idx") - 1, F.lit(KSWIN_WINDOW)) >= old).cast("int").alias("recent"),
    )
    block = Window.partitionBy(*keys, "window_index")
    upto = block.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    recent_below = F.sum("recent").over(upto) / KSWIN_RECENT
    old_below = F.sum(1 - c("recent")).over(upto) / old
    critical = math.sqrt(-0.5 * math.log(alpha / 2)) * math.sqrt(KSWIN_WINDOW / (KSWIN_RECENT * old))
    return (
        rows.withColumn("d", F.abs(recent_below - old_below))
        .groupBy(*keys, "window_index")
        .agg(F.max("d").alias("distance"), F.count("*").alias("rows"))
        .filter(c("rows") == KSWIN_WINDOW)
        .select(*keys, "window_index", "distance", (c("distance") > critical).alias("changed"))
    )


def page_hinkley_series(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    value: str = "p_fake",
    *,
    delta: float = PH_DELTA,
    forgetting: float = PH_FORGETTING,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The Page-Hinkley statistic at every row, counted from the start of the sequence.

    The discounted sums are linear: inside a block they are a scaled prefix sum, and a block
    passes its end value on, discounted by its length. Blocks so far back that their
    weight is below 1e-40 cannot change a double and are not looked at.
    """
    keys, c = list(key), F.col
    block_rows = min(block_rows, int(600 / -math.log(forgetting))) if forgetting < 1 else block_rows
    indexed = _scores(df, order, keys, value)
    summed = running(indexed, keys, {"_sum": ("sum", c("x"))}, block_rows=block_rows)
    gaps = materialise(summed.select(*keys, "idx", (c("x") - c("_sum") / c("idx")).alias("gap")), "ph-gaps")
    place = F.pmod(c("idx") - 1, F.lit(block_rows))
    rows = gaps.withColumn("block", block_of(c("idx"), block_rows))
    if forgetting < 1:
        weight = F.pow(F.lit(forgetting), -place)
        reach = max(1, math.ceil(-math.log(1e-40) / (-math.log(forgetting) * block_rows)))
    else:
        weight, reach = F.lit(1.0), None
    parts = {"rise": c("gap") - delta, "fall": c("gap") + delta}
    ends = rows.groupBy(*keys, "block").agg(
        *[(F.sum(part * weight) * F.pow(F.lit(forgetting), F.lit(block_rows - 1))).alias(name) for name, part in parts.items()]
    )
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding if reach is None else -reach, -1)
    age = F.pow(F.lit(forgetting), F.lit(float(block_rows)))
    carried = ends.select(
        *keys,
        "block",
        *[
            # Oldest first: each step ages what came before by one block and adds the next.
            (F.aggregate(F.collect_list(name).over(earlier), F.lit(0.0), lambda acc, end: acc * age + end)
             if reach is not None else F.coalesce(F.sum(name).over(earlier), F.lit(0.0))).alias(f"_{name}")
            for name in parts
        ],
    )
    local = Window.partitionBy(*keys, "block").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decayed = {
        name: (F.sum(part * weight).over(local) / weight + c(f"_{name}") * F.pow(F.lit(forgetting), place + 1)).alias(name)
        for name, part in parts.items()
    }
    series = materialise(join_on(rows, carried, [*keys, "block"]).select(*keys, "idx", *decayed.values()), "ph-series")
    out = running(series, keys, {"low": ("min", c("rise")), "high": ("max", c("fall"))}, block_rows=block_rows)
    return out.withColumn("statistic", F.greatest(c("rise") - c("low"), c("high") - c("fall")))


def page_hinkley_first(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    value: str = "p_fake",
    *,
    threshold: float = PH_THRESHOLD,
    min_rows: int = PH_MIN_ROWS,
    **options,
) -> DataFrame:
    """Row number of the first alarm per sequence, null if there is none, and the peak."""
    series = page_hinkley_series(df, order, key, value, **options)
    alarm = (F.col("idx") >= min_rows) & (F.col("statistic") > threshold)
    return series.groupBy(*key).agg(
        F.min(F.when(alarm, F.col("idx"))).alias("first_alarm"),
        F.max("statistic").alias("peak"),
        F.count("*").alias("rows"),
    )


def kswin_tests(indexed: DataFrame, key: Sequence[str], settings: Settings, block_rows: int) -> DataFrame:
    """One row per block of ``block_rows`` rows: ``changes``, the rows whose window of 100 differs from
    its past, and ``exits``, what the block makes of a state.

    The state is how many rows must pass before the next alarm, 0 to 67, for an alarm empties the
    window but for 33 rows. ``exits[r]`` is the state after the block if it was entered in state r.
    """
    keys = list(key)
    most = KSWIN_WINDOW - KSWIN_RECENT
    kept = [indexed.schema[k] for k in keys]
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*kept, T.StructField("block", T.LongType()), T.StructField("changes", longs), T.StructField("exits", longs)])

    def test_block(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("idx")
        own = ~rows["halo"].to_numpy()
        tests = kswin_changes(rows["x"].to_numpy(), int(rows["idx"].iloc[-1]), settings.seed, settings.kswin_alpha)[own]
        changes, length = np.flatnonzero(tests), int(own.sum())
        ends = []
        for first in range(most + 1):
            alarms = spaced(changes, first)
            ends.append(max(0, (alarms[-1] + most if alarms else first) - length))
        start = int(rows["idx"].to_numpy()[own][0])
        return pd.DataFrame([{**{k: rows[k].iloc[0] for k in keys}, "block": int(group["block"].iloc[0]), "changes": changes + start, "exits": ends}])[
            [f.name for f in schema]
        ]

    staged = with_halo(indexed.select(*keys, "idx", "x"), KSWIN_WINDOW - 1, block_rows=block_rows)
    # a halo alone, behind the last row of a sequence, is no block
    own = join_on(staged, staged.filter(~F.col("halo")).select(*keys, "block").distinct(), [*keys, "block"], "left_semi")
    return own.groupBy(*keys, "block").applyInPandas(test_block, schema)


def entered_states(tests: DataFrame, key: Sequence[str], group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """Add ``entry``, the state in which each block of ``kswin_tests`` is entered.

    The blocks' maps are composed within groups of blocks, all groups in parallel, and the
    groups' maps along the key: one short array per group.
    """
    keys = list(key)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*tests.schema.fields, T.StructField("upto", longs), T.StructField("whole", longs)])

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("block")
        reached = np.arange(KSWIN_WINDOW - KSWIN_RECENT + 1)
        upto = []
        for ends in rows["exits"]:
            upto.append(reached)
            reached = np.asarray(ends)[reached]
        return rows.assign(upto=upto, whole=[reached] * len(rows))[[f.name for f in schema]]

    groups = tests.withColumn("group", F.floor(F.col("block") / group_blocks))
    placed = materialise(groups.groupBy(*keys, "group").applyInPandas(compose, schema), "kswin-states")
    placed = placed.withColumn("group", F.floor(F.col("block") / group_blocks))
    maps = placed.groupBy(*keys, "group").agg(F.first("whole").alias("whole"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    state = F.aggregate(F.collect_list("whole").over(earlier), F.lit(0).cast("long"), lambda at, ends: F.element_at(ends, (at + 1).cast("int")))
    entered = maps.select(*keys, "group", state.alias("_at"))
    return join_on(placed, entered, [*keys, "group"]).withColumn("entry", F.element_at("upto", (F.col("_at") + 1).cast("int")))


def kswin_rows(indexed: DataFrame, key: Sequence[str], settings: Settings, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """key and idx of the KSWIN alarms of a numbered frame (idx, x); see ``kswin_alarms``."""
    keys = list(key)
    schema = T.StructType([*[indexed.schema[k] for k in keys], T.StructField("idx", T.LongType())])
    placed = entered_states(materialise(kswin_tests(indexed, keys, settings, block_rows), "kswin-tests"), keys, group_blocks)

    def mark(batches):
        for batch in batches:
            for _, block in batch.iterrows():
                places = np.asarray(block["changes"], dtype=np.int64)
                alarms = spaced(places, block["block"] * block_rows + 1 + block["entry"])
                if alarms:
                    yield pd.DataFrame({**{k: [block[k]] * len(alarms) for k in keys}, "idx": alarms})

    return placed.select(*keys, "block", "changes", "entry").filter(F.size("changes") > 0).mapInPandas(mark, schema)


def kswin_alarms(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    value: str = "p_fake",
    *,
    settings: Settings = Settings(),
    block_rows: int = BLOCK_ROWS,
    group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """key and ``message_index`` of every alarm of the KSWIN detector, which forgets all but 33 rows
    after an alarm.

    No sequence is walked: every row's test needs 100 rows only, and what an alarm changes later on
    is a state of 68 values. Each block maps states at its start to states at its end; the maps are
    composed, then all blocks mark their alarms.
    """
    indexed = materialise(_scores(df, order, key, value), "kswin-rows")
    return kswin_rows(indexed, key, settings, block_rows, group_blocks).withColumnRenamed("idx", "message_index")


def detect(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str],
    value: str = "p_fake",
    *,
    settings: Settings = Settings(),
    slice_rows: int = SLICE_ROWS,
    keep_index: bool = False,
) -> DataFrame:
    """Add the votes ``adwin``, ``kswin``, ``page_hinkley`` of the sequential detectors.

    KSWIN is found for all blocks of all sequences in parallel (``kswin_alarms``). ADWIN and
    Page-Hinkley are walked in order, in slices of ``slice_rows`` rows: a task never holds more
    than one slice, whose rows are taken in stretches from alarm to alarm; the state of a few
    kilobytes per sequence is stored between slices, and all sequences advance side by side.
    Give ``key`` enough values to occupy the cluster; for one long sequence prefer the parallel
    forms above. Only key, order and score are sorted and stored; other columns are joined back by
    key and order. ``keep_index`` keeps the row number as ``message_index``, which ``drift_state``
    then need not work out again.
    """
    if not key:
        raise ValueError("give at least one key column; a constant column makes one sequence")
    keys, names = list(key), ("adwin", "kswin", "page_hinkley")
    needed = list(dict.fromkeys([*keys, *order, value]))
    wide = [c for c in df.columns if c not in needed]
    rows = with_index(df.select(*needed), order, keys).withColumn("x", scores.sanitise(F.col(value)))
    rows = materialise(rows, "detect-rows")
    indexed = rows.select(*keys, "idx", "x")
    slices = indexed.agg(F.max("idx").alias("rows")).first()["rows"] or 0
    kept = [indexed.schema[k] for k in keys]
    out_schema = T.StructType(
        [*kept, T.StructField("idx", T.LongType()), T.StructField("adwin", T.BooleanType()), T.StructField("page_hinkley", T.BooleanType())]
        + [T.StructField("state", T.StringType())]
    )
    # one folder per slice: a slice reads its own rows only, however many slices there are
    spark, parts, done = df.sparkSession, scratch_path(df.sparkSession, "detect-parts"), scratch_path(df.sparkSession, "detect-slices")
    indexed.withColumn("slice", F.floor((F.col("idx") - 1) / slice_rows)).write.partitionBy("slice").parquet(parts)

    def advance(group: pd.DataFrame) -> pd.DataFrame:
        carried = group["state"].dropna()
        state = DetectorState.loads(carried.iloc[0] if len(carried) else None)
        rows = group[group["x"].notna()].sort_values("idx")
        values = rows["x"].to_numpy()
        found = np.array([run_adwin(state, values, settings.adwin_delta), run_page_hinkley(state, values, settings)])
        state.rows += len(values)
        alarms = found.any(axis=0)
        out = pd.DataFrame({"idx": rows["idx"].to_numpy()[alarms], "adwin": found[0, alarms], "page_hinkley": found[1, alarms]})
        out["state"] = None
        last = pd.DataFrame([{"idx": -1, "adwin": False, "page_hinkley": False, "state": state.dumps()}])
        return pd.concat([out, last], ignore_index=True).assign(**{k: group[k].iloc[0] for k in keys})[[f.name for f in out_schema]]

    for number in range(math.ceil(slices / slice_rows)):
        piece = spark.read.schema(indexed.schema).parquet(f"{parts}/slice={number}").withColumn("state", F.lit(None).cast("string"))
        if number:
            # Only sequences that go on need their state.
            states = spark.read.schema(out_schema).parquet(f"{done}/slice={number - 1}").filter("idx = -1")
            states = states.select(*keys, "idx", F.lit(None).cast("double").alias("x"), "state")
            piece = piece.unionByName(join_on(states, piece.select(*keys).distinct(), keys, "left_semi"))
        piece.groupBy(*keys).applyInPandas(advance, out_schema).write.parquet(f"{done}/slice={number}")
    if not slices:
        flagged = rows.select("*", *[F.lit(False).alias(c) for c in names])
    else:
        walked = spark.read.schema(out_schema).parquet(f"{done}/slice=*").filter("idx > 0")
        alarmed = kswin_rows(indexed, keys, settings).withColumn("kswin", F.lit(True))
        flagged = join_on(join_on(rows, walked.drop("state"), [*keys, "idx"], "left"), alarmed, [*keys, "idx"], "left")
    index = [F.col("idx").alias("message_index")] if keep_index else []
    flagged = flagged.select(*needed, *index, *[F.coalesce(c, F.lit(False)).alias(c) for c in names])
    added = [c for c in flagged.columns if c not in needed]
    if wide:
        place = list(dict.fromkeys([*keys, *order]))
        flagged = join_on(flagged, df.select(*place, *wide), place)
    return flagged.select(*df.columns, *added)

"""Delimited files whose quoted fields hold line breaks, read in parts.

A file is read as physical lines in splits. A line is a map: it says whether its end lies inside
quotes if its start lies outside, and if it lies inside. These maps are composed over the lines of
each split, all splits in parallel, and over the splits of a file, a row each. So every line knows
whether it begins a record, and which: its number in the file, the same for any size of splits.
Only records of several lines are gathered; all others stay where they were read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE = ("_file", "_record")


def _open_after(line: Column, sep: str) -> Column:
    """Whether a quoted field is open at the end of a line that starts outside of quotes."""
    s = re.escape(sep)
    whole = rf'(^|{s})"[^"]*+(?:""[^"]*+)*+"(?!")'
    # a quote inside a field without quotes is an ordinary letter
    return F.regexp_replace(line, whole, "$1x").rlike(rf'(?:^|{s})"')


def line_maps(line: Column, sep: str) -> tuple[Column, Column]:
    """State at the end of a line (1: inside quotes) if it starts outside, and if it starts inside."""
    closed = F.regexp_replace(line, r'^[^"]*+(?:""[^"]*+)*+"(?!")', "x")
    still = ~line.rlike(r'^[^"]*+(?:""[^"]*+)*+"(?!")')
    return _open_after(line, sep).cast("int"), (still | _open_after(closed, sep)).cast("int")


def _states(entry: Column, before: Window) -> Column:
    """State before each row, of maps ``a`` and ``b``, given the state before the window's first row.

    Of maps between two states some forget where they started; what counts is the last of those
    and how many that swap the states have come since."""
    swaps = F.coalesce(F.sum(((F.col("a") == 1) & (F.col("b") == 0)).cast("int")).over(before), F.lit(0))
    last = F.last(F.when(F.col("a") == F.col("b"), F.struct(F.col("a").alias("value"), F.col("swaps_here").alias("swaps"))), ignorenulls=True).over(before)
    return F.when(last.isNotNull(), (last["value"] + swaps - last["swaps"]) % 2).otherwise((entry + swaps) % 2)


def numbered_records(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """_file, _record (from 1, in the order of the file) and text of every record.

    A record that is never closed takes the rest of its file, as in any reader of the format.
    Empty lines between records are none."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line")
    )
    a, b = line_maps(F.col("line"), sep)
    lines = lines.withColumns({"at": F.monotonically_increasing_id(), "a": a, "b": b})
    split = Window.partitionBy("_file", "split").orderBy("at")
    upto, before = split.rowsBetween(Window.unboundedPreceding, 0), split.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col("a") == 1) & (F.col("b") == 0)).cast("int")
    lines = lines.withColumn("swaps_here", F.sum(swap).over(upto))
    # what a split as a whole does to a state, and how many records begin in it for either
    maps = lines.select("*", *[_states(F.lit(entry), before).alias(f"s{entry}") for entry in (0, 1)])
    starts = [((F.col(f"s{entry}") == 0) & (F.trim("line") != "")).cast("long") for entry in (0, 1)]
    ends = [F.when(F.col(f"s{entry}") == 0, F.col("a")).otherwise(F.col("b")) for entry in (0, 1)]
    parts = maps.groupBy("_file", "split").agg(
        *[F.max_by(end, "at").alias(name) for end, name in zip(ends, ("a", "b"))], *[F.sum(start).alias(f"n{entry}") for entry, start in enumerate(starts)]
    )
    along = Window.partitionBy("_file").orderBy("split")
    parts = parts.withColumn("swaps_here", F.sum(swap).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("entry", _states(F.lit(0), earlier))
    parts = parts.withColumn("began", F.coalesce(F.sum(F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1"))).over(earlier), F.lit(0)))
    # one row per split: as many as the file has parts
    known = maps.join(parts.select("_file", "split", "entry", "began"), ["_file", "split"])
    inside = F.when(F.col("entry") == 0, F.col("s0")).otherwise(F.col("s1")) == 1
    known = known.withColumn("begins", ~inside & (F.trim("line") != "")).filter(F.col("begins") | inside)
    known = known.withColumn("_record", F.col("began") + F.sum(F.col("begins").cast("long")).over(upto))
    known = known.withColumn("alone", F.col("begins") & F.coalesce(F.lead("begins").over(split), F.lit(False)))
    whole = known.filter("alone").select(*PLACE, F.col("line").alias("text"))
    rest = known.filter("not alone").groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.struct("split", "at", "line"))).alias("lines"))
    joined = rest.select(*PLACE, F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))
    return whole.unionByName(joined).withColumn("text", F.regexp_replace("text", "\r\\z", ""))


def read_records(spark: SparkSession, paths: Sequence[str], schema: T.StructType, options: Mapping[str, str], *, sep: str, header: bool) -> DataFrame:
    """Fields of ``schema`` with file and record number, parsed as Spark's reader does."""
    records = numbered_records(spark, paths, sep)
    if header:
        records = records.filter("_record > 1")
    given = {**{k: str(v) for k, v in options.items()}, "sep": sep, "multiLine": "true"}
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    return records.select(*PLACE, F.from_csv("text", ddl, given).alias("fields")).select(*PLACE, "fields.*")

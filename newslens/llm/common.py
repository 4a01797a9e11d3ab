"""Shared by the operators: batched work on whole texts, hold-out folds, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

SLICE_CHARS = 1 << 20
SLICE_ROWS = 512


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores after it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
    return F.coalesce(rest == remainder, F.lit(False))


def slices(batch: pa.RecordBatch, text: int) -> Iterator[list[list]]:
    """The columns of ``batch`` as lists, a few rows at a time: at most ``SLICE_ROWS`` rows
    or, beyond one row, ``SLICE_CHARS`` bytes of column ``text``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > SLICE_CHARS or i - start >= SLICE_ROWS):
            yield [c.slice(start, i - start).to_pylist() for c in batch.columns]
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield [c.slice(start).to_pylist() for c in batch.columns]


def map_texts_with_end(df: DataFrame, columns: list[str], ddl: str, make: Callable[[], tuple[Callable[..., list[list]], Callable[[], list[list]]]]) -> DataFrame:
    """Rows computed in Python from ``columns`` of ``df``, the last of which is the text.

    ``make`` runs once per task and returns two functions: one turns lists of column values
    into lists of output columns (of ``ddl``), with fewer or more rows than it got; the other
    gives what is left after the task's last row. No lists mean no rows.
    """
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)

    def table(made: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(made, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, end = make()
        for batch in batches:
            for values in slices(batch, len(columns) - 1):
                if made := work(*values):
                    yield table(made)
        if made := end():
            yield table(made)

    return df.select(*columns).mapInArrow(run, schema)


def map_texts(df: DataFrame, columns: list[str], ddl: str, make: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """``map_texts_with_end`` for work that holds nothing back; ``make`` returns one function."""
    return map_texts_with_end(df, columns, ddl, lambda: (make(), lambda: []))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: tuple[int, int], limit: int) -> list[tuple[str, int]]:
    """At most ``limit`` pairs (text, label) outside the held-out fold, on the driver.

    The rows with the smallest hash of their id are taken, so the sample is the same on every
    run. The ids are chosen from the narrow table first: at most ``limit`` of them, which
    bounds the broadcast, meet the texts. Rows without id, label or 0/1 value are no use.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id", *fold))
        .select("doc_id", F.col(label).cast("int").alias("_label"))
        .groupBy("doc_id").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(limit).collect()
    )
    return [(r["text"], r["_label"]) for r in rows]

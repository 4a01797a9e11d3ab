"""Words of fields turned into blocks of postings by term, in Arrow batches, and back into sorted rows."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

#: Words of the fields whose postings one task sorts and writes, about.
PART = 1 << 21
#: One word of so many tells how terms are spread.
STEP = 1 << 14
#: Words that are inverted together; a longer text is by itself.
WORDS = 1 << 22
#: Postings that are sorted together where a part is larger than expected, and of one batch.
MERGED, ROWS = 1 << 23, 1 << 17
#: Between term and field; no word has it.
END = "\0"

BLOCKS = "part int, n int, size int, block binary"
POSTINGS = "id string, field string, term string, tf bigint, dl int"


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each value as a number, and the values that the numbers stand for."""
    coded = pc.dictionary_encode(values)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _ranks(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of values, and the place of each in it."""
    order = pc.sort_indices(values).to_numpy().astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return order, place


def _combined(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _small(values: np.ndarray) -> np.ndarray:
    """Numbers from zero on, in as few bytes as hold the largest."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _strings(values: pa.Array) -> list[np.ndarray]:
    """Lengths, one more than they are, or zero for null, and bytes."""
    sizes = pc.fill_null(pc.binary_length(values), -1).to_numpy() + 1
    return [_small(sizes), np.frombuffer("".join(v or "" for v in values.to_pylist()).encode(), np.uint8)]


def _of_strings(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(np.maximum(sizes.astype(np.int64) - 1, 0)))
    values = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]).cast(pa.string())
    return pc.if_else(pa.array(sizes > 0), values, None) if (sizes == 0).any() else values


def _packed(columns: list[np.ndarray]) -> tuple[int, bytes]:
    head = np.array([[c.dtype.itemsize, c.nbytes] for c in columns], "<i8")
    raw = b"".join([head.tobytes(), *[np.ascontiguousarray(c).tobytes() for c in columns]])
    return len(raw), pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(size: int, block: bytes, columns: int) -> list[np.ndarray]:
    raw = pa.Codec("zstd", 1).decompress(block, size, asbytes=True)
    found, at = [], columns * 16
    for width, length in np.frombuffer(raw, "<i8", columns * 2).reshape(-1, 2).tolist():
        found.append(np.frombuffer(raw, f"<u{width}", length // width, at))
        at += length
    return found


def bounds(fields: DataFrame) -> list[tuple[str, str]]:
    """Last (term and field, id) of all parts but one, into which the postings of ``fields`` fall evenly.

    They follow from one word of STEP, told by the lengths of the fields, so that few texts are
    looked into. All postings are dealt, whatever the bounds are.
    """
    schema = _parse_datatype_string("unit string, id string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = int(np.random.default_rng(TaskContext.get().partitionId()).integers(STEP))
        for batch in batches:
            ids, names, dl, words = batch.columns
            ends = np.cumsum(dl.to_numpy(), dtype=np.int64)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(ahead, total, STEP)
            ahead += len(at) * STEP - total
            rows = np.searchsorted(ends, at, "right")
            found = [words[r].as_py().split(" ")[p - ends[r]] + END + names[r].as_py() for r, p in zip(rows.tolist(), at.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pc.fill_null(ids.take(pa.array(rows)), "")], schema=arrow)

    found = fields.select(F.col("id").cast("string"), "field", "dl", "words").mapInArrow(run, schema)
    found = sorted((r["unit"], r["id"]) for r in found.collect())  # a row for STEP words
    parts = max(1, len(found) * STEP // PART)
    return sorted({found[i * len(found) // parts] for i in range(1, parts)})


def _invert(ids: pa.Array, names: pa.Array, lengths: np.ndarray, words: pa.Array, cuts: list[tuple[str, str]]) -> Iterator[tuple]:
    lists = pc.split_pattern(words, " ")
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    (term, terms), (name, fields) = _codes(_combined(lists.flatten())), _codes(names)
    (by_term, term_place), (by_field, field_place) = _ranks(terms), _ranks(fields)
    known = pc.fill_null(ids, "")
    by_id, id_place = _ranks(known)
    # one number for term, field and id: sorted, its runs are the postings by term
    unit = term_place[term] * len(fields) + field_place[name][owner]
    key, tf = np.unique(unit * len(lists) + id_place[owner], return_counts=True)
    unit, place = key // len(lists), key % len(lists)
    new = np.flatnonzero(np.diff(unit, prepend=-1))
    of = unit[new]
    units = pc.binary_join_element_wise(terms.take(pa.array(by_term[of // len(fields)])), fields.take(pa.array(by_field[of % len(fields)])), END)
    texts, in_order, starts = units.to_pylist(), known.take(pa.array(by_id)).to_pylist() if cuts else [], np.append(new, len(key))
    at = [0]
    for last, last_id in cuts:
        u = bisect_left(texts, last)
        cut = starts[u]
        if u < len(texts) and texts[u] == last:
            cut += np.searchsorted(place[cut : starts[u + 1]], bisect_right(in_order, last_id))
        at.append(int(cut))
    for part, (start, end) in enumerate(pairwise([*at, len(key)])):
        if start == end:
            continue
        first, after = np.searchsorted(new, start, "right") - 1, np.searchsorted(new, end)
        edges = np.append(np.maximum(new[first:after], start), end) - start
        rows, row = np.unique(place[start:end], return_inverse=True)
        step = np.diff(row, prepend=0)
        step[edges[:-1]] = row[edges[:-1]]  # ids of a unit are in order, so steps are small
        rows = by_id[rows]
        columns = [*_strings(units[first:after]), _small(np.diff(edges)), *_strings(ids.take(pa.array(rows))), _small(lengths[rows]), _small(step), _small(tf[start:end])]
        yield part, end - start, *_packed(columns)


def inverted(fields: DataFrame, cuts: list[tuple[str, str]] | None = None) -> DataFrame:
    """BLOCKS of fields (id, field, dl, words joined by a space): the postings of a batch that fall in a part, which ends
    at one of ``cuts``, packed: each term and field, each id and ``dl`` once. The number of parts is noted on the column."""
    schema = _parse_datatype_string(BLOCKS)
    arrow, cuts = to_arrow_schema(schema), cuts or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            part = np.cumsum(lengths, dtype=np.int64) // WORDS
            slices = [0, *np.flatnonzero(np.diff(part)) + 1, batch.num_rows] if batch.num_rows else [0]
            for start, end in pairwise(slices):
                ids, names, _, words = (c.slice(start, end - start) for c in batch.columns)
                made = zip(*_invert(ids, names, lengths[start:end], words, cuts))
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(made, arrow, strict=True)], schema=arrow)

    made = fields.select(F.col("id").cast("string"), "field", "dl", "words").mapInArrow(run, schema)
    return made.withColumn("part", F.col("part").alias("part", metadata={"parts": len(cuts) + 1}))


def _sorted(blocks: list[tuple[int, bytes]]) -> Iterator[list[pa.Array]]:
    """Columns of POSTINGS of blocks, by term, field and id."""
    units, counts, ids, lengths, rows, tfs, held = [], [], [], [], [], [], 0
    for size, block in blocks:
        unit_sizes, unit_bytes, count, id_sizes, id_bytes, dl, step, tf = _unpacked(size, block, 8)
        count, total = count.astype(np.int64), np.cumsum(step, dtype=np.int64)
        start = np.cumsum(count) - count
        rows.append(total - np.repeat(total[start] - step[start], count) + held)
        held += len(dl)
        for kept, value in ((units, _of_strings(unit_sizes, unit_bytes)), (counts, count), (ids, _of_strings(id_sizes, id_bytes)), (lengths, dl.astype(np.int32)), (tfs, tf.astype(np.int64))):
            kept.append(value)
    unit, names = _codes(pa.concat_arrays(units))
    ids, lengths, row, tf = pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(rows), np.concatenate(tfs)
    unit = np.repeat(_ranks(names)[1][unit], np.concatenate(counts))
    order = np.argsort(unit * held + _ranks(pc.fill_null(ids, ""))[1][row], kind="stable")
    both = pc.split_pattern(names.take(pc.sort_indices(names)), END).flatten()
    terms, fields = both.take(pa.array(np.arange(0, len(both), 2))), both.take(pa.array(np.arange(1, len(both), 2)))
    for at in range(0, len(order), ROWS):
        now = order[at : at + ROWS]
        of, r = pa.array(unit[now]), row[now]
        yield [ids.take(pa.array(r)), fields.take(of), terms.take(of), pa.array(tf[now]), pa.array(lengths[r])]


def postings(blocks: DataFrame) -> DataFrame:
    """POSTINGS of BLOCKS, each part by term, field and id; a part's blocks have to follow on each other."""
    schema = _parse_datatype_string(POSTINGS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batched() -> Iterator[pa.RecordBatch]:
            for columns in _sorted(held):
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        held, of, rows = [], None, 0
        for batch in batches:
            for part, n, size, block in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (part != of or rows + n > MERGED):
                    yield from batched()
                    held, rows = [], 0
                held.append((size, block))
                of, rows = part, rows + n
        if held:
            yield from batched()

    return blocks.select("part", "n", "size", "block").mapInArrow(run, schema)

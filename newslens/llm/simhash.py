"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into segments of 21, 21 and 22 bits, read as words of 23
bits. The binary Golay code [23,12] is perfect: each word lies within 3 bits of exactly one
codeword. A word at distance 3 has five more codewords at distance 4, a nearer word none;
the 12-bit indices of these 1 or 6 codewords are its keys. Two words that differ in at most
two bits share a key; if they differ in at most one, the nearest codeword of either is a key
of the other.

Four differing bits over three segments leave one of two cases. Either a segment is equal
and another differs in at most two bits: the key is the equal segment with a codeword index
of the other. Or no segment is equal, two differ in just one bit and the third in at most two:
the key is a codeword index of each, on the left side the nearest of the first only, on the
right side of the second. Candidates that meet under a key are checked by their differing bits;
on random fingerprints they are few, for such a key has 36 bits.

Fingerprints that share a one-bit neighbour, which are linked for certain, are merged first:
such a group has at most 65 members and yields links to its smallest only. Later links are
looked for between merged classes, so that a cloud of near copies is not paired out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import map_texts
from newslens.llm.components import components
from newslens.plans.storage import materialise

WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b110001110101
#: Rounds in which certain links merge fingerprints before other links are looked for.
MERGE_ROUNDS = 2
#: Rows that a task makes of its fingerprints, the keys a fingerprint has at most, and the fingerprints around one.
TASK_ROWS, KEYS, AROUND = 2_000_000, 144, 65
#: Parts into which a class is dealt when it meets its smallest id.
SALTS = 64
SEGMENTS = ((0, 21), (21, 21), (42, 22))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of the word shingles, repeats included; zero without words."""
    found = (text or "").encode("utf-8").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    take = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [take(joined, seed)]
    else:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        hashes = [take(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=False)]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256) @ BITS
    return int(np.packbits((2 * counts > len(hashes)).ravel(), bitorder="little").view("<i8")[0])


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    rest = np.array(words, np.int64)
    for shift in range(11, -1, -1):
        rest = np.where(rest >> (shift + 11) & 1, rest ^ (GENERATOR << shift), rest)
    return rest


def error_table() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the error patterns of at most 4 bits, lightest first, and their number (1 or 6)."""
    one = 1 << np.arange(23)
    patterns = np.array([0])
    every = [patterns]
    for _ in range(4):
        patterns = np.unique((patterns[:, None] | one)[(patterns[:, None] & one) == 0])
        every.append(patterns)
    patterns = np.concatenate(every)
    found = syndrome(patterns)
    order = np.argsort(found, kind="stable")
    counts = np.bincount(found, minlength=2048)
    table = np.zeros((2048, 6), np.int64)
    place = np.arange(len(patterns)) - np.repeat(np.cumsum(counts) - counts, counts)
    table[found[order], place] = patterns[order]
    return table, counts


def codeword_indices(words: np.ndarray, table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords near each word, the nearest first, and which of the six places are in use."""
    found = syndrome(words)
    near = (words[:, None] ^ table[found]) >> 11
    return near, np.arange(6) < counts[found][:, None]


def keys(fingerprints: np.ndarray, left: bool, table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints, with the number of the fingerprint each belongs to."""
    parts = [((fingerprints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [codeword_indices(p, table, counts) for p in parts]
    number = np.arange(len(fingerprints))
    made, owner = [], []
    for kind, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        codes, used = near[j]
        made.append(((kind << 40) | (parts[i][:, None] << 12) | codes)[used])
        owner.append(np.broadcast_to(number[:, None], used.shape)[used])
    for kind, (i, j, k) in enumerate(((0, 1, 2), (0, 2, 1), (1, 2, 0)), start=6):
        (a, used_a), (b, used_b), (c, used_c) = near[i], near[j], near[k]
        # the nearest codeword of the first on the left, of the second on the right
        if left:
            a, used_a = a[:, :1], used_a[:, :1]
        else:
            b, used_b = b[:, :1], used_b[:, :1]
        used = used_a[:, :, None, None] & used_b[:, None, :, None] & used_c[:, None, None, :]
        made.append(((kind << 40) | (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :])[used])
        owner.append(np.broadcast_to(number[:, None, None, None], used.shape)[used])
    return np.concatenate(made), np.concatenate(owner)


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint as a signed 64-bit number, one row per row of ``df``."""
    kind = df.schema[doc_id].dataType.simpleString()
    return map_texts(df, [doc_id, text], f"doc_id {kind}, fp bigint", lambda: lambda ids, texts: [ids, [fingerprint(t, words) for t in texts]])


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def spread(df: DataFrame, rows: int, by: int) -> DataFrame:
    """``df``, at most ``rows`` rows, dealt by fingerprint to as many tasks as it takes after each row has become ``by``."""
    return df.repartition(max(1, -(-rows * by // TASK_ROWS)), "fp")


def keyed(classes: DataFrame, left: bool) -> DataFrame:
    """key, fp, class of every key of every fingerprint."""

    def run(batches):
        table, counts = error_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                fp, label = (part.column(i).to_numpy() for i in range(2))
                key, owner = keys(fp.view(np.uint64), left, table, counts)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[owner]), pa.array(label[owner])], ["key", "fp", "class"])

    return classes.select("fp", "class").mapInArrow(run, "key bigint, fp bigint, class bigint")


def certain_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints with a common one-bit neighbour.

    The fingerprints around one centre are at most 65, so the collected groups are small
    whatever the data.
    """
    centres = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(bit if bit < 1 << 63 else bit - (1 << 64))) for bit in (1 << i for i in range(64))])
    groups = distinct.select("fp", F.explode(centres).alias("centre")).groupBy("centre").agg(F.collect_list("fp").alias("near"))
    return (
        groups.filter(F.size("near") > 1).select(F.array_min("near").alias("b"), F.explode("near").alias("a"))
        .filter("a <> b").distinct()
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id, the smallest id reachable over links of at most
    ``max_bits`` (at most 4) differing bits.

    Null, empty and wordless texts have fingerprint zero and are linked like others. Rows with
    one id are separate members; a null id counts for the component only if it has no other.
    No rows give no rows. Intermediate tables go to the shared folder of the session.

    What has as many rows as ``df`` or keys is never sent to all: Spark sizes keys as it does the fingerprints
    that they are made of, up to KEYS times too low, and stored numbers by their packed bytes.
    """
    return grouped(df, doc_id, text, words, max_bits).drop("class")


def grouped(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``near_duplicates`` with class, the group's smallest fingerprint, which tells groups without an id apart."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys are made for at most 4 differing bits")
    marked = materialise(fingerprints(df, doc_id, text, words), "simhash")
    rows = marked.count()
    labels = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    if max_bits == 0:
        return marked.hint("merge").join(labels, "fp").select("doc_id", "fp", F.col("first").alias("component_id"), F.col("fp").alias("class"))
    labels = labels.withColumn("class", F.col("fp"))
    links = None
    if max_bits >= 2:
        links = materialise(certain_links(spread(labels, rows, AROUND)), "simhash-certain")
        merged = components(links, MERGE_ROUNDS).withColumnRenamed("node", "fp")
        labels = labels.hint("merge").join(merged, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    labels = materialise(labels, "simhash-classes")
    dealt = spread(labels, rows, KEYS)
    left, right = keyed(dealt, True).alias("l"), keyed(dealt, False).alias("r")
    met = (F.col("l.key") == F.col("r.key")) & (F.col("l.class") < F.col("r.class")) & (differing(F.col("l.fp"), F.col("r.fp")) <= max_bits)
    found = left.hint("merge").join(right, met).select(F.col("r.class").alias("a"), F.col("l.class").alias("b"))
    if links is not None:
        classes = labels.select("fp", "class").filter("fp <> class")
        inside = classes.select(F.col("fp").alias("a"), F.col("class").alias("b"))
        found = found.unionByName(links).unionByName(inside)
    whole = components(materialise(found.distinct(), "simhash-links")).withColumnRenamed("node", "fp")
    labels = labels.hint("merge").join(whole, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    # a class may hold a large part of all fingerprints: its smallest id goes to parts of it
    salted = labels.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    smallest = salted.groupBy("class", "salt").agg(F.min("first").alias("first"))
    ids = smallest.groupBy("class").agg(F.min("first").alias("component_id"))
    of_part = smallest.select("class", "salt").hint("merge").join(ids, "class")
    named = salted.hint("merge").join(of_part, ["class", "salt"]).select("fp", "component_id", "class")
    return marked.hint("merge").join(named, "fp").select("doc_id", "fp", "component_id", "class")

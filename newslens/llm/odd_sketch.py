"""MinHash near-duplicates with odd sketches between the bands and the exact check.

A text's set are its distinct word shingles, hashed to 64 bits. ``SAMPLES`` MinHash values are
drawn from it. Bands of ``BAND_ROWS`` of them give the candidate keys: with 24 bands of 5, two
sets of similarity 0.85 miss each other with a probability of 8e-7. All samples are folded into
an odd sketch: sample i flips the bit that a hash of (i, value) names, so equal samples of two
sets cancel and the population count of the sketches' XOR grows with the samples that differ
only, by two at most for each. With d the largest number of differing samples that sets at the
threshold have but for a risk of 1e-6, a candidate whose count is over 2 d is dropped. What is
left is confirmed on the full sets.

Rows with one set are one node. Nodes under a key are not paired out: first each meets one
centre per key, which differs from key to key; what is linked is merged, and only nodes of
different components that still share a key meet after that. Star rounds go on as long as
they find many links and more than a few pairs a node are left. Sets whose shingles are too often
their own cannot be linked. If more than a few pairs a node are still left, each key is split at a
centre: two sets that share nothing outside it have no more in common than either has with it, which
rules out nearly all that are not linked with it; the others meet under the shingles that they
share outside it. What remains is compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import map_texts
from newslens.llm.components import components
from newslens.plans.storage import materialise

WORDS = 3
PERCENT = 85
SAMPLES = 240
BANDS, BAND_ROWS = 24, 5
SKETCH_BITS = 1024
RISK = 1e-6
STAR_ROUNDS = 3
#: Pairs for each node under a key that are looked at without another round of stars before.
FEW_PAIRS = 8
#: A round of stars of which not one pair in so many was a link is the last.
WORTH = 8
#: Rounds in which keys with more pairs than that are split at a centre.
SPLIT_ROUNDS = 3
#: Rounds in which links merge nodes before others are looked for.
MERGE_ROUNDS = 2
SEED = 11
#: Most bits of a broadcast bit table (16 MB), and bits for each wanted row.
MOST_SLOTS, SLOTS_A_ROW = 1 << 26, 16
#: Rows of a set that are multiplied at once.
CHUNK = 128
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of fewer words, of the whole sequence."""
    found = (text or "").encode("utf-8").translate(LOWER).split()
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found))] if found else [], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    rows = len(found) - words + 1
    joined = np.zeros(rows, np.uint64)
    for i in range(words):
        joined = mixed_bits(joined) + hashes[i : i + rows]
    joined = mixed_bits(joined)
    joined.sort()
    return joined[np.concatenate([[True], joined[1:] != joined[:-1]])]


def multipliers() -> np.ndarray:
    """Two odd numbers per sample: one orders the set, one places the sample's bit."""
    return np.random.default_rng(SEED).integers(1, 1 << 63, (2, SAMPLES), dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def minima(hashes: np.ndarray, factors: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
    """The MinHash samples of a set that is not empty. ``room`` is worked in, ``CHUNK`` rows at a time."""
    room = np.empty((CHUNK, len(factors)), np.uint64) if room is None else room
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK]
        made = np.multiply(part[:, None], factors, out=room[: len(part)])
        np.minimum(low, np.minimum.reduce(made, axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> list[int]:
    rows = np.ascontiguousarray(low[: BANDS * BAND_ROWS]).view(np.uint8).reshape(BANDS, -1)
    return [xxhash.xxh64_intdigest(row.tobytes(), seed=band) - (1 << 63) for band, row in enumerate(rows)]


def odd_sketch(low: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as signed words of 64 bits."""
    places = (low * factors) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    parity = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")


def estimate(differing_bits: float) -> float:
    """Similarity of two sets whose sketches differ in so many bits."""
    share = min(2 * differing_bits / SKETCH_BITS, 1 - 1e-9)
    return max(0.0, 1 - math.log(1 - share) / math.log(1 - 2 / SKETCH_BITS) / (2 * SAMPLES))


def most_bits(percent: int, risk: float = RISK) -> int:
    """Bits in which the sketches of sets of that similarity differ at most, but for ``risk``."""
    p, tail = 1 - percent / 100, 1.0
    for differ in range(SAMPLES + 1):
        tail -= math.comb(SAMPLES, differ) * p**differ * (1 - p) ** (SAMPLES - differ)
        if tail <= risk:
            return 2 * differ
    return 2 * SAMPLES


def signatures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row: rid (a number of its own), doc_id, at (hash of the text), d1 and d2 (128-bit
    digest of the set), n (its size), keys and sketch. Without words: n 0, no keys."""

    def make() -> Callable[..., list[list]]:
        (order, place), room = multipliers(), np.empty((CHUNK, SAMPLES), np.uint64)
        row = (TaskContext.get().partitionId() << 33) - 1

        def work(ids: list, at: list, texts: list) -> list[list]:
            nonlocal row
            out = []
            for key, where, body in zip(ids, at, texts, strict=True):
                row += 1
                hashes = shingles(body, words)
                if not len(hashes):
                    out.append((row, key, where, 0, 0, 0, [], []))
                    continue
                low, digest = minima(hashes, order, room), digest_of(hashes)
                out.append((row, key, where, *digest, len(hashes), band_keys(low), odd_sketch(low, place).tolist()))
            return list(map(list, zip(*out, strict=True)))

        return work

    kind = df.schema[doc_id].dataType.simpleString()
    narrow = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("at"), F.col(text).alias("text"))
    ddl = f"rid bigint, doc_id {kind}, at bigint, d1 bigint, d2 bigint, n bigint, keys array<bigint>, sketch array<bigint>"
    return map_texts(narrow, ["doc_id", "at", "text"], ddl, make)


def digest_of(hashes: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def likely(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``on`` may be in the stored table ``wanted``, found without a shuffle of ``df``.

    None that is there is lost; of the others one in ``SLOTS_A_ROW`` stays, and more where the
    table has its largest size. An exact join must follow."""
    slots = min(MOST_SLOTS, 1 << (SLOTS_A_ROW * wanted.count()).bit_length())
    slot, bit = F.pmod(F.xxhash64(*on), F.lit(slots)), F.expr("shiftleft(1L, cast(_slot & 63 as int))")
    words = wanted.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    met = df.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)).join(F.broadcast(words), "_word")
    return met.filter(F.col("_bits").bitwiseAND(bit) != 0).select(*df.columns)


def full_sets(df: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """node and set of the nodes in ``wanted`` (node, doc_id, at, d1, d2), from the texts.

    Texts are found by id and hash, so of a group of copies one row is shingled again; they are
    never shuffled."""
    narrow = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("at"), F.col(text).alias("text"))
    found = likely(narrow, wanted, ["doc_id", "at"])

    def work(texts: list) -> list[list]:
        sets = [shingles(t, words) for t in texts]
        pairs = [digest_of(s) for s in sets]
        return [[a for a, _ in pairs], [b for _, b in pairs], [s.view(np.int64) for s in sets]]

    again = map_texts(found, ["text"], "d1 bigint, d2 bigint, hashes array<bigint>", lambda: work)
    # one shuffle serves the join and what follows, for both have the digests as keys
    return again.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).dropDuplicates(["d1", "d2"]).select("node", "hashes")


def apart(a: Column, b: Column) -> Column:
    """Differing bits of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, bits: n + bits)


def _fetched(pairs: DataFrame, values: DataFrame, fields: list[str], salts: int) -> DataFrame:
    """The pairs (a, b) with ``fields`` of both nodes.

    A node may be in very many pairs, so what is fetched for b goes to salted keys: no more
    copies than pairs, and a number of salts that grows with the pairs.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(salts)))
    left = values.select(F.col("node").alias("a"), *[F.col(f).alias(f"{f}_a") for f in fields])
    right = values.select(F.col("node").alias("b"), *[F.col(f).alias(f"{f}_b") for f in fields])
    right = salted.select("b", "salt").distinct().join(right, "b")
    return salted.join(left, "a").join(right, ["b", "salt"]).drop("salt")


def near_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The stored pairs (a, b) whose sizes and sketches allow the similarity, with their differing bits."""
    both = _fetched(pairs, nodes.select("node", "n", "sketch"), ["n", "sketch"], 64 + pairs.count() // (1 << 18))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    bits = apart(F.col("sketch_a"), F.col("sketch_b"))
    return both.filter(fits).select("a", "b", bits.alias("bits")).filter(F.col("bits") <= most_bits(percent))


def wanted_sets(involved: DataFrame, nodes: DataFrame, df: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """node and hashes of the nodes in ``involved``."""
    wanted = materialise(nodes.join(involved, "node", "left_semi").select("node", "doc_id", "at", "d1", "d2"), "odd-wanted")
    return materialise(full_sets(df, wanted, doc_id, text, words), "odd-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links: the stored pairs (a, b) whose full sets have the similarity."""
    both = _fetched(pairs.select("a", "b"), sets, ["hashes"], 64 + pairs.count() // (1 << 18))
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    linked = both.filter(shared * 100 >= (F.size("hashes_a") + F.size("hashes_b") - shared) * percent)
    return materialise(linked.select("a", "b"), "odd-links")


def with_shared(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Add ``s``: how many shingles of a node's set any other set has. No two sets have more in common."""
    only = sets.select("node", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.min("node").alias("node"), F.count("*").alias("k"))
    alone = only.filter("k = 1").groupBy("node").agg(F.count("*").alias("alone"))
    return mixed.join(alone, "node", "left").select("key", "node", "n", "label", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def several_keys(mixed: DataFrame) -> DataFrame:
    """The keys that nodes of several components have."""
    return mixed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")


def of_several(mixed: DataFrame) -> DataFrame:
    """The rows under such keys."""
    return mixed.join(several_keys(mixed), "key", "left_semi")


def able_nodes(mixed: DataFrame, percent: int) -> DataFrame:
    """The rows of ``mixed`` (key, node, n, label, s) whose node can be linked under their key at all.

    Sets with m shingles in common have a union of n + n' - m, and m is at most s and s'. A node that
    cannot reach the similarity with the smallest set under a key does not meet it.
    """
    least = mixed.groupBy("key").agg(F.min("n").alias("least"))
    able = mixed.join(least, "key").filter(F.col("s") * 100 >= (F.col("n") + F.greatest("least", "s") - F.col("s")) * percent)
    return of_several(able.drop("least"))


def within_reach(left: str, right: str, percent: int) -> Column:
    """Whether the sizes and shared shingles of two sets allow the similarity."""
    common = F.least(F.col(f"{left}s"), F.col(f"{right}s"))
    return common * 100 >= (F.col(f"{left}n") + F.col(f"{right}n") - common) * percent


def unmerged_pairs(mixed: DataFrame, percent: int, ends: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of nodes with a common key and of different labels that can be linked; with
    ``ends``, those that have one of these rows at least."""
    unlike = F.col("l.label") < F.col("r.label") if ends is None else F.col("l.label") != F.col("r.label")
    met = (mixed if ends is None else ends).alias("l").join(mixed.alias("r"), (F.col("l.key") == F.col("r.key")) & unlike & within_reach("l.", "r.", percent))
    return materialise(met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct(), "odd-rest")


def relabelled(mixed: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``mixed`` with what the links have merged so far."""
    labels = components(links, MERGE_ROUNDS).withColumnRenamed("component", "label")
    others = [c for c in mixed.columns if c != "label"]
    return mixed.drop("label").join(labels, "node", "left").select(*others, F.coalesce("label", "node").alias("label"))


def pairs_left(mixed: DataFrame) -> tuple[int, int]:
    """How many pairs of different labels meet under the keys, and how many rows there are."""
    same = mixed.groupBy("key", "label").agg(F.count("*").alias("k")).groupBy("key").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("s"))
    return same.agg(F.coalesce(F.sum((F.col("k") * F.col("k") - F.col("s")) / 2), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()


def rarest_outside(led: DataFrame, both: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node, n, label, s) of ``led``'s nodes under a key for each centre and each of the
    rarest shingles outside it that they have.

    A node must share ``needed`` of these with any it is linked with; of two sets that share so
    many, the first but for ``needed`` - 1 of each have one in common, whatever the order is.
    """
    once = led.select("node", "b", "n", "label", "s").distinct()
    least = once.groupBy("b").agg(F.min("n").alias("least"))
    needed = F.ceil((F.col("n") + F.col("least")) * percent / F.lit(100 + percent) - 1e-6) - F.col("shared")
    kept = F.size("outside") - F.greatest(needed, F.lit(1)) + 1
    rows = once.join(both.withColumnRenamed("a", "node").select("node", "b", "shared", "outside"), ["node", "b"]).join(least, "b")
    rows = materialise(rows.select("node", "b", "n", "label", "s", kept.alias("kept"), F.explode("outside").alias("hash")), "odd-outside")
    counted = rows.join(rows.groupBy("b", "hash").agg(F.count("*").alias("k")), ["b", "hash"])
    place = F.row_number().over(Window.partitionBy("node", "b").orderBy("k", "hash"))
    first = counted.withColumn("place", place).filter("place <= kept and k > 1")
    return materialise(first.select(F.xxhash64("b", "hash").alias("key"), "node", "n", "label", "s"), "odd-rarest")


def split(mixed: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) with a centre of each key, the pairs (a, b) that may be linked without a common
    shingle outside it, and rows like those of ``mixed`` under a key for each centre and each
    shingle outside it. Any two nodes that are linked and met under a key are of one component by
    now, a pair, or meet under a new key.

    Without such a shingle two sets have no more in common than either has with the centre.
    """
    own = F.struct((F.col("n") - F.col("s")) / F.col("n"), "n", "node")
    led = mixed.join(mixed.groupBy("key").agg(F.min_by("node", own).alias("b")), "key").filter("node <> b")
    led = materialise(led, "odd-led")
    pairs = materialise(led.select(F.col("node").alias("a"), "b").distinct(), "odd-stars")
    both = _fetched(pairs, sets, ["hashes"], 64 + pairs.count() // (1 << 18))
    n_a, n_b, outside = F.size("hashes_a"), F.size("hashes_b"), F.array_except("hashes_a", "hashes_b")
    shared = n_a - F.size(outside)
    linked = (shared * 100 >= (n_a + n_b - shared) * percent).alias("linked")
    both = materialise(both.select("a", "b", shared.alias("shared"), linked, outside.alias("outside")), "odd-split")
    found = both.filter("linked").select("a", "b")
    led = materialise(of_several(relabelled(led, links.unionByName(found))), "odd-led")
    near = led.drop("s").join(both.select(F.col("a").alias("node"), "b", F.col("shared").alias("s"), "linked"), ["node", "b"])
    inside = materialise(able_nodes(near.select("key", "node", "n", "label", "s", "linked"), percent), "odd-inside")
    # two that are linked with the centre are of one component
    inside = unmerged_pairs(inside, percent, inside.filter("not linked"))
    return found, inside, materialise(able_nodes(of_several(rarest_outside(led, both, percent)), percent), "odd-mixed")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows are linked if their sets have at least ``percent`` % of their union in common;
    component_id is the smallest id reachable over links. Null, empty and wordless texts have no
    set and stand alone. Rows with one id are separate members. A null id counts for a component
    only if it has no other, and such a component's rows are all kept; else kept is whether the id
    is the component's. No rows give no rows. Very long texts are hashed in bounded pieces; other
    columns of ``df`` are not looked at. Links are the exact ones but for pairs that no band or
    sketch shows, at the threshold about one in a million. Intermediate tables go to the session's
    shared folder.
    """
    marked = materialise(signatures(df, doc_id, text, words), "odd-marked")
    classes = marked.filter("n > 0").groupBy("d1", "d2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("first"))
    classes = materialise(classes, "odd-classes")
    nodes = marked.join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    nodes = materialise(nodes, "odd-nodes")
    members = materialise(nodes.select(F.explode("keys").alias("key"), "node", "n"), "odd-members")
    # only keys with two nodes matter, and there only nodes of different components
    members = members.withColumn("label", F.col("node"))
    several = materialise(several_keys(members), "odd-several")
    mixed = materialise(likely(members, several, ["key"]).join(several, "key", "left_semi"), "odd-mixed")
    sets = wanted_sets(mixed.select("node").distinct(), nodes, df, doc_id, text, words)
    mixed = materialise(able_nodes(materialise(with_shared(mixed, sets), "odd-shared"), percent), "odd-able")
    links = None
    for number in range(STAR_ROUNDS):
        # the centre is the member with the least share of its own: others are near it, if near any
        own = (F.col("n") - F.col("s")) / F.col("n") + F.pmod(F.xxhash64("key", "node", F.lit(number)), F.lit(1000)) * (1e-9 if number == 0 else 1e-4)
        centres = mixed.groupBy("key").agg(F.min_by("node", own).alias("b"))
        owner = mixed.select("key", F.col("node").alias("b"), F.col("label").alias("_label"), F.col("n").alias("_n"), F.col("s").alias("_s"))
        stars = mixed.join(centres.join(owner, ["key", "b"]), "key").filter((F.col("label") != F.col("_label")) & within_reach("", "_", percent))
        pairs = materialise(stars.select(F.col("node").alias("a"), "b").distinct(), "odd-stars")
        # one link is enough to merge a node: that with the centre whose sketch is nearest
        nearest = materialise(near_pairs(pairs, nodes, percent).groupBy("a").agg(F.min_by("b", "bits").alias("b")), "odd-near")
        found = confirmed(nearest, sets, percent)
        links = found if links is None else materialise(links.unionByName(found), "odd-links")
        mixed = materialise(able_nodes(relabelled(mixed, links), percent), "odd-mixed")
        left, rows = pairs_left(mixed)
        if left <= FEW_PAIRS * rows or found.count() * WORTH < nearest.count():
            break
    rest = None
    for _ in range(SPLIT_ROUNDS):
        if left <= FEW_PAIRS * rows:
            break
        found, inside, mixed = split(mixed, links, sets, percent)
        links = materialise(links.unionByName(found), "odd-links")
        rest = inside if rest is None else rest.unionByName(inside)
        left, rows = pairs_left(mixed)
    if left:
        last = unmerged_pairs(mixed, percent)
        rest = last if rest is None else rest.unionByName(last)
    if rest is not None:
        near = materialise(near_pairs(materialise(rest.distinct(), "odd-rest"), nodes, percent), "odd-near")
        links = materialise(links.unionByName(confirmed(near, sets, percent)), "odd-links")
    named = classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(firsts, "component").select("d1", "d2", "component_id")
    alone = marked.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    grouped = marked.filter("n > 0").join(named, ["d1", "d2"]).select("doc_id", "n", "component_id").unionByName(alone)
    return grouped.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

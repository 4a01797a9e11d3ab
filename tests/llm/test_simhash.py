import random

import numpy as np
import pytest
import xxhash

from newslens.llm import components, simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), key), key)
    return sorted((key, prints[i], lowest[root(i)]) for i, (key, _) in enumerate(rows))


def test_golay_keys_meet_within_two_bits():
    table, counts = simhash.error_table()
    assert sorted(set(counts.tolist())) == [1, 6] and (counts == 6).sum() == 1771
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 3000)
    codes, used = simhash.codeword_indices(words, table, counts)
    for bits in (0, 1, 2):
        other = words.copy()
        for row in range(len(words)):
            for bit in draw.choice(23, bits, replace=False):
                other[row] ^= 1 << bit
        more, also = simhash.codeword_indices(other, table, counts)
        for a, u, b, v in zip(codes, used, more, also, strict=True):
            assert set(a[u]) & set(b[v])
            if bits < 2:
                assert a[0] in b[v] and b[0] in a[u]


@pytest.mark.parametrize("bits", range(5))
def test_fingerprints_share_a_key_within_four_bits(bits):
    table, counts = simhash.error_table()
    draw = random.Random(bits)
    fps = [draw.getrandbits(64) for _ in range(400)]
    others = [f ^ sum(1 << b for b in draw.sample(range(64), bits)) for f in fps]
    one, at = simhash.keys(np.array(fps, np.uint64), True, table, counts)
    two, to = simhash.keys(np.array(others, np.uint64), False, table, counts)
    for i in range(len(fps)):
        assert set(one[at == i]) & set(two[to == i])


def near_copies(seed=5):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 400)}" for _ in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "Ünï cödé\x0bA"), (7, "ünï cödé a")]
    for i in range(140):
        words = list(base) * (1 + i % 2)
        for _ in range(draw.choice([0, 1, 1, 2, 9])):
            words[draw.randrange(len(words))] = f"v{draw.randint(0, 99)}"
        rows.append((10 + i, " ".join(words)))
    return rows + [(500, rows[-1][1]), (500, "other text of this id altogether"), (8, "very long " * 20000)]


def test_components_equal_all_pairs(spark):
    rows = near_copies()
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, fp int").repartition(3)
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_planted_bits_link_exactly_within_four(spark):
    draw = random.Random(9)
    fps = []
    for _ in range(40):
        f = draw.getrandbits(64)
        for _ in range(6):
            fps.append(f)
            f ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3, 4, 5])))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    table = spark.createDataFrame(rows, "doc_id long, fp long")
    old, simhash.fingerprints = simhash.fingerprints, lambda *a: table
    try:
        got = dict((r.doc_id, r.component_id) for r in simhash.near_duplicates(table).collect())
    finally:
        simhash.fingerprints = old
    parent = list(range(len(fps)))
    for _ in range(len(fps)):
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    low = min(parent[i], parent[j])
                    if parent[i] != low or parent[j] != low:
                        parent[i] = parent[j] = low
                        break
    while True:
        before = list(parent)
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    parent[i] = parent[j] = min(parent[i], parent[j])
        if parent == before:
            break
    assert got == dict(enumerate(parent))


def test_components_of_a_long_path_and_of_nothing(spark):
    path = spark.createDataFrame([(i + 1, i) for i in range(100, 180)] + [(7, 7), (5, 3), (5, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(path).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, 5: 3, 3: 3}
    assert components.components(path.limit(0)).count() == 0


def test_few_false_candidates_among_random_fingerprints():
    """Pairs that meet under a key though they differ in more than four bits."""
    table, counts = simhash.error_table()
    draw = np.random.default_rng(7)
    prints = draw.integers(0, 1 << 64, 80_000, dtype=np.uint64)
    (left, a), (right, b) = (simhash.keys(prints, side, table, counts) for side in (True, False))
    order = np.argsort(right, kind="stable")
    right, b = right[order], b[order]
    first, last = np.searchsorted(right, left), np.searchsorted(right, left, "right")
    pairs = np.repeat(a, last - first), b[np.concatenate([np.arange(x, y) for x, y in zip(first[last > first], last[last > first])])]
    false = pairs[0] < pairs[1]
    bits = np.bitwise_count(prints[pairs[0][false]] ^ prints[pairs[1][false]])
    assert (bits > 4).sum() / len(prints) < 0.05
    assert len(left) / len(prints) <= simhash.KEYS and len(right) / len(prints) <= simhash.KEYS


def test_keys_and_rows_are_not_sent_to_all(spark, monkeypatch):
    """Spark takes what is made of few stored bytes for small, however many rows there are."""
    plans = {}
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module, name in ((simhash, "materialise"), (components, "stored")):
        put = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, at, put=put: plans.setdefault(at.split("/")[-1].split("-")[0] if "/" in at else at, plan_of(df)) and put(df, at))
    monkeypatch.setattr(components, "SENT_ROWS", -1, raising=False)
    rows = [(i, f"one two three four five six seven {i % 9} {i % 4}") for i in range(60)] + [(60, ""), (3, None)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    plans["rows"] = plan_of(found)
    assert {"simhash-links", "simhash-classes", "stars", "rows"} <= plans.keys()
    assert [k for k, plan in plans.items() if "Broadcast" in plan] == []
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found.collect()) == brute(rows)

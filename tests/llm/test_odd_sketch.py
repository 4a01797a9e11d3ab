import random
import re

import numpy as np
import pytest

from newslens.llm import odd_sketch


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            lowest[root(i)] = min(lowest.get(root(i), key), key)
    return [(key, len(sets[i]), lowest.get(root(i)), key == lowest.get(root(i))) for i, (key, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def corpus(draw, groups=25, near=8):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 5, 40, 120, 300]))
        texts.append(" ".join(base))
        for _ in range(draw.randrange(near)):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 1, 2, 4, 8])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def test_samples_and_sketch_estimate_the_similarity():
    order, place = odd_sketch.multipliers()
    draw = np.random.default_rng(3)
    for share in (0.7, 0.85, 0.95, 1.0):
        misses = []
        for _ in range(40):
            both = draw.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            own = [draw.integers(0, 1 << 63, int(500 * (1 - share)), dtype=np.uint64) for _ in range(2)]
            lows = [odd_sketch.minima(np.concatenate([both, o]), order) for o in own]
            a, b = (odd_sketch.odd_sketch(low, place).view(np.uint64) for low in lows)
            bits = sum(int(x ^ y).bit_count() for x, y in zip(a, b))
            true = len(both) / (len(both) + sum(map(len, own)))
            if true >= 0.85:
                assert bits <= odd_sketch.most_bits(85)
            misses.append(odd_sketch.estimate(bits) - true)
        assert abs(np.mean(misses)) < 0.02 and np.abs(misses).max() < 0.12


def test_shingles_are_those_of_the_words():
    for text in (None, "", " \t\n", "one", "A b", "a B c", "x y z x y z x y", "é È\x0bß\x0c a", "  a b c"):
        assert len(odd_sketch.shingles(text)) == len(plain_set(text))
    assert odd_sketch.shingles("The Cat  sat\n").tolist() == odd_sketch.shingles("the cat\tsat").tolist()


def test_equals_all_pairs(spark):
    draw = random.Random(5)
    rows = [(i, t) for i, t in enumerate(corpus(draw))]
    rows += [(900, None), (901, ""), (902, "  "), (903, rows[4][1].upper()), (7, rows[9][1]), (7, rows[9][1]), (None, rows[3][1]), (None, "alone without an id"), (904, "q " * 9000)]
    draw.shuffle(rows)
    df = spark.createDataFrame([(t, k, 1, "x") for k, t in rows], "text string, doc_id bigint, n long, keys string")
    found = [tuple(r) for r in odd_sketch.near_duplicates(df).collect()]
    want = [(k, n, c, k == c) for k, n, c, _ in brute(rows)]
    assert ordered(found) == ordered(want)


def test_a_large_group_of_near_copies(spark):
    """Near copies of one text that mostly link with each other only through others."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(draw.randrange(1, 9)):
            copy[draw.randrange(200)] = f"x{draw.randrange(5000)}"
        rows.append((i, " ".join(copy)))
    found = [tuple(r) for r in odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()]
    assert sorted(found) == sorted(brute(rows))


@pytest.mark.parametrize("with_base", [True, False])
def test_near_copies_that_are_not_linked_are_not_paired_out(spark, monkeypatch, with_base):
    """200 copies with six words replaced each: they share keys, but few are linked."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    copies = [list(base)] if with_base else []
    for _ in range(200):
        copy = list(base)
        for i in draw.sample(range(200), 6):
            copy[i] = f"x{i}-{draw.randrange(5)}"
        copies.append(copy)
    for at in draw.sample(range(1, 200), 40):
        copy = list(copies[at])
        copy[draw.randrange(200)] = "y"
        copies.append(copy)
    rows = [(i, " ".join(copy)) for i, copy in enumerate(copies)]
    looked = []
    whole = odd_sketch.near_pairs
    monkeypatch.setattr(odd_sketch, "near_pairs", lambda pairs, *rest: looked.append(pairs.count()) or whole(pairs, *rest))
    found = [tuple(r) for r in odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()]
    assert sorted(found) == sorted(brute(rows))
    assert len(looked) > 1 and max(looked) < 20 * len(rows)


def test_likely_rows_keep_all_that_are_wanted(spark):
    rows = spark.createDataFrame([(i if i % 50 else None, i % 7, str(i)) for i in range(20000)], "a long, b long, c string")
    wanted = odd_sketch.materialise(rows.filter("c like '%77'"), "wanted")
    kept = odd_sketch.likely(rows, wanted, ["a", "b"])
    assert kept.columns == rows.columns and wanted.exceptAll(kept).isEmpty()
    assert wanted.count() <= kept.count() < 0.12 * rows.count()
    assert odd_sketch.likely(rows, odd_sketch.materialise(rows.limit(0), "wanted"), ["a", "b"]).count() == 0


def test_texts_are_not_shuffled(spark):
    """Only the set of a text that is near another goes through a shuffle, not the texts."""
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    wanted = odd_sketch.materialise(odd_sketch.signatures(rows).filter("doc_id < 5").withColumnRenamed("rid", "node"), "wanted")
    found = odd_sketch.full_sets(rows, wanted, "doc_id", "text", 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 5 and not re.search(r"Exchange hashpartitioning\(doc_id", plan)


def test_no_rows(spark):
    assert odd_sketch.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []

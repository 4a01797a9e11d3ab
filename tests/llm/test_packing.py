import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newslens.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


def brute(positions, penalties, length):
    cost = [0]
    for j in range(1, len(positions)):
        cost.append(min(cost[i] + length - (positions[j] - positions[i]) + penalties[j] for i in range(j) if positions[j] - positions[i] <= length))
    return cost


@pytest.mark.parametrize("seed", range(20))
def test_cuts_have_the_least_cost(seed):
    draw = random.Random(seed)
    positions = np.cumsum([0, *[draw.randint(1, 9) for _ in range(60)]])
    penalties = np.array([0, *[draw.choice([0, 2, 6]) for _ in range(60)]])
    cost, back = packing.cuts(positions, penalties, 16)
    assert cost == brute(positions.tolist(), penalties.tolist(), 16)
    for j in range(1, 61):
        i = back[j]
        assert 0 < positions[j] - positions[i] <= 16 and cost[j] == cost[i] + 16 - (positions[j] - positions[i]) + penalties[j]


def test_pieces_hold_every_token_once(spark, vocabulary):
    library = Tokenizer.from_file(PATH)
    draw = random.Random(3)
    texts = [None, "", "one"] + [" ".join(draw.choice(["alpha", "be.", "gamma", "the", "x!"]) for _ in range(draw.choice([3, 40, 700, 5000]))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string").coalesce(2)
    rows = packing.pack(df, vocabulary, length=256).collect()
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(docs[i], key=lambda r: r.start)
        assert [x for r in parts for x in r.ids] == want
        assert all(r.doc_tokens == len(want) for r in parts) and [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in parts)
    padding = 0
    for pieces in windows.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces]])[:-1])
        total = sum(r.length for r in pieces)
        assert total <= 256 and [r.doc_id for r in pieces] == sorted(r.doc_id for r in pieces)
        padding += 0 if total & (total - 1) == 0 else 256 - total
    assert padding < 0.05 * sum(r.length for r in rows)


def test_edges(spark, vocabulary):
    df = spark.createDataFrame([(7, "same"), (7, "same"), (None, "x")], "doc_id long, text string")
    assert packing.pack(df, vocabulary).groupBy("doc_id").agg(F.sum("length")).count() == 2
    assert packing.pack(df.limit(0), vocabulary).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, vocabulary, length=100)


def test_cuts_are_at_sentence_ends_with_little_padding(vocabulary):
    draw = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta"]
    sentence = lambda: " ".join(draw.choices(words, k=draw.choice([4, 9, 15, 40]))) + "."
    texts = [" ".join(sentence() for _ in range(draw.choice([1, 3, 20, 60, 400]))) for _ in range(400)] + ["word " * 9000]
    shared = type("Shared", (), {"value": vocabulary})
    coder, ends = bpe.coder_of(shared), packing.sentence_ends(vocabulary)
    packer = packing.Packer(ends, 0, packing.LENGTH, packing.SENTENCE_PENALTY, packing.INNER_PENALTY, packing.GRID, True)
    flat, counts = coder.encode(texts)
    flat = np.insert(flat, np.cumsum(counts), packing.END_TOKEN)
    rows = [r for made in (packer.add(list(range(len(texts))), flat, counts + 1), packer.end()) for r in zip(*made)]
    assert sum(r[2] for r in rows) == len(flat)
    inner = [r for r in rows if r[1] + r[2] < r[4] and r[0] < 400]
    assert len(inner) > 50 and np.mean([ends[r[7][-1]] for r in inner]) > 0.95
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[5]] += r[2]
    padding = sum(packing.LENGTH - n for n in sizes.values() if n & (n - 1))
    assert padding / (padding + len(flat)) < 0.02

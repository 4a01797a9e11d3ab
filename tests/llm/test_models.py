import numpy as np
import pytest

from newslens.llm import quality_net, toxicity
from newslens.llm.common import labelled_sample
from newslens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held_out_rows(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return [(r.score, r.predicted, r[label]) for r in QUERIES[query](spark, SF).join(labels, "doc_id").filter("held_out").collect()]


def test_quality_on_held_out_labels(spark):
    rows = held_out_rows(spark, "op3_quality_net", "quality")
    right = [p == y for _, p, y in rows]
    assert len(rows) > 80 and np.mean(right) > 0.95 and all(0 <= s <= 1 and p == (s >= 0.5) for s, p, _ in rows)


def test_toxicity_on_held_out_labels(spark):
    rows = held_out_rows(spark, "op10_toxicity", "toxic")
    assert len(rows) > 60 and all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in rows)
    assert np.mean([p for _, p, y in rows if not y]) < 0.05
    assert np.mean([p for _, p, y in rows if y]) > 0.6


def test_sample_leaves_the_fold_out_and_is_bounded(spark):
    from zlib import crc32

    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(300)] + [(None, "no id", "x"), (3, "text 3", "x")], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", (3, 1), 1000)
    used = {int(t.split()[1]) for t, _ in rows}
    assert used == {i for i in range(300) if crc32(str(i).encode()) % 3 != 1} and all(int(t.split()[1]) % 2 == y for t, y in rows)
    some = labelled_sample(docs, labels, "quality", (3, 1), 20)
    assert len(some) == 20 and some == labelled_sample(docs.repartition(5), labels.repartition(3), "quality", (3, 1), 20)


def test_filters_cover_the_whole_text_and_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    net = quality_net.Network.fresh(rng)
    texts = ["", "a", "plain words " * 9000, "x" * 511, "é" * 700, "ab" * 40000 + "END", "ab" * 40000]
    whole = net.score(texts)
    assert whole[-1] != whole[-2] and ((0 <= whole) & (whole <= 1)).all()
    assert np.allclose([net.score([t])[0] for t in texts], whole, atol=1e-5)
    monkeypatch.setattr(quality_net, "BLOCK", 64 * 10)
    assert np.allclose(net.score(texts), whole, atol=1e-5)


def test_pooling_equals_the_plain_one():
    net = quality_net.Network.fresh(np.random.default_rng(4))
    texts = ["some text of words " * 80, "short", "word " * 300]
    octets, counts = quality_net.lay_out(texts)
    maps = (net.windows(octets) @ net.filters).reshape(-1, quality_net.PLACES, quality_net.FILTERS).max(axis=1)
    first, number, chunks = quality_net.chunk_starts(counts)
    at, plain = 0, []
    for n in counts.tolist():
        own, k = maps[at : at + n], 0
        while True:
            plain.append(own[k : k + 8].max(axis=0))
            k += 7
            if k >= n - 1:
                break
        at += n
    assert len(plain) == chunks.sum() and np.array_equal(net.chunk_maxima(maps, first, number), np.array(plain))


def test_gradients_equal_differences():
    net = quality_net.Network.fresh(np.random.default_rng(3))
    texts, labels, weights = ["some words here", "AAA!! BBB!! " * 50], np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = net.score(texts)
        return -np.mean(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p)))

    found = net.gradients(texts, labels, weights)
    for name, g in zip(("filters", "hidden", "out", "out_bias", "hidden_bias"), (found[1], found[3], found[5], found[6], found[4]), strict=True):
        value = getattr(net, name)
        place = np.unravel_index(np.abs(g).argmax(), g.shape)
        value[place] += 1e-3
        up = loss()
        value[place] -= 2e-3
        down = loss()
        value[place] += 1e-3
        assert g[place] == pytest.approx((up - down) / 2e-3, rel=0.1, abs=2e-4), name


def test_isotonic_is_the_nearest_rising_function():
    rng = np.random.default_rng(1)
    margin, y = rng.normal(size=60), (rng.random(60) < 0.5).astype(float)
    at, to = toxicity.isotonic(margin, y)
    assert (np.diff(at) > 0).all() and (np.diff(to) >= 0).all()
    order = np.argsort(margin)
    fitted = np.interp(margin[order], at, to)
    z = y[order]
    best = [max(min(z[i : j + 1].mean() for j in range(k, len(z))) for i in range(k + 1)) for k in range(len(z))]
    assert np.allclose(fitted, best)


def test_features_and_edges(spark):
    assert toxicity.features(None, {}) == toxicity.features("", {})
    named = dict(zip(toxicity.NAMES, toxicity.features("You are an IDIOT, a real 1d1ot!! soooo", {"real": 2.0}), strict=True))
    assert named["lexicon_hits"] == 1 and named["near_second"] == 2 and named["learned_best"] == 2 and named["disguised_hits"] == 1
    assert named["capital_words"] > 0 and named["stretched"] > 0 and named["exclamations"] > 0
    one = toxicity.fit([("a", 1)] * 20)
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "you idiot " * 30000, 9), (2, "", 9)], "doc_id long, text string, score int")
    assert {r.score for r in toxicity.score(df, one, ["doc_id"]).collect()} == {1.0}
    assert toxicity.score(df.limit(0), one, ["doc_id"]).count() == 0
    net = quality_net.fit([])
    assert quality_net.score(df, net, ["doc_id"]).count() == 4 and quality_net.score(df.limit(0), net, ["doc_id"]).count() == 0

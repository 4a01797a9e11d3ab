import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import ann


def brute(ids, x, q, k):
    scores = x @ x[ids.tolist().index(q)]
    order = np.lexsort((ids, -scores))
    return [(int(ids[i]), scores[i]) for i in order if ids[i] != q][:k]


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 1.0) for i, row in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, score double").repartition(3)


def test_estimates_hold_their_bounds():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(3000, 60)) + 0.3, rng.normal(size=(20, 60))
    index = ann.Index.fit(x[:500])
    middle, spread = index.estimates(q, *index.encode(x))
    true = q @ x.T
    assert (np.abs(true - middle) <= spread).mean() > 0.98
    assert np.corrcoef(true.ravel(), middle.ravel())[0, 1] > 0.78  # the signs keep a share of sqrt(2 / pi)
    assert np.allclose(index.rotation @ index.rotation.T, np.eye(64))


def test_recall_on_whole_tables(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROW_BLOCK", 300)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 20)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hit = total = 0
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    for q, found in got.items():
        want = brute(ids, x, q, 20)
        assert sorted(found) == list(range(1, 21))
        hit += len({v for v, _ in want} & {v for v, _ in found.values()})
        total += 20
        assert all(abs(s - x[ids == v][0] @ x[ids == q][0]) < 1e-12 for v, s in found.values())
    assert hit / total >= 0.95


def test_ties_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6)).astype(np.float32)
    x[:30] = x[0]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(100, None), (120, [0.0] * 6), (140, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (160, [float("nan")] * 6), (180, [float("inf")] * 6), (200, [1.0] * 4), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20}
    ids = np.arange(40)
    for q, found in got.items():
        want = brute(ids, x.astype(float), q, 20)
        assert [v for v, _ in found] == [v for v, _ in want] and np.allclose([s for _, s in found], [s for _, s in want])


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_candidates(spark, n):
    rng = np.random.default_rng(n)
    found = ann.nearest(frame(spark, range(n), rng.normal(size=(n, 3))), F.col("vec_id") == 0).collect()
    assert len(found) == max(0, n - 1)

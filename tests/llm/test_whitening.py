import math

import numpy as np
import pytest

from newslens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, component string, n int"


def brute(rows):
    """Whitened values by a library's eigenvectors, up to their signs."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = len(kept[0][1])
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept if len(v) == d], dtype=object)
    distinct = np.array(sorted(set(map(tuple, x.tolist()))), float)
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    away = distinct - distinct.mean(axis=0)
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    deviations = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviations, (x.astype(float) - distinct.mean(axis=0)) @ vectors / np.sqrt(values), values / np.trace(away.T @ away / n)


def vectors(n, d, seed=0):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) @ np.diag(np.linspace(0.05, 0.4, d))).astype(np.float32)


def test_equals_a_librarys_eigenvectors(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(400, 24))]
    rows += [(3, rows[8][1]), (None, rows[9][1]), (9, rows[9][1])]
    broken = [(900, None), (901, []), (902, [1.0] * 23 + [None]), (903, [math.nan] * 24), (904, [math.inf] + [0.0] * 23), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, 1, "c", 2) for k, v in rows + broken], SCHEMA).repartition(5)
    found = whitening.whiten(df).collect()
    n, deviations, whitened, explained = brute(rows)
    assert len(found) == 4 * len(rows)
    want = sorted((str(k), c + 1, int(dev)) for (k, _), dev in zip(rows, deviations) for c in range(4))
    assert sorted((str(r["vec_id"]), r["component"], int(r["deviation"])) for r in found) == want
    assert {r["n"] for r in found} == {n} and len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    once = {r["vec_id"]: r for r in found if r["component"] == 1}
    for c in range(4):
        mine = {(r["vec_id"], int(r["deviation"])): r["whitened"] for r in found if r["component"] == c + 1}
        got = np.array([mine[k, int(dev)] for (k, _), dev in zip(rows, deviations)])
        sign = np.sign(got @ whitened[:, c])
        assert np.abs(got * sign - whitened[:, c]).max() < 1e-9
        shares = {r["explained"] for r in found if r["component"] == c + 1}
        assert len(shares) == 1 and shares.pop() == pytest.approx(explained[c], rel=1e-9)
    assert once


@pytest.mark.parametrize("kind", ["random", "repeated", "diagonal", "one", "two", "graded", "blocks"])
def test_leading_components(kind):
    draw = np.random.default_rng(4)
    q = np.linalg.qr(draw.normal(size=(30, 30)))[0]
    matrix = {
        "random": lambda: (lambda a: a @ a.T)(draw.normal(size=(30, 40))),
        "repeated": lambda: q @ np.diag([5.0] * 3 + [2.0] * 10 + [1.0] * 17) @ q.T,
        "diagonal": lambda: np.diag(np.arange(30.0)),
        "one": lambda: np.array([[3.0]]),
        "two": lambda: np.array([[2.0, 1.0], [1.0, 2.0]]),
        "graded": lambda: q @ np.diag(10.0 ** -np.arange(30)) @ q.T,
        "blocks": lambda: np.kron(np.eye(5), (lambda a: a @ a.T)(draw.normal(size=(6, 6)))),
    }[kind]()
    values, found = whitening.leading_components(matrix, 4)
    size = np.abs(matrix).max()
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:4]).max() < 1e-13 * size * len(matrix)
    assert np.abs(found @ matrix - values[:, None] * found).max() < 1e-13 * size * len(matrix)
    assert np.abs(found @ found.T - np.eye(len(found))).max() < 1e-13


def test_sturm_counts_are_those_of_the_eigenvalues():
    draw = np.random.default_rng(9)
    diagonal, off = draw.normal(size=12), draw.normal(size=11)
    off[4] = 0
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = draw.uniform(-4, 4, 200)
    assert whitening.sturm_counts(diagonal, off, at).tolist() == [(values < a).sum() for a in at]


def test_few_rows_and_dimensions(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert make([]) == [] and make([(1, None)]) == []
    alone = make([(1, [0.5, 0.25, 1.0]), (2, [0.5, 0.25, 1.0])])
    assert [(r["vec_id"], r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in sorted(alone)] == [
        (k, c, 1, 0, None, 0.0) for k in (1, 2) for c in (1, 2, 3)
    ]
    line = make([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [-0.0, 0.0])])
    assert {r["n"] for r in line} == {2} and {r["whitened"] is None for r in line if r["component"] == 2} == {True}
    assert sorted(round(abs(r["whitened"]), 9) for r in line if r["component"] == 1) == [1.0, 1.0, 1.0]


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e12 * (i + 1), 1e12 * i * i]) for i in range(5)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((5 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == want

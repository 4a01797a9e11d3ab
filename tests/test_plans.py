"""Distributed running windows and hash selections against plain pandas."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newslens.plans import ordered
from newslens.plans.ordered import running, with_index
from newslens.plans.sampling import bottom_k, hash_key, split_by_rank
from newslens.plans.storage import checkpoint_dir, discard, scratch_path


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 700
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n)).astype(object)
    key[:5] = None
    return pd.DataFrame({"key": key, "t": rng.integers(0, 90, n), "id": np.arange(n), "x": rng.random(n).round(3)})


def test_index_is_dense_and_ordered_per_key(spark, rows):
    got = with_index(spark.createDataFrame(rows).repartition(5), ["t", "id"], ["key"]).toPandas()
    assert len(got) == len(rows)
    for _, part in got.groupby("key", dropna=False):
        part = part.sort_values(["t", "id"])
        assert part["idx"].tolist() == list(range(1, len(part) + 1))


def test_index_without_key(spark, rows):
    got = with_index(spark.createDataFrame(rows), ["t", "id"]).toPandas().sort_values(["t", "id"])
    assert got["idx"].tolist() == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("block_rows", [7, 50, 10_000])
def test_running_and_sliding_do_not_depend_on_blocks(spark, rows, block_rows):
    indexed = with_index(spark.createDataFrame(rows), ["t", "id"], ["key"])
    got = running(
        indexed,
        ["key"],
        {"s": ("sum", F.col("x")), "hi": ("max", F.col("x")), "lo": ("min", F.col("x")), "past": ("max", F.col("x"), False)},
        sliding={"mean6": (F.avg("x"), 6)},
        block_rows=block_rows,
    ).toPandas()
    assert len(got) == len(rows)
    for _, part in got.groupby("key", dropna=False):
        part = part.sort_values("idx")
        np.testing.assert_allclose(part["s"], part["x"].cumsum(), rtol=1e-12)
        np.testing.assert_allclose(part["hi"], part["x"].cummax())
        np.testing.assert_allclose(part["lo"], part["x"].cummin())
        np.testing.assert_allclose(part["past"].iloc[1:], part["x"].cummax().iloc[:-1])
        assert pd.isna(part["past"].iloc[0])
        np.testing.assert_allclose(part["mean6"], part["x"].rolling(6, min_periods=1).mean(), rtol=1e-9)


def test_lookback_longer_than_a_block_is_refused(spark, rows):
    indexed = with_index(spark.createDataFrame(rows), ["t", "id"], ["key"])
    with pytest.raises(ValueError):
        running(indexed, ["key"], {}, sliding={"m": (F.avg("x"), 50)}, block_rows=10)


@pytest.mark.parametrize("k", [0, 1, 17, 300, 5000])
def test_bottom_k(spark, k):
    df = spark.range(300).withColumn("key", hash_key(["id"], 42))
    got = {r["id"] for r in bottom_k(df, "key", k, ["id"]).collect()}
    ranked = sorted(range(300), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())
    assert got == set(ranked[:k])


@pytest.mark.parametrize("cuts", [{0: (3, 10), 1: (0, 40)}, {0: (0, 0), 1: (250, 250)}, {0: (50, 50), 1: (1, 2)}])
def test_split_by_rank(spark, cuts):
    df = spark.range(300).withColumn("label", (F.col("id") % 6 != 0).cast("int")).withColumn("key", hash_key(["id"], 1))
    table = spark.createDataFrame([(g, a, b) for g, (a, b) in cuts.items()], "label int, cut0 long, cut1 long")
    got = split_by_rank(df, "label", "key", table, ("x", "y", "z"), ["id"]).toPandas()
    assert len(got) == 300
    for label, (a, b) in cuts.items():
        part = got[got["label"] == label].sort_values(["key", "id"])["split"].tolist()
        assert part == ["x"] * a + ["y"] * (b - a) + ["z"] * (len(part) - b)


def test_a_split_does_not_gather_a_group_in_one_task(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = session.range(300).withColumn("label", (F.col("id") % 2).cast("int")).withColumn("key", hash_key(["id"], 1))
    table = session.createDataFrame([(0, 3, 10), (1, 5, 20)], "label int, cut0 long, cut1 long")
    plan = split_by_rank(df, "label", "key", table, ("x", "y", "z"), ["id"])._jdf.queryExecution().executedPlan().toString()
    # both the rows between the cuts and those of the buckets at them stay where they are for it
    assert plan.count("BroadcastHashJoin [label") == 2


class _Session:
    """As much of a session as the choice of folder looks at."""

    def __init__(self, settings, master, app="app-1"):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "applicationId": app})


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(_Session({"spark.checkpoint.dir": "s3a://shared/x/"}, "yarn")) == "s3a://shared/x"
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session({}, "yarn"))
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_only_a_single_process_may_do_without_the_setting(spark):
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "k8s://x"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(_Session({}, master))


def test_bottom_k_keeps_null_keys(spark):
    df = spark.createDataFrame([(i, None if i < 2 else f"{i:08d}") for i in range(10)], "id long, key string")
    assert sorted(r["id"] for r in bottom_k(df, "key", 4, ["id"]).collect()) == [0, 1, 2, 3]


def test_discard_removes_a_scratch_folder(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


ODD_ROWS = [("a", None, "x"), ("b", 1, "y"), ("b", 1, "y"), ("b", 1, "z"), ("c", None, "p"), ("c", 5, "q"), (None, 2, "n"), (None, None, "m"), ("", 3, "e")]


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_first_per_key_keeps_exactly_one_row(spark, kind):
    given = {None: None, 1: 1, 2: 2, 3: 3, 5: 5} if kind == "long" else {k: f"2024-01-0{k}" if k else None for k in (None, 1, 2, 3, 5)}
    df = spark.createDataFrame([(k, given[o] if kind == "long" else given[o], v) for k, o, v in ODD_ROWS], f"k string, o {'long' if kind == 'long' else 'string'}, v string")
    df = df.withColumn("o", F.col("o").cast(kind)).repartition(5)
    got = {r.k: (str(r.o) if r.o is not None else None, r.v) for r in ordered.first_per_key(df, "k", ["o"]).collect()}
    assert ordered.first_per_key(df, "k", ["o"]).count() == 5
    assert got["a"] == (None, "x") and got["c"] == (str(given[5]), "q") and got[None] == (str(given[2]), "n") and got[""][1] == "e"
    assert got["b"][1] in ("y", "z") and ordered.first_per_key(df.repartition(2), "k", ["o"]).filter("k = 'b'").collect()[0].v == got["b"][1]


def test_last_per_key_and_several_orders(spark):
    df = spark.createDataFrame([("a", 1, 2, "old"), ("a", 3, None, "new"), ("a", None, 9, "none"), ("b", None, None, "only")], "k string, o long, p long, v string")
    assert sorted(r.v for r in ordered.first_per_key(df, "k", ["o"], last=True).collect()) == ["new", "only"]
    assert sorted(r.v for r in ordered.first_per_key(df, "k", ["o", "p"]).collect()) == ["old", "only"]
    assert sorted(r.v for r in ordered.first_per_key(df, "k", ["o", "p"], last=True).collect()) == ["new", "only"]
    assert sorted(r.v for r in ordered.first_per_key(df, "k", ["p", "o"], last=True).collect()) == ["none", "only"]
    extreme = spark.createDataFrame([("a", -(2**63), "low"), ("a", 2**63 - 1, "high"), ("a", None, "none")], "k string, o long, v string")
    assert [r.v for r in ordered.first_per_key(extreme, "k", ["o"]).collect()] == ["low"]
    assert [r.v for r in ordered.first_per_key(extreme, "k", ["o"], last=True).collect()] == ["high"]


def test_first_per_key_does_not_sort_to_aggregate(spark):
    df = spark.range(10).selectExpr("string(id % 3) k", "id o", "repeat('x', 50) v")
    plan = ordered.first_per_key(df, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min" in plan

"""Change detectors against plain loops written from their definitions."""

import math
from itertools import pairwise

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslens.functions import sequential as seq
from newslens.operators import detectors as ops


def steady_then_uniform(seed=42, stable=500, shifted=200):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.beta(9, 1, stable), rng.beta(1, 1, shifted)])


def jumps(seed, n=6000):
    rng = np.random.default_rng(seed)
    levels = np.repeat(rng.choice([0.15, 0.5, 0.85], n // 300), 300)
    return np.clip(levels + rng.normal(0, 0.1, len(levels)), 0, 1).round(2)


def loop_adwin(values, delta):
    """Buckets keep their raw values, so nothing is merged incrementally."""
    buckets, flags = [], []
    for i, x in enumerate(values):
        buckets.append([x])
        size = 1
        while sum(len(b) == size for b in buckets) > 5:
            at = next(j for j, b in enumerate(buckets) if len(b) == size)
            buckets[at : at + 2] = [buckets[at] + buckets[at + 1]]
            size *= 2
        flag = False
        while (i + 1) % 32 == 0:
            flat = np.concatenate(buckets)
            n = len(flat)
            if n <= 10:
                break
            cuts = np.cumsum([len(b) for b in buckets])[:-1]
            log_term = math.log(2 * math.log(n) / delta)
            for c in cuts:
                if c >= 5 and n - c >= 5:
                    h = 1 / c + 1 / (n - c)
                    bound = math.sqrt(2 * h * flat.var() * log_term) + 2 / 3 * h * log_term
                    if abs(flat[:c].mean() - flat[c:].mean()) > bound:
                        buckets.pop(0)
                        flag = True
                        break
            else:
                break
        flags.append(flag)
    return np.array(flags)


def loop_kswin(values, alpha, seed):
    window, flags = [], []
    for i, x in enumerate(values):
        window = [*window, x][-100:]
        flag = len(window) == 100 and bool(seq.ks_changed(np.array([window]), np.array([i + 1]), seed, alpha)[0])
        if flag:
            window = window[-33:]
        flags.append(flag)
    return np.array(flags)


def loop_page_hinkley(values, s):
    flags, since = [], []
    for x in values:
        since.append(x)
        up = down = 0.0
        ups, downs = [], []
        for j in range(len(since)):
            mean = sum(since[: j + 1]) / (j + 1)
            up = s.ph_forgetting * up + since[j] - mean - s.ph_delta
            down = s.ph_forgetting * down + since[j] - mean + s.ph_delta
            ups.append(up)
            downs.append(down)
        flag = len(since) >= s.ph_min_rows and (up - min(ups) > s.ph_threshold or max(downs) - down > s.ph_threshold)
        if flag:
            since = []
        flags.append(flag)
    return np.array(flags)


@pytest.mark.parametrize("values", [steady_then_uniform(), jumps(1)[:2500], np.full(900, 0.4)])
def test_adwin_equals_the_loop(values):
    got = seq.run_adwin(seq.DetectorState(), values, 0.002)
    assert (got == loop_adwin(values, 0.002)).all()


@pytest.mark.parametrize("values", [steady_then_uniform(), jumps(2)[:2500], np.full(300, 0.4)])
def test_kswin_equals_the_loop(values):
    got = seq.run_kswin(seq.DetectorState(), values, 0.005, 42)
    assert (got == loop_kswin(values, 0.005, 42)).all()


def test_page_hinkley_equals_the_loop():
    s = seq.Settings(ph_threshold=4.0)
    values = jumps(3)[:700]
    got = seq.run_page_hinkley(seq.DetectorState(), values, s)
    assert got.any() and (got == loop_page_hinkley(values, s)).all()


def brute_distance(a, b):
    points = np.unique(np.concatenate([a, b]))
    return max(abs((a <= p).mean() - (b <= p).mean()) for p in points)


def test_kolmogorov_smirnov_statistic_handles_ties():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 6, (200, 100)) / 5
    windows[:100, 67:] = (windows[:100, 67:] + 0.4).clip(0, 1)
    got = seq.ks_changed(windows, np.arange(200), 1, 0.005)
    # The largest and smallest distance any choice of 33 older scores could give.
    assert got[:100].mean() > got[100:].mean()
    same = np.tile(np.arange(100) % 7 / 7, (1, 1))
    assert not seq.ks_changed(same, np.array([1]), 1, 0.005)[0]


def test_critical_distance_is_the_exact_one():
    k = seq.ks_critical(33, 0.005)
    n, trials = 33, 40_000
    rng = np.random.default_rng(3)
    order = rng.random((trials, 2 * n)).argsort(axis=1)
    walk = np.abs(np.cumsum(np.where(order < n, 1, -1), axis=1)).max(axis=1)
    assert (walk >= k).mean() < 0.0065 and (walk >= k - 1).mean() > 0.005


def test_draws_differ_from_row_to_row():
    rng = np.random.default_rng(0)
    windows = np.tile(np.concatenate([rng.random(67), rng.random(33) * 0.75]), (400, 1))
    share = seq.ks_changed(windows, np.arange(400), 42, 0.2).mean()
    assert 0 < share < 1


@pytest.mark.parametrize("cut", [1, 33, 99, 100, 101, 640])
def test_any_slicing_gives_the_same_alarms(cut):
    values, s = jumps(4)[:3000], seq.Settings(ph_threshold=5.0)
    whole = np.array(seq.run_detectors(seq.DetectorState(), values, s))
    state, parts = seq.DetectorState(), []
    for start in range(0, len(values), cut * 7):
        state = seq.DetectorState.loads(state.dumps())
        parts.append(np.array(seq.run_detectors(state, values[start : start + cut * 7], s)))
    assert (np.concatenate(parts, axis=1) == whole).all()
    assert whole.any(axis=1).all()


def test_small_chunks_give_the_same_kswin_alarms():
    values = jumps(5)[:2000]
    whole = seq.kswin_changes(values, 2500, 1, 0.005)
    assert whole.any() and (seq.kswin_changes(values, 2500, 1, 0.005, chunk=64) == whole).all()
    assert (seq.kswin_changes(values[700:], 2500, 1, 0.005)[99:] == whole[799:]).all()


def test_reactions():
    quiet = seq.run_detectors(seq.DetectorState(), np.full(3000, 0.7), seq.Settings())
    assert not np.array(quiet).any()
    step = np.concatenate([np.full(600, 0.9), np.full(400, 0.2)])
    adwin, kswin, _ = seq.run_detectors(seq.DetectorState(), step, seq.Settings())
    assert not adwin[:600].any() and not kswin[:600].any()
    assert np.flatnonzero(adwin)[0] - 600 <= 64 and np.flatnonzero(kswin)[0] - 600 <= 33
    assert all(b - a >= 67 for a, b in pairwise(np.flatnonzero(kswin)))


def test_state_stays_small():
    state = seq.DetectorState()
    seq.run_detectors(state, np.full(60_000, 0.5), seq.Settings())
    assert len(state.dumps()) < 20_000


# On Spark ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sequences(spark):
    parts = []
    for i, name in enumerate(["a", "b", "hot"]):
        x = jumps(10 + i)[: 900 if name != "hot" else 3000]
        name = None if name == "b" else name
        parts.append(pd.DataFrame({"key": name, "t": np.arange(len(x)), "p_fake": x}))
    pdf = pd.concat(parts, ignore_index=True)
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=1))


@pytest.mark.parametrize("block_rows,group_blocks", [(99, 2), (150, 3), (1000, 256), (100_000, 256)])
def test_kswin_alarms_without_a_walk(spark, sequences, block_rows, group_blocks):
    pdf, df = sequences
    got = ops.kswin_alarms(df, ["t"], ["key"], block_rows=block_rows, group_blocks=group_blocks).toPandas()
    for name, part in pdf.groupby("key", dropna=False):
        want = np.flatnonzero(loop_kswin(part["p_fake"].to_numpy(), seq.KSWIN_ALPHA, 42)) + 1
        mine = got[got["key"].isna() if pd.isna(name) else got["key"] == name]["message_index"]
        assert len(want) and sorted(mine) == want.tolist()


def test_kswin_alarms_of_one_sequence_and_of_none(spark, sequences):
    pdf, df = sequences
    ordered = pdf.sort_values(["key", "t"], na_position="first")["p_fake"].to_numpy()
    got = ops.kswin_alarms(df, ["key", "t"], block_rows=700).toPandas()["message_index"]
    assert sorted(got) == (np.flatnonzero(loop_kswin(ordered, seq.KSWIN_ALPHA, 42)) + 1).tolist()
    assert ops.kswin_alarms(df.limit(0), ["t"], ["key"]).count() == 0


def test_detect_carries_narrow_rows_only(spark, sequences):
    _, df = sequences
    wide = df.select("*", F.concat(F.col("key"), F.lit(" body")).alias("body"), F.array(F.col("t")).alias("more"))
    got = ops.detect(wide, ["t"], ["key"], keep_index=True)
    assert got.columns == [*wide.columns, "message_index", "adwin", "kswin", "page_hinkley"]
    plain = ops.detect(df, ["t"], ["key"], keep_index=True)
    assert sorted(map(str, got.drop("body", "more").collect())) == sorted(map(str, plain.collect()))
    assert got.filter("body <> concat(key, ' body') or more[0] <> t").count() == 0


@pytest.mark.parametrize("slice_rows", [400, 100_000])
def test_detect_in_slices(spark, sequences, slice_rows):
    pdf, df = sequences
    s = seq.Settings(ph_threshold=5.0)
    got = ops.detect(df, ["t"], ["key"], settings=s, slice_rows=slice_rows).toPandas()
    assert len(got) == len(pdf)
    for name, part in pdf.groupby("key", dropna=False):
        want = seq.run_detectors(seq.DetectorState(), part["p_fake"].to_numpy(), s)
        mine = got[got["key"].isna() if pd.isna(name) else got["key"] == name].sort_values("t")
        for column, flags in zip(("adwin", "kswin", "page_hinkley"), want):
            assert (mine[column].to_numpy() == flags).all()


def test_detect_needs_a_key_and_takes_no_rows(spark, sequences):
    _, df = sequences
    with pytest.raises(ValueError):
        ops.detect(df, ["t"], [])
    assert ops.detect(df.limit(0), ["t"], ["key"]).count() == 0


@pytest.mark.parametrize("block_rows", [3, 100_000])
def test_adwin_cuts(spark, sequences, block_rows):
    pdf, df = sequences
    got = ops.adwin_cuts(df, ["t"], ["key"], block_rows=block_rows).toPandas()
    for name, part in pdf.groupby("key", dropna=False):
        x = part["p_fake"].to_numpy()
        mine = got[got["key"].isna() if pd.isna(name) else got["key"] == name].sort_values("cut")
        assert mine["cut"].tolist() == list(range(50, len(x), 50))
        for cut, gap, bound in mine[["cut", "gap", "bound"]].itertuples(index=False):
            assert gap == pytest.approx(abs(x[:cut].mean() - x[cut:].mean()), abs=1e-9)
            assert bound == pytest.approx(float(seq.adwin_bound(x.var(), cut, len(x) - cut, len(x), 0.002)), abs=1e-9)


def test_adwin_cuts_without_key(spark, sequences):
    pdf, df = sequences
    x = pdf.sort_values(["key", "t"], na_position="first")["p_fake"].to_numpy()
    got = ops.adwin_cuts(df, ["key", "t"]).toPandas().set_index("cut")["gap"]
    assert len(got) == (len(x) - 1) // 50
    assert got[1000] == pytest.approx(abs(x[:1000].mean() - x[1000:].mean()), abs=1e-9)


def test_kswin_blocks(spark, sequences):
    pdf, df = sequences
    got = ops.kswin_blocks(df, ["t"], ["key"]).toPandas()
    for name, part in pdf.groupby("key", dropna=False):
        x = part["p_fake"].to_numpy()
        mine = got[got["key"].isna() if pd.isna(name) else got["key"] == name].sort_values("window_index")
        want = [brute_distance(x[i + 67 : i + 100], x[i : i + 67]) for i in range(0, len(x) - 99, 100)]
        np.testing.assert_allclose(mine["distance"], want, atol=1e-12)


@pytest.mark.parametrize("block_rows,forgetting", [(40, 0.9999), (40, 0.9), (40, 1.0), (100_000, 0.9999)])
def test_page_hinkley_series(spark, sequences, block_rows, forgetting):
    pdf, df = sequences
    got = ops.page_hinkley_series(df, ["t"], ["key"], forgetting=forgetting, block_rows=block_rows).toPandas()
    for name, part in pdf.groupby("key", dropna=False):
        mine = got[got["key"].isna() if pd.isna(name) else got["key"] == name].sort_values("idx")["statistic"].to_numpy()
        up = down = mean = 0.0
        low, high, want = math.inf, -math.inf, []
        for n, x in enumerate(part["p_fake"], start=1):
            mean += (x - mean) / n
            up, down = forgetting * up + x - mean - 0.005, forgetting * down + x - mean + 0.005
            low, high = min(low, up), max(high, down)
            want.append(max(up - low, high - down))
        np.testing.assert_allclose(mine, want, atol=1e-8)


def test_page_hinkley_first(spark, sequences):
    pdf, df = sequences
    got = ops.page_hinkley_first(df, ["t"], ["key"], threshold=5.0).toPandas().fillna({"key": "null"}).set_index("key")["first_alarm"]
    for name, part in pdf.groupby("key", dropna=False):
        flags = seq.run_page_hinkley(seq.DetectorState(), part["p_fake"].to_numpy(), seq.Settings(ph_threshold=5.0))
        assert got["null" if pd.isna(name) else name] == np.flatnonzero(flags)[0] + 1
    assert df.withColumn("p_fake", F.lit(0.5)).transform(lambda d: ops.page_hinkley_first(d, ["t"], ["key"])).filter("first_alarm is not null").count() == 0


def test_the_plan_does_not_grow_with_the_slices(spark, sequences):
    _, df = sequences
    sizes = []
    for rows in (1000, 200):
        found = ops.detect(df, ["t"], ["key"], slice_rows=rows)
        plan = found._jdf.queryExecution().executedPlan().toString()
        sizes.append((plan.count("Scan"), plan.count("Union"), plan.count("Join")))
    assert sizes[0] == sizes[1] and sizes[0][1] == 0

"""Classifier, replay and online learning."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.operators import metrics, model

TEXTS = [("shocking secret conspiracy revealed", 1), ("agency reports rates raised", 0), ("shocking hoax spreads fast", 1), ("official figures published today", 0)]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(str(i), f"{t} {i}", "body text", lb) for i in range(25) for t, lb in TEXTS]
    return spark.createDataFrame([(f"{i}", t, b, lb) for i, (_, t, b, lb) in enumerate(rows)], "id string, title string, body string, label int")


def test_train_and_score(spark, corpus):
    fitted = model.train(corpus, features=1024)
    new = spark.createDataFrame([("a", "SHOCKING: secret conspiracy revealed!", ""), ("b", "Agency: official figures published", None)], "id string, title string, body string")
    got = {r.id: r for r in model.score(new, fitted).collect()}
    assert (got["a"].is_fake, got["b"].is_fake) == (1, 0)
    assert all(r.confidence == max(r.p_fake, 1 - r.p_fake) and 0 <= r.p_fake <= 1 for r in got.values())


def test_select_stops_once_good_enough(corpus):
    chosen = model.select_model(corpus, corpus, [{"reg": 0.01, "features": 1024}] * 3)
    rows = chosen.history.collect()
    assert [r.epoch for r in rows] == [1] and rows[0].val_f1 == 1.0 and rows[0].val_auc == 1.0
    assert model.best_epoch(chosen.history).first().epoch == 1


def test_best_epoch_takes_the_first_of_equals(spark):
    history = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9)], "epoch int, val_f1 double")
    assert model.best_epoch(history).first().asDict() == {"epoch": 2, "val_f1": 0.9}


def test_reservoir_is_the_same_by_batches_or_at_once(spark):
    rows = spark.range(900).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("text"), F.lit(1).alias("label"))
    whole = {r.id for r in model.reservoir_update(None, rows, 50).collect()}
    kept = None
    for low in range(0, 900, 300):
        kept = model.reservoir_update(kept, rows.filter(f"id >= {low} and id < {low + 300}"), 50)
    assert {r.id for r in kept.collect()} == whole and len(whole) == 50
    assert model.reservoir_update(None, rows.limit(10), 50).count() == 10


def test_reservoir_is_uniform(spark):
    """Chi-squared over tenths of the stream, summed over seeds."""
    n, k, seeds = 1000, 100, 30
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"))
    counts = Counter()
    for seed in range(seeds):
        counts.update(int(r.id) * 10 // n for r in rows.withColumn("k", model.hash_key(["id"], seed)).orderBy("k").limit(k).collect())
    expected = k * seeds / 10
    assert sum((counts[d] - expected) ** 2 / expected for d in range(10)) < 27.9  # 99.9 % point, 9 degrees


def test_replay_and_training_batch(spark):
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("t"), "id").alias("text"), F.lit(1).alias("label"), F.col("id").alias("n"))
    reservoir = model.reservoir_update(None, rows.drop("n"), 20)
    first, second = ({r.id for r in model.replay_sample(reservoir, 4, salt).collect()} for salt in (1, 2))
    assert len(first) == len(second) == 4 and first != second
    got = model.training_batch(rows, reservoir, ["n"], 1).collect()
    assert [r.id for r in got if not r.replayed] == [str(i) for i in range(8)]
    assert {r.id for r in got if r.replayed} == first
    assert model.training_batch(rows, reservoir, ["n"], 1, new_rows=None).count() == 44
    assert model.replay_sample(reservoir.limit(2), 4, 1).count() == 2


def features(text):
    out = Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % model.FEATURES for t in re.findall(r"[^\W_]+", text.lower()))
    out[model.BIAS] += 1
    return out


def loop_steps(examples, lr, steps):
    w, m, v, losses = Counter(), Counter(), Counter(), []
    for t in range(1, steps + 1):
        grad, loss = Counter(), 0.0
        for text, label in examples:
            x = features(text)
            p = 1 / (1 + math.exp(-sum(w[f] * c for f, c in x.items())))
            loss -= math.log(p if label else 1 - p) / len(examples)
            for f, c in x.items():
                grad[f] += (p - label) * c / len(examples)
        norm = math.sqrt(sum(g * g for g in grad.values()))
        scale = min(1.0, 1.0 / (norm + 1e-6))
        for f in set(w) | set(grad):
            g = grad[f] * scale
            m[f], v[f] = 0.9 * m[f] + 0.1 * g, 0.999 * v[f] + 0.001 * g * g
            w[f] += -lr * 0.01 * w[f] - lr * (m[f] / (1 - 0.9**t)) / (math.sqrt(v[f] / (1 - 0.999**t)) + 1e-8)
        losses.append(loss)
    return w, losses


def test_online_steps_equal_the_loop(spark):
    examples = [(t, lb) for t, lb in TEXTS] + [("fresh words à part", 1)]
    batch = spark.createDataFrame([(str(i), t, lb) for i, (t, lb) in enumerate(examples)], "row string, text string, label int")
    want, losses = loop_steps(examples, 0.05, 3)
    weights = model.empty_weights(spark)
    for step in (1, 2, 3):
        weights, report = model.online_step(weights, batch, 0.05, step)
        assert report.first().loss == pytest.approx(losses[step - 1], abs=1e-9)
        weights = model.materialise(weights, "test-weights")
    got = {r.feature: r.w for r in weights.collect()}
    assert got == pytest.approx({f: x for f, x in want.items()}, abs=1e-9)
    assert losses[2] < losses[0]
    scored = model.score_with_weights(batch.select(F.col("row").alias("id"), F.col("text").alias("title"), F.lit("").alias("body")), weights)
    assert scored.count() == 5
    unnamed = spark.createDataFrame([(None, "fresh words", ""), (None, "fresh words", ""), ("1", "x", None)], "id string, title string, body string")
    scored = model.score_with_weights(unnamed, weights)
    assert scored.count() == 3 and "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()


def test_score_with_any_model(spark):
    df = spark.createDataFrame([("1", "aaaa", "b"), ("2", "a", None)], "id string, title string, body string")
    got = {r.id: (r.is_fake, r.p_fake) for r in model.score_with(df, lambda s: np.minimum(s.str.count("a") / 4, 1.0)).collect()}
    assert got == {"1": (1, 1.0), "2": (0, 0.25)}


def test_trainer_metrics_and_sync(spark):
    log = spark.createDataFrame([(10 + i, 0.5 + i, 100) for i in range(5)], "batch_id int, loss double, examples int")
    out = model.trainer_metrics(log).orderBy("batch").collect()
    assert [(r.batch, r.total_examples, r.avg_loss) for r in out][-1] == (5, 500, 2.5)
    assert [r.batch_id for r in model.sync_due(model.trainer_metrics(log), 2).orderBy("batch").collect()] == [11, 13]


# Metrics ----------------------------------------------------------------------------------------


def pairs_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("block_rows", [4, 100_000])
def test_auc_and_roc(spark, block_rows):
    rng = np.random.default_rng(0)
    rows = [(int(y), round(float(s), 1)) for y, s in zip(rng.random(300) < 0.3, rng.random(300))]
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.auc(df, block_rows=block_rows).first().auc == pytest.approx(pairs_auc(rows), abs=1e-12)
    curve = metrics.roc_curve(df, block_rows=block_rows).orderBy("idx").collect()
    for r in curve[1:]:
        assert r.tpr == pytest.approx(np.mean([s >= r.threshold for y, s in rows if y]))
        assert r.fpr == pytest.approx(np.mean([s >= r.threshold for y, s in rows if not y]))
    assert (curve[0].fpr, curve[0].tpr, curve[-1].fpr, curve[-1].tpr) == (0, 0, 1, 1)
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(pairs_auc(rows), abs=1e-12)


def test_one_class_has_no_auc(spark):
    assert metrics.auc(spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")).first().auc == 0.0


def test_classification_report(spark):
    cells = [(0, 0)] * 50 + [(0, 1)] * 10 + [(1, 0)] * 5 + [(1, 1)] * 35
    df = spark.createDataFrame(cells, "label int, prediction int")
    rows = {r["row"]: r for r in metrics.classification_report(df).collect()}
    assert rows["Réel"].precision == pytest.approx(50 / 55) and rows["Réel"].recall == pytest.approx(50 / 60)
    assert rows["Fake"].f1 == pytest.approx(70 / 85) and rows["Fake"].support == 40
    assert rows["accuracy"].f1 == pytest.approx(0.85) and rows["accuracy"].precision is None
    macro = (2 * 50 / 115 + 70 / 85) / 2
    assert rows["macro avg"].f1 == pytest.approx(macro) and metrics.macro_f1(df).first().macro_f1 == pytest.approx(macro)
    assert rows["weighted avg"].f1 == pytest.approx((60 * 2 * 50 / 115 + 40 * 70 / 85) / 100)
    never = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    assert metrics.macro_f1(never).first().macro_f1 == pytest.approx((2 / 3 + 0) / 2)
    single = spark.createDataFrame([(0, 0)], "label int, prediction int")
    assert metrics.macro_f1(single).first().macro_f1 == 1.0

"""Training, scoring, replay and online learning."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.corpus_queries import SPLIT, split
from catalog.views import ARTICLES, LABELLED, SCORED, articles, labelled, scored_events
from newslens.functions import text
from newslens.operators import model as ops
from newslens.plans.storage import materialise


@register("score_articles")
def score_articles(spark, sf):
    """A classifier trained on the labelled articles, applied to all articles."""
    fitted = ops.train(materialise(labelled(spark, sf).select("title", "body", "label"), "train"))
    return ops.score(articles(spark, sf).select("seq", "id", "title", "body"), fitted).drop("title", "body")


def _share_of_long_words(texts):
    """Stand-in for an external model."""
    return texts.str.count(r"\S{7,}") / texts.str.count(r"\S+").clip(lower=1)


@register(
    "score_with_hook",
    rf"""WITH {ARTICLES}, w AS (SELECT seq, regexp_extract_all(substring(title, 1, 200) || ' [SEP] ' || substring(body, 1, 100), '\S+') AS ws FROM articles),
p AS (SELECT seq, len(list_filter(ws, LAMBDA x: length(x) > 6)) * 1e0 / len(ws) AS p FROM w)
SELECT seq, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS is_fake, round(greatest(p, 1 - p), 6) AS confidence, round(p, 6) AS p_fake FROM p""",
)
def score_with_hook(spark, sf):
    scored = ops.score_with(articles(spark, sf).select("seq", "title", "body"), _share_of_long_words)
    return rounded(scored.drop("title", "body"), "confidence", "p_fake")


@register("select_model")
def select_model(spark, sf):
    """Validation history of a small grid on the 80/10/10 split."""
    parts = materialise(split(spark, sf), "split")
    grid = [{"reg": r} for r in (1.0, 0.1, 0.01)]
    return ops.select_model(parts.filter("split = 'train'"), parts.filter("split = 'val'"), grid).history


@register("scored_once", f"WITH {ARTICLES} SELECT seq, true AS in_range, true AS consistent FROM articles")
def scored_once(spark, sf):
    """One decision per article, and the decision that follows from p_fake."""
    p, fake = F.col("p_fake"), F.col("is_fake") == 1
    sure = F.when(fake, p).otherwise(1 - p)
    consistent = (fake == (p > 0.5)) & (F.abs(F.col("confidence") - sure) < 1e-12)
    return score_articles(spark, sf).select("seq", ((p >= 0) & (p <= 1)).alias("in_range"), consistent.alias("consistent"))


@register("selection_rules", "SELECT true AS contiguous, true AS stops_when_good, true AS best_is_first_highest, true AS in_range")
def selection_rules(spark, sf):
    """The candidates are numbered in order, the search ends with the first that is good enough
    or the last, and the best is the first with the highest F1."""
    history = materialise(select_model(spark, sf), "history")
    good = F.col("val_f1") >= ops.GOOD_ENOUGH_F1
    facts = history.agg(
        (F.max("epoch") == F.count("*")).alias("numbered"), (F.countDistinct("epoch") == F.count("*")).alias("apart"),
        F.min(F.when(good, F.col("epoch"))).alias("first_good"), F.max("epoch").alias("last"), F.max("val_f1").alias("highest"),
        F.min(F.least("train_f1", "val_f1", "val_auc")).alias("least"), F.max(F.greatest("train_f1", "val_f1", "val_auc")).alias("most"),
    )
    first = history.join(facts, F.col("val_f1") == F.col("highest")).agg(F.min("epoch").alias("first_highest"))
    best = ops.best_epoch(history).select(F.col("epoch").alias("best"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    whole = one(facts).join(one(first), "_one").join(one(best), "_one")
    return whole.select(
        (F.col("numbered") & F.col("apart")).alias("contiguous"),
        F.coalesce(F.col("first_good") == F.col("last"), F.col("last") == 3).alias("stops_when_good"),
        (F.col("best") == F.col("first_highest")).alias("best_is_first_highest"),
        ((F.col("least") >= 0) & (F.col("most") <= 1)).alias("in_range"),
    )


@register(
    "best_epoch",
    f"""WITH {LABELLED}, h AS (SELECT CAST(substring(source, 4) AS INTEGER) AS epoch, round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS val_f1
  FROM labelled GROUP BY 1) SELECT epoch, val_f1 FROM h ORDER BY val_f1 DESC, epoch LIMIT 1""",
)
def best_epoch(spark, sf):
    right = F.avg(F.when(F.col("label") == F.col("prediction"), 1).otherwise(0))
    per_source = labelled(spark, sf).groupBy(F.substring("source", 4, 9).cast("int").alias("epoch"))
    return ops.best_epoch(per_source.agg(F.round(right, 6).alias("val_f1")))


@register("evaluation_sample", f"WITH {SPLIT} SELECT seq, label FROM split WHERE split = 'test' ORDER BY seq LIMIT 2000")
def evaluation_sample(spark, sf):
    return ops.evaluation_sample(split(spark, sf).filter("split = 'test'"), ["seq"]).select("seq", "label")


RESERVOIR = (
    SCORED
    + """, keyed AS (SELECT id, title || ' [SEP] ' || substring(body, 1, 100) AS text, is_fake AS label, md5(id || '|42') AS reservoir_key, processed_at FROM scored),
reservoir AS (SELECT * FROM keyed ORDER BY reservoir_key, id LIMIT 5000)"""
)


def examples(spark, sf):
    body = text.train_text(F.col("title"), F.col("body"))
    return scored_events(spark, sf).select("id", body.alias("text"), F.col("is_fake").alias("label"), "processed_at")


@register("reservoir", f"WITH {RESERVOIR} SELECT id, text, label, reservoir_key FROM reservoir")
def reservoir(spark, sf):
    return ops.reservoir_update(None, examples(spark, sf).drop("processed_at"))


@register(
    "reservoir_in_batches",
    f"WITH {RESERVOIR} SELECT id, label, reservoir_key FROM reservoir",
)
def reservoir_in_batches(spark, sf):
    """The same sample, first of all real articles, then updated with all fake ones."""
    rows = examples(spark, sf).select("id", "text", "label")
    first = materialise(ops.reservoir_update(None, rows.filter("label = 0")), "reservoir")
    return ops.reservoir_update(first, rows.filter("label = 1")).drop("text")


@register(
    "replay_sample",
    f"WITH {RESERVOIR} SELECT id, label FROM reservoir ORDER BY md5(reservoir_key || '|7'), reservoir_key LIMIT 4",
)
def replay_sample(spark, sf):
    return ops.replay_sample(ops.reservoir_update(None, examples(spark, sf)), 4, 7).select("id", "label")


@register(
    "training_batch",
    f"""WITH {RESERVOIR} SELECT id, text, label, false AS replayed FROM (SELECT * FROM keyed ORDER BY processed_at, id LIMIT 8)
UNION ALL SELECT id, text, label, true FROM (SELECT * FROM reservoir ORDER BY md5(reservoir_key || '|7'), reservoir_key LIMIT 4)""",
)
def training_batch(spark, sf):
    rows = examples(spark, sf)
    return ops.training_batch(rows, ops.reservoir_update(None, rows), ["processed_at", "id"], 7)


def _batch(spark, sf):
    body = text.train_text(F.col("title"), F.col("body"))
    return labelled(spark, sf).select(F.col("seq").alias("row"), body.alias("text"), "label")


def _start(spark, sf):
    """Weights to start from: a fixed function of the feature number, for the features in use."""
    used = ops.hashed_features(_batch(spark, sf)).select("feature").distinct()
    return used.select("feature", ((F.col("feature") % 7 - 3) / 100.0).alias("w"), F.lit(0.0).alias("m"), F.lit(0.0).alias("v"))


STEP = (
    LABELLED
    + r""", batch AS (SELECT seq AS row, title || ' [SEP] ' || substring(body, 1, 100) AS text, label FROM labelled),
terms AS (SELECT row, unnest(list_append(list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'),
    LAMBDA t: ('0x' || substr(md5(t), 1, 8))::BIGINT % 262144), 262144::BIGINT)) AS feature FROM batch),
x AS (SELECT row, feature, count(*) * 1e0 AS x FROM terms GROUP BY 1, 2),
w AS (SELECT DISTINCT feature, (feature % 7 - 3) / 100.0e0 AS w FROM x),
z AS (SELECT row, sum(x * w) AS z FROM x JOIN w USING (feature) GROUP BY 1),
p AS (SELECT row, z, label, 1 / (1 + exp(-z)) AS p FROM z JOIN batch USING (row)),
n AS (SELECT count(*) AS n FROM batch),
g AS (SELECT feature, sum((p - label) * x) / any_value(n) AS g FROM x JOIN p USING (row), n GROUP BY 1),
norm AS (SELECT sqrt(sum(g * g)) AS norm FROM g),
c AS (SELECT feature, w, g * least(1e0, 1e0 / (norm + 1e-6)) AS g FROM g JOIN w USING (feature), norm)"""
)


@register(
    "online_step_weights",
    f"""WITH {STEP} SELECT feature, round(w * (1 - 0.001e0 * 0.01e0) - 0.001e0 * g / (abs(g) + 1e-8), 6) AS w,
  round(0.1e0 * g, 6) AS m, round(0.001e0 * g * g, 6) AS v FROM c""",
)
def online_step_weights(spark, sf):
    weights, _ = ops.online_step(_start(spark, sf), _batch(spark, sf), lr=0.001, step=1)
    return rounded(weights, "w", "m", "v")


@register(
    "online_step_loss",
    f"""WITH {STEP} SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS loss, round((SELECT norm FROM norm), 6) AS grad_norm FROM p""",
)
def online_step_loss(spark, sf):
    _, report = ops.online_step(_start(spark, sf), _batch(spark, sf), lr=0.001, step=1)
    return rounded(report, "loss", "grad_norm")


LOG = (
    SCORED
    + """, log AS (SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%d %H') AS batch_id, count(*) AS examples, avg(-ln(confidence)) AS loss FROM scored GROUP BY 1),
metrics AS (SELECT *, row_number() OVER (ORDER BY batch_id) AS batch, CAST(sum(examples) OVER (ORDER BY batch_id) AS BIGINT) AS total_examples,
  avg(loss) OVER (ORDER BY batch_id) AS avg_loss FROM log)"""
)


def step_log(spark, sf):
    hour = F.date_format("processed_at", "yyyy-MM-dd HH").alias("batch_id")
    loss = F.avg(-F.log("confidence"))
    return scored_events(spark, sf).groupBy(hour).agg(F.count("*").alias("examples"), loss.alias("loss"))


@register("trainer_metrics", f"WITH {LOG} SELECT batch_id, examples, round(loss, 6) AS loss, batch, total_examples, round(avg_loss, 6) AS avg_loss FROM metrics")
def trainer_metrics(spark, sf):
    return rounded(ops.trainer_metrics(step_log(spark, sf)), "loss", "avg_loss")


@register("sync_due", f"WITH {LOG} SELECT batch_id, batch FROM metrics WHERE batch % 100 = 0")
def sync_due(spark, sf):
    return ops.sync_due(ops.trainer_metrics(step_log(spark, sf))).select("batch_id", "batch")


@register(
    "score_with_weights",
    rf"""WITH {STEP}, new AS (SELECT feature, w * (1 - 0.001e0 * 0.01e0) - 0.001e0 * g / (abs(g) + 1e-8) AS w FROM c),
inputs AS (SELECT seq, substring(title, 1, 200) || ' [SEP] ' || substring(body, 1, 100) AS text FROM articles),
parts AS (SELECT seq, unnest(list_append(list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'),
    LAMBDA t: ('0x' || substr(md5(t), 1, 8))::BIGINT % 262144), 262144::BIGINT)) AS feature FROM inputs),
scored AS (SELECT seq, 1 / (1 + exp(-sum(coalesce(w, 0)))) AS p FROM parts LEFT JOIN new USING (feature) GROUP BY 1)
SELECT seq, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS is_fake, round(greatest(p, 1 - p), 6) AS confidence, round(p, 6) AS p_fake FROM scored""",
)
def score_with_weights(spark, sf):
    """All articles scored with the weights after one online step."""
    weights, _ = ops.online_step(_start(spark, sf), _batch(spark, sf), lr=0.001, step=1)
    scored = ops.score_with_weights(articles(spark, sf).select("seq", "title", "body"), materialise(weights, "weights"))
    return rounded(scored.drop("title", "body"), "confidence", "p_fake")

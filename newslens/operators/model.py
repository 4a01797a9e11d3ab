"""Article classifier: training, scoring, and online learning with a replay reservoir.

The batch model is a Spark ML pipeline. The online model is a table of weights over
hashed terms, so one learning step is a join and two aggregations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions import text
from newslens.operators.corpus import class_weights
from newslens.operators.metrics import auc, macro_f1
from newslens.plans.ordered import running, with_index
from newslens.plans.sampling import bottom_k, hash_key
from newslens.plans.storage import materialise

# Fixed values.
GOOD_ENOUGH_F1 = 0.93
RESERVOIR_ROWS = 5000
NEW_ROWS, REPLAY_ROWS = 8, 4
CLIP_NORM, WEIGHT_DECAY = 1.0, 0.01
ADAM_BETA1, ADAM_BETA2, ADAM_EPSILON = 0.9, 0.999, 1e-8
SYNC_EVERY = 100
EVALUATION_ROWS = 2000

FEATURES = 2**18
BATCH_FEATURES = 2**16
BIAS = FEATURES


# Batch model ------------------------------------------------------------------------------------


def model_input(df: DataFrame) -> DataFrame:
    return df.withColumn("model_input", text.score_text(F.col("title"), F.col("body")))


def train(df: DataFrame, label: str = "label", reg: float = 0.01, features: int = BATCH_FEATURES, max_iter: int = 25, tol: float = 1e-4) -> PipelineModel:
    """Weighted logistic regression over TF-IDF of the title and the start of the body."""
    weights = class_weights(df, label).first()
    weight = F.when(F.col(label) == 1, F.lit(weights["weight_fake"])).otherwise(F.lit(weights["weight_real"]))
    prepared = model_input(df).withColumn("class_weight", weight).withColumn(label, F.col(label).cast("double"))
    stages = [
        RegexTokenizer(inputCol="model_input", outputCol="terms", pattern=r"[\p{L}\p{N}]+", gaps=False),
        HashingTF(inputCol="terms", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=label, weightCol="class_weight", regParam=reg, maxIter=max_iter, tol=tol),
    ]
    return Pipeline(stages=stages).fit(prepared.select("model_input", label, "class_weight"))


def _decide(p_fake: Column) -> list[Column]:
    label = F.when(p_fake > 0.5, 1).otherwise(0)
    return [
        label.alias("is_fake"),
        F.when(label == 1, p_fake).otherwise(1 - p_fake).alias("confidence"),
        p_fake.alias("p_fake"),
    ]


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add is_fake, confidence and p_fake."""
    scored = model.transform(model_input(df))
    return scored.withColumn("_p", vector_to_array("probability")[1]).select(*df.columns, *_decide(F.col("_p")))


def score_with(df: DataFrame, predict: Callable[[pd.Series], np.ndarray]) -> DataFrame:
    """Score with any model that maps a batch of input texts to p_fake, loaded once per task."""
    fields = [*model_input(df).schema.fields, T.StructField("_p", T.DoubleType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_p=np.asarray(predict(batch["model_input"]), dtype=float))

    return model_input(df).mapInPandas(run, T.StructType(fields)).select(*df.columns, *_decide(F.col("_p")))


def evaluate(df: DataFrame, model: PipelineModel, label: str = "label") -> tuple[float, float]:
    """Macro F1 and AUC."""
    scored = materialise(score(df, model).select(label, "is_fake", "p_fake"), "evaluation")
    return macro_f1(scored, label, "is_fake").first()[0], auc(scored, label, "p_fake").first()[0]


@dataclass
class Selection:
    model: PipelineModel
    history: DataFrame


def select_model(train_df: DataFrame, val_df: DataFrame, candidates: Sequence[dict], good_enough: float = GOOD_ENOUGH_F1) -> Selection:
    """Try ``candidates`` (arguments of ``train``) in order, keep the best validation macro F1,
    stop once it is good enough. One history row per candidate."""
    best, best_f1, rows = None, -1.0, []
    for number, arguments in enumerate(candidates, start=1):
        model = train(train_df, **arguments)
        train_f1 = macro_f1(score(train_df, model), "label", "is_fake").first()[0]
        val_f1, val_auc = evaluate(val_df, model)
        rows.append((number, round(train_f1, 4), round(val_f1, 4), round(val_auc, 4)))
        if val_f1 > best_f1:
            best, best_f1 = model, val_f1
        if val_f1 >= good_enough:
            break
    history = train_df.sparkSession.createDataFrame(rows, "epoch int, train_f1 double, val_f1 double, val_auc double")
    return Selection(best, history)


def best_epoch(history: DataFrame) -> DataFrame:
    """The epoch with the highest validation F1, the earliest on a tie."""
    first_best = F.struct(F.col("val_f1"), -F.col("epoch"))
    return history.agg(F.max_by("epoch", first_best).alias("epoch"), F.max("val_f1").alias("val_f1"))


def evaluation_sample(df: DataFrame, order: Sequence[str], rows: int = EVALUATION_ROWS) -> DataFrame:
    """The first 2,000 test rows."""
    return df.orderBy(*order).limit(rows)


# Replay -----------------------------------------------------------------------------------------


def reservoir_update(reservoir: DataFrame | None, batch: DataFrame, size: int = RESERVOIR_ROWS, seed: int = 42, identity: Sequence[str] = ("id",)) -> DataFrame:
    """Uniform sample of at most ``size`` rows of everything seen so far.

    Each row draws a uniform hash key once; the sample is the rows with the smallest keys.
    It can be updated batch by batch or built from the whole history with the same result.
    """
    seen = batch.withColumn("reservoir_key", hash_key(list(identity), seed))
    if reservoir is not None:
        seen = reservoir.unionByName(seen.select(reservoir.columns))
    return bottom_k(seen, "reservoir_key", size, tie=list(identity))


def replay_sample(reservoir: DataFrame, rows: int = REPLAY_ROWS, salt: int | str = 0) -> DataFrame:
    """``rows`` of the reservoir without replacement, another choice for every ``salt``."""
    return reservoir.orderBy(hash_key(["reservoir_key"], salt), "reservoir_key").limit(rows)


def training_batch(
    batch: DataFrame,
    reservoir: DataFrame,
    order: Sequence[str],
    salt: int | str,
    new_rows: int | None = NEW_ROWS,
    replay_rows: int = REPLAY_ROWS,
) -> DataFrame:
    """The first rows of the batch (all if ``new_rows`` is None) and a replay sample."""
    columns = ["id", "text", "label"]
    fresh = batch if new_rows is None else batch.orderBy(*order).limit(new_rows)
    old = replay_sample(reservoir, replay_rows, salt)
    return (
        fresh.select(*columns, F.lit(False).alias("replayed"))
        .unionByName(old.select(*columns, F.lit(True).alias("replayed")))
    )


# Online model -----------------------------------------------------------------------------------

WEIGHT_SCHEMA = "feature long, w double, m double, v double"


def empty_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WEIGHT_SCHEMA)


def _hashed_terms(column: str, features: int) -> Column:
    """Hash of every term of the text, repeats included, and the bias feature."""
    term_hash = lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long") % features
    return F.concat(F.transform(text.tokens(F.col(column)), term_hash), F.array(F.lit(features).cast("long")))


def hashed_features(df: DataFrame, column: str = "text", features: int = FEATURES) -> DataFrame:
    """(row, feature, x): term counts per hashed term and a constant bias feature."""
    counted = df.select("row", F.explode(text.counts(_hashed_terms(column, features))).alias("c"))
    return counted.select("row", F.col("c.value").alias("feature"), F.col("c.n").cast("double").alias("x"))


def margins(features: DataFrame, weights: DataFrame) -> DataFrame:
    """(row, z). The weight table has at most 2**18 + 1 rows whatever the corpus."""
    known = weights.select("feature", "w")
    z = F.sum(F.col("x") * F.coalesce("w", F.lit(0.0))).alias("z")
    return features.join(F.broadcast(known), "feature", "left").groupBy("row").agg(z)


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def online_step(weights: DataFrame, batch: DataFrame, lr: float, step: int, clip: float = CLIP_NORM, decay: float = WEIGHT_DECAY) -> tuple[DataFrame, DataFrame]:
    """One AdamW step on the mean cross-entropy of ``batch`` (row, text, label).

    Returns the new weights and a one-row frame (loss, grad_norm). The gradient norm is
    clipped after it is known. Write the weights before the next step so that the lineage
    stays short.
    """
    c = F.col
    features = hashed_features(batch)
    probability = margins(features, weights).join(batch.select("row", "label"), "row").withColumn("p", sigmoid(c("z")))
    rows = batch.agg(F.count("*").alias("rows"))
    log_loss = F.log1p(F.exp(-F.abs(c("z")))) + F.greatest(c("z"), F.lit(0.0)) - c("z") * c("label")
    loss = probability.agg(F.avg(log_loss).alias("loss"))
    errors = probability.select("row", (c("p") - c("label")).alias("error"))
    summed = features.join(errors, "row").groupBy("feature").agg(F.sum(c("error") * c("x")).alias("total"))
    one = lambda df: F.broadcast(df.withColumn("_one", F.lit(1)))  # noqa: E731 - single-row frames
    gradient = summed.withColumn("_one", F.lit(1)).join(one(rows), "_one").select("feature", (c("total") / c("rows")).alias("g"))
    norm = gradient.agg(F.sqrt(F.sum(c("g") * c("g"))).alias("grad_norm"))
    scale = F.least(F.lit(1.0), F.lit(clip) / (c("grad_norm") + 1e-6))
    updated = weights.join(gradient, "feature", "full_outer").withColumn("_one", F.lit(1)).join(one(norm), "_one")
    old = {k: F.coalesce(c(k), F.lit(0.0)) for k in ("w", "m", "v", "g")}
    g = old["g"] * scale
    m = ADAM_BETA1 * old["m"] + (1 - ADAM_BETA1) * g
    v = ADAM_BETA2 * old["v"] + (1 - ADAM_BETA2) * g * g
    move = (m / (1 - ADAM_BETA1**step)) / (F.sqrt(v / (1 - ADAM_BETA2**step)) + ADAM_EPSILON)
    new = updated.select(
        "feature", (old["w"] * (1 - lr * decay) - lr * move).alias("w"), m.alias("m"), v.alias("v")
    )
    report = one(loss).join(one(norm), "_one").drop("_one")
    return new, report


def score_with_weights(df: DataFrame, weights: DataFrame, features: int = FEATURES) -> DataFrame:
    """Add is_fake, confidence and p_fake from the online model, every row by itself.

    The weights, at most ``features`` + 1 numbers, go to the tasks as one array; no row is
    shuffled, and none is lost for want of an id.
    """
    table = np.zeros(features + 1)
    for feature, w in weights.select("feature", "w").collect():
        table[feature] = w
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("double")
    def margin(hashed: pd.Series) -> pd.Series:
        return pd.Series([shared.value[np.asarray(h, dtype=np.int64)].sum() for h in hashed])

    hashed = model_input(df).withColumn("_hashed", _hashed_terms("model_input", features))
    return hashed.withColumn("_p", sigmoid(margin("_hashed"))).select(*df.columns, *_decide(F.col("_p")))


# Step log ---------------------------------------------------------------------------------------


def trainer_metrics(step_log: DataFrame, order: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Per step (loss, examples): batch number, examples so far, mean loss so far."""
    numbered = with_index(step_log, order, name="batch")
    sums = {"total_examples": ("sum", F.col("examples")), "_loss": ("sum", F.col("loss"))}
    out = running(numbered, [], sums, idx="batch")
    return out.withColumn("avg_loss", F.col("_loss") / F.col("batch")).drop("_loss")


def sync_due(metrics: DataFrame, every: int = SYNC_EVERY) -> DataFrame:
    """The batches after which refreshed weights are published."""
    return metrics.filter(F.col("batch") % every == 0)

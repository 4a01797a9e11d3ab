"""Classification metrics, all from counts per distinct score or per class pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.plans.ordered import BLOCK_ROWS, running, with_index
from newslens.plans.storage import materialise


def confusion(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per true class with the counts of each prediction."""
    return df.groupBy(F.col(truth).alias("truth")).agg(
        F.count_if(F.col(prediction) == 0).alias("predicted_real"), F.count_if(F.col(prediction) == 1).alias("predicted_fake")
    )


def _cells(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    def cell(t: int, p: int) -> Column:
        return F.count_if((F.col(truth) == t) & (F.col(prediction) == p)).alias(f"n{t}{p}")

    return df.agg(*[cell(t, p) for t in (0, 1) for p in (0, 1)])


def _class_scores() -> dict[str, Column]:
    """Precision, recall and F1 of both classes from the four cells; 0 where undefined."""
    c = F.col
    made = {}
    for k, other in ((0, 1), (1, 0)):
        hit = c(f"n{k}{k}")
        predicted, actual = hit + c(f"n{other}{k}"), hit + c(f"n{k}{other}")
        made[f"precision{k}"] = F.coalesce(hit / F.nullif(predicted, F.lit(0)), F.lit(0.0))
        made[f"recall{k}"] = F.coalesce(hit / F.nullif(actual, F.lit(0)), F.lit(0.0))
        made[f"f1{k}"] = F.coalesce(2 * hit / F.nullif(predicted + actual, F.lit(0)), F.lit(0.0))
        made[f"support{k}"] = actual
    return made


def macro_f1(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Plain mean of the F1 of the classes that occur in truth or prediction."""
    s = _class_scores()
    present = [F.when(F.col(f"n{k}{k}") + F.col(f"n{k}{1 - k}") + F.col(f"n{1 - k}{k}") > 0, 1).otherwise(0) for k in (0, 1)]
    mean = (s["f10"] * present[0] + s["f11"] * present[1]) / F.nullif(present[0] + present[1], F.lit(0))
    return _cells(df, truth, prediction).select(mean.alias("macro_f1"))


def classification_report(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows Réel, Fake, accuracy, macro avg, weighted avg."""
    s = _class_scores()
    cells = _cells(df, truth, prediction).select("*", *[v.alias(k) for k, v in s.items()])
    c = F.col
    total = c("support0") + c("support1")

    def row(name, precision, recall, f1, support):
        values = {"precision": precision, "recall": recall, "f1": f1}
        return F.struct(
            F.lit(name).alias("row"), *[v.cast("double").alias(k) for k, v in values.items()], support.cast("long").alias("support")
        )

    def macro(m):
        return (c(f"{m}0") + c(f"{m}1")) / 2

    def weighted(m):
        return (c(f"{m}0") * c("support0") + c(f"{m}1") * c("support1")) / F.nullif(total, F.lit(0))

    nothing = F.lit(None)
    accuracy = (c("n00") + c("n11")) / F.nullif(total, F.lit(0))
    rows = [
        row("Réel", c("precision0"), c("recall0"), c("f10"), c("support0")),
        row("Fake", c("precision1"), c("recall1"), c("f11"), c("support1")),
        row("accuracy", nothing, nothing, accuracy, total),
        row("macro avg", *[macro(m) for m in ("precision", "recall", "f1")], total),
        row("weighted avg", *[weighted(m) for m in ("precision", "recall", "f1")], total),
    ]
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _per_score(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, numbered from the highest score down.

    Rows are reduced to one per distinct score before anything is ordered; the running
    counts are then taken in blocks, so many distinct scores need no single task.
    """
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg")
    )
    return materialise(with_index(counts.withColumn("_down", -F.col("score")), ["_down"]).drop("_down"), "scores")


def roc_curve(df: DataFrame, truth: str = "label", score: str = "score", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Threshold, false and true positive rate at every distinct score, from the highest down,
    after the starting point (infinity, 0, 0)."""
    scores = _per_score(df, truth, score)
    totals = F.broadcast(scores.agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).withColumn("_one", F.lit(1)))  # one row
    upto = running(scores, [], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, block_rows=block_rows)
    points = upto.withColumn("_one", F.lit(1)).join(totals, "_one").select(
        "idx",
        F.col("score").alias("threshold"),
        (F.col("fp") / F.nullif(F.col("_n"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("_p"), F.lit(0))).alias("tpr"),
    )
    start = df.sparkSession.sql("SELECT 0L AS idx, double('infinity') AS threshold, 0.0D AS fpr, 0.0D AS tpr")
    return start.unionByName(points)


def auc(df: DataFrame, truth: str = "label", score: str = "score", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs ranked rightly, ties
    counted half. 0 when a class is missing."""
    scores = _per_score(df, truth, score)
    above = running(scores, [], {"_tp": ("sum", F.col("pos"), False)}, block_rows=block_rows)
    won = F.col("neg").cast("double") * (F.col("_tp") + F.col("pos") / 2)
    sums = above.agg(F.sum(won).alias("_won"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return sums.select(
        F.coalesce(F.col("_won") / F.nullif(F.col("_p").cast("double") * F.col("_n"), F.lit(0.0)), F.lit(0.0)).alias("auc")
    )

"""Model quality over the labelled articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.views import LABELLED, SCORED, labelled, scored_events
from newslens.operators import metrics as ops

CELLS = (
    LABELLED
    + """, cells AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) * 1e0 AS a, count(*) FILTER (WHERE label = 0 AND prediction = 1) * 1e0 AS b,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) * 1e0 AS c, count(*) FILTER (WHERE label = 1 AND prediction = 1) * 1e0 AS d FROM labelled),
k AS (SELECT 0 AS class, 'Réel' AS name, a / (a + c) AS p, a / (a + b) AS r, 2 * a / (2 * a + b + c) AS f, a + b AS s FROM cells
  UNION ALL SELECT 1, 'Fake', d / (b + d), d / (c + d), 2 * d / (2 * d + b + c), c + d FROM cells)"""
)


@register(
    "confusion",
    f"""WITH {LABELLED} SELECT label AS truth, count(*) FILTER (WHERE prediction = 0) AS predicted_real,
  count(*) FILTER (WHERE prediction = 1) AS predicted_fake FROM labelled GROUP BY 1""",
)
def confusion(spark, sf):
    return ops.confusion(labelled(spark, sf))


@register("macro_f1", f"WITH {CELLS} SELECT round(avg(f), 6) AS macro_f1 FROM k")
def macro_f1(spark, sf):
    return rounded(ops.macro_f1(labelled(spark, sf)), "macro_f1")


@register(
    "classification_report",
    f"""WITH {CELLS}, rows AS (
  SELECT name AS row, p, r, f, s FROM k
  UNION ALL SELECT 'accuracy', NULL, NULL, (a + d) / (a + b + c + d), a + b + c + d FROM cells
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM k
  UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM k)
SELECT row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM rows""",
)
def classification_report(spark, sf):
    return rounded(ops.classification_report(labelled(spark, sf)), "precision", "recall", "f1")


_AUC = """, u AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2e0 AS r FROM t)
SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2e0)
  / (count(*) FILTER (WHERE y = 1) * 1e0 * count(*) FILTER (WHERE y = 0)), 6) AS auc FROM u"""


@register("auc", f"WITH {LABELLED}, t AS (SELECT label AS y, score AS s FROM labelled){_AUC}")
def auc(spark, sf):
    return rounded(ops.auc(labelled(spark, sf)), "auc")


@register("auc_events", f"WITH {SCORED}, t AS (SELECT CASE WHEN language = 'fr' THEN 1 ELSE 0 END AS y, round(p_fake, 3) AS s FROM scored){_AUC}")
def auc_events(spark, sf):
    rows = scored_events(spark, sf).select(
        F.when(F.col("language") == "fr", 1).otherwise(0).alias("label"), F.round("p_fake", 3).alias("score")
    )
    return rounded(ops.auc(rows), "auc")


@register(
    "roc_curve",
    f"""WITH {LABELLED}, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM labelled GROUP BY 1),
r AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
  row_number() OVER (ORDER BY score DESC) AS idx FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT idx, round(score, 6) AS threshold, round(fp * 1e0 / n, 6) AS fpr, round(tp * 1e0 / p, 6) AS tpr FROM r
UNION ALL SELECT 0, 'Infinity'::DOUBLE, 0e0, 0e0""",
)
def roc_curve(spark, sf):
    return rounded(ops.roc_curve(labelled(spark, sf)), "threshold", "fpr", "tpr")

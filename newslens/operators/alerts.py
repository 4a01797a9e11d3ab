"""Threshold alerts, windowed rules, alert states and notifications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.functions import scores

# Fixed values.
THRESHOLDS = {
    "fake_rate_warn": 40.0,
    "fake_rate_crit": 70.0,
    "drift_warn": 0.3,
    "drift_crit": 0.5,
    "conf_low": 0.70,
    "silence_minutes": 15,
}
TITLES = {
    ("fake_rate", "critical"): "Taux de désinformation critique",
    ("fake_rate", "warning"): "Taux de désinformation élevé",
    ("drift_score", "critical"): "Concept Drift confirmé",
    ("drift_score", "warning"): "Concept Drift détecté",
}
MESSAGES = {
    ("fake_rate", "critical"): "Taux actuel : %.1f%% (seuil : {}%%)",
    ("fake_rate", "warning"): "Taux actuel : %.1f%% (seuil : {}%%)",
    ("drift_score", "critical"): "Score : %.3f (seuil critique : {})",
    ("drift_score", "warning"): "Score : %.3f (seuil avertissement : {})",
}
RULE_ROWS = (
    ("Taux de fake (avertissement)", "fake_rate_warn", "> {:.0f}%", 1, "Avertissement", "5 min"),
    ("Taux de fake (critique)", "fake_rate_crit", "> {:.0f}%", 1, "Critique", "5 min"),
    ("Score drift (avertissement)", "drift_warn", "> {:.2f}", 1, "Avertissement", "2 min"),
    ("Score drift (critique)", "drift_crit", "> {:.2f}", 1, "Critique", "1 min"),
    ("Confiance modèle (faible)", "conf_low", "< {:.0f}%", 100, "Avertissement", "10 min"),
)
RECENT_ALERTS = 100
BUCKET_MINUTES = 5
REPEAT_MINUTES = 60


@dataclass(frozen=True)
class Rule:
    uid: str
    title: str
    metric: str
    above: bool
    threshold: float
    range_minutes: int
    hold_minutes: int
    severity: str


# Fixed values.
RULES = (
    Rule("alert-drift-detecte", "Concept Drift Détecté (score > 0.5)", "max_drift_score", True, 0.5, 5, 2, "warning"),
    Rule("alert-drift-confirme", "Concept Drift Confirmé (score > 0.8)", "max_drift_score", True, 0.8, 5, 1, "critical"),
    Rule("alert-high-fake-rate", "Taux de Désinformation Critique (>70%)", "avg_is_fake", True, 0.7, 5, 5, "critical"),
    Rule("alert-moderate-fake-rate", "Taux de Désinformation Élevé (>40%)", "avg_is_fake", True, 0.4, 5, 10, "warning"),
    Rule("alert-low-confidence", "Confiance Modèle Faible (<70%)", "avg_confidence", False, 0.7, 10, 10, "warning"),
)


def _pick(mapping: Mapping[tuple[str, str], Column | str]) -> Column:
    chosen = F.lit(None)
    for (metric, severity), value in mapping.items():
        value = value if isinstance(value, Column) else F.lit(value)
        chosen = F.when((F.col("metric") == metric) & (F.col("severity") == severity), value).otherwise(chosen)
    return chosen


def evaluate_alerts(stats: DataFrame, drift_alerts: DataFrame, now: datetime, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """Active alerts: fake rate of the statistics, composite score of the newest drift alert."""
    newest = F.max_by("composite_score", F.struct("timestamp", "messages_total"))
    values = stats.select(F.lit("fake_rate").alias("metric"), F.col("fake_rate").alias("value")).unionByName(
        drift_alerts.agg(newest.alias("value")).select(F.lit("drift_score").alias("metric"), "value")
    )
    limits = {
        ("fake_rate", "critical"): float(thresholds["fake_rate_crit"]),
        ("fake_rate", "warning"): float(thresholds["fake_rate_warn"]),
        ("drift_score", "critical"): float(thresholds["drift_crit"]),
        ("drift_score", "warning"): float(thresholds["drift_warn"]),
    }
    reached = {k: (F.col("metric") == k[0]) & (F.col("value") >= limit) for k, limit in limits.items()}
    severity = F.when(reached["fake_rate", "critical"] | reached["drift_score", "critical"], "critical").when(
        reached["fake_rate", "warning"] | reached["drift_score", "warning"], "warning"
    )
    messages = {k: F.format_string(text.format(limits[k]), F.col("value")) for k, text in MESSAGES.items()}
    return (
        values.withColumn("severity", severity)
        .filter(F.col("severity").isNotNull())
        .select(
            "severity",
            _pick(TITLES).alias("title"),
            _pick(messages).alias("message"),
            "metric",
            "value",
            F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("timestamp"),
        )
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count("*").alias("alerts"))


def severity_rank(column: Column) -> Column:
    return scores.value_map(column, scores.SEVERITY_RANK, 0)


def indicator(stats: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """Traffic light of the fake rate."""
    steps = ((None, "🟢"), (float(thresholds["fake_rate_warn"]), "🟡"), (float(thresholds["fake_rate_crit"]), "🔴"))
    return stats.select("fake_rate", scores.band(F.col("fake_rate"), steps).alias("light"))


def rules_table(spark: SparkSession, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    rows = [
        (name, pattern.format(thresholds[limit] * factor), severity, delay, "Actif")
        for name, limit, pattern, factor, severity, delay in RULE_ROWS
    ]
    return spark.createDataFrame(rows, "rule string, threshold string, severity string, delay string, status string")


# Windowed rules ---------------------------------------------------------------------------------


def _minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def _floor_to(column: str, minutes: int) -> Column:
    """Start of the ``minutes`` bucket of the hour."""
    past = (F.floor(F.minute(column) / minutes) * minutes).cast("int")
    return F.date_trunc("hour", column) + F.make_dt_interval(mins=past)


def windowed_alerts(df: DataFrame, rules: Sequence[Rule] = RULES, column: str = "processed_at") -> DataFrame:
    """Every rule at every minute: value, and whether the rule's condition holds (null: no data).

    A tick looks at the rows of the rule's range before it, split in five-minute buckets;
    the newest bucket that has the metric counts. Rows are first reduced to one per minute,
    so all that follows grows with the time span and not with the number of articles.
    """
    per_minute = (
        df.withColumn("minute", F.date_trunc("minute", column).cast(df.schema[column].dataType))
        .groupBy("minute")
        .agg(
            F.max("drift_score").alias("drift"),
            F.sum("is_fake").alias("fakes"),
            F.count("is_fake").alias("labelled"),
            F.sum("confidence").alias("confidence"),
            F.count("confidence").alias("scored"),
        )
        .withColumn("bucket", _floor_to("minute", BUCKET_MINUTES).cast(df.schema[column].dataType))
    )
    ranges = sorted({r.range_minutes for r in rules})
    seen = F.array(
        *[
            F.struct(F.lit(n).alias("range"), F.sequence(F.col("minute") + _minutes(1), F.col("minute") + _minutes(n), _minutes(1)).alias("ticks"))
            for n in ranges
        ]
    )
    buckets = (
        per_minute.select("*", F.explode(seen).alias("_r"))
        .select("*", F.col("_r.range").alias("range"), F.explode("_r.ticks").alias("tick"))
        .groupBy("range", "tick", "bucket")
        .agg(
            F.max("drift").alias("max_drift_score"),
            (F.sum("fakes") / F.nullif(F.sum("labelled"), F.lit(0))).alias("avg_is_fake"),
            (F.sum("confidence") / F.nullif(F.sum("scored"), F.lit(0))).alias("avg_confidence"),
        )
    )
    metrics = sorted({r.metric for r in rules})
    newest = [F.max_by(m, F.when(F.col(m).isNotNull(), F.col("bucket"))).alias(m) for m in metrics]
    values = buckets.groupBy("range", "tick").agg(*newest)
    table = F.array(
        *[
            F.struct(
                F.lit(r.uid).alias("uid"), F.lit(r.range_minutes).alias("range"), F.lit(r.metric).alias("metric"),
                F.lit(r.above).alias("above"), F.lit(float(r.threshold)).alias("threshold"), F.lit(r.hold_minutes).alias("hold_minutes"),
            )
            for r in rules
        ]
    )
    first, last = F.min("minute") + _minutes(1), F.max("minute") + _minutes(1)
    ticks = per_minute.agg(F.sequence(first, last, _minutes(1)).alias("ticks")).select(F.explode("ticks").alias("tick"))
    ticks = ticks.select("tick", F.explode(table).alias("rule")).select("tick", "rule.*")
    joined = ticks.join(values, ["range", "tick"], "left")
    value = F.lit(None).cast("double")
    for m in metrics:
        value = F.when(F.col("metric") == m, F.col(m)).otherwise(value)
    breached = F.when(F.col("above"), F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    return joined.withColumn("value", value).select("uid", "tick", "value", breached.alias("breached"), "hold_minutes")


def alert_states(ticks: DataFrame) -> DataFrame:
    """Normal, Pending, Alerting or NoData per rule and minute. A rule is Pending from the first
    minute its condition holds and Alerting once it has held for the rule's time; a minute
    without data ends the run. One row per minute and rule, so a rule's window spans time
    only: five million rows for ten years."""
    line = Window.partitionBy("uid").orderBy("tick")
    code = F.coalesce(F.col("breached").cast("int"), F.lit(-1))
    islands = ticks.withColumn("_code", code).withColumn(
        "_new", F.coalesce((F.col("_code") != F.lag("_code").over(line)).cast("int"), F.lit(1))
    )
    islands = islands.withColumn("_island", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.min("tick").over(Window.partitionBy("uid", "_island"))
    held = (F.unix_micros(F.col("tick").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 60_000_000
    state = (
        F.when(F.col("_code") == -1, "NoData")
        .when(F.col("_code") == 0, "Normal")
        .when(held >= F.col("hold_minutes"), "Alerting")
        .otherwise("Pending")
    )
    return islands.select("uid", "tick", "value", state.alias("state"))


def notifications(states: DataFrame, repeat_minutes: int = REPEAT_MINUTES) -> DataFrame:
    """Messages per rule: when it starts alerting, again every hour while it lasts, and when
    it is over."""
    line = Window.partitionBy("uid").orderBy("tick")
    firing = F.col("state") == "Alerting"
    before = F.coalesce(F.lag(firing).over(line), F.lit(False))
    marked = states.withColumn("_firing", firing).withColumn("_starts", firing & ~before).withColumn("_ends", ~firing & before)
    start = F.max(F.when(F.col("_starts"), F.col("tick"))).over(line.rowsBetween(Window.unboundedPreceding, 0))
    minutes = (F.unix_micros(F.col("tick").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 60_000_000
    kind = (
        F.when(F.col("_starts"), "firing")
        .when(F.col("_firing") & (minutes % repeat_minutes == 0), "repeat")
        .when(F.col("_ends"), "resolved")
    )
    return marked.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("uid", "tick", "kind")


def rule_titles(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the title and severity of a rule, by which notifications are grouped."""
    titled = scores.value_map(F.col("uid"), {r.uid: r.title for r in rules})
    return df.withColumn("alertname", titled).withColumn(
        "severity", scores.value_map(F.col("uid"), {r.uid: r.severity for r in rules})
    )

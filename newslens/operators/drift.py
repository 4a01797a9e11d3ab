"""Drift state over an ordered score sequence, drift alerts, and queries on alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions import scores
from newslens.operators.articles import MAX_DRIFT, check_limit
from newslens.plans.ordered import BLOCK_ROWS, join_on, running, with_index
from newslens.plans.storage import materialise

# Fixed values.
MEAN_ROWS = 100
SUMMARY_ROWS = 100
DETECTORS = {"ADWIN": "adwin", "KSWIN": "kswin", "PageHinkley": "page_hinkley"}


def signals(kind: str) -> Column:
    return F.struct(*[F.col(column).cast(kind).alias(name) for name, column in DETECTORS.items()]).alias("signals")


def message_index(df: DataFrame, order: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    return with_index(df, order, key, name="message_index")


def last_mean(indexed: DataFrame, key: Sequence[str] = (), value: str = "p_fake", rows: int = MEAN_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean of the last 100 sanitised scores, rounded to 4 digits."""
    average = (F.avg(scores.sanitise(F.col(value))), rows)
    out = running(indexed, key, {}, idx="message_index", sliding={"_mean": average}, block_rows=block_rows)
    return out.withColumn("confidence_mean_last100", F.round("_mean", 4)).drop("_mean")


def drift_state(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    *,
    value: str = "p_fake",
    hold: int = scores.HOLD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """State of the monitor after every row.

    Needs the three detector votes, and numbers the rows unless they carry a
    ``message_index``. A row whose composite reaches 0.5 switches drift on;
    it stays on until more than ``hold`` rows have passed since the last such row, and is
    confirmed while that last row's composite was at least 0.8.

    Only key, order, votes and score are sorted and stored; other columns, bodies say, are
    joined back to the state by key and order, which must name a row.
    """
    keys, column = list(key), F.col
    needed = [*keys, *order, *DETECTORS.values(), value, "message_index"]
    wide = [c for c in df.columns if c not in needed]
    if wide:
        narrow = drift_state(df.drop(*wide), order, keys, value=value, hold=hold, block_rows=block_rows)
        added = [c for c in narrow.columns if c not in df.columns]
        return join_on(narrow, df.select(*dict.fromkeys([*keys, *order]), *wide), list(dict.fromkeys([*keys, *order]))).select(*df.columns, *added)
    exact = scores.composite(*[column(c) for c in DETECTORS.values()])
    scored = df.withColumn("_composite", exact)
    if "message_index" not in df.columns:
        scored = message_index(scored, order, keys)
    hit = column("_composite") >= scores.DRIFT_THRESHOLD
    sure = column("_composite") >= scores.CONFIRM_THRESHOLD
    staged = running(
        scored,
        keys,
        {
            "_hit": ("max", F.when(hit, column("message_index"))),
            "_sure": ("max", F.when(sure, column("message_index"))),
            "_before": ("max", F.when(hit, column("message_index")), False),
        },
        idx="message_index",
        sliding={"_mean": (F.avg(scores.sanitise(column(value))), MEAN_ROWS)},
        block_rows=block_rows,
    )
    on = F.coalesce(column("message_index") - column("_hit") <= hold, F.lit(False))
    was_on = F.coalesce(column("message_index") - 1 - column("_before") <= hold, F.lit(False))
    staged = staged.select(
        *df.columns,
        *([] if "message_index" in df.columns else ["message_index"]),
        F.round("_composite", 4).alias("composite_score"),
        on.alias("drift_active"),
        (on & F.coalesce(column("_sure") == column("_hit"), F.lit(False))).alias("drift_confirmed"),
        (F.coalesce(column("_hit") == column("message_index"), F.lit(False)) & ~was_on).alias("is_edge"),
        scores.recommended_lr(on).alias("recommended_lr"),
        F.round("_mean", 4).alias("confidence_mean_last100"),
    )
    stored = materialise(staged, "drift-state")
    edges = {"total_drift_events": ("sum", column("is_edge").cast("long"))}
    return running(stored, keys, edges, idx="message_index", block_rows=block_rows)


def drift_edges(state: DataFrame, time: str = "processed_at", key: Sequence[str] = ()) -> DataFrame:
    """One row each time drift switches on."""
    return state.filter("is_edge").select(
        *key, F.col(time).alias("timestamp"), "message_index", F.col("composite_score").alias("score"), signals("double")
    )


def _last(columns: Sequence[Column]) -> Column:
    return F.max_by(F.struct(*columns), F.col("message_index")).alias("_last")


def alert_payloads(state: DataFrame, batch: str, time: str = "processed_at", key: Sequence[str] = ()) -> DataFrame:
    """The monitor's state after the last row of each batch that ends with drift on."""
    fields = [
        F.col(time).alias("timestamp"),
        F.col("composite_score"),
        signals("boolean"),
        F.col("drift_confirmed"),
        F.col("recommended_lr"),
        F.col("message_index").alias("messages_total"),
        F.col("confidence_mean_last100"),
        F.col("total_drift_events"),
        F.col("drift_active"),
    ]
    last = state.groupBy(*key, F.col(batch).alias("_batch_id")).agg(_last(fields))
    return last.select(*key, "_batch_id", "_last.*").filter("drift_active").drop("drift_active")


def monitor_stats(state: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    fields = [
        F.col("message_index").alias("messages_total"),
        F.col("composite_score"),
        F.col("drift_active"),
        F.col("drift_confirmed"),
        F.col("total_drift_events"),
        F.col("recommended_lr").alias("current_lr"),
    ]
    return state.groupBy(*key).agg(_last(fields)).select(*key, "_last.*")


def drift_eval(state: DataFrame, change_index: int) -> DataFrame:
    """Rows flagged after a known change point."""
    after = F.col("message_index") > change_index
    return state.agg(
        F.count_if(after & F.col("drift_active")).alias("flagged"),
        F.count_if(after).alias("rows_after"),
        F.min(F.when(after & F.col("drift_active"), F.col("message_index"))).alias("first_flagged"),
    )


# Queries on stored alerts -----------------------------------------------------------------------


def drift_stats(alerts: DataFrame) -> DataFrame:
    out = alerts.agg(
        F.count("*").alias("total_events"),
        F.count_if("drift_confirmed").alias("confirmed_events"),
        F.max_by(F.struct("*"), F.col("timestamp")).alias("last_event"),
    )
    rate = scores.percent(F.col("confirmed_events"), F.col("total_events"), 2)
    return out.select("total_events", "confirmed_events", rate.alias("confirmation_rate"), "last_event")


def recent_drift(alerts: DataFrame, limit: int = 20) -> DataFrame:
    check_limit("limit", limit, MAX_DRIFT)
    return alerts.orderBy(F.desc("timestamp"), "_batch_id").limit(limit)


def drift_summary(alerts: DataFrame, rows: int = SUMMARY_ROWS) -> DataFrame:
    """Mean and largest composite and the confirmed count over the newest alerts."""
    return recent_drift(alerts, rows).agg(
        F.count("*").alias("events"),
        F.count_if("drift_confirmed").alias("confirmed"),
        F.avg("composite_score").alias("mean_score"),
        F.max("composite_score").alias("max_score"),
    )


def unpack_signals(alerts: DataFrame) -> DataFrame:
    """Detector votes as 0/1 columns, 0 where missing."""
    names = {"adwin": "ADWIN", "kswin": "KSWIN", "ph": "PageHinkley"}
    return alerts.select(
        "*", *[F.coalesce(F.col(f"signals.{field}").cast("int"), F.lit(0)).alias(c) for c, field in names.items()]
    )


def cumulative_signals(alerts: DataFrame, ascending: bool = False, rows: int = SUMMARY_ROWS) -> DataFrame:
    """Running votes per detector over the newest alerts, added up from the newest backwards
    unless ``ascending``. At most 100 rows reach the window."""
    newest = unpack_signals(recent_drift(alerts, rows))
    time = F.asc("timestamp") if ascending else F.desc("timestamp")
    upto = Window.partitionBy(F.lit(0)).orderBy(time, "_batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return newest.select("timestamp", "_batch_id", *[F.sum(c).over(upto).alias(f"{c}_cumulative") for c in ("adwin", "kswin", "ph")])


def present_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("confirmed_text", scores.value_map(F.col("drift_confirmed"), scores.CONFIRMED_LABELS))

"""The drift monitor as a stateful stream operator, one sequence per key."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newslens.functions import scores
from newslens.functions.sequential import DetectorState, Settings, run_detectors
from newslens.operators.drift import MEAN_ROWS

STATE = T.StructType([T.StructField("detectors", T.StringType()), T.StructField("monitor", T.StringType())])

ADDED = T.StructType(
    [
        T.StructField("message_index", T.LongType()),
        T.StructField("adwin", T.BooleanType()),
        T.StructField("kswin", T.BooleanType()),
        T.StructField("page_hinkley", T.BooleanType()),
        T.StructField("composite_score", T.DoubleType()),
        T.StructField("drift_active", T.BooleanType()),
        T.StructField("drift_confirmed", T.BooleanType()),
        T.StructField("is_edge", T.BooleanType()),
        T.StructField("recommended_lr", T.DoubleType()),
        T.StructField("confidence_mean_last100", T.DoubleType()),
        T.StructField("total_drift_events", T.LongType()),
    ]
)


def _advance(rows: pd.DataFrame, x: np.ndarray, detectors: DetectorState, monitor: dict, settings: Settings) -> pd.DataFrame:
    """Monitor columns for rows in order; ``detectors`` and ``monitor`` move on."""
    start, n = detectors.rows, len(x)
    tail = detectors.recent[-(MEAN_ROWS - 1) :]
    adwin, kswin, page_hinkley = run_detectors(detectors, x, settings)
    index = start + 1 + np.arange(n)
    composite = scores.WEIGHT_ADWIN * adwin + scores.WEIGHT_KSWIN * kswin + scores.WEIGHT_PAGE_HINKLEY * page_hinkley
    hits = np.where(composite >= scores.DRIFT_THRESHOLD, index, 0)
    last_hit = np.maximum.accumulate(np.concatenate([[monitor["hit"]], hits]))
    sure = np.where(composite >= scores.CONFIRM_THRESHOLD, index, 0)
    last_sure = np.maximum.accumulate(np.concatenate([[monitor["sure"]], sure]))
    hit, before = last_hit[1:], last_hit[:-1]
    active = (hit > 0) & (index - hit <= scores.HOLD_ROWS)
    was_active = (before > 0) & (index - 1 - before <= scores.HOLD_ROWS)
    edge = (hits > 0) & ~was_active
    known = np.concatenate([tail, x])
    means = pd.Series(known).rolling(MEAN_ROWS, min_periods=1).mean().to_numpy()[len(tail) :]
    events = monitor["events"] + np.cumsum(edge)
    if n:
        monitor.update(hit=int(last_hit[-1]), sure=int(last_sure[-1]), events=int(events[-1]))
    return rows.assign(
        message_index=index,
        adwin=adwin,
        kswin=kswin,
        page_hinkley=page_hinkley,
        composite_score=composite,
        drift_active=active,
        drift_confirmed=active & (last_sure[1:] == hit),
        is_edge=edge,
        recommended_lr=np.where(active, scores.LR_DRIFT, scores.LR_BASE),
        confidence_mean_last100=means,
        total_drift_events=events,
    )


def monitor_stream(
    df: DataFrame, order: Sequence[str], key: str, value: str = "p_fake", settings: Settings = Settings()
) -> DataFrame:
    """Add the monitor columns to a stream of scored rows.

    One sequence per ``key``; a constant key gives a single one. Within a micro-batch rows
    are taken in ``order``. A task holds the rows of one key and one micro-batch, which the
    source's rate limit bounds, and a state of a few kilobytes.
    """
    columns = df.columns
    out = T.StructType([*df.schema.fields, *ADDED.fields])
    prepared = df.withColumn("_x", scores.sanitise(F.col(value)))

    def advance(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        detectors, monitor = DetectorState(), {"hit": 0, "sure": 0, "events": 0}
        if state.exists:
            stored = state.get
            detectors, monitor = DetectorState.loads(stored[0]), json.loads(stored[1])
        rows = pd.concat(batches, ignore_index=True).sort_values(list(order), kind="stable")
        result = _advance(rows[columns], rows["_x"].to_numpy(dtype=float), detectors, monitor, settings)
        state.update((detectors.dumps(), json.dumps(monitor)))
        yield result[[f.name for f in out]]

    watched = prepared.groupBy(key).applyInPandasWithState(advance, out, STATE, "append", GroupStateTimeout.NoTimeout)
    # rounded where the batch form rounds, so that exact halves go the same way
    return watched.withColumns({c: F.round(c, 4) for c in ("composite_score", "confidence_mean_last100")})

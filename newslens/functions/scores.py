"""Score expressions: sanitising, decisions, bands and display maps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
WEIGHT_ADWIN, WEIGHT_KSWIN, WEIGHT_PAGE_HINKLEY = 0.45, 0.35, 0.20
DRIFT_THRESHOLD = 0.5
CONFIRM_THRESHOLD = 0.8
HOLD_ROWS = 1000
LR_BASE, LR_DRIFT = 1e-5, 5e-5
FAKE_RATE_BANDS = ((None, "green"), (20.0, "yellow"), (40.0, "orange"), (60.0, "red"))
DRIFT_BANDS = ((None, "green"), (0.3, "yellow"), (0.5, "orange"), (0.8, "red"))
CONFIDENCE_BANDS = ((None, "red"), (0.7, "yellow"), (0.9, "green"))
TOTAL_BANDS = ((None, "green"), (1000.0, "blue"))
FAKE_COUNT_BANDS = ((None, "green"), (100.0, "orange"), (500.0, "red"))
DRIFT_ACTIVE_LABELS = {0: "NON", 1: "OUI"}
DRIFT_ACTIVE_COLOURS = {0: "green", 1: "red"}
STATUS_LABELS = {1: "🔴 FAKE", 0: "🟢 RÉEL"}
EXPORT_LABELS = {1: "FAKE", 0: "REEL"}
CONFIRMED_LABELS = {True: "⚠️ CONFIRMÉ", False: "🔔 Détecté"}
SEVERITY_RANK = {"critical": 2, "warning": 1}


def sanitise(column: Column) -> Column:
    """Missing, NaN and infinite scores become 0.5; the rest is clamped to [0, 1]."""
    score = column.cast("double")
    unusable = score.isNull() | F.isnan(score) | (F.abs(score) == F.lit(float("inf")))
    return F.when(unusable, F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def safe_tone(column: Column) -> Column:
    """Number or 0.0. The Java number suffixes d and f do not count as numbers."""
    text = column.cast("string")
    suffixed = text.rlike(r"(?i)[0-9.][df]\s*$")
    return F.when(suffixed, F.lit(0.0)).otherwise(F.coalesce(text.try_cast("double"), F.lit(0.0)))


def composite(adwin: Column, kswin: Column, page_hinkley: Column) -> Column:
    """Weighted detector vote, added in this order so that 0.45 + 0.35 passes 0.8."""
    return (
        F.lit(WEIGHT_ADWIN) * adwin.cast("double")
        + F.lit(WEIGHT_KSWIN) * kswin.cast("double")
        + F.lit(WEIGHT_PAGE_HINKLEY) * page_hinkley.cast("double")
    )


def recommended_lr(active: Column) -> Column:
    return F.when(active, F.lit(LR_DRIFT)).otherwise(F.lit(LR_BASE))


def from_logits(logits: Column) -> Column:
    """Struct (label, confidence, p_fake) from the two logits; a tie gives label 0."""
    top = F.greatest(logits[0], logits[1])
    real, fake = F.exp(logits[0] - top), F.exp(logits[1] - top)
    p_real, p_fake = real / (real + fake), fake / (real + fake)
    label = F.when(p_fake > p_real, F.lit(1)).otherwise(F.lit(0))
    return F.struct(
        label.alias("label"),
        F.when(label == 1, p_fake).otherwise(p_real).alias("confidence"),
        p_fake.alias("p_fake"),
    )


def band(column: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the highest step whose lower bound the value reaches."""
    result = F.lit(steps[0][1])
    for bound, name in steps[1:]:
        result = F.when(column >= F.lit(bound), F.lit(name)).otherwise(result)
    return F.when(column.isNull(), F.lit(None)).otherwise(result)


def value_map(column: Column, mapping: dict, default=None) -> Column:
    chain = F.lit(default)
    for value, text in mapping.items():
        chain = F.when(column == F.lit(value), F.lit(text)).otherwise(chain)
    return chain


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """100 * numerator / denominator, 0 when the denominator is 0."""
    share = F.round(numerator / F.nullif(denominator, F.lit(0)) * 100, digits)
    return F.coalesce(share, F.lit(0.0))


def at_time(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` (UTC) as a literal of the column's own timestamp type, so filters reach the scan."""
    kind = "timestamp_ntz" if isinstance(df.schema[column].dataType, T.TimestampNTZType) else "timestamp"
    text = moment.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text if kind == "timestamp_ntz" else text + "+00:00").cast(kind)

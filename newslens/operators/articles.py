"""Queries over scored articles: filters, statistics, trends, histograms, top lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import scores, text

# Fixed values.
MAX_RECENT, MAX_DRIFT, MAX_HOURS, MAX_SEARCH = 200, 100, 168, 100
ARTICLE_COLUMNS = (
    "id", "title", "body", "url", "source", "language", "is_fake", "confidence",
    "p_fake", "drift_score", "drift_active", "processed_at",
)
LATEST_HIDDEN = (
    "body", "url", "_id", "_index", "_type", "p_fake", "gdelt_tone", "drift_score",
    "drift_active", "source_category", "language", "timestamp",
)
LATEST_ORDER = ("processed_at", "title", "source", "is_fake", "confidence")
HISTOGRAM_BINS = 30


def check_limit(name: str, value: int, highest: int) -> int:
    if value < 0 or value > highest:
        raise ValueError(f"{name} must be between 0 and {highest}, got {value}")
    return value


def since(df: DataFrame, now: datetime, hours: float, column: str = "processed_at") -> DataFrame:
    return df.filter(F.col(column) >= scores.at_time(df, column, now - timedelta(hours=hours)))


def valid(df: DataFrame) -> DataFrame:
    """Rows with a non-empty title."""
    return df.filter(F.col("title").isNotNull() & (F.col("title") != ""))


# Filters and projections ------------------------------------------------------------------------


def filter_articles(
    df: DataFrame,
    *,
    fake_only: bool = False,
    real_only: bool = False,
    source: str | None = None,
    drift_only: bool = False,
    min_confidence: float = 0.0,
) -> DataFrame:
    """The article page's predicates and its projection; ``real_only`` wins over ``fake_only``."""
    conditions: list[Column] = []
    if fake_only or real_only:
        conditions.append(F.col("is_fake") == (0 if real_only else 1))
    if source:
        conditions.append(F.col("source") == source)
    if drift_only:
        conditions.append(F.col("drift_active"))
    if min_confidence > 0:
        conditions.append(F.col("confidence") >= min_confidence)
    for condition in conditions:
        df = df.filter(condition)
    return df.select(*ARTICLE_COLUMNS)


def newest(df: DataFrame, limit: int, column: str = "processed_at", tie: Sequence[str] = ("id",)) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *tie).limit(limit)


def recent(df: DataFrame, limit: int = 50, fake_only: bool = False) -> DataFrame:
    check_limit("limit", limit, MAX_RECENT)
    return newest(df.filter(F.col("is_fake") == 1) if fake_only else df, limit)


def latest_table(df: DataFrame) -> DataFrame:
    """Newest first, without the hidden columns, the leading columns in fixed order, then any others."""
    lead = list(LATEST_ORDER)
    rest = [c for c in df.columns if c not in LATEST_ORDER and c not in LATEST_HIDDEN]
    return df.select(*lead, *rest).orderBy(F.col("processed_at").desc(), *[c for c in ("id", "title") if c in rest + lead])


def percent_text(column: Column) -> Column:
    return F.concat(F.format_string("%.1f", F.round(column * 100, 1)), F.lit("%"))


def present(df: DataFrame) -> DataFrame:
    """Display columns: status, shortened title, percentages as text."""
    return df.select(
        "id",
        scores.value_map(F.col("is_fake"), scores.STATUS_LABELS).alias("status"),
        scores.value_map(F.col("is_fake"), scores.EXPORT_LABELS).alias("export_status"),
        F.substring(text.or_empty(F.col("title")), 1, 70).alias("short_title"),
        "source",
        percent_text(F.col("confidence")).alias("confidence_text"),
        percent_text(F.col("p_fake")).alias("p_fake_text"),
        "language",
    )


def sources(df: DataFrame) -> DataFrame:
    return df.select("source").distinct().orderBy("source")


# Statistics -------------------------------------------------------------------------------------


def global_stats(articles: DataFrame, drift_alerts: DataFrame, now: datetime) -> DataFrame:
    """One row. Each input is scanned once and reduced to one partial row per task."""
    last_hour = F.col("processed_at") >= scores.at_time(articles, "processed_at", now - timedelta(hours=1))
    counted = articles.agg(
        F.count("*").alias("total_articles"),
        F.count_if(F.col("is_fake") == 1).alias("fake_articles"),
        F.count_if(F.col("is_fake") == 0).alias("real_articles"),
        F.count_if(last_hour).alias("articles_last_hour"),
        F.lit(0).cast("long").alias("drift_events"),
    )
    zero = F.lit(0).cast("long")
    alerts = drift_alerts.agg(
        zero.alias("total_articles"),
        zero.alias("fake_articles"),
        zero.alias("real_articles"),
        zero.alias("articles_last_hour"),
        F.count("*").alias("drift_events"),
    )
    both = counted.unionByName(alerts).agg(*[F.sum(c).alias(c) for c in counted.columns])
    return both.select(
        "total_articles",
        "fake_articles",
        "real_articles",
        scores.percent(F.col("fake_articles"), F.col("total_articles"), 2).alias("fake_rate"),
        "drift_events",
        "articles_last_hour",
    )


def virality(articles: DataFrame, now: datetime, hours: int = 24) -> DataFrame:
    """Hourly totals, fakes and mean confidence over the last ``hours``."""
    check_limit("hours", hours, MAX_HOURS)
    return (
        since(articles, now, hours)
        .groupBy(F.date_trunc("hour", "processed_at").alias("_hour"))
        .agg(
            F.count("*").alias("total"),
            F.sum("is_fake").alias("fakes"),
            F.avg("confidence").alias("avg_confidence"),
        )
        .select(F.date_format("_hour", "yyyy-MM-dd'T'HH").alias("hour"), "total", "fakes", "avg_confidence")
        .orderBy("hour")
    )


def virality_pct(trend: DataFrame) -> DataFrame:
    total = F.when(F.col("total") == 0, 1).otherwise(F.col("total"))
    return trend.withColumn("fake_pct", F.round(F.col("fakes") / total * 100, 1))


def page_metrics(df: DataFrame) -> DataFrame:
    """Counts, mean confidence in percent and fake rate of a result set."""
    return df.agg(
        F.count("*").alias("shown"),
        F.count_if(F.col("is_fake") == 1).alias("fakes"),
        F.count_if(F.col("is_fake") == 0).alias("reals"),
        (F.avg("confidence") * 100).alias("mean_confidence_pct"),
    ).withColumn("fake_rate", F.col("fakes") / F.nullif(F.col("fakes") + F.col("reals"), F.lit(0)) * 100)


def terms(df: DataFrame, column: str, size: int) -> DataFrame:
    """Most frequent values; ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("doc_count")).orderBy(F.desc("doc_count"), column).limit(size)


def by_source(df: DataFrame, size: int = 10) -> DataFrame:
    return (
        df.groupBy("source")
        .agg(F.count("is_fake").alias("total"), F.sum("is_fake").alias("fakes"))
        .withColumn("reals", F.col("total") - F.col("fakes"))
        .orderBy(F.desc("total"), "source")
        .limit(size)
    )


def by_language(df: DataFrame) -> DataFrame:
    return df.groupBy("language").agg(F.count("*").alias("articles")).orderBy(F.desc("articles"), "language")


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS, by: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal bins of [0, 1], the last one closed."""
    slot = F.least(F.floor(F.col(column) * bins), F.lit(bins - 1)).cast("int")
    groups = [by] if by else []
    return df.groupBy(*groups, slot.alias("bin")).agg(F.count("*").alias("articles")).orderBy(*groups, "bin")


def word_frequencies(df: DataFrame, n: int = 30, column: str = "title") -> DataFrame:
    word = F.col("word")
    return (
        df.filter(F.col(column).isNotNull())
        .select(F.explode(text.words(F.col(column))).alias("word"))
        .filter((F.char_length(word) > 3) & ~word.isin(*text.STOP_WORDS))
        .groupBy("word")
        .agg(F.count("*").alias("frequency"))
        .orderBy(F.desc("frequency"), "word")
        .limit(n)
    )


# Date histograms --------------------------------------------------------------------------------


def date_histogram(
    df: DataFrame,
    every: str,
    metrics: dict[str, Column],
    *,
    column: str = "processed_at",
    fill: bool = True,
    zero: Sequence[str] = (),
) -> DataFrame:
    """``metrics`` per time bucket. With ``fill`` the empty buckets between the first and
    the last are kept, their ``zero`` metrics 0 and the others null.

    The spine is a sequence between the smallest and largest bucket, as long as the
    time span and not the data.
    """
    counts = df.groupBy(F.window(column, every).alias("_w")).agg(*[c.alias(n) for n, c in metrics.items()])
    counts = counts.select(F.col("_w.start").alias("bucket"), *metrics)
    if not fill:
        return counts.orderBy("bucket")
    first, last = F.min("bucket"), F.max("bucket")
    spine = counts.agg(F.sequence(first, last, F.expr(f"INTERVAL {every}")).alias("_all")).select(
        F.explode("_all").alias("bucket")
    )
    joined = spine.join(counts, "bucket", "left")
    return joined.fillna(0, list(zero)).orderBy("bucket")


def count_metrics() -> dict[str, Column]:
    return {
        "articles": F.count("*"),
        "fakes": F.count_if(F.col("is_fake") == 1),
        "reals": F.count_if(F.col("is_fake") == 0),
    }


def panel_metrics() -> dict[str, Column]:
    return {
        "fake_ratio": F.avg("is_fake"),
        "avg_confidence": F.avg("confidence"),
        "max_drift_score": F.max("drift_score"),
        "max_drift_active": F.max(F.col("drift_active").cast("int")),
    }


def metric_histogram(df: DataFrame, every: str = "1 hour") -> DataFrame:
    return date_histogram(df, every, panel_metrics(), fill=True).withColumn("fake_percent", F.col("fake_ratio") * 100)


def last_not_null(buckets: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric, its value in the newest bucket that has one."""
    return buckets.agg(*[F.max_by(m, F.when(F.col(m).isNotNull(), F.col("bucket"))).alias(m) for m in metrics])


def status_panels(df: DataFrame, every: str = "1 hour") -> DataFrame:
    """The single-value panels: reduced series, colour band and display text."""
    metrics = {**count_metrics(), **panel_metrics()}
    buckets = date_histogram(df, every, metrics, fill=False)
    last = lambda m: F.max_by(m, F.when(F.col(m).isNotNull(), F.col("bucket")))
    row = buckets.agg(
        F.sum("articles").alias("total"),
        F.sum("fakes").alias("fakes"),
        last("fake_ratio").alias("fake_ratio"),
        last("max_drift_score").alias("drift_score"),
        F.avg("avg_confidence").alias("mean_confidence"),
        last("max_drift_active").alias("drift_active"),
    )
    return row.select(
        "*",
        scores.band(F.col("total"), scores.TOTAL_BANDS).alias("total_colour"),
        scores.band(F.col("fakes"), scores.FAKE_COUNT_BANDS).alias("fakes_colour"),
        scores.band(F.col("fake_ratio"), scores.FAKE_RATE_BANDS).alias("fake_ratio_colour"),
        scores.band(F.col("fake_ratio") * 100, scores.FAKE_RATE_BANDS).alias("fake_percent_colour"),
        scores.band(F.col("drift_score"), scores.DRIFT_BANDS).alias("drift_colour"),
        scores.band(F.col("mean_confidence"), scores.CONFIDENCE_BANDS).alias("confidence_colour"),
        scores.value_map(F.col("drift_active"), scores.DRIFT_ACTIVE_LABELS).alias("drift_active_text"),
    )


# Validation -------------------------------------------------------------------------------------


def validate(df: DataFrame) -> DataFrame:
    """Add ``violations``, the names of the document rules a row breaks. No row is removed."""
    rules = {f"{c}_missing": F.col(c).isNull() for c in ("id", "title", "is_fake", "processed_at") if c in df.columns}
    rules |= {f"{c}_missing": F.lit(True) for c in ("id", "title", "is_fake", "processed_at") if c not in df.columns}
    types = {
        **dict.fromkeys(("id", "title", "body", "url", "source"), ("string",)),
        "is_fake": ("int",),
        **dict.fromkeys(("confidence", "p_fake", "drift_score"), ("double",)),
        "processed_at": ("timestamp", "timestamp_ntz", "string"),
    }
    kinds = dict(df.dtypes)
    rules |= {f"{c}_type": F.lit(True) for c, ok in types.items() if c in kinds and kinds[c] not in ok}
    for c in ("is_fake", "confidence", "p_fake"):
        if c in kinds:
            rules[f"{c}_range"] = (F.col(c) < 0) | (F.col(c) > 1)
    broken = F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return df.withColumn("violations", F.filter(broken, lambda v: v.isNotNull()))


def violation_counts(df: DataFrame) -> DataFrame:
    return (
        validate(df)
        .select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("rows"))
        .orderBy("rule")
    )

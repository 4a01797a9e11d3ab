"""Raw article records: stream scan, decoding, publishing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions import text
from newslens.plans.ordered import first_per_key

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "title", "body", "url", "source", "source_category", "language", "timestamp")]
    + [T.StructField("gdelt_tone", T.FloatType())]
)

# Fixed values.
ROWS_PER_TRIGGER = 1000
TRIGGER = "5 seconds"
DEFAULTS = {"body": "", "url": "", "source": "", "source_category": "unknown", "language": "en"}


def read_articles(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Stream of raw articles.

    ``kafka``: decoded message values, from the earliest offset, at most 1,000 rows per
    trigger, tolerant of lost offsets; ``options`` name brokers and topic and may override.
    Any other format is a directory of files holding the article columns.
    """
    if fmt == "kafka":
        settings = {
            "startingOffsets": "earliest",
            "maxOffsetsPerTrigger": str(ROWS_PER_TRIGGER),
            "failOnDataLoss": "false",
            **options,
        }
        return decode(spark.readStream.format("kafka").options(**settings).load())
    path = options.pop("path")
    return spark.readStream.format(fmt).schema(RAW_SCHEMA).options(**options).load(path)


def decode(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """JSON ``value`` to article columns; text that is not such JSON gives all nulls."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("d")).select("d.*")


def or_default(column: str, default: str) -> Column:
    """The default also replaces an empty string."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default)).alias(column)


def enrich(df: DataFrame, now: datetime | Column) -> DataFrame:
    """Fill in defaults and stamp the processing time."""
    moment = now if isinstance(now, Column) else F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f") + "+00:00").cast("timestamp")
    kept = [c for c in df.columns if c not in (*DEFAULTS, "timestamp", "gdelt_tone", "processed_at")]
    return df.select(
        *kept,
        *[or_default(c, d) for c, d in DEFAULTS.items()],
        F.coalesce(F.try_to_timestamp(F.nullif(F.col("timestamp"), F.lit(""))), moment).alias("timestamp"),
        F.coalesce(F.col("gdelt_tone").cast("double"), F.lit(0.0)).alias("gdelt_tone"),
        moment.alias("processed_at"),
    )


def with_ids(df: DataFrame) -> DataFrame:
    """Give articles without an id the id of their content, so that no later step loses them."""
    content = text.content_id(F.coalesce("url", F.lit("")), F.col("title"))
    return df.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), content))


def keyed_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Message form of articles: key is the id, value the whole row as JSON."""
    return df.select(F.col("id").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def publish(df: DataFrame, fmt: str, **options: str) -> None:
    """Write keyed JSON messages to a topic (``kafka``) or, for any other format, a folder."""
    writer = keyed_json(df).write.format(fmt).options(**{k: v for k, v in options.items() if k != "path"})
    writer.save() if fmt == "kafka" else writer.mode("append").save(options["path"])


def dedup_ingest(df: DataFrame, event_time: str | None = None, delay: str = "1 hour", order: Sequence[str] = ()) -> DataFrame:
    """One row per content id.

    In a batch exact over the whole input: the first row of an id in ``order``, which must be
    unique within the id. On a stream give ``event_time``: ids are remembered for ``delay``.
    """
    if df.isStreaming:
        if event_time is None:
            raise ValueError("a stream needs an event-time column")
        return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id"])
    if not order:
        raise ValueError("a batch needs an order that names the row to keep")
    return first_per_key(df, "id", order)


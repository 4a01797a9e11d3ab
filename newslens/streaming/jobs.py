"""The two streaming jobs: scoring, and monitoring with all sinks.

The first scores raw articles with the newest published weights, stores and indexes them
batch by batch. The second follows the scored batches: it drops repeated articles, runs the
drift monitor and writes the articles' drift columns, drift alerts, reservoir and
online-learning steps. Each has its own checkpoint; both write per-batch folders that a
retry replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from newslens.functions import text
from newslens.functions.sequential import Settings
from newslens.operators import model
from newslens.operators.articles import valid
from newslens.operators.drift import alert_payloads
from newslens.plans.storage import discard, scratch_path
from newslens.sources import sinks
from newslens.sources.articles import RAW_SCHEMA, TRIGGER, dedup_ingest, enrich, read_articles, with_ids
from newslens.sources.corpora import is_missing
from newslens.streaming.monitor import monitor_stream

SCORED_SCHEMA = T.StructType(
    [
        *[f for f in RAW_SCHEMA.fields if f.name not in ("timestamp", "gdelt_tone")],
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("gdelt_tone", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("is_fake", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("p_fake", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass
class Job:
    """Folders and choices of a deployment. ``key`` is the column that names a sequence."""

    root: str
    key: str = "source"
    watermark: str = "1 hour"
    files_per_trigger: int = 100
    reservoir_rows: int = model.RESERVOIR_ROWS
    new_rows: int | None = model.NEW_ROWS
    replay_rows: int = model.REPLAY_ROWS
    sync_every: int = model.SYNC_EVERY
    settings: Settings = field(default_factory=Settings)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


def _start(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime=TRIGGER).start()


def start_scoring(
    spark: SparkSession,
    job: Job,
    fmt: str,
    score: Callable[[DataFrame], DataFrame] | None = None,
    once: bool = False,
    **options: str,
) -> StreamingQuery:
    """Score raw articles batch by batch. Without ``score`` the newest published weights do it."""
    raw = with_ids(valid(read_articles(spark, fmt, **options)))

    def each(batch: DataFrame, batch_id: int) -> None:
        done = enrich(batch, F.current_timestamp())
        if score is not None:
            scored = score(done)
        else:
            weights = sinks.latest_weights(spark, job.at("weights"))
            scored = model.score_with_weights(done, model.empty_weights(spark) if weights is None else weights)
        columns = [F.col(f.name).cast(f.dataType) for f in SCORED_SCHEMA if f.name != "batch_id"]
        sinks.write_batch(scored.select(*columns), job.at("scored"), batch_id)
        written = spark.read.parquet(f"{job.at('scored')}/batch_id={batch_id}")
        store_arrivals(job, written, batch_id)

    return _start(raw, each, job.at("checkpoints/scoring"), once)


def store_arrivals(job: Job, scored: DataFrame, batch_id: int) -> None:
    """Store and index every scored article, however late: the monitor forgets ids beyond its
    watermark, the store does not depend on it. A row that the monitor writes replaces this one."""
    number = sinks.ARRIVALS + batch_id
    articles = scored.withColumns({"drift_score": F.lit(0.0), "drift_active": F.lit(False)})
    sinks.upsert_articles(articles, number, job.at("articles"), ["timestamp", "processed_at"])
    sinks.write_postings(sinks.last_per_id(articles.select("id", "title", "body", "timestamp"), ["timestamp"]), number, job.at("index"))


def start_monitoring(spark: SparkSession, job: Job, once: bool = False) -> StreamingQuery:
    """Follow the scored articles: dedup, drift monitor, and every table that is kept.

    Ids are remembered by processing time, so an article with an old date of its own is
    kept; a scoring batch that was retried is recognised by its ids.
    """
    files = spark.readStream.schema(SCORED_SCHEMA).option("maxFilesPerTrigger", job.files_per_trigger)
    scored = files.parquet(job.at("scored")).drop("batch_id")
    fresh = dedup_ingest(scored, "processed_at", job.watermark)
    watched = monitor_stream(fresh, ["processed_at", "id"], job.key, settings=job.settings)

    def each(batch: DataFrame, batch_id: int) -> None:
        path = scratch_path(spark, "micro-batch")
        try:
            batch.write.parquet(path)
            stored = spark.read.schema(batch.schema).parquet(path)
            if not stored.isEmpty():
                write_outputs(spark, job, stored, batch_id)
        finally:
            discard(spark, path)

    return _start(watched, each, job.at("checkpoints/monitoring"), once)


def write_outputs(spark: SparkSession, job: Job, batch: DataFrame, batch_id: int) -> None:
    """All tables of one micro-batch. Safe to repeat."""
    articles = batch.withColumn("drift_score", F.col("composite_score"))
    kept = [f.name for f in SCORED_SCHEMA if f.name != "batch_id"] + ["drift_score", "drift_active"]
    sinks.upsert_articles(articles.select(*kept), batch_id, job.at("articles"), ["timestamp", "processed_at"])
    alerts = alert_payloads(batch.withColumn("_batch", F.lit(batch_id)), "_batch", key=[job.key])
    sinks.write_drift_alerts(alerts, batch_id, job.at("drift"))
    learn(spark, job, batch, batch_id)


def learn(spark: SparkSession, job: Job, batch: DataFrame, batch_id: int) -> None:
    """Update the reservoir and take one online step; publish the weights every so many steps.

    State is read from the last step before this batch, so a retried batch starts from the
    same point. The predicted label serves as training label.
    """
    body = text.train_text(F.col("title"), F.col("body"))
    examples = batch.select("id", body.alias("text"), F.col("is_fake").alias("label"), "processed_at")
    previous = _before(spark, job.at("steps"), batch_id)
    reservoir, weights, number = None, model.empty_weights(spark), 0
    if previous is not None:
        number = previous["step"]
        reservoir = spark.read.parquet(f"{job.at('reservoir')}/batch_id={previous['batch_id']}")
        weights = spark.read.parquet(f"{job.at('learner')}/batch_id={previous['batch_id']}")
    updated = model.reservoir_update(reservoir, examples.drop("processed_at"), job.reservoir_rows)
    sinks.write_batch(updated, job.at("reservoir"), batch_id)
    updated = spark.read.parquet(f"{job.at('reservoir')}/batch_id={batch_id}")
    rows = model.training_batch(examples, updated, ["processed_at", "id"], batch_id, job.new_rows, job.replay_rows)
    rows = rows.withColumn("row", F.concat_ws("-", "id", F.col("replayed").cast("string")))
    # With sequences per key the highest recommended rate counts for the shared model.
    lr = batch.groupBy(job.key).agg(F.max_by("recommended_lr", "message_index").alias("lr")).agg(F.max("lr")).first()[0]
    new, report = model.online_step(weights, rows.select("row", "text", "label"), lr, number + 1)
    sinks.write_batch(new, job.at("learner"), batch_id)
    # "examples" counts the whole batch, though only its first rows are trained on.
    log = report.select("loss", F.lit(lr).alias("lr"), F.lit(number + 1).cast("long").alias("step"), F.lit(batch.count()).cast("long").alias("examples"))
    sinks.write_batch(log, job.at("steps"), batch_id)
    if (number + 1) % job.sync_every == 0:
        sinks.publish_weights(spark.read.parquet(f"{job.at('learner')}/batch_id={batch_id}"), job.at("weights"), number + 1)


def _before(spark: SparkSession, root: str, batch_id: int):
    """The newest step of an earlier batch. That is nearly always the batch before; only
    after a batch without rows are all step folders listed."""
    try:
        last = spark.read.parquet(f"{root}/batch_id={batch_id - 1}")
        return last.withColumn("batch_id", F.lit(batch_id - 1)).first()
    except AnalysisException as error:
        if not is_missing(error):
            raise
    steps = sinks.read_batches(spark, root)
    if steps is None:
        return None
    return steps.filter(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()


def stop_gracefully(query: StreamingQuery) -> None:
    """Finish the rows that have arrived, then stop."""
    query.processAllAvailable()
    query.stop()

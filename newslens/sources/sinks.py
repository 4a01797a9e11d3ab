"""Tables the jobs write: articles by batch, postings, drift alerts, alert history, weights.

Every batch goes to a folder named after its number, replaced when the batch is retried,
so a replayed batch changes nothing. Reading takes the newest row per key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.operators.articles import newest
from newslens.operators.search import Index, build_index, index_of, read_index, store_index, write_index
from newslens.plans.ordered import first_per_key
from newslens.plans.storage import discard, folders, stored_bytes
from newslens.sources.corpora import CSV, is_missing

#: Messages keep the whole time stamp.
MOMENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All batches with their ``batch_id``, or None before the first one."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    try:
        found = reader.parquet(root)
        return found.withColumn("batch_id", F.col("batch_id").cast("long"))
    except AnalysisException as error:
        if is_missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


# Versions: written whole, then announced ---------------------------------------------------------


def write_version(df: DataFrame, root: str, version: int, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as a version. Readers see it only once its marker, written last, exists."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/data/version={version}")
    _announce(df.sparkSession, root, version)


def _announce(spark: SparkSession, root: str, version: int, **facts: int) -> None:
    marker = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in {"version": version, **facts}.items()])
    marker.coalesce(1).write.mode("overwrite").parquet(f"{root}/published/n={version}")


def latest_version(spark: SparkSession, root: str) -> int | None:
    try:
        return spark.read.parquet(f"{root}/published/*").agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    version = latest_version(spark, root) if version is None else version
    return None if version is None else spark.read.parquet(f"{root}/data/version={version}")


def publish_weights(weights: DataFrame, root: str, version: int) -> None:
    write_version(weights, root, version)


def latest_weights(spark: SparkSession, root: str) -> DataFrame | None:
    return read_version(spark, root)


#: Least number of buckets of the merged articles, unless the deployment gives another.
BUCKETS = 32
#: Stored bytes that a bucket of them should not exceed by much.
BUCKET_BYTES = 64 << 20
#: Batches of arrived articles are numbered from here; any batch of the monitor comes after them.
ARRIVALS = -(1 << 40)

# Articles ---------------------------------------------------------------------------------------


def last_per_id(df: DataFrame, order: Sequence[str], key: str = "id") -> DataFrame:
    """Newest row per id, exactly one. One narrow row per id and task is left before the
    shuffle, so an id sent over and over does not overload one task; whole rows are only filtered."""
    return first_per_key(df, key, order, last=True)


def upsert_articles(batch: DataFrame, batch_id: int, root: str, order: Sequence[str] = ("timestamp",)) -> None:
    """Store a batch of articles, one row per id; a later batch replaces earlier rows on read."""
    write_batch(last_per_id(batch, order), f"{root}/log", batch_id)


def _table_name(path: str) -> str:
    return f"newslens_base_{hashlib.md5(path.encode()).hexdigest()}"


def write_base(df: DataFrame, root: str, version: int, buckets: int) -> None:
    """Write the merged articles as a version, in buckets of the id and by day within them.

    Readers that join it by id then need not move it; one that asks for days skips row groups. There
    are as many files as buckets, whatever time the articles span. A bucket is one task's work.
    """
    spark, path = df.sparkSession, f"{root}/data/version={version}"
    discard(spark, path)  # of an attempt that did not get as far as its marker
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    dated = df.withColumn("processed_date", F.to_date("processed_at"))
    dealt = dated.repartition(buckets, "id")
    dealt.write.bucketBy(buckets, "id").sortBy("processed_date").option("path", path).format("parquet").saveAsTable(_table_name(path))
    _announce(spark, root, version, buckets=buckets)


def read_base(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The articles of a version. The session's catalog is told of the files' buckets where it does
    not know them, as in a session that did not write them."""
    path = f"{root}/data/version={version}"
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        buckets = spark.read.parquet(f"{root}/published/n={version}").first()["buckets"]
        fields = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY (processed_date) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _newer_rows(log: DataFrame, upto: int | None) -> DataFrame:
    """Last write per id of the batches that no base holds yet."""
    if upto is not None:
        log = log.filter((F.col("batch_id") > upto) | (F.col("batch_id") < 0))
    return last_per_id(log, ["batch_id"]).drop("batch_id")


def _merged(base: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of the base that no newer row replaces, and the newer rows.

    The base stays where it is: its buckets meet the newer ids, which alone are shuffled, or sent
    to all where Spark measures them as small. A bucket's share of those ids is hashed in its
    task, so compact before they are many.
    """
    kept = base.join(newer.select("id").hint("shuffle_hash"), "id", "left_anti")
    return kept.select(*newer.columns).unionByName(newer)


def current_articles(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored articles, last write per id."""
    upto = latest_version(spark, f"{root}/base")
    log = read_batches(spark, f"{root}/log")
    if log is None:
        return None
    newer = _newer_rows(log, upto)
    return newer if upto is None else _merged(read_base(spark, f"{root}/base", upto), newer)


def compact_articles(spark: SparkSession, root: str, upto: int, buckets: int = BUCKETS) -> None:
    """Merge all batches up to ``upto`` into a base bucketed by id; nothing, if that was done. There are
    ``buckets`` or, for a large base, more, so that each fits a task."""
    done = latest_version(spark, f"{root}/base")
    if done is not None and done >= upto:
        return
    newer = _newer_rows(read_batches(spark, f"{root}/log").filter(F.col("batch_id") <= upto), done)
    merged = newer if done is None else _merged(read_base(spark, f"{root}/base", done), newer)
    held = [f"{root}/log"] if done is None else [f"{root}/log", f"{root}/base/data/version={done}"]
    buckets = max(buckets, -(-sum(stored_bytes(spark, path) for path in held) // BUCKET_BYTES))
    write_base(merged, f"{root}/base", upto, buckets)


def upsert_report(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """How many ids of a batch are new and how many are replaced."""
    ids = batch.select("id").distinct()
    zero = F.lit(0).cast("long")
    sizes = ids.agg(F.count("*").alias("ids"), zero.alias("updates"))
    if current is not None:
        # The batch is the small side; the stored ids are only filtered by it.
        known = current.select("id").join(ids, "id", "left_semi").agg(zero.alias("ids"), F.countDistinct("id").alias("updates"))
        sizes = sizes.unionByName(known).agg(F.sum("ids").alias("ids"), F.sum("updates").alias("updates"))
    return sizes.select((F.col("ids") - F.col("updates")).alias("inserts"), "updates")


def write_postings(batch: DataFrame, batch_id: int, root: str) -> None:
    """Index a batch of articles beside the article log: a segment with its ids, fields, postings, lengths
    and the terms that occur in it."""
    write_index(build_index(batch).fields, lambda name: f"{root}/{name}/batch_id={batch_id}", "overwrite")
    write_batch(batch.select("id"), f"{root}/ids", batch_id)  # an article without a word left is one, too


def _segments(spark: SparkSession, root: str, upto: int | None, names: Sequence[str]) -> tuple[DataFrame, ...] | None:
    """The named tables of the segments that no base holds yet."""
    parts = [read_batches(spark, f"{root}/{name}") for name in names]
    if any(p is None for p in parts):
        return None
    return tuple(p if upto is None else p.filter((F.col("batch_id") > upto) | (F.col("batch_id") < 0)) for p in parts)


def _newest(ids: DataFrame) -> DataFrame:
    return ids.groupBy("id").agg(F.max("batch_id").alias("newest"))


def _live(df: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of the batch that has their id last. The join is on the id alone, so one deal by it serves
    what groups the rows by id next; a task's share of the ids is hashed, and the rows are not sorted."""
    seen = newest.select(F.col("id").alias("_id"), "newest").hint("shuffle_hash")
    return df.join(seen, (F.col("id") == F.col("_id")) & (F.col("batch_id") >= F.col("newest")), "left_semi").drop("batch_id")


def _without(df: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of a base whose id no later batch has."""
    return df.join(newest.select("id").hint("shuffle_hash"), "id", "left_anti")


def current_index(spark: SparkSession, root: str) -> Index | None:
    """The stored index with each article's newest text only.

    The base holds merged segments. An article that a later segment has again is dead before it;
    only the articles of the later segments are grouped for that, and a search filters
    the postings by term before they meet them. Document frequencies are counted on the live
    postings of the terms that are asked for; the segments' dictionaries only name the terms.
    """
    upto = latest_version(spark, f"{root}/base")
    later = _segments(spark, root, upto, ("ids", "postings", "lengths", "terms"))
    if later is None:  # no segment yet, or none that was not merged and discarded
        return None if upto is None else read_index(spark, f"{root}/base/data/version={upto}")
    ids, postings, lengths, terms = later
    newest = _newest(ids)
    live = lambda df: _live(df, newest)
    names = terms.select("field", "term")
    if upto is None:
        return Index(live(postings), live(lengths), names=names.distinct())
    base = read_index(spark, f"{root}/base/data/version={upto}")
    if ids.isEmpty():
        return base
    old = lambda df: _without(df, newest)
    merged = [old(before).unionByName(live(after)) for before, after in ((base.postings, postings), (base.lengths, lengths))]
    return Index(*merged, names=base.terms.select("field", "term").unionByName(names).distinct())


def compact_index(spark: SparkSession, root: str, upto: int) -> None:
    """Merge the segments up to ``upto`` into a base: live postings by term, lengths, dictionary and
    statistics. Nothing, if that was done. The fields are merged, which are few beside their postings, and
    stored anew."""
    done = latest_version(spark, f"{root}/base")
    if done is not None and done >= upto:
        return
    later = _segments(spark, root, done, ("ids", "fields"))
    if later is None:
        return
    ids, fields = (df.filter(F.col("batch_id") <= upto) for df in later)
    newest = _newest(ids)
    live = _live(fields, newest)
    if done is not None:
        live = _without(spark.read.parquet(f"{root}/base/data/version={done}/fields"), newest).unionByName(live)
    path = f"{root}/base/data/version={upto}"
    discard(spark, path)  # of an attempt that did not get as far as its marker
    store_index(index_of(live), path)
    _announce(spark, f"{root}/base", upto)


def discard_merged(spark: SparkSession, root: str) -> None:
    """Remove what the last merge of an index replaced: its segments, but for their ids, and the bases before
    it. For when nothing reads an index of before the merge any more."""
    upto = latest_version(spark, f"{root}/base")
    if upto is None:
        return
    old = [f"{root}/{name}/{f}" for name in ("fields", "postings", "lengths", "terms") for f in folders(spark, f"{root}/{name}") if 0 <= _number(f) <= upto]
    old += [f"{root}/base/data/{f}" for f in folders(spark, f"{root}/base/data") if 0 <= _number(f) < upto]
    for path in old:
        discard(spark, path)


def _number(folder: str) -> int:
    """Of a batch or version; -1 of anything else."""
    return int(found[1]) if (found := re.fullmatch(r"(?:batch_id|version)=(\d+)", folder)) else -1


# Drift alerts and alert history -----------------------------------------------------------------


def write_drift_alerts(alerts: DataFrame, batch_id: int, root: str, fmt: str = "json", **options: str) -> None:
    """Store alerts with their batch number and send them as JSON messages."""
    write_batch(alerts, f"{root}/rows", batch_id)
    messages = alerts.select(F.to_json(F.struct("*"), {"timestampFormat": f"{MOMENT}XXX", "timestampNTZFormat": MOMENT}).alias("value"))
    if fmt == "kafka":
        messages.write.format("kafka").options(**options).save()
    else:
        messages.write.mode("overwrite").text(f"{root}/messages/batch_id={batch_id}")


def append_alerts(alerts: DataFrame, path: str, batch_id: int) -> None:
    """Add an evaluation's alerts to the history; the same evaluation again replaces itself."""
    write_batch(alerts, path, batch_id)


def recent_alerts(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    return newest(read_batches(spark, path).drop("batch_id"), limit, "timestamp", ("metric", "severity"))


# Export -----------------------------------------------------------------------------------------


def export_csv(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write the given columns as CSV with a header; nested values as JSON text."""
    kinds = {f.name: f.dataType for f in df.schema}
    nested = (T.StructType, T.ArrayType, T.MapType)
    shown = [F.to_json(c).alias(c) if isinstance(kinds[c], nested) else F.col(c) for c in columns]
    df.select(*shown).write.mode("overwrite").options(**CSV).csv(path)

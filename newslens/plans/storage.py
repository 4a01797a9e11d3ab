"""Where intermediate tables go, and how large a frame may be to be broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a session that runs in one process, which has
    no other machine to share with, may do without and gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_dirs[app] = tempfile.mkdtemp(prefix="newslens-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/newslens/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, fixes the outcome of any step whose result could change on
    recomputation, and stays columnar so later reads keep column pruning and
    filter push-down. Survives executor loss.
    """
    return stored(df, scratch_path(df.sparkSession, label))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back; with ``scratch_path`` and ``discard`` for a
    table that its user can tell the end of."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files in a folder, in whatever store it lies."""
    place, store = _place(spark, path)
    return store.getContentSummary(place).getLength()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in whatever store; none without it."""
    place, store = _place(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


@contextmanager
def shuffles_discarded(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files when it ends. Else they stay until the driver happens to
    collect its garbage, and large ones of steps that follow each other add up."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named, in whatever store it lies."""
    place, store = _place(spark, path)
    store.delete(place, True)

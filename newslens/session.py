"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app: str) -> SparkSession.Builder:
    """Cluster session: master, executors and shuffle partitions come from the submit command."""
    made = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        made = made.config(name, value)
    return made


def local_session(app: str, cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the bench."""
    session = (
        builder(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session

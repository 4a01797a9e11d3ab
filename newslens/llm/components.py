"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.plans.storage import discard, scratch_path, stored

ROUNDS = 60
FILE_ROWS = 500_000
#: Edges whose nodes may be sent to all; Spark sizes the nodes of more by the packed bytes of one end.
SENT_ROWS = 500_000


def _star(edges: DataFrame, whole: bool, sent: bool) -> DataFrame:
    """Edges (a, b) hung on the smallest neighbour of each node: of the larger ends of all its
    edges (``whole``), or of the smaller ends of the edges in which it is the larger. Only with
    ``sent`` may the nodes be sent to all."""
    if whole:
        edges = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    met = edges.join(lowest if sent else lowest.hint("merge"), "a")
    if whole:
        low = F.least("a", "low")
        return met.filter("b > a").select(F.col("b").alias("a"), low.alias("b"))
    return met.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """node and component (its smallest node) of every node of the edges (a, b), a stored table.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones;
    stars around the smallest nodes remain after a number of rounds that grows with the
    logarithm of the longest path. Neighbours are never gathered: their minimum is a partial
    aggregate, and the join back to the edges may be split where a node has very many.

    With ``rounds`` it stops after so many; nodes of one component may then still be apart,
    nodes of different ones never come together.
    """
    stars = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before, path, rows = None, None, edges.count()
    for _ in range(rounds or ROUNDS):
        last, path = path, scratch_path(edges.sparkSession, "stars")
        # few edges need few files, whatever the number of shuffle partitions
        sent = rows <= SENT_ROWS
        stars = stored(_star(_star(stars, True, sent), False, sent).distinct().coalesce(-(-rows // FILE_ROWS) or 1), path)
        if last:
            discard(edges.sparkSession, last)
        # two numbers; not by an Observation, which a session cannot run Spark ML beside
        state = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state[0] == 0 or state == before:
            break
        before, rows = state, state[0]
    else:
        if not rounds:
            raise RuntimeError(f"no end after {ROUNDS} rounds")
    own = stars.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), "b"))).alias("e"))
    return own.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("component"))

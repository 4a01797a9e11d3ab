"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

A vector x is centred, rotated by a random orthogonal matrix and reduced to the signs of its
coordinates, packed into bytes. With r = |x - c|, the unit vector o = R(x - c) / r and its
code s in {-1, 1}^D / sqrt(D), the inner product with a rotated query is estimated as

    <x, q>  ~  <c, q> + r <s, Rq> / <s, o>

with an error that exceeds r |q| sqrt((1 - f^2) / f^2) E / sqrt(D - 1), f = <s, o>, only with a
probability that falls like exp(-E^2). The code and the two scalars r and f are the index.
<s, Rq> is twice the sum of Rq over the code's set bits, less the sum of Rq. In each block the true scores of the best estimates give a bar; every vector whose upper
bound reaches the bar is ranked by its true score in double precision.

Queries and rows meet in blocks of bounded size, each pair of blocks in a task of its own;
what leaves a task is the ``k`` nearest of each query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import schema_of
from newslens.plans.storage import materialise

K = 20
ERROR = 2.5
FIRST_LOOK = 4  # times as many estimates as results give the bar
SAMPLE = 4096
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
QUERIES_AT_ONCE = 128
SEED = 7


@dataclass(frozen=True)
class Index:
    """Centre and rotation; coordinates beyond the vectors' own are zero before rotating."""

    centre: np.ndarray
    rotation: np.ndarray
    error: float

    @classmethod
    def fit(cls, sample: np.ndarray, error: float = ERROR, seed: int = SEED) -> Index:
        """Centre of a sample of vectors, and a rotation that depends on the seed alone."""
        dims = sample.shape[1]
        wide = -(-dims // 8) * 8
        q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(wide, wide)))
        return cls(sample.mean(axis=0) if len(sample) else np.zeros(dims), q * np.sign(np.diag(r)), error)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        return x @ self.rotation[:, : x.shape[1]].T

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed codes, distances from the centre and correction scalars <s, o>."""
        turned = self.rotate(x - self.centre)
        bits = turned > 0
        far = np.linalg.norm(turned, axis=1)
        fit = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]) / np.where(far > 0, far, 1)
        return np.packbits(bits, axis=1, bitorder="little"), far, np.where(far > 0, fit, 1)

    def estimates(self, queries: np.ndarray, codes: np.ndarray, far: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (query, row) and the half-width of their bounds."""
        turned = self.rotate(queries).astype(np.float32)
        wide = turned.shape[1]
        bits = np.unpackbits(codes, axis=1, bitorder="little").astype(np.float32)
        signs = (2 * (turned @ bits.T) - turned.sum(axis=1, keepdims=True)) / np.float32(np.sqrt(wide))
        middle = signs * (far / fit).astype(np.float32) + (queries @ self.centre).astype(np.float32)[:, None]
        spread = far * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * self.error / np.sqrt(max(wide - 1, 1))
        return middle, np.linalg.norm(queries, axis=1).astype(np.float32)[:, None] * spread.astype(np.float32) + np.float32(1e-5)


def search_block(index: Index, k: int, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, codes: np.ndarray, far: np.ndarray, fit: np.ndarray) -> pd.DataFrame:
    """The ``k`` nearest rows of the block for each query, but the query's own row.

    Equal vectors are scored once, by their k + 1 smallest ids; ties go to smaller ids.
    """
    order = np.argsort(ids, kind="stable")
    ids, rows, codes, far, fit = ids[order], rows[order], codes[order], far[order], fit[order]
    distinct, first, member = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    codes, far, fit = codes[first], far[first], fit[first]
    member = member.ravel()
    grouped = np.argsort(member, kind="stable")
    begin = np.searchsorted(member[grouped], np.arange(len(distinct) + 1))
    need, first_look = min(k + 1, len(distinct)), min(FIRST_LOOK * (k + 1), len(distinct))
    out = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[at : at + QUERIES_AT_ONCE]
        middle, spread = index.estimates(some, codes, far, fit)
        best = np.argpartition(-middle, first_look - 1, axis=1)[:, :first_look]
        true = np.einsum("qd,qnd->qn", some, distinct[best])
        bar = -np.partition(-true, need - 1, axis=1)[:, need - 1]  # so many vectors reach it
        reach = middle + spread >= bar[:, None]
        np.put_along_axis(reach, best, False, axis=1)
        for i in range(len(some)):
            more = np.flatnonzero(reach[i])
            seen = np.concatenate([best[i], more])
            score = np.concatenate([true[i], distinct[more] @ some[i]])
            enough = np.partition(score, len(score) - need)[len(score) - need]
            high = score >= enough
            top = seen[high]
            spans = [grouped[begin[d] : min(begin[d + 1], begin[d] + k + 1)] for d in top]
            found = ids[np.concatenate(spans)]
            points = np.repeat(score[high], [len(s) for s in spans])
            other = found != query_ids[at + i]
            found, points = found[other], points[other]
            rank = np.lexsort((found, -points))[:k]
            out.append((np.full(len(rank), query_ids[at + i]), found[rank], points[rank]))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))


def coded(rows: DataFrame, index: Index) -> DataFrame:
    """The index table: vec_id, v, packed code, distance from the centre and correction scalar of every row."""

    def run(batches):
        for batch in batches:
            codes, far, fit = index.encode(np.stack(batch["v"].to_numpy()))
            yield batch.assign(code=[c.tobytes() for c in codes], far=far, fit=fit)

    return rows.mapInPandas(run, schema_of("vec_id bigint, v array<double>, code binary, far double, fit double"))


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part: vectors neither null nor zero, all of
    whose components are finite, of the most common length (the shorter one of equals)."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(
            F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
        )
    )
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("v") == (lengths["n"] if lengths else 0))


def nearest(df: DataFrame, queries, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, error: float = ERROR, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest rows of each query.

    ``queries`` is a condition on the column vec_id that picks the query rows. All rows are
    coded and searched; the centre alone is fitted, on at most ``sample`` rows with the smallest
    hash of their id. Null, zero and non-finite vectors take no part, as queries or as rows;
    a null id does neither. The coded rows are written to the session's shared folder once. Rows with one id count as the same row only for excluding a query's own.
    With fewer candidates than ``k``, all are returned. No rows give no rows.
    """
    rows = usable(df, vec_id, vector)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    schema = schema_of("query_id bigint, vec_id bigint, score double")
    if not drawn:
        return df.sparkSession.createDataFrame([], schema_of("query_id bigint, rank int, vec_id bigint, score double"))
    index = Index.fit(np.array([r["v"] for r in drawn]), error)
    asked = rows.filter(queries)
    table = materialise(coded(rows, index), "ann-index")
    counts = table.agg(F.count("*").alias("n"), F.count_if(queries).alias("q")).first()
    row_blocks, query_blocks = -(-counts["n"] // ROW_BLOCK), max(1, -(-counts["q"] // QUERY_BLOCK))
    spread = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n)).cast("int")
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", spread(query_blocks)).withColumn("rb", blocks(row_blocks)).groupBy("qb", "rb")
    right = table.withColumn("rb", spread(row_blocks)).withColumn("qb", blocks(query_blocks)).groupBy("qb", "rb")

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        codes = np.frombuffer(b"".join(r["code"]), np.uint8).reshape(len(r), -1)
        arrays = r["vec_id"].to_numpy(), np.stack(r["v"].to_numpy()), codes, r["far"].to_numpy(), r["fit"].to_numpy()
        return search_block(index, k, q["vec_id"].to_numpy(), np.stack(q["v"].to_numpy()), *arrays)

    found = left.cogroup(right).applyInPandas(search, schema)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

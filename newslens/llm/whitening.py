"""Whitening of vectors on the leading components of their covariance.

Vectors are scaled to whole numbers, so sums and deviations are exact. The covariance of the
distinct vectors is centred before multiplying and added up in the tasks. On the driver, which
sees nothing larger than this one matrix, it is brought to tridiagonal form by Householder
reflections; its leading eigenvalues are found by bisection on Sturm counts, their vectors by
inverse iteration, orthogonalised again within clusters of near eigenvalues, and reflected
back. The components go to the tasks, where every vector is projected.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from newslens.llm.common import schema_of
from newslens.plans.storage import materialise

COMPONENTS = 4
SCALE = 256
#: Eigenvalues nearer than this share of the matrix's size are one cluster.
CLUSTER = 1e-3
ITERATIONS = 4
EPS = np.finfo(float).eps
#: Rows that are projected at once.
ROWS = 4096


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections that lead there."""
    a, reflections = np.array(matrix, float), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        alpha = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= alpha
        size = np.linalg.norm(v)
        v = v / size if size > 0 else v
        reflections.append(v)
        a[k + 1, k] = a[k, k + 1] = alpha
        rest = a[k + 1 :, k + 1 :]
        p = 2 * rest @ v
        w = p - (v @ p) * v
        rest -= np.outer(v, w) + np.outer(w, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of ``at``."""
    size = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    least = size * EPS * EPS
    below, q = np.zeros(len(at), int), None
    for d, e in zip(diagonal, np.append(0, off), strict=True):
        q = d - at if q is None else d - at - e * e / q
        q = np.where(np.abs(q) < least, -least, q)  # a pivot of zero counts as below
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, largest first, each by bisection."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    wanted = n - 1 - np.arange(k)  # so many lie below it
    for _ in range(120):
        middle = (low + high) / 2
        above = sturm_counts(diagonal, off, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """Solve (T - shift) x = b by elimination with row exchanges; a zero pivot becomes a tiny one."""
    n = len(diagonal)
    least = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny) * EPS
    d, x = (diagonal - shift).tolist(), b.tolist()
    e, f = off.tolist(), [0.0] * n  # first and second superdiagonal
    for i in range(n - 1):
        under = float(off[i])
        following = e[i + 1] if i + 1 < n - 1 else 0.0
        if abs(under) > abs(d[i]):
            ratio = d[i] / under
            d[i], e[i], f[i], d[i + 1], below = under, d[i + 1], following, e[i] - ratio * d[i + 1], -ratio * following
            x[i], x[i + 1] = x[i + 1], x[i] - ratio * x[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            ratio = under / d[i]
            d[i + 1] -= ratio * e[i]
            below = following
            x[i + 1] -= ratio * x[i]
        if i + 1 < n - 1:
            e[i + 1] = below
    out = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        pivot = d[i] if abs(d[i]) >= least else least
        out[i] = (x[i] - (e[i] if i < n - 1 else 0.0) * out[i + 1] - f[i] * out[i + 2]) / pivot
    return np.array(out[:n])


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix for values in falling order."""
    n, size = len(diagonal), max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    draw, found, first = np.random.default_rng(n), np.zeros((len(values), n)), 0
    shift = np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * size:
            first = i
        # equal values get shifts of their own
        shift = min(value, shift - 10 * EPS * size) if i > first else value
        x = draw.normal(size=n)
        for _ in range(ITERATIONS):
            for _ in range(2):
                x -= found[first:i].T @ (found[first:i] @ x)
            x /= np.linalg.norm(x)
            x = solve_shifted(diagonal, off, shift, x)
            x /= np.linalg.norm(x)
        for _ in range(2):
            x -= found[first:i].T @ (found[first:i] @ x)
            x /= np.linalg.norm(x)
        found[i] = x
    return found


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix and their unit vectors (rows)."""
    size = np.abs(covariance).max(initial=0.0)
    k = min(k, len(covariance))
    if size == 0:
        return np.zeros(k), np.eye(len(covariance))[:k]
    diagonal, off, reflections = tridiagonal(covariance / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = eigenvectors(diagonal, off, values)
    for i, v in reversed(list(enumerate(reflections))):
        vectors[:, i + 1 :] -= 2 * np.outer(vectors[:, i + 1 :] @ v, v)
    return values * size, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@dataclass(frozen=True)
class Whitening:
    """Number and sums of the fitted vectors, eigenvalues, components and shares of the variance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def usable(self) -> np.ndarray:
        """Components whose variance is more than rounding error."""
        floor = len(self.sums) * EPS * max(self.values.max(initial=0.0), 0.0)
        return self.values > floor

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates (row, component) of scaled vectors; NaN for a component without variance."""
        centre = np.array([s / self.n for s in self.sums])
        scale = np.sqrt(np.where(self.usable, self.values, np.nan))
        return (x - centre) @ self.vectors.T / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over dimensions of (n x - S)^2."""
        largest = self.n * float(np.abs(x.astype(float)).max(initial=0.0)) + max(map(abs, self.sums), default=0)
        if largest**2 * len(self.sums) < 2**62:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        away = x.astype(object) * self.n - np.array(self.sums, object)
        return (away * away).sum(axis=1).tolist()


def scaled(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and x, floor(scale * component) as whole numbers, of the rows that take part: vectors
    neither null nor empty, all of whose components are finite, of the most common length (the
    shorter one of equals)."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = df.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter(F.coalesce(finite, F.lit(False)) & (F.size("v") > 0))
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    whole = F.transform("v", lambda c: F.floor(F.lit(scale) * c).cast("long"))
    return good.filter(F.size("v") == (lengths["d"] if lengths else 0)).select("vec_id", whole.alias("x"))


def matrix_of(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows of ``vectors`` (column x), each counted once; None without rows.

    Each task sends a sum per dimension, then one per pair of dimensions, which Spark adds up.
    """

    def sums(batches):
        n, total = 0, None
        for batch in batches:
            x = matrix_of(batch, 0)
            whole = x.sum(axis=0).tolist() if np.abs(x.astype(float)).max(initial=0.0) * len(x) < 2**62 else x.astype(object).sum(axis=0).tolist()
            total = whole if total is None else [a + b for a, b in zip(total, whole, strict=True)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(len(total)), "n": np.full(len(total), n), "s": pa.array([str(t) for t in total])})

    parts = vectors.select("x").mapInArrow(sums, schema_of("dim bigint, n bigint, s string"))
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect()
    if not rows:
        return None
    n, totals = rows[0]["n"], tuple(int(r["s"]) for r in rows)
    centre = np.array([s / n for s in totals])
    upper = np.triu_indices(len(totals))

    def products(batches):
        total = np.zeros((len(centre), len(centre)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                away = matrix_of(batch.slice(at, ROWS), 0) - centre
                total += away.T @ away
        if total.any():
            cell = total[upper]
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cell)), "s": cell})

    cells = vectors.select("x").mapInArrow(products, schema_of("cell bigint, s double")).groupBy("cell").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(len(upper[0]))
    for r in cells:
        flat[r["cell"]] = r["s"] / n
    covariance = np.zeros((len(centre), len(centre)))
    covariance[upper] = flat
    covariance = covariance + np.triu(covariance, 1).T
    values, components = leading_components(covariance, k)
    trace = np.trace(covariance)
    return Whitening(n, totals, values, components, np.maximum(values, 0) / trace if trace > 0 else np.zeros(len(values)))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, measured over
    ``vectors`` (column x); components without variance are left out."""
    used = np.flatnonzero(model.usable)
    if not len(used):
        return 0.0

    def products(batches):
        n, first, second = 0, np.zeros(len(used)), np.zeros((len(used), len(used)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                w = model.project(matrix_of(batch.slice(at, ROWS), 0))[:, used]
                n, first, second = n + len(w), first + w.sum(axis=0), second + w.T @ w
        if n:
            cell = np.concatenate([[n], first, second.ravel()])
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cell)), "s": cell})

    rows = vectors.select("x").mapInArrow(products, schema_of("cell bigint, s double")).groupBy("cell").agg(F.sum("s").alias("s")).orderBy("cell").collect()
    cells = np.array([r["s"] for r in rows])
    n, mean = cells[0], cells[1 : len(used) + 1] / cells[0]
    covariance = cells[len(used) + 1 :].reshape(len(used), -1) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(used))).max())


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation, whitened, explained and
    identity_error, one row per vector that takes part and component.

    The fit counts equal scaled vectors once; every row is projected, repeated rows and rows with
    a null id included. Vectors that are null, empty, of another than the most common length or
    with null or non-finite components give no rows. Vectors of fewer dimensions than ``k`` have
    as many components as dimensions. A component without variance, as of equal vectors, has
    whitened null and explained 0. deviation is decimal(38,0). No rows give no rows. Other columns
    are not looked at. What comes to the driver is one matrix of dimensions squared. Tables go to
    the session's shared folder.
    """
    rows = scaled(df, vec_id, vector, scale)
    distinct = materialise(rows.select("x").distinct(), "whitening-fit")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = schema_of(f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    model = fit(distinct, k)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error, arrow = identity_error(distinct, model), to_arrow_schema(schema)
    parts = len(model.values)

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix_of(part, 1)
                owner = pa.array(np.repeat(np.arange(len(x)), parts))
                deviation = pa.array([Decimal(d) for d in model.deviations(x)], arrow.field("deviation").type).take(owner)
                whitened = model.project(x).ravel()
                columns = [
                    part.column(0).take(owner),
                    pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(owner), model.n)),
                    deviation,
                    pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(owner), error)),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(project, schema)

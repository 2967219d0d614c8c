"""Whitening of embeddings by an incremental eigendecomposition.

Vectors are put on a grid of whole numbers, and each different one counts once. Every task keeps the count, the mean and the spectrum (eigenvalues and
eigenvectors) of the scatter of its vectors and updates them vector by vector: a new vector x changes the scatter about the mean by a multiple
of (x - mean)(x - mean)', a rank-one update of a matrix whose eigenvectors are known, so the new eigenvalues are the roots of a secular
equation. Directions in which the update has no part, and all but one of equal eigenvalues, are deflated first: they stay as they are.
Spectra of two tasks are combined by as many rank-one updates as the other one has directions, and one for the distance of their means;
this goes on in groups of ``FAN`` until one is left.

What rounding has gathered is removed at the end: the covariance is projected on the eigenvectors found, in one more pass that centres each vector by
the exact mean before it multiplies, and the small projected matrix is solved (Rayleigh-Ritz). As the basis is whole, its vectors are
eigenvectors of the covariance to double precision. Sums of the vectors are exact whole numbers.

What reaches the driver is in proportion to the square of the vectors' length, never to their number.

Cases: vectors that are null, empty, or have a null or non-finite entry are left out, as are those with an entry beyond 2 ** 31 after scaling and
those of another length than the one that most of them have (the greater at a tie); repeated rows count once in the fit and all get their
components; directions without variance can't be whitened and give no component, so a table of one distinct vector, or an empty one, gives no rows;
only the named columns are read. A deviation that doesn't fit a long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import staged

#: Vectors of a spectrum, and spectra that one task combines.
VECTORS, FAN = 4096, 8
#: Share of the largest eigenvalue below which a direction counts as one without variance.
NOTHING = 1e-12
STATE = "part bigint, n bigint, mean array<double>, spectrum array<double>, vectors array<double>"
_EPS = float(np.finfo(float).eps)


def secular(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of f(x) = 1 + rho sum z2_i / (d_i - x) for ascending different d and rho > 0: for each the number of its nearest pole and the distance from it.

    Root k lies between d_k and d_k+1 (the last one up to d_n + rho sum z2). Distances from the nearer pole keep full precision. A step goes to
    the root of the function with two poles, at the interval's ends, that agrees with f and its slopes; where that leaves the bracket, or the
    bracket has not halved in three steps, it is halved.
    """
    n = len(d)
    k = np.arange(n)
    top = d[-1] + rho * z2.sum()
    gap = np.append(d[1:], top) - d
    if n == 1:
        return np.zeros(1, int), gap
    f = 1 + rho * (z2 / ((d - d[:, None]) - (gap / 2)[:, None])).sum(1)
    upper = (f < 0) & (k < n - 1)
    origin = np.where(upper, k + 1, k)
    low = np.where(upper, -gap / 2, np.where(f < 0, gap / 2, 0.0))
    high = np.where(upper, 0.0, np.where(f < 0, gap, gap / 2))
    start = (low + high) / 2
    out = start.copy()
    one = np.minimum(k, n - 2)  # the two poles are this one and the next
    go, t, width = k, start, high - low  # the roots that still move
    delta, z2 = d - d[origin][:, None], rho * z2
    below = (k <= one[:, None]).astype(float)
    for step in range(120):
        e = delta - t[:, None]
        q = z2 / e
        f, size = 1 + q.sum(1), 1 + np.abs(q).sum(1)
        q /= e
        psi, slope = (q * below).sum(1), q.sum(1)
        at = np.arange(len(go))
        left, right = e[at, one], e[at, one + 1]
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        a, b, c = (left + right) * f - left * right * slope, left * right * f, f - left * psi - right * (slope - psi)
        final = go == n - 1
        c = np.where(final, f - left * psi - z2[-1] / right, c)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            flip = np.where(final, -1.0, 1.0)
            eta = np.where(a * flip <= 0, (a - flip * root) / (2 * c), 2 * b / (a + flip * root))
        new = t + eta
        bad = ~((new > low) & (new < high))
        if step % 3 == 2:
            bad |= high - low > width / 2
            width = high - low
        new = np.where(bad, (low + high) / 2, new)
        there = np.abs(f) <= 2 * _EPS * size
        done = there | (np.abs(new - t) <= 2 * _EPS * np.abs(t)) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        t = np.where(there, t, new)
        out[go[done]] = t[done]
        rest = ~done
        if not rest.any():
            break
        if done.any():
            go, t, low, high, width, one, delta, below = (v[rest] for v in (go, t, low, high, width, one, delta, below))
    else:
        out[go] = t
    return origin, np.where(out == 0, np.where(origin > k, -1.0, 1.0) * np.finfo(float).tiny, out)


def update(values: np.ndarray, vectors: np.ndarray, x: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors (columns) of  vectors diag(values) vectors' + rho x x'  for rho >= 0."""
    z = vectors.T @ x
    norm = float(np.sqrt(z @ z))
    if rho <= 0 or norm == 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tolerance = 8 * _EPS * max(abs(values[-1]), abs(values[0]), rho)
    # equal eigenvalues: a reflection of their vectors puts the whole of z's part into the last of them
    close = np.diff(values) <= tolerance
    if close.any():
        vectors = vectors.copy()
        first = 0
        while first < len(values):
            last = first
            while last < len(values) - 1 and close[last]:
                last += 1
            if last > first:
                part = z[first : last + 1]
                size = float(np.sqrt(part @ part))
                if size > 0:
                    v = part.copy()
                    v[-1] += size if v[-1] >= 0 else -size
                    v /= np.sqrt(v @ v)
                    block = vectors[:, first : last + 1]
                    vectors[:, first : last + 1] = block - 2 * np.outer(block @ v, v)
                    z = z.copy()
                    end = -size if part[-1] >= 0 else size
                    z[first : last + 1] = 0
                    z[last] = end
            first = last + 1
    live = np.flatnonzero(rho * np.abs(z) > tolerance)
    if not len(live):
        return values, vectors
    d, w = values[live], z[live]
    origin, t = secular(d, w * w, rho)
    roots = d[origin] + t
    # the vector for which these roots are exact gives eigenvectors that are orthogonal
    away = (d[:, None] - d[origin][None, :]) - t[None, :]  # d_i - root_j
    away = np.where(away == 0, -np.finfo(float).tiny, away)
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    ratio = -away / np.where(between == 0, 1.0, -between)
    own = np.diagonal(-away).copy()
    np.fill_diagonal(ratio, 1.0)
    w2 = np.abs(own * np.prod(np.abs(ratio), axis=1))
    w = np.sign(w) * np.sqrt(w2)
    inner = w[:, None] / away
    inner /= np.sqrt((inner * inner).sum(0))
    vectors = vectors.copy()
    values = values.copy()
    vectors[:, live] = vectors[:, live] @ inner
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter about the mean of vectors seen one by one."""

    def __init__(self, size: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(size), np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.values, self.vectors = update(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        away, both = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = update(self.values, self.vectors, vector, float(value))
        self.values, self.vectors = update(self.values, self.vectors, away, self.n * other.n / both)
        self.mean, self.n = self.mean + away * (other.n / both), both

    def row(self, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"part": part, "n": self.n, "mean": self.mean.tolist(), "spectrum": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}], schema=_STATE)

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        out = cls(len(row["mean"]))
        out.n, out.mean, out.values = row["n"], np.array(row["mean"]), np.array(row["spectrum"])
        out.vectors = np.array(row["vectors"]).reshape(len(out.mean), -1)
        return out


_STATE = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("spectrum", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64()))])


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def spectra(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's vectors to one spectrum."""
    own, part = Spectrum(size), 0
    for batch in batches:
        part = batch.column("part")[0].as_py() if batch.num_rows else part
        for x in matrix(batch.column("x"), size).astype(float):
            own.add(x)
    if own.n:
        yield own.row(part)


def combined(states: pa.Table) -> pa.Table:
    rows = sorted(states.to_pylist(), key=lambda r: (r["n"], r["mean"]), reverse=True)
    whole = Spectrum.of(rows[0])
    for r in rows[1:]:
        whole.merge(Spectrum.of(r))
    return pa.Table.from_batches([whole.row(rows[0]["part"])])


def projected(size: int, basis: np.ndarray, n: int, total: np.ndarray, mean: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum of products of its vectors, centred and on the basis (``mean``: of what the basis gives, taken off as well), and their sum."""
    products, sums = np.zeros((basis.shape[1],) * 2), np.zeros(basis.shape[1])
    for batch in batches:
        y = ((n * matrix(batch.column("x"), size) - total) / n) @ basis
        y = y if mean is None else y - mean
        products += y.T @ y
        sums += y.sum(0)
    yield pa.RecordBatch.from_pylist([{"v": np.concatenate([products.ravel(), sums]).tolist()}], schema=pa.schema([("v", pa.list_(pa.float64()))]))


def summed(rows: DataFrame) -> np.ndarray:
    """The sum of arrays ``v`` over all rows, place by place, added up in Spark."""
    at = rows.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).sort("at").toPandas()
    return at["v"].to_numpy(float)


def gridded(rows: DataFrame, vector_col: str, scale: float, shift: int) -> DataFrame:
    """``rows`` with ``x``, the vector's place on the grid; without the vectors that have none."""
    c = F.col(vector_col).cast("array<double>")
    good = F.col(vector_col).isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & (F.abs(v * scale) < float(1 << 31)))
    return rows.where(F.coalesce(good, F.lit(False))).withColumn("x", F.transform(c, lambda v: F.floor(v * scale).cast("long") + F.lit(shift)))


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learned; basis: columns for components, by falling variance."""

    n: int
    total: np.ndarray
    basis: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float
    scale: float
    shift: int


def fit(rows: DataFrame, vector_col: str, *, scale: float = 64, shift: int = 0, most: int = 16) -> Whitening | None:
    """The mean and the ``most`` components of greatest variance of the different vectors of ``rows``; None where none has variance."""
    x = staged(gridded(rows.select(vector_col), vector_col, scale, shift).groupBy("x").count().select("x"), "vectors")
    sizes = x.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).agg(F.max_by("size", F.struct("n", "size")).alias("size"), F.max(F.struct("n", "size"))["n"].alias("n")).first()
    size, n = sizes.size, sizes.n
    if not n or n == 1:
        return None
    x = x.where(F.size("x") == size)
    total = np.array([r.s for r in x.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("s")).sort("at").collect()], np.int64)
    numbered = x.repartition(-(-n // VECTORS)).select(F.spark_partition_id().cast("long").alias("part"), F.transform("x", lambda v: v - F.lit(shift)).alias("x"))
    states = staged(numbered.mapInArrow(partial(spectra, size), STATE), "spectra")
    while (left := states.count()) > 1:
        states = staged(states.withColumn("part", F.pmod("part", F.lit(-(-left // FAN)))).groupBy("part").applyInArrow(combined, STATE), "spectra")
    found = Spectrum.of(states.first().asDict())
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    projected_on = lambda b, m=None: summed(x.mapInArrow(partial(projected, size, b, n, total, m), "v array<double>"))
    small = projected_on(basis)[: size * size].reshape(size, size) / n
    variance, turn = np.linalg.eigh((small + small.T) / 2)
    variance, basis = variance[::-1], basis @ turn[:, ::-1]
    real = variance > NOTHING * max(variance[0], 0.0)
    k = min(most, int(real.sum()))
    if not k or variance[0] <= 0:
        return None
    basis = basis[:, :k] * np.where(basis[np.abs(basis[:, :k]).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    white = basis / np.sqrt(variance[:k])
    mean = projected_on(white)[k * k :] / n
    covariance = projected_on(white, mean)[: k * k].reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, total, basis, variance[:k], variance[:k] / variance.sum(), error, scale, shift)


def deviation(x: np.ndarray, n: int, total: np.ndarray) -> list[int]:
    """Exact sums of squares of n x - total; in whole numbers of any size where 64 bits might not do."""
    away = n * x - total
    if len(x) and float(np.abs(away).max()) ** 2 * x.shape[1] < float(1 << 62):
        return (away * away).sum(1).tolist()
    return [sum(v * v for v in row) for row in away.tolist()]


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def components(rows: DataFrame, model: Whitening | None, vector_col: str, *keep: Column) -> DataFrame:
    """Per row that has a place on the grid and component: the kept columns, component (from 1), n, deviation, whitened, explained, identity_error."""
    own = gridded(rows.select(F.col(vector_col).alias("__vector"), *keep), "__vector", model.scale if model else 1, model.shift if model else 0).drop("__vector")
    names = own.columns[:-1]
    schema = StructType([*own.schema.fields[:-1], *StructType.fromDDL(OUT).fields])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    size, k = model.basis.shape
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            x = matrix(batch.column("x"), size)
            white = ((m.n * x - m.total) / m.n) @ (m.basis / np.sqrt(m.variance))
            rows_ = len(x)
            take = pa.array(np.repeat(np.arange(rows_), k))
            more = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)), pa.array(np.full(rows_ * k, m.n)), pa.array(deviation(x, m.n, m.total), pa.int64()).take(take),
                pa.array(white.ravel()), pa.array(np.tile(m.explained, rows_)), pa.array(np.full(rows_ * k, m.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in names), *more], names=schema.names)

    return own.where(F.size("x") == size).mapInArrow(run, schema)

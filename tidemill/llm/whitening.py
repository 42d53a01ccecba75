"""Whitening of vectors: principal components and deviations by a one-sided Jacobi SVD.

Entries become integers, ``floor(scale * entry) + shift``, so that their sums are exact whatever the
order.  One pass sums each dimension.  The next takes the rows, centred by the exact means, through
blockwise TSQR: a task stacks blocks of rows under its triangle R and factors again, triangles of
tasks meet in groups of ``FAN`` until one is left, so no task holds more than a block and a few
triangles and nothing is squared.  Plane rotations then make R's columns orthogonal; the columns'
norms are the deviations (times the root of the rows), the accumulated rotations the components.  Small
deviations come out as accurately as large ones, which an eigensolver of the covariance does not give.
The driver holds one triangle and the rotations, a few matrices of the dimension squared.

A last pass measures the covariance of the whitened rows, in centred blocks that are merged pairwise,
and gives its largest distance from the identity.

Which rows count: those whose vector is neither null nor empty, holds no null or non-finite entry
nor one of 2**53 / ``scale`` or more, and has the commonest length of such vectors (of equally common
ones the longest); the others are dropped.  Ids may be null, repeated or of any type: every row
stands for itself.  Directions without variance, to rounding, have no component: equal vectors give no
rows, and neither does an empty table.  Only the key is carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.scratch import written

SCALE, SHIFT = 64, 1_000_000
#: Bytes of centred rows in a block, and how many triangles or summaries one task merges.
BLOCK_BYTES = 1 << 22
FAN = 32
SWEEPS = 60
#: Columns count as orthogonal at this cosine.
LEVEL = 1e-15


def usable(vector: str):
    """Whether a vector's entries are all there and finite, and small enough to become exact integers."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float(2**53 // SCALE), F.lit(False))), F.lit(False))


def integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The vectors of the second column as integers, a row each."""
    column = batch.column(1)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(len(column), d)


def _sliced(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, BLOCK_BYTES // (8 * d))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass(frozen=True)
class Sums:
    """How many rows there are, and each dimension's exact sum, split into a whole mean and what remains."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exactly, the sum over dimensions of (n * x - S) squared, of each row."""
        away = x - self.whole
        most = (int(np.abs(away).max(initial=0)) + 1) * self.n
        kind = np.int64 if most * most * max(1, x.shape[1]) < 2**63 else object
        scaled = away.astype(kind) * self.n - self.rest.astype(kind)
        return (scaled * scaled).sum(axis=1).tolist()


def sums_of(rows: DataFrame, d: int) -> Sums:
    """Exact sums of the vectors' integers, by task and then by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of high and low halves stay within 64 bits for 2**31 rows of a task.
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in _sliced(batches, d):
            x = integers(batch, d)
            n += len(x)
            high += (x >> 24).sum(axis=0)
            low += (x & 0xFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(high), pa.array(low), pa.array(np.full(d, n))], names=["k", "high", "low", "n"])

    parts = rows.mapInArrow(add, "k long, high long, low long, n long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    found = parts.groupBy("k").agg(exact("high").alias("high"), exact("low").alias("low"), F.sum("n").alias("n")).orderBy("k").collect()
    return Sums(found[0]["n"], tuple((int(r["high"]) << 24) + int(r["low"]) for r in found))


def merged(parts: DataFrame, merge) -> bytes | None:
    """One blob from a table of blobs ``part``, by rounds of tasks that each merge about ``FAN`` of them.

    ``merge`` takes an iterator of blobs and gives one; every round is written, so a lost executor repeats little.
    """
    parts = written(parts, "parts")
    n = parts.count()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = merge(x for b in batches for i in range(b.num_rows) for x in (b.column(0)[i].as_py(),))
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["part"])

    while n > 1:
        tasks = -(-n // FAN)
        parts = written(parts.repartition(tasks).mapInArrow(fold, "part binary"), "parts")
        n = parts.count()
    found = parts.first()
    return bytes(found[0]) if found else None


def _triangle(blobs: Iterator[bytes], d: int) -> bytes | None:
    r = None
    for blob in blobs:
        own = np.frombuffer(blob).reshape(-1, d)
        r = own if r is None else np.linalg.qr(np.vstack([r, own]), mode="r")
    return None if r is None else np.ascontiguousarray(r).tobytes()


def tsqr(rows: DataFrame, sums: Sums) -> np.ndarray:
    """The triangle R of the centred rows: R'R is theirs."""
    d = len(sums.sums)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in _sliced(batches, d):
            r = np.linalg.qr(np.vstack([r, sums.centred(integers(batch, d))]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["part"])

    found = merged(rows.mapInArrow(factor, "part binary"), lambda blobs: _triangle(blobs, d))
    return np.frombuffer(found).reshape(-1, d)


def jacobi(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deviations (singular values, falling) and components (columns, in their order) of ``r``.

    One-sided: plane rotations make pairs of columns orthogonal, all pairs in a sweep, half of the
    columns against the other half at a time in the order of a round-robin; the rotations are
    accumulated.  Sweeps end when no pair is further than ``LEVEL`` from orthogonal.
    """
    d = r.shape[1]
    a, v = np.array(r.T, dtype=np.float64, order="C"), np.eye(d)  # rows are columns here: they lie together
    m = d + d % 2
    for _ in range(SWEEPS):
        worst, seats = 0.0, np.arange(m)
        for _ in range(m - 1):
            p, q = seats[: m // 2], seats[m // 2 :][::-1]
            own = (p < d) & (q < d)
            p, q = p[own], q[own]
            x, y = a[p], a[q]
            alpha, beta, gamma = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            size = np.sqrt(alpha) * np.sqrt(beta)
            cosine = np.divide(np.abs(gamma), size, out=np.zeros_like(gamma), where=size > 0)
            worst = max(worst, float(cosine.max(initial=0)))
            turn = cosine > LEVEL
            if turn.any():
                p, q, x, y = p[turn], q[turn], x[turn], y[turn]
                with np.errstate(over="ignore"):
                    zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
                    t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = 1 / np.hypot(1, t)
                c, s = c[:, None], (c * t)[:, None]
                a[p], a[q] = c * x - s * y, s * x + c * y
                x, y = v[p], v[q]
                v[p], v[q] = c * x - s * y, s * x + c * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= LEVEL * max(1, math.sqrt(d)):
            break
    norms = np.sqrt((a * a).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    return norms[order], v[order].T


@dataclass(frozen=True)
class Whitener:
    """What turns vectors into independent directions of variance one."""

    sums: Sums
    #: Eigenvalues of the covariance, falling, each with its unit component, a column of ``components``.
    values: np.ndarray
    components: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.sums.centred(x) @ self.components / np.sqrt(self.values)


def fit(rows: DataFrame, d: int, most: int) -> Whitener | None:
    """At most ``most`` components of all ``rows`` (key, vector), which must be usable and of length ``d``; None without variance."""
    sums = sums_of(rows, d)
    deviations, components = jacobi(tsqr(rows, sums))
    trace = math.fsum(s * s for s in deviations) / sums.n
    # What rounding alone makes of no variance.
    real = deviations > deviations[0] * max(sums.n, d) * np.finfo(float).eps
    k = min(most, int(real.sum()))
    return Whitener(sums, deviations[:k] ** 2 / sums.n, np.ascontiguousarray(components[:, :k]), trace) if k else None


def _summary(n: int, mean: np.ndarray, m2: np.ndarray) -> bytes:
    return np.concatenate([[float(n)], mean, m2.ravel()]).tobytes()


def _met(blobs: Iterator[bytes], k: int) -> bytes | None:
    """Counts, means and centred products of two lots of rows at a time, merged."""
    n, mean, m2 = 0, np.zeros(k), np.zeros((k, k))
    for blob in blobs:
        x = np.frombuffer(blob)
        more, own = int(x[0]), x[1 : k + 1]
        away, both = own - mean, n + more
        m2 = m2 + x[k + 1 :].reshape(k, k) + np.outer(away, away) * (n * more / both)
        mean, n = mean + away * (more / both), both
    return _summary(n, mean, m2) if n else None


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    d, k = len(model.sums.sums), len(model.values)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in _sliced(batches, d):
                w = model.whiten(integers(batch, d))
                away = w - w.mean(axis=0)
                yield _summary(len(w), w.mean(axis=0), away.T @ away)

        found = _met(parts(), k)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["part"])

    found = np.frombuffer(merged(rows.mapInArrow(measure, "part binary"), lambda blobs: _met(blobs, k)))
    return float(np.abs(found[k + 1 :].reshape(k, k) / found[0] - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """One row per usable vector: (key, n, deviation, whitened, explained, identity_error).

    ``whitened`` and ``explained`` (the component's share of all variance) are arrays over at most ``most``
    components, numbered by falling variance.  ``deviation`` is exact, a decimal of 38 digits, null beyond.
    """
    spark = df.sparkSession
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("explained", T.ArrayType(T.DoubleType())), T.StructField("identity_error", T.DoubleType()),
    ])
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{vector}`").cast("array<double>").alias("_vector"))
    rows = rows.filter(usable("_vector"))
    common = rows.groupBy(F.size("_vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    d = common["d"]
    rows = rows.filter(F.size("_vector") == d)
    model = fit(rows, d, most)
    if model is None:
        return spark.createDataFrame([], schema)
    error, k = identity_error(rows, model), len(model.values)
    shares = (model.values / model.trace).tolist()

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in _sliced(batches, max(d, 256)):
            x = integers(batch, d)
            n = len(x)
            deviation = [Decimal(v) if v < 10**38 else None for v in model.sums.deviations(x)]
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(n, model.sums.n)), pa.array(deviation, pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, pa.array(model.whiten(x).ravel())),
                    pa.ListArray.from_arrays(offsets, pa.array(np.tile(shares, n))), pa.array(np.full(n, error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(give, schema)

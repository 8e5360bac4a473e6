"""Whitening of embeddings: components of an exact covariance, found in mixed precision.

Vectors lie on an integer grid, so sums and centred products are added up exactly, in any order. The eigenvectors of the
covariance come from a float32 solver and are corrected by the iteration of Ogita and Aishima: matrix products in extended
precision whose error squares with each step. Where eigenvalues lie closer together than a step can tell apart, the
covariance is projected on their common space, shifted, and solved there on its own; the iteration then goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import require, saved

SCALE, OFFSET = 64, 1_000_000
EXACT = 2**53
#: Eigenvalues below this share of their sum are taken for zero: their components are rounding.
LEAST_SHARE = 1e-14


def grid(vector: Column) -> Column:
    """``floor(SCALE * c) + OFFSET`` of each entry as long; null for a vector that is null or holds null or non-finite entries.

    An entry beyond 2**56 in size, whose place on the grid is no long, fails the job.
    """
    at = F.transform(vector, lambda c: c.cast("double"))
    usable = F.forall(at, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    place = lambda c: F.when(F.abs(c) < 2.0**56, F.floor(c * SCALE) + OFFSET).otherwise(
        F.raise_error(F.lit("an entry of a vector is too large for the grid")).cast("long")
    )
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(at, place))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def exact_product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of integers, as Python integers: in doubles, as many rows at once as stay exact."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    largest = int(np.abs(y).max(initial=0)) ** 2
    if largest >= EXACT:
        y = y.astype(object)
        return total + y.T @ y
    rows = EXACT // max(largest, 1)
    for i in range(0, len(y), rows):
        part = y[i : i + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _exact_sum(y: np.ndarray) -> np.ndarray:
    safe = int(np.abs(y).max(initial=0)) * len(y) < 2**62
    return (y if safe else y.astype(object)).sum(axis=0).astype(object)


def _totals(fit_list: DataFrame, work, cells: int) -> list[int]:
    """Sums over all rows of ``work(matrix)``, which gives ``cells`` integers; the driver gets one number a cell."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, object)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column(0)))
        values = pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(cells), pa.int32()), values], ["cell", "value"])

    sums = fit_list.select("x").mapInArrow(partial, "cell int, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value"))
    out = dict(sums.collect())
    return [int(out.get(i, 0)) for i in range(cells)]


def _quotient(number: int, by: int) -> np.longdouble:
    """``number / by`` in extended precision."""
    if not number:
        return np.longdouble(0)
    shift = max(0, 80 + by.bit_length() - abs(number).bit_length())
    scaled = (abs(number) << shift) // by
    cut = max(0, scaled.bit_length() - 80)
    high, low = divmod(scaled >> cut, 2**40)
    value = np.ldexp(np.longdouble(high), 40) + np.longdouble(low)
    return (np.ldexp(value, cut - shift)) * (1 if number > 0 else -1)


def _norm(m: np.ndarray) -> np.longdouble:
    return np.sqrt((m * m).sum())


def _refined(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble]:
    """Corrects approximate eigenvectors until a step changes nothing more; with eigenvalues and the gap that it can't tell apart."""
    eye, size, before = np.eye(len(v), dtype=v.dtype), _norm(v), np.inf
    for _ in range(12):
        r, s = eye - x.T @ x, x.T @ (v @ x)
        s = (s + s.T) / 2  # what rounding makes unequal would be divided by the gap, and spoil right angles
        values = np.diag(s) / (1 - np.diag(r))
        near = 2 * (_norm(s - np.diag(values)) + size * _norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        change = np.abs(step).max()
        if change >= before and change < 1e-9:
            break
        x, before = x + x @ step, change
    x = x + x @ (eye - x.T @ x) / 2
    return values, x, near


def _clusters(values: np.ndarray, near: np.longdouble) -> list[np.ndarray]:
    """The places of eigenvalues that follow each other by at most ``near``; lone ones left out."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in the precision of ``np.longdouble``.

    Eigenvectors of equal eigenvalues are some orthonormal basis of their space.
    """
    v = np.asarray(v, np.longdouble)
    scale = np.abs(v).max(initial=0)
    if not scale:
        return np.zeros(len(v), np.longdouble), np.eye(len(v), dtype=np.longdouble)
    v = v / scale
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(np.longdouble)
    values, x, near = _refined(v, x)
    tried = None
    while (found := _clusters(values, near)) and tried != (places := [sorted(c.tolist()) for c in found]):
        tried = places
        for c in found:
            shifted = v - values[c].mean() * np.eye(len(v), dtype=v.dtype)
            inner = x[:, c].T @ (shifted @ x[:, c])
            size = np.abs(inner).max()
            if size:
                x[:, c] = x[:, c] @ np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(np.float64))[1].astype(x.dtype)
        values, x, near = _refined(v, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))


@dataclass
class Whitening:
    """What ``fit`` finds: distinct vectors, their sums, the exact covariance, and its leading components."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    trace: np.longdouble
    eigenvalues: np.ndarray
    components: np.ndarray
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        return (self.eigenvalues / self.trace).astype(np.float64)

    def centred(self):
        """A function from grid vectors to integers ``n * x - sums`` and doubles ``x - sums / n``."""
        base = np.array([s // self.n for s in self.sums], object)
        rest, n = np.array([s % self.n for s in self.sums], object), self.n
        fraction = np.array([float(_quotient(int(r), n)) for r in rest])
        base_long = base.astype(np.int64)

        def work(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            y = x - base_long
            safe = (int(np.abs(y).max(initial=0)) + 1) * n < 2**28
            whole = y * n - rest.astype(np.int64) if safe else y.astype(object) * n - rest
            return whole, y - fraction

        return work

    def weights(self) -> np.ndarray:
        return (self.components / np.sqrt(self.eigenvalues)).astype(np.float64)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 16) -> Whitening | None:
    """Components of the distinct grid vectors; None where there is none.

    Every distinct vector counts once, so groups of copies, however large, collapse before the shuffle. Partitions send sums
    of integers only, d + d² numbers. A vector of another length than the commonest (the longer, if equally common) is left
    out. Components number ``components`` at most, and only those whose eigenvalue isn't zero.
    """
    require(vectors, vector)
    at = vectors.select(grid(F.col(vector)).alias("x")).where("x IS NOT NULL")
    fit_list = saved(at.distinct(), "whitening-fit")
    dims = _common_length(fit_list)
    if not dims:
        return None
    fit_list = fit_list.where(F.size("x") == dims)
    *sums, n = _totals(fit_list, lambda x: np.append(_exact_sum(x), len(x)), dims + 1)
    base = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    upper = np.triu_indices(dims)
    products = _totals(fit_list, lambda x: exact_product(x - base)[upper], len(upper[0]))
    covariance = np.zeros((dims, dims), np.longdouble)
    for i, j, z in zip(*upper, products):
        covariance[i, j] = covariance[j, i] = _quotient(n * z - rest[i] * rest[j], n * n)
    trace = np.trace(covariance)
    values, axes = eigenvectors(covariance)
    kept = np.flatnonzero(values > LEAST_SHARE * trace)[:components] if trace else []
    found = Whitening(n, sums, covariance, trace, values[kept], axes[:, kept])
    found.identity_error = _identity_error(fit_list, found)
    return found


def _common_length(fit_list: DataFrame) -> int:
    row = fit_list.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row.d if row else 0


def _identity_error(fit_list: DataFrame, found: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, measured on the fit list."""
    weights, centred, k = found.weights(), found.centred(), len(found.eigenvalues)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = centred(_matrix(batch.column(0)))[1] @ weights
                total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["cell", "value"])

    if not k:
        return 0.0
    cells = dict(fit_list.mapInArrow(partial, "cell int, value double").groupBy("cell").agg(F.sum("value")).collect())
    total = np.array([cells.get(i, 0.0) for i in range((k + 1) * k)]).reshape(k + 1, k) / found.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(vectors: DataFrame, found: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: ``key``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. Nothing is shuffled.

    ``deviation`` is the exact sum of ``(n * x - sums)²``, a decimal; null beyond 38 digits. Vectors that the grid has no place
    for (null, or with null or non-finite entries) or of another length than the fit's have no rows; neither has any where
    nothing could be fitted, or where all vectors are one. Null keys and repeated rows stay. Other columns are not read.
    """
    require(vectors, key, vector)
    rows = vectors.select(F.col(key).alias("__key"), grid(F.col(vector)).alias("x"))
    kind = rows.schema["__key"].dataType.simpleString()
    schema = f"__key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None or not len(found.eigenvalues):
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("__key", key)
    weights, centred, k, n, explained, error = found.weights(), found.centred(), len(found.eigenvalues), found.n, found.explained, found.identity_error

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, y = centred(_matrix(batch.column(1)))
            squares = [int(v) for v in (whole * whole).sum(axis=1)]
            size, each = len(squares), np.repeat(np.arange(len(squares)), k)
            deviation = pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * k, n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array((y @ weights).ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * k, error)),
                ],
                ["__key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    usable = rows.where(F.col("x").isNotNull() & (F.size("x") == len(found.sums)))
    return usable.mapInArrow(work, schema).withColumnRenamed("__key", key)

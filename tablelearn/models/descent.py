"""Mini-batch descent on squared error as a product of affine maps (R2).

A step takes the weights ``t`` of the augmented inputs ``u = (x, 1)`` to ``t - rate / n * (U'U t - U'y)``: an affine map that
depends on its batch alone. Maps compose, and composing is associative, so an epoch is a scan: each range of batches is made one
map of (d + 1) x (d + 2) numbers by the task that has its rows, the driver goes through the ranges' maps, and every range can
then be entered with its own weights, for the losses. What is sent doesn't depend on the size of a batch.

Few batches (``max_ranges`` at most) are ranges by themselves: their maps come from sums of products, in which many tasks share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import double_array

MAX_RANGES, MAX_MAP_NUMBERS = 1024, 4_000_000
# Epochs whose losses are found in one job.
EPOCHS_AT_ONCE = 10


def max_ranges(d: int) -> int:
    """So many that the driver holds ``MAX_MAP_NUMBERS`` numbers at most."""
    return max(16, min(MAX_RANGES, MAX_MAP_NUMBERS // (d + 2) ** 2))


class SummedBatches:
    """Each batch's map from its sums of products. ``rows``: run, batch_id, x0.., y."""

    def __init__(self, rows: DataFrame, d: int, n: list[int], batches: list[int], loss: Callable[[Any, Any], Column], gram: Callable[..., dict]):
        self.rows, self.d, self.n, self.batches, self.loss = rows, d, n, batches, loss
        self.width = max(batches)
        placed = rows.withColumn("slot", self._slot())
        parts = gram(placed, {c: F.col(c) for c in [f"x{i}" for i in range(d)] + ["y"]}, by="slot")
        self.products = {}
        for slot, (count, s, m) in parts.items():
            u = np.empty((d + 1, d + 2))
            u[:d, :d], u[:d, d], u[:d, d + 1] = m[:d, :d], s[:d], m[:d, d]
            u[d, :d], u[d, d], u[d, d + 1] = s[:d], count, s[d]
            self.products[int(slot)] = u

    def _slot(self) -> Column:
        return F.col("run") * F.lit(self.width) + F.col("batch_id")

    def epoch(self, run: int, start: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """The weights before each batch, and after the last."""
        before, t = [], start
        for b in range(self.batches[run]):
            before.append(t)
            u = self.products[run * self.width + b]
            t = t - rate / self.n[run] * (u[:, :-1] @ t - u[:, -1])
        return np.array(before), t

    def losses(self, trajectory: list[dict[int, tuple[np.ndarray, float]]]) -> list[dict[int, list[float]]]:
        """Per epoch and run, the losses of the batches: weights are looked up in constants by run and batch, so no row is repeated."""
        aggs, runs = [], len(self.n)
        for e, epoch in enumerate(trajectory):
            table = np.zeros((runs * self.width, self.d + 1))
            for run, (before, _) in epoch.items():
                table[run * self.width : run * self.width + len(before)] = before
            at = self._slot().cast("int")
            z = F.get(double_array(table[:, self.d].tolist()), at)
            for j in range(self.d):
                z = z + F.col(f"x{j}") * F.get(double_array(table[:, j].tolist()), at)
            aggs.append(self.loss(F.col("y"), z).alias(f"e{e}"))
        rows = self.rows.groupBy("run", "batch_id").agg(*aggs).collect()
        out = [{run: [0.0] * len(epoch[run][0]) for run in epoch} for epoch in trajectory]
        for r in rows:
            for e, epoch in enumerate(out):
                if r["run"] in epoch:
                    epoch[r["run"]][r["batch_id"]] = float(r[f"e{e}"])
        return out

    def close(self) -> None:
        pass


def _segments(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(run, range, batch, augmented inputs, targets) of the pieces that batches come in: in order, never two batches in one."""
    for part in batches:
        if not part.num_rows:
            continue
        run, where, batch, *columns = (np.asarray(c) for c in part.columns)
        u = np.column_stack([*columns[:d], np.ones(part.num_rows)])
        cuts = np.flatnonzero((np.diff(batch) != 0) | (np.diff(run) != 0)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows]):
            yield int(run[a]), int(where[a]), int(batch[a]), u[a:z], columns[d][a:z]


class _Steps:
    """Weights (a column per start) that follow the batches of a range; a batch counts when it is over."""

    def __init__(self, start: np.ndarray, offset: np.ndarray, rate: np.ndarray):
        self.t, self.offset, self.rate = start, offset, rate
        self.pull = np.zeros_like(start)
        self.batch: int | None = None

    def meet(self, batch: int, u: np.ndarray, y: np.ndarray) -> np.ndarray:
        """What the weights before the batch make of its rows, less the target where ``offset`` says so."""
        if batch != self.batch:
            self.close()
            self.batch = batch
        z = u @ self.t
        self.pull += u.T @ (z - y[:, None] * self.offset)
        return z

    def close(self) -> np.ndarray:
        self.t = self.t - self.rate * self.pull
        self.pull = np.zeros_like(self.t)
        return self.t


class ComposedRanges:
    """Maps of ranges of whole batches, each composed by the task that has the range's rows in order. ``rows``: run, batch_id,
    pos, x0.., y."""

    def __init__(self, rows: DataFrame, d: int, n: list[int], batches: list[int], loss: Callable[[Any, Any], Column]):
        self.d, self.n, self.loss = d, n, loss
        self.per_range = [-(-b // max_ranges(d)) for b in batches]
        self.ranges = [-(-b // p) for b, p in zip(batches, self.per_range)]
        per = F.get(F.array(*[F.lit(p).cast("bigint") for p in self.per_range]), F.col("run"))
        placed = rows.withColumn("range", F.floor(F.col("batch_id") / per).cast("int"))
        laid = placed.repartition("run", "range").sortWithinPartitions("run", "range", "pos")
        self.rows = laid.select("run", "range", "batch_id", *[f"x{i}" for i in range(d)], "y").persist(StorageLevel.MEMORY_AND_DISK)
        self.maps: dict[tuple[int, float], dict[int, np.ndarray]] = {}

    def close(self) -> None:
        self.rows.unpersist()

    def compose(self, rates: dict[int, float]) -> None:
        """The maps at these rates by run, in one job; those of rates that came before are kept."""
        new = {run: rate for run, rate in rates.items() if (run, rate) not in self.maps}
        if not new:
            return
        d, steps = self.d, {run: rate / self.n[run] for run, rate in new.items()}
        offset = np.r_[np.zeros(d + 1), 1.0]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, state, done = None, None, []
            for run, where, batch, u, y in _segments(batches, d):
                if run not in steps:
                    continue
                if (run, where) != here:
                    if state is not None:
                        done.append((*here, state.close().ravel().tolist()))
                    here, state = (run, where), _Steps(np.eye(d + 1, d + 2), offset, steps[run])
                state.meet(batch, u, y)
            if state is not None:
                done.append((*here, state.close().ravel().tolist()))
            run, where, cells = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(where, pa.int32()), pa.array(cells, pa.list_(pa.float64()))], ["run", "range", "cells"])

        wanted = self.rows.where(F.col("run").isin(list(new)))
        for r in wanted.mapInArrow(work, "run int, range int, cells array<double>").collect():
            self.maps.setdefault((r["run"], new[r["run"]]), {})[r["range"]] = np.array(r["cells"]).reshape(d + 1, d + 2)

    def epoch(self, run: int, start: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """The weights before each range, and after the last."""
        before, t = [], start
        for r in range(self.ranges[run]):
            before.append(t)
            m = self.maps[run, rate][r]
            t = m[:, :-1] @ t + m[:, -1]
        return np.array(before), t

    def losses(self, trajectory: list[dict[int, tuple[np.ndarray, float]]]) -> list[dict[int, list[float]]]:
        """Per epoch and run, the mean of the batches' losses, as a list of one."""
        d, n, epochs = self.d, self.n, len(trajectory)
        spec = self.rows.sparkSession.sparkContext.broadcast(trajectory)  # numbers: ranges * (d + 1) * epochs * runs
        schema = "run int, batch_id long, y double, " + ", ".join(f"z{e} double" for e in range(epochs))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, state, starts = None, None, spec.value

            def pieces(part: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
                nonlocal here, state
                for run, where, batch, u, y in _segments(iter([part]), d):
                    if (run, where) != here:
                        columns = [e[run] if run in e else None for e in starts]
                        first = np.column_stack([np.full(d + 1, np.nan) if c is None else c[0][where] for c in columns])
                        rate = np.array([0.0 if c is None else c[1] for c in columns])
                        here, state = (run, where), _Steps(first, np.ones(epochs), rate / n[run])
                    yield run, batch, y, state.meet(batch, u, y)

            for part in batches:
                if not part.num_rows:
                    continue
                run, batch, y, z = zip(*pieces(part))
                sizes = [len(v) for v in y]
                z = np.concatenate(z)
                arrays = [pa.array(np.repeat(np.array(run, np.int32), sizes)), pa.array(np.repeat(np.array(batch, np.int64), sizes)), pa.array(np.concatenate(y))]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(z[:, e]) for e in range(epochs)]], ["run", "batch_id", "y", *[f"z{e}" for e in range(epochs)]])

        scored = self.rows.mapInArrow(work, schema)
        by_batch = scored.groupBy("run", "batch_id").agg(*[self.loss(F.col("y"), F.col(f"z{e}")).cast("double").alias(f"e{e}") for e in range(epochs)])
        means = {r["run"]: r for r in by_batch.groupBy("run").agg(*[F.avg(f"e{e}").alias(f"e{e}") for e in range(epochs)]).collect()}
        return [{run: [means[run][f"e{e}"]] for run in epoch} for e, epoch in enumerate(trajectory)]


def shard_descent(start: np.ndarray, rate: float, n: dict[int, int], batch_size: int, output: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]):
    """For rows (shard, x0.., y) sorted by shard: each shard's own descent from ``start``, in batches of so many rows.

    Gives (shard, batch_id, y, p, t): every row with what the weights before its batch make of it, and for each shard a line with
    ``batch_id`` -1 and the weights at the end.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, t, seen, pull = None, start, 0, np.zeros_like(start)

        def line(what: int, end: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([what], pa.int32()), pa.array([-1], pa.int64()), *[pa.array([None], pa.float64())] * 2, pa.array([end.tolist()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(columns, ["shard", "batch_id", "y", "p", "t"])

        for part in batches:
            if not part.num_rows:
                continue
            shards, *columns = (np.asarray(c) for c in part.columns)
            u, y = np.column_stack([*columns[:-1], np.ones(part.num_rows)]), columns[-1]
            hard, number = np.empty(len(y)), np.empty(len(y), np.int64)
            at = 0
            while at < len(y):
                if shards[at] != shard:
                    if shard is not None:
                        yield line(shard, t - rate / n[shard] * pull)
                    shard, t, seen, pull = int(shards[at]), start, 0, np.zeros_like(start)
                end = min(at + batch_size - seen % batch_size, int(np.searchsorted(shards, shard, "right")))
                soft, hard[at:end] = output(u[at:end] @ t)
                pull += u[at:end].T @ (soft - y[at:end])
                number[at:end] = seen // batch_size
                seen += end - at
                if seen % batch_size == 0:  # the batch is full
                    t, pull = t - rate / n[shard] * pull, np.zeros_like(start)
                at = end
            none = pa.nulls(len(y), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(number), pa.array(y), pa.array(hard), none], ["shard", "batch_id", "y", "p", "t"])
        if shard is not None:
            yield line(shard, t - rate / n[shard] * pull)

    return work

"""Linear and logistic regression and the perceptron."""

from __future__ import annotations

import copy
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, double_array, feature, to_col
from ..functions.metrics import accuracy, mean_absolute_error
from ..operators.position import shuffle_hash
from .descent import EPOCHS_AT_ONCE, ComposedRanges, SummedBatches, max_ranges, shard_descent
from .training import LearningRateScheduler, Run, StepTrainer

# Sums are written out as expressions up to this many; above, each task sums its rows' products with numpy.
MAX_SUM_EXPRESSIONS = 400


def gram(df: DataFrame, columns: dict[str, Column], by: str | None = None, shift: Sequence[float] | None = None) -> dict:
    """Per group the row count, the sums and the matrix of product sums of some columns: ``{group: (n, s, M)}``.

    One pass; what leaves a task is one matrix per group.
    """
    names = list(columns)
    width = len(names)
    shift = list(shift) if shift is not None else [0.0] * width
    group = to_col(by) if by is not None else F.lit(0)
    wide = df.select(
        group.alias("g"),
        *[(c - F.lit(float(m)) if m else c).alias(f"x{i}") for i, (c, m) in enumerate(zip(columns.values(), shift))],
    )
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    out = {}
    if len(pairs) <= MAX_SUM_EXPRESSIONS:
        rows = wide.groupBy("g").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(f"x{i}").alias(f"s{i}") for i in range(width)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
        ).collect()
        for r in rows:
            m = np.empty((width, width))
            for i, j in pairs:
                m[i, j] = m[j, i] = r[f"p{i}_{j}"]
            out[r["g"]] = (r["n"], np.array([r[f"s{i}"] for i in range(width)]), m)
        return out

    def partial(batches):
        sums: dict[Any, np.ndarray] = {}
        for pdf in batches:
            for g, part in pdf.groupby("g"):
                x = np.column_stack([np.ones(len(part)), part.drop(columns="g").to_numpy(dtype="float64")])
                product = x.T @ x
                sums[g] = sums[g] + product if g in sums else product
        for g, m in sums.items():
            yield pd.DataFrame({"g": [g] * m.size, "cell": np.arange(m.size), "v": m.ravel()})

    g_type = dict(wide.dtypes)["g"]
    cells = (
        wide.mapInPandas(partial, f"g {g_type}, cell bigint, v double")
        .groupBy("g", "cell").agg(F.sum("v").alias("v")).collect()
    )
    side = width + 1
    for r in cells:
        out.setdefault(r["g"], np.zeros(side * side))[r["cell"]] = r["v"]
    return {
        g: (int(round(flat[0])), flat.reshape(side, side)[0, 1:].copy(), flat.reshape(side, side)[1:, 1:].copy())
        for g, flat in out.items()
    }


def linear_score(cols: list[str], weights: Sequence[float], bias: float) -> Column:
    """``x . w + b`` as one expression, left to right."""
    z = F.lit(float(bias))
    for c, w in zip(cols, weights):
        z = z + feature(c) * F.lit(float(w))
    return z


class LinearRegression(TableEstimator):
    """R1, ``solver="norm_eq"``: the normal equation with intercept, several targets at once.

    R2, ``solver="mbgd"``: mini-batch descent on squared error, with batches of any size. Steps are affine maps, composed by
    range of batches where their rows are (see ``descent``): one job for as long as the rate stays, and one for the ``loss``
    (mean absolute error by default) of ten epochs, or of each where a callback reads it. Result and loss history are those
    of descending row by row. A callback finds all batch losses of the epoch, or their mean alone beyond some 1,000 batches.
    """

    def __init__(
        self,
        input_cols,
        target_cols,
        solver: str = "norm_eq",
        row_key=None,
        loss=mean_absolute_error,
        learning_rate: float = 1e-4,
        epochs: int = 10,
        batch_size: int | None = None,
        shuffle: bool = False,
        seed: int = 42,
        callbacks=(),
        progress: str | None = None,
    ):
        super().__init__()
        if solver not in ("norm_eq", "mbgd"):
            raise ValueError("solver is norm_eq or mbgd")
        self.input_cols = as_list(input_cols)
        self.target_cols = as_list(target_cols)
        self.solver = solver
        self.loss = loss
        self.trainer = None
        if solver == "mbgd":
            if len(self.target_cols) != 1 or not as_list(row_key):
                raise ValueError("mbgd takes one target and a row_key")
            self.trainer = SquaredErrorTrainer(
                input_cols, target_cols, row_key, loss, learning_rate, epochs, batch_size, shuffle, seed, callbacks, progress
            )

    def _columns(self) -> dict[str, Column]:
        return {c: feature(c) for c in self.input_cols + self.target_cols}

    def _settings(self) -> dict[str, Any]:
        return {"input_cols": self.input_cols, "target_cols": self.target_cols, "solver": self.solver}

    def _means(self, df: DataFrame) -> list[float]:
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(self._columns().values())]).first()
        if row["m0"] is None:
            raise ValueError("no rows to train on")
        return list(row)

    def _solve(self, shift, parts) -> "LinearModel":
        """Products are taken about ``shift``, near the means, which keeps the system well conditioned."""
        d = len(self.input_cols)
        n = sum(p[0] for p in parts)
        s = sum(p[1] for p in parts)
        m = sum(p[2] for p in parts)
        centred = m - np.outer(s, s) / n
        a, b = centred[:d, :d], centred[:d, d:]
        scale = np.sqrt(np.clip(np.diag(a), 0, None))
        if (scale == 0).any() or np.linalg.matrix_rank(a / np.outer(scale, scale)) < d:
            raise ValueError("the inputs are linearly dependent, so the normal equation has no single solution")
        w = np.linalg.solve(a / np.outer(scale, scale), b / scale[:, None]) / scale[:, None]
        means = np.asarray(shift) + s / n
        bias = means[d:] - means[:d] @ w
        return LinearModel(self._settings(), {"coefs": w.tolist(), "bias": bias.tolist(), "history": []})

    def _fit(self, dataset: DataFrame) -> "LinearModel":
        if self.solver == "mbgd":
            return self.trainer.fit(dataset)
        shift = self._means(dataset)
        return self._solve(shift, list(gram(dataset, self._columns(), shift=shift).values()))

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "LinearModel"]:
        if self.solver == "mbgd":
            return super().fit_folds(df, fold_col, folds)
        shift = self._means(df)
        parts = gram(df, self._columns(), by=fold_col, shift=shift)
        return {i: self._solve(shift, [p for g, p in parts.items() if g != i]) for i in folds}


class LinearModel(TableModel):
    @classmethod
    def by_fold(cls, df: DataFrame, models: list["LinearModel"], index: Column) -> DataFrame | None:
        first, out = models[0], {}
        for t, name in enumerate(first.prediction_cols):
            z = F.get(double_array([m.state["bias"][t] for m in models]), index)
            for j, c in enumerate(first.input_cols):
                z = z + feature(c) * F.get(double_array([m.state["coefs"][j][t] for m in models]), index)
            out[name] = z
        return df.withColumns(out)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {
                name: linear_score(self.input_cols, [w[t] for w in self.state["coefs"]], self.state["bias"][t])
                for t, name in enumerate(self.prediction_cols)
            }
        )


class _CoefTrainer(StepTrainer):
    """Weights from zero; ``w -= rate / n * sum(error * x)`` with n the rows of the table, not of the batch."""

    def columns(self) -> dict[str, Column]:
        return {
            **{f"x{i}": feature(c) for i, c in enumerate(self.input_cols)},
            "y": self.target_column(),
        }

    def target_column(self) -> Column:
        return feature(self.target_cols[0])

    def initial_state(self, df: DataFrame, n: int) -> dict[str, Any]:
        return {"coefs": [0.0] * len(self.input_cols), "bias": 0.0}

    def z(self, state) -> Column:
        return linear_score([f"x{i}" for i in range(len(self.input_cols))], state["coefs"], state["bias"])

    def output(self, z: Column) -> tuple[Column, Column]:
        """What the error is taken from, and what the loss sees."""
        return z, z

    def step(self, batch: DataFrame, state) -> DataFrame:
        soft, hard = self.output(self.z(state))
        scored = batch.withColumn("e", soft - F.col("y")).withColumn("p", hard)
        return scored.agg(
            F.sum("e").alias("e"),
            *[F.sum(F.col("e") * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(self.input_cols))],
            self.loss("y", "p").alias("loss"),
        )

    def fold_step(self, batch: DataFrame, states) -> DataFrame:
        d, run = len(self.input_cols), F.col("run")
        z = F.get(double_array([s["bias"] for s in states]), run)
        for j in range(d):
            z = z + F.col(f"x{j}") * F.get(double_array([s["coefs"][j] for s in states]), run)
        soft, hard = self.output(z)
        scored = batch.withColumn("e", soft - F.col("y")).withColumn("p", hard)
        sums = [F.sum("e").alias("e"), *[F.sum(F.col("e") * F.col(f"x{j}")).alias(f"g{j}") for j in range(d)]]
        return scored.groupBy("run").agg(*sums, self.loss("y", "p").alias("loss"))

    def update(self, state, rows, learning_rate, n):
        (row,) = rows
        rate = learning_rate / n
        return {
            "coefs": [w - rate * row[f"g{i}"] for i, w in enumerate(state["coefs"])],
            "bias": state["bias"] - rate * row["e"],
        }


class SquaredErrorTrainer(_CoefTrainer):
    def _fit(self, dataset: DataFrame) -> LinearModel:
        most = max_ranges(len(self.input_cols))
        many = self.batch_size is not None and dataset.count() > most * self.batch_size
        placed, n, batches = self.batched(dataset, clustered=many)
        placed = placed.withColumnRenamed("__pos", "pos").withColumn("run", F.lit(0))
        (run,) = self._descend(placed, [n], [batches], self.progress)
        return self.make_model(run.state, run.history)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, LinearModel]:
        """All folds at once: a row enters the sums or ranges of all folds but its own."""
        placed, n, batches = self.batched_folds(df, fold_col, folds)
        rows = placed.select(*self.columns(), F.inline("at"))
        return {i: self.make_model(r.state, r.history) for i, r in zip(folds, self._descend(rows, n, batches))}

    def _descend(self, rows: DataFrame, n: list[int], batches: list[int], progress: str | None = None) -> list[Run]:
        d = len(self.input_cols)
        few = max(batches) <= max_ranges(d)
        scan = SummedBatches(rows, d, n, batches, self.loss, gram) if few else ComposedRanges(rows, d, n, batches, self.loss)
        # a callback that reads losses needs them epoch by epoch; else those of several epochs are found at once
        watched = progress is not None or any(not isinstance(c, LearningRateScheduler) for c in self.callbacks)
        start = lambda: {"coefs": [0.0] * d, "bias": 0.0}
        if progress is not None:
            runs = [self.run(rows.sparkSession, n[0], start)]
        else:
            runs = [Run(copy.deepcopy(self.callbacks) if len(n) > 1 else self.callbacks, self.epochs, self.learning_rate, start) for _ in n]
        trajectory = []
        try:
            while any(r.active for r in runs):
                going = {j: r for j, r in enumerate(runs) if r.active}
                if not few:
                    scan.compose({j: r.rate for j, r in going.items()})
                epoch = {}
                for j, r in going.items():
                    before, after = scan.epoch(j, np.array([*r.state["coefs"], r.state["bias"]]), r.rate)
                    epoch[j] = before, r.rate
                    r.state = {"coefs": after[:d].tolist(), "bias": float(after[d])}
                trajectory.append(epoch)
                if watched or len(trajectory) == EPOCHS_AT_ONCE:
                    self._note_losses(scan, trajectory, runs, watched)
                for j, r in going.items():
                    r.end_epoch(r.losses if watched else [])
            self._note_losses(scan, trajectory, runs, False)
        finally:
            scan.close()
        return runs

    def _note_losses(self, scan, trajectory: list, runs: list[Run], watched: bool) -> None:
        for epoch in scan.losses(trajectory) if trajectory else []:
            for j, losses in epoch.items():
                if watched:
                    runs[j].losses = losses
                else:
                    runs[j].history.append(sum(losses) / len(losses))
        trajectory.clear()

    def make_model(self, state, history) -> LinearModel:
        params = {"input_cols": self.input_cols, "target_cols": self.target_cols, "solver": "mbgd"}
        return LinearModel(
            params, {"coefs": [[w] for w in state["coefs"]], "bias": [state["bias"]], "history": history}
        )


class LogisticClassifier(_CoefTrainer):
    """The error uses the probability, the loss and the prediction the class at 0.5. Targets are 0 and 1.

    With ``shards`` rows are dealt to so many shards by a hash of their key, whatever the partitioning. In an epoch every shard
    descends on its own from the common weights, batch after batch (of 32 rows, if no other size is given), as if it were the
    table; the weights that they reach are averaged by rows. An epoch is one job at any batch size. One shard is plain descent.
    """

    def __init__(self, input_cols, target_cols, row_key, loss=accuracy, shards: int | None = None, **kwargs):
        super().__init__(input_cols, target_cols, row_key, loss, **kwargs)
        if len(self.target_cols) != 1:
            raise ValueError("a binary classifier takes one target")
        if shards is not None and shards < 1:
            raise ValueError("there is at least 1 shard")
        self.shards = shards

    def _fit(self, dataset: DataFrame) -> "BinaryModel":
        return super()._fit(dataset) if self.shards is None else self._fit_shards(dataset)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "BinaryModel"]:
        return super().fit_folds(df, fold_col, folds) if self.shards is None else TableEstimator.fit_folds(self, df, fold_col, folds)

    def _fit_shards(self, dataset: DataFrame) -> "BinaryModel":
        keyed, keys = self._keyed(dataset)
        order = [shuffle_hash(self.seed, keys).alias("__hash")] if self.shuffle else []
        dealt = keyed.select("*", F.pmod(F.xxhash64(*keys), F.lit(self.shards)).cast("int").alias("shard"), *order)
        laid = dealt.repartition("shard").sortWithinPartitions("shard", *(["__hash"] if order else []), *keys)
        inputs = [f"x{i}" for i in range(len(self.input_cols))]
        cached = laid.select("shard", *inputs, "y").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = {r["shard"]: r["count"] for r in cached.groupBy("shard").count().collect()}
            if not n:
                raise ValueError("no rows to train on")
            run = self.run(dataset.sparkSession, sum(n.values()), lambda: {"coefs": [0.0] * len(inputs), "bias": 0.0})
            while run.active:
                t = np.array([*run.state["coefs"], run.state["bias"]])
                descent = cached.mapInArrow(
                    shard_descent(t, run.rate, n, self.batch_size or 32, self.numpy_output()), "shard int, batch_id long, y double, p double, t array<double>"
                )
                by_batch = descent.groupBy("shard", "batch_id").agg(F.when(F.col("batch_id") >= 0, self.loss("y", "p")).alias("loss"), F.max("t").alias("t"))
                ends = by_batch.groupBy("shard").agg(F.sum("loss").alias("loss"), F.count("loss").alias("batches"), F.max("t").alias("t")).collect()
                ends.sort(key=lambda r: r["shard"])  # sums in one order, so that runs agree to the last bit
                mean = sum(n[r["shard"]] * np.array(r["t"]) for r in ends) / sum(n.values())
                run.state = {"coefs": mean[:-1].tolist(), "bias": float(mean[-1])}
                run.end_epoch([sum(r["loss"] for r in ends) / sum(r["batches"] for r in ends)])
        finally:
            cached.unpersist()
        return self.make_model(run.state, run.history)

    def numpy_output(self) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """``output`` for arrays, as a function that travels without the estimator."""

        def output(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-z))
            return p, (p >= 0.5).astype(float)

        return output

    def target_column(self) -> Column:
        y = feature(self.target_cols[0])
        return F.when(y.isin(0.0, 1.0), y).otherwise(
            F.raise_error(F.lit("the target of a binary classifier is 0 or 1")).cast("double")
        )

    def output(self, z: Column) -> tuple[Column, Column]:
        p = sigmoid(z)
        return p, (p >= 0.5).cast("double")

    def make_model(self, state, history) -> "BinaryModel":
        params = {"input_cols": self.input_cols, "target_cols": self.target_cols, "rule": "logistic", "threshold": 0.5}
        return BinaryModel(params, {**state, "history": history})


class Perceptron(LogisticClassifier):
    """The class is ``z > threshold``, and the error is taken from the class."""

    def __init__(self, input_cols, target_cols, row_key, loss=accuracy, threshold: float = 0.0, **kwargs):
        super().__init__(input_cols, target_cols, row_key, loss, **kwargs)
        self.threshold = threshold

    def numpy_output(self) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        threshold = self.threshold
        return lambda z: ((z > threshold).astype(float),) * 2

    def output(self, z: Column) -> tuple[Column, Column]:
        hard = (z > F.lit(self.threshold)).cast("double")
        return hard, hard

    def make_model(self, state, history) -> "BinaryModel":
        params = {
            "input_cols": self.input_cols,
            "target_cols": self.target_cols,
            "rule": "perceptron",
            "threshold": self.threshold,
        }
        return BinaryModel(params, {**state, "history": history})


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


class BinaryModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        z = linear_score(self.input_cols, self.state["coefs"], self.state["bias"])
        if self.params_["rule"] == "perceptron":
            return dataset.withColumn("prediction", (z > F.lit(self.params_["threshold"])).cast("int"))
        out = dataset.withColumn("probability", sigmoid(z))
        return out.withColumn("prediction", (F.col("probability") >= self.params_["threshold"]).cast("int"))

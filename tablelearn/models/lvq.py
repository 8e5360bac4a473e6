"""Learning vector quantization (V1-V3)."""

from __future__ import annotations

from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..base import TableEstimator, TableModel
from ..functions.columns import constant_array, feature, long_array, to_col
from ..functions.metrics import accuracy
from ..operators.position import lowest_hashes, positional, shuffle_hash
from ..session import dropped, written
from .knn import nearest_neighbours
from .training import StepTrainer

# Codebooks times inputs up to which distances are written out; above, numpy compares a batch with all codebooks. Both add
# up the squares input by input, so near ties fall the same way.
MAX_TERMS = 600
MAX_CODEBOOKS = 100_000


def _closest(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype="int32")
    step = max(1, 4_000_000 // table.size)
    for at in range(0, len(x), step):
        part = x[at : at + step]
        total = np.zeros((len(part), len(table)))
        for j in range(table.shape[1]):
            gap = part[:, j, None] - table[None, :, j]
            total += gap * gap
        out[at : at + step] = total.argmin(axis=1)
    return out


def nearest_codebook(xs: list[Column], codebooks: list[list[float]]) -> Column:
    """The number of the nearest codebook, the lowest on ties."""
    if len(codebooks) == 1:
        return F.lit(0)
    if len(codebooks) * len(xs) <= MAX_TERMS:
        ranked = []
        for i, c in enumerate(codebooks):
            total = F.lit(0.0)
            for x, m in zip(xs, c):
                total = total + (x - F.lit(m)) * (x - F.lit(m))
            ranked.append(F.struct(total.alias("d"), F.lit(i).alias("i")))
        return F.least(*ranked)["i"]
    table = np.array(codebooks)

    def closest(vec: pd.Series) -> pd.Series:
        return pd.Series(_closest(np.stack(vec.to_numpy()), table) if len(vec) else [], dtype="int32")

    return F.pandas_udf(closest, "int")(F.array(*xs))


def nearest_by_run(xs: list[Column], run: Column, codebooks: list[list[list[float]]]) -> Column:
    """The number of the nearest codebook among those of the row's own run, the lowest on ties."""
    tables = [np.array(c) for c in codebooks]

    def closest(vec: pd.Series, run: pd.Series) -> pd.Series:
        out = np.zeros(len(vec), dtype="int32")
        for r in run.unique():
            at = np.flatnonzero(run.to_numpy() == r)
            out[at] = _closest(np.stack(vec.to_numpy()[at]), tables[r])
        return pd.Series(out)

    return F.pandas_udf(closest, "int")(F.array(*xs), run)


def nearest_in_table(table: DataFrame, rows: DataFrame, xs: list[Column], key: Column) -> DataFrame:
    """``(__row, cb)``: the key of each row and its nearest codebook of a table, the lowest on ties."""
    places = table.select("cb", F.array(*[F.col(f"m{i}") for i in range(len(xs))]).alias("at"))
    asked = rows.select(key.alias("__row"), F.array(*xs).alias("at"))
    found = nearest_neighbours(places, asked, "at", 1, "cb", "__row")
    return found.select(F.col("query").alias("__row"), F.col("neighbour").alias("cb"))


class LVQ(StepTrainer):
    """A step finds each row's nearest codebook as of the batch's start and sums, per codebook, the pull of rows
    with its label and the push of the others; the driver gets one row per codebook.

    ``n_codebooks`` is by default a twentieth of the rows and at least 3, at any size. ``init="rows"`` takes whole rows,
    ``"columns"`` samples every column on its own. Both are the rows of least ``md5(seed...:key)``.

    Up to ``driver_codebooks`` the codebooks are numbers in the plan. Beyond that they are a table in the shared folder: a step
    joins the batch with it (each row to its nearest codebook, block by block), adds up pulls and pushes by codebook, and
    writes the moved table. The driver then holds none of them, and the model keeps them as a table.
    """

    def __init__(
        self, input_cols, target_cols, row_key, loss=accuracy, n_codebooks: int | None = None, init: str = "rows",
        driver_codebooks: int = MAX_CODEBOOKS, **kwargs,
    ):
        super().__init__(input_cols, target_cols, row_key, loss, **kwargs)
        if init not in ("rows", "columns"):
            raise ValueError("init is rows or columns")
        self.n_codebooks = n_codebooks
        self.init = init
        self.driver_codebooks = driver_codebooks

    def columns(self) -> dict[str, Column]:
        return {
            **{f"x{i}": feature(c) for i, c in enumerate(self.input_cols)},
            **{f"y{i}": to_col(c) for i, c in enumerate(self.target_cols)},
        }

    def initial_state(self, df: DataFrame, n: int) -> dict[str, Any]:
        wanted = self._wanted(n)
        if wanted > self.driver_codebooks:
            return {"table": written(self._first_table(df, min(wanted, n)), "codebooks")}
        keys = [f"__key_{k}" for k in self.row_key]
        d, t = len(self.input_cols), len(self.target_cols)
        if self.init == "rows":
            rows = lowest_hashes(df, shuffle_hash(self.seed, keys), keys, wanted, n)
            return {
                "codebooks": [[r[f"x{i}"] for i in range(d)] for r in rows],
                "labels": [[r[f"y{i}"] for i in range(t)] for r in rows],
            }
        cells = {}
        for name in [f"x{i}" for i in range(d)] + [f"y{i}" for i in range(t)]:
            order = shuffle_hash(f"{self.seed}:{name}", keys)
            cells[name] = [r[name] for r in lowest_hashes(df.select(name, *keys), order, keys, wanted, n)]
        size = len(cells["x0"])
        return {
            "codebooks": [[cells[f"x{i}"][j] for i in range(d)] for j in range(size)],
            "labels": [[cells[f"y{i}"][j] for i in range(t)] for j in range(size)],
        }

    def _wanted(self, n: int) -> int:
        return self.n_codebooks or max(n // 20, 3)

    def _first_table(self, df: DataFrame, wanted: int) -> DataFrame:
        """``(cb, m0.., p0..)``: positions and labels of the first codebooks, numbered in the order of the key's hash."""
        keys, d, t = [f"__key_{k}" for k in self.row_key], len(self.input_cols), len(self.target_cols)
        names = {**{f"x{i}": f"m{i}" for i in range(d)}, **{f"y{i}": f"p{i}" for i in range(t)}}
        if self.init == "rows":
            placed = positional(df.select(*names, *keys), keys, self.seed, "cb")
            return placed.filter(F.col("cb") < wanted).select("cb", *[F.col(x).alias(m) for x, m in names.items()])
        columns = []
        for x, m in names.items():
            placed = positional(df.select(x, *keys), keys, f"{self.seed}:{x}", "cb")
            columns.append(placed.filter(F.col("cb") < wanted).select("cb", F.col(x).alias(m)))
        return reduce(lambda a, b: a.join(b, "cb"), columns)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, TableModel]:
        # at most so many codebooks for any fold
        if self._wanted(df.count()) > self.driver_codebooks:
            return TableEstimator.fit_folds(self, df, fold_col, folds)
        return super().fit_folds(df, fold_col, folds)

    def advance(self, run, batch: DataFrame, n: int) -> None:
        if "table" not in run.state:
            super().advance(run, batch, n)
            return
        d, t, old = len(self.input_cols), len(self.target_cols), run.state["table"]
        near = nearest_in_table(old, batch, [F.col(f"x{i}") for i in range(d)], F.col("__pos"))
        met = batch.join(near, F.col("__pos") == F.col("__row")).drop("__row").join(old, "cb")
        same = reduce(lambda a, b: a & b, [F.col(f"y{i}").eqNullSafe(F.col(f"p{i}")) for i in range(t)])
        loss = self.loss([f"y{i}" for i in range(t)], [f"p{i}" for i in range(t)])
        # the line without codebook carries the loss, as in a step of few codebooks
        pulls = written(
            met.withColumn("s", F.when(same, 1.0).otherwise(-1.0)).rollup("cb").agg(
                F.sum("s").alias("s"), *[F.sum(F.col("s") * F.col(f"x{i}")).alias(f"sx{i}") for i in range(d)],
                F.when(F.grouping("cb") == 1, loss).alias("loss"),
            ),
            "pulls",
        )
        run.losses.append(float(pulls.filter("cb IS NULL").first()["loss"]))
        step = lambda i: F.lit(run.rate) * (F.col(f"sx{i}") - F.col("s") * F.col(f"m{i}"))
        moved = old.join(pulls.filter("cb IS NOT NULL").drop("loss"), "cb", "left").select(
            "cb", *[(F.col(f"m{i}") + F.coalesce(step(i), F.lit(0.0))).alias(f"m{i}") for i in range(d)], *[f"p{i}" for i in range(t)]
        )
        new = written(moved, "codebooks")
        dropped(pulls)
        live = run.context.memory.setdefault(LVQ, [old])
        # tables at the end of an epoch may be the record that a callback restores
        if len(run.losses) > 1:
            dropped(live.pop())
        live.append(new)
        run.state = {"table": new}

    def clean(self, run) -> None:
        """Deletes the tables at the ends of epochs, but for the one that became the model."""
        for table in run.context.memory.get(LVQ, []):
            if table is not run.state["table"]:
                dropped(table)

    def step(self, batch: DataFrame, state) -> DataFrame:
        xs = [F.col(f"x{i}") for i in range(len(self.input_cols))]
        hit = batch.withColumn("cb", nearest_codebook(xs, state["codebooks"]))
        return self._pulls(hit, F.col("cb"), state["labels"])

    def fold_step(self, batch: DataFrame, states) -> DataFrame:
        xs = [F.col(f"x{i}") for i in range(len(self.input_cols))]
        hit = batch.withColumn("cb", nearest_by_run(xs, F.col("run"), [s["codebooks"] for s in states]))
        first = long_array([sum(len(s["labels"]) for s in states[:j]) for j in range(len(states))])
        label = (F.get(first, F.col("run")) + F.col("cb")).cast("int")
        return self._pulls(hit, label, [row for s in states for row in s["labels"]], "run").filter("run IS NOT NULL")

    def _pulls(self, hit: DataFrame, label: Column, labels: list[list], *by: str) -> DataFrame:
        """Per codebook the sums that move it; the line without codebook carries the loss."""
        d, t = len(self.input_cols), len(self.target_cols)
        for i in range(t):
            hit = hit.withColumn(f"p{i}", F.get(constant_array([row[i] for row in labels]), label))
        same = F.lit(True)
        for i in range(t):
            same = same & F.col(f"y{i}").eqNullSafe(F.col(f"p{i}"))
        signed = hit.withColumn("s", F.when(same, 1.0).otherwise(-1.0))
        loss = self.loss([f"y{i}" for i in range(t)], [f"p{i}" for i in range(t)])
        return signed.rollup(*by, "cb").agg(
            F.sum("s").alias("s"),
            *[F.sum(F.col("s") * F.col(f"x{i}")).alias(f"sx{i}") for i in range(d)],
            F.when(F.grouping("cb") == 1, loss).alias("loss"),
        )

    def update(self, state, rows, learning_rate, n):
        moved = [list(c) for c in state["codebooks"]]
        for r in rows:
            if r["cb"] is None:
                continue
            old = state["codebooks"][r["cb"]]
            moved[r["cb"]] = [c + learning_rate * (r[f"sx{i}"] - r["s"] * c) for i, c in enumerate(old)]
        return {"codebooks": moved, "labels": state["labels"]}

    def make_model(self, state, history) -> "LVQModel | LVQTableModel":
        params = {"input_cols": self.input_cols, "target_cols": self.target_cols}
        if "table" in state:
            return LVQTableModel({**params, "row_key": self.row_key}, {"history": history}, {"codebooks": state["table"]})
        return LVQModel(params, {**state, "history": history})


class LVQModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumn("__cb", nearest_codebook([feature(c) for c in self.input_cols], self.state["codebooks"]))
        for i, name in enumerate(self.prediction_cols):
            labels = constant_array([row[i] for row in self.state["labels"]])
            out = out.withColumn(name, F.get(labels, F.col("__cb")))
        return out.drop("__cb")

    def codebooks(self, spark) -> DataFrame:
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.state["codebooks"])]
        return spark.createDataFrame(rows, "codebook int, position array<double>")


class LVQTableModel(TableModel):
    """A model whose codebooks are a table: rows, told apart by their key, are joined with their nearest codebook."""

    row_local = False

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keyed = dataset.withColumn("__row", F.to_json(F.struct(*[to_col(k) for k in self.params_["row_key"]])))
        table, xs = self.tables["codebooks"], [feature(c) for c in self.input_cols]
        near = nearest_in_table(table, keyed, xs, F.col("__row"))
        labels = near.join(table, "cb").select("__row", *[F.col(f"p{i}").alias(name) for i, name in enumerate(self.prediction_cols)])
        return keyed.drop(*self.prediction_cols).join(labels, "__row", "left").drop("__row")

    def codebooks(self, spark) -> DataFrame:
        table = self.tables["codebooks"]
        return table.select(F.col("cb").alias("codebook"), F.array(*[F.col(c) for c in table.columns if c.startswith("m")]).alias("position"))

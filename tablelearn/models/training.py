"""Loop for models trained in steps.

Every step is one aggregate job over one batch of a cached table; only its few sums reach the driver, and the
state goes into the next step as literals. No lineage grows with the steps. A step costs a job, so the default
is ten large batches per epoch, whatever the size of the table.
"""

from __future__ import annotations

import copy
import json
import math
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from ..base import TableEstimator, TableModel, read_value, written_value
from ..functions.columns import as_list, to_col
from ..operators.position import positional_with_count, rank_groups

DEFAULT_BATCHES = 10
MANY_STEPS = 1000
# Rows whose places are counted in one task.
CHUNK_ROWS = 250_000


@dataclass
class TrainingContext:
    """What a callback sees after each epoch; it may change ``learning_rate`` and ``state``."""

    epoch: int
    epochs: int
    losses: list[float]
    learning_rate: float
    state: dict[str, Any]
    history: list[float] = field(default_factory=list)
    # what callbacks keep from epoch to epoch of this training, under a key of their own
    memory: dict[Any, Any] = field(default_factory=dict)


# A callback gets the context and says whether training goes on.
Callback = Callable[[TrainingContext], bool]


class LearningRateScheduler:
    """After each epoch the rate is multiplied by ``1 - epoch / epochs``, so the decay compounds."""

    def __init__(self, mode: str = "linear_decay"):
        if mode != "linear_decay":
            raise ValueError("the only mode is linear_decay")
        self.mode = mode

    def __call__(self, ctx: TrainingContext) -> bool:
        ctx.learning_rate = ctx.learning_rate * (1.0 - ctx.epoch / ctx.epochs)
        return True


def best_epoch(scores: Sequence[float], mode: str = "min", min_delta: float = 0.0) -> int:
    """The epoch that holds the record at the end, where a new record must beat the old one by more than ``min_delta``."""
    gain = (lambda old, new: old - new) if mode == "min" else (lambda old, new: new - old)
    return reduce(lambda best, e: e if gain(scores[best], scores[e]) > min_delta else best, range(len(scores)), 0)


class EarlyStopping:
    """Ends training once the record is ``patience`` epochs old, and then restores the record's state.

    The rule looks at the scores of all epochs so far, which the training keeps; the object itself has settings only.
    """

    def __init__(self, patience: int = 5, mode: str = "min", restore_best: bool = True, min_delta: float = 1e-4):
        if mode not in ("min", "max"):
            raise ValueError("mode is min or max")
        self.patience, self.mode, self.restore_best, self.min_delta = patience, mode, restore_best, min_delta

    def get_score(self, losses: Sequence[float]) -> float:
        return sum(losses) / len(losses)

    def __call__(self, ctx: TrainingContext) -> bool:
        kept = ctx.memory.setdefault(self, {"scores": [], "state": None})
        kept["scores"].append(self.get_score(ctx.losses))
        age = len(kept["scores"]) - 1 - best_epoch(kept["scores"], self.mode, self.min_delta)
        if age == 0:
            kept["state"] = dict(ctx.state)
        if age < self.patience:
            return True
        ctx.state = kept["state"] if self.restore_best else ctx.state
        return False


class Progress:
    """The state after each epoch as a line of JSON in a folder of its own, so that a training outlives its driver.

    A state that is a table stays where it was written, and is named. ``settings`` tell trainings apart: another table or other
    settings are not continued. Of callbacks, what they keep in the context's ``memory`` under themselves is kept.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict[str, Any]):
        self.spark, self.path, self.settings = spark, path, settings

    def save(self, run: Run) -> None:
        ctx = run.context
        kept = {
            "settings": self.settings, "epoch": ctx.epoch, "rate": ctx.learning_rate, "state": ctx.state, "history": ctx.history,
            "memory": [ctx.memory.get(c) for c in run.callbacks], "active": run.active,
        }
        line = self.spark.createDataFrame([(json.dumps(kept, default=_named),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self.path}/epoch-{ctx.epoch:05d}")

    def restore(self, run: Run) -> bool:
        """Puts a run where the last whole epoch left it, if there is one."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return False
        lines = self.spark.read.option("recursiveFileLookup", "true").text(self.path).collect()  # a line per epoch
        if not lines:
            return False
        last = max((json.loads(r[0]) for r in lines), key=lambda k: k["epoch"])
        if not last["active"]:  # tables of other epochs are gone
            last["memory"] = []
        kept = json.loads(json.dumps(last), object_hook=self._found)
        if kept["settings"] != json.loads(json.dumps(self.settings)):
            raise ValueError(f"{self.path} holds the progress of another training: {kept['settings']}, not {self.settings}")
        ctx = run.context
        ctx.epoch, ctx.learning_rate, ctx.state, ctx.history = kept["epoch"], kept["rate"], kept["state"], kept["history"]
        ctx.memory = {c: m for c, m in zip(run.callbacks, kept["memory"]) if m is not None}
        run.active = kept["active"]
        return True

    def _found(self, value: dict) -> Any:
        return self.spark.read.parquet(value["__table"]) if "__table" in value else read_value(value)


def _named(value: Any) -> dict[str, str]:
    return {"__table": value.inputFiles()[0].rpartition("/")[0]} if isinstance(value, DataFrame) else written_value(value)


class Run:
    """The course of one training: its state, rate, losses and callbacks from epoch to epoch."""

    def __init__(
        self, callbacks: Sequence[Callback], epochs: int, learning_rate: float, start: Callable[[], dict[str, Any]], progress: Progress | None = None
    ):
        self.callbacks = list(callbacks)
        for c in self.callbacks:
            if hasattr(c, "reset"):
                c.reset()
        self.progress = progress
        self.context = TrainingContext(-1, epochs, [], learning_rate, {})
        self.losses: list[float] = []
        self.active = epochs > 0
        if progress is None or not progress.restore(self):
            self.state = start()

    @property
    def state(self) -> dict[str, Any]:
        return self.context.state

    @state.setter
    def state(self, value: dict[str, Any]) -> None:
        self.context.state = value

    @property
    def rate(self) -> float:
        return self.context.learning_rate

    @property
    def history(self) -> list[float]:
        return self.context.history

    def end_epoch(self, losses: list[float] | None = None) -> None:
        """Takes note of the epoch's losses, if they are known yet. All callbacks see it, even when an earlier one asks to stop."""
        ctx = self.context
        ctx.epoch, ctx.losses = ctx.epoch + 1, self.losses if losses is None else losses
        if ctx.losses:
            ctx.history.append(sum(ctx.losses) / len(ctx.losses))
        go_on = all([bool(c(ctx)) for c in self.callbacks])
        self.active, self.losses = go_on and ctx.epoch + 1 < ctx.epochs, []
        if self.progress is not None:
            self.progress.save(self)


class StepTrainer(TableEstimator):
    """Base of step-trained models. A subclass gives the start, the sums of a step, and the update:

    ``columns()``            the columns training needs, by name
    ``initial_state(df, n)`` a dict of plain values
    ``step(batch, state)``   a DataFrame of bounded size with a ``loss`` column, at least in its first row
    ``fold_step(batch, states)``  the same for all folds at once, if the model has such a form
    ``update(state, rows, learning_rate, n)``  the next state, from the collected step
    ``make_model(state, history)``

    ``progress`` names a folder that keeps the state after every epoch; a training that finds one there goes on from it. Folds
    are trained without.
    """

    def __init__(
        self,
        input_cols,
        target_cols,
        row_key,
        loss: Callable[[Any, Any], Column],
        learning_rate: float = 1e-4,
        epochs: int = 10,
        batch_size: int | None = None,
        shuffle: bool = False,
        seed: int = 42,
        callbacks: Sequence[Callback] = (),
        progress: str | None = None,
    ):
        super().__init__()
        self.progress = progress
        self.input_cols = as_list(input_cols)
        self.target_cols = as_list(target_cols)
        self.row_key = as_list(row_key)
        self.loss = loss
        self.learning_rate = learning_rate
        self.epochs = epochs
        self.batch_size = batch_size
        self.shuffle = shuffle
        self.seed = seed
        self.callbacks = list(callbacks)

    # -- the surface of a subclass --

    def columns(self) -> dict[str, Column]:
        raise NotImplementedError

    def initial_state(self, df: DataFrame, n: int) -> dict[str, Any]:
        raise NotImplementedError

    def step(self, batch: DataFrame, state: dict[str, Any]) -> DataFrame:
        raise NotImplementedError

    def fold_step(self, batch: DataFrame, states: list[dict[str, Any]]) -> DataFrame:
        """``step`` for several trainings at once: ``batch`` says with ``run`` whose state a row meets, and so does the result."""
        raise NotImplementedError

    def update(self, state: dict[str, Any], rows: list, learning_rate: float, n: int) -> dict[str, Any]:
        raise NotImplementedError

    def make_model(self, state: dict[str, Any], history: list[float]) -> TableModel:
        raise NotImplementedError

    # -- the loop --

    def _keyed(self, df: DataFrame, *more: Column) -> tuple[DataFrame, list[str]]:
        keyed = df.select(*[c.alias(n) for n, c in self.columns().items()], *[F.col(k).alias(f"__key_{k}") for k in self.row_key], *more)
        return keyed, [f"__key_{k}" for k in self.row_key]

    def _batch_rows(self, n: int) -> int:
        if n == 0:
            raise ValueError("no rows to train on")
        return self.batch_size or math.ceil(n / DEFAULT_BATCHES)

    def batched(self, df: DataFrame, clustered: bool = True) -> tuple[DataFrame, int, int]:
        """The training columns with ``batch_id``; the row count; the number of batches.

        ``clustered`` lays the rows of a batch together, in the order of ``__pos``, for training that visits batches one by one.
        """
        keyed, keys = self._keyed(df)
        seed = self.seed if self.shuffle else None
        if not clustered:
            placed, n = rank_groups(keyed, keys, seed, lambda n: range(self._batch_rows(n), n, self._batch_rows(n)), "batch_id")
            return placed, n, math.ceil(n / self._batch_rows(n))
        placed, n = positional_with_count(keyed, keys, seed, "__pos")
        size = self._batch_rows(n)
        return placed.withColumn("batch_id", F.floor(F.col("__pos") / size).cast("bigint")), n, math.ceil(n / size)

    def batched_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> tuple[DataFrame, list[int], list[int]]:
        """The training columns with ``at``: for every fold that a row trains (all but its own), the fold's number ``run``, and the
        row's ``pos`` and ``batch_id`` among those that train it; rows and batches of each.

        A row's place among the other folds' rows is its place in the table less the rows of that fold before it: those of
        earlier chunks, which are counted, and those of its own chunk, in which they are summed up.
        """
        keyed, keys = self._keyed(df, to_col(fold_col).alias("__fold"))
        placed, _ = positional_with_count(keyed.where("__fold IS NOT NULL"), keys, self.seed if self.shuffle else None, "__pos")
        placed = placed.withColumn("__chunk", F.floor(F.col("__pos") / CHUNK_ROWS))
        ones = [F.when(F.col("__fold") == i, 1).otherwise(0).cast("bigint") for i in folds]
        counts = placed.groupBy("__chunk").agg(*[F.sum(c).alias(f"n{j}") for j, c in enumerate(ones)], F.count(F.lit(1)).alias("n"))
        totals = counts.agg(*[F.sum(f"n{j}") for j in range(len(folds))], F.sum("n")).first()
        n = [(totals[-1] or 0) - (t or 0) for t in totals[:-1]]
        sizes = [self._batch_rows(x) for x in n]
        # one row per chunk
        before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("__chunk", *[F.coalesce(F.sum(f"n{j}").over(before), F.lit(0)).alias(f"o{j}") for j in range(len(folds))])
        inside = Window.partitionBy("__chunk").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
        counted = placed.withColumns({f"c{j}": F.sum(c).over(inside) for j, c in enumerate(ones)}).join(offsets, "__chunk")
        places = []
        for j, i in enumerate(folds):
            pos = F.col("__pos") - F.col(f"o{j}") - F.col(f"c{j}")
            place = F.struct(F.lit(j).alias("run"), pos.alias("pos"), F.floor(pos / sizes[j]).cast("bigint").alias("batch_id"))
            places.append(F.when(F.col("__fold") != i, place))
        at = F.filter(F.array(*places), lambda a: a.isNotNull())
        rows = counted.select(*self.columns(), *keys, "__fold", at.alias("at"))
        return rows, n, [math.ceil(x / s) for x, s in zip(n, sizes)]

    def _fit(self, dataset: DataFrame) -> TableModel:
        placed, n, batches = self.batched(dataset)
        self._warn(batches)
        # rows lie in batch order, so cached blocks of other batches are skipped by their min and max
        cached = placed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run = self.run(dataset.sparkSession, n, lambda: self.initial_state(cached, n))
            while run.active:
                for b in range(batches):
                    part = cached.filter(F.col("batch_id") == b) if batches > 1 else cached
                    self.advance(run, part, n)
                run.end_epoch()
        finally:
            cached.unpersist()
        self.clean(run)
        return self.make_model(run.state, run.history)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, TableModel]:
        """All folds in one course of training: a step is one job over its batch, in which a row meets the states of all folds
        but its own. The models are those of a training by fold."""
        if type(self).fold_step is StepTrainer.fold_step:
            return super().fit_folds(df, fold_col, folds)
        rows, n, batches = self.batched_folds(df, fold_col, folds)
        self._warn(max(batches))
        ids = F.transform("at", lambda a: a["batch_id"])
        cached = rows.withColumns({"first": F.array_min(ids), "last": F.array_max(ids)}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            runs = [
                Run(copy.deepcopy(self.callbacks), self.epochs, self.learning_rate, lambda i=i, j=j: self.initial_state(cached.filter(F.col("__fold") != i), n[j]))
                for j, i in enumerate(folds)
            ]
            while any(r.active for r in runs):
                for b in range(max(batches)):
                    going = [j for j, r in enumerate(runs) if r.active and b < batches[j]]
                    if not going:
                        continue
                    meets = F.filter("at", lambda a: (a["batch_id"] == b) & a["run"].isin(going))
                    part = cached.filter((F.col("first") <= b) & (F.col("last") >= b)).withColumn("run", F.explode(F.transform(meets, lambda a: a["run"])))
                    found = self.fold_step(part, [r.state for r in runs]).collect()
                    for j in going:
                        self._moved(runs[j], [r for r in found if r["run"] == j], n[j])
                for r in runs:
                    if r.active:
                        r.end_epoch()
        finally:
            cached.unpersist()
        return {i: self.make_model(r.state, r.history) for i, r in zip(folds, runs)}

    def run(self, spark: SparkSession, n: int, start: Callable[[], dict[str, Any]]) -> Run:
        """A training of this estimator, from its start or from where ``progress`` says it got to."""
        settings = {"trainer": type(self).__name__, "rows": n} | {
            k: getattr(self, k) for k in ("input_cols", "target_cols", "row_key", "learning_rate", "epochs", "batch_size", "shuffle", "seed")
        }
        kept = Progress(spark, self.progress, settings) if self.progress else None
        return Run(self.callbacks, self.epochs, self.learning_rate, start, kept)

    def _warn(self, batches: int) -> None:
        if batches * self.epochs > MANY_STEPS:
            warnings.warn(f"{batches * self.epochs} steps, each a Spark job; a larger batch_size needs fewer")

    def clean(self, run: Run) -> None:
        """What is to be done when a training is over."""

    def advance(self, run: Run, batch: DataFrame, n: int) -> None:
        """One step of a run."""
        self._moved(run, self.step(batch, run.state).collect(), n)

    def _moved(self, run: Run, rows: list, n: int) -> None:
        run.losses.append(next(float(r["loss"]) for r in rows if r["loss"] is not None))
        run.state = self.update(run.state, rows, run.rate, n)


def loss_history(model: TableModel, spark) -> DataFrame:
    """``(epoch, loss)``, the mean of the batch losses before each update."""
    rows = [(i, float(x)) for i, x in enumerate(model.state["history"])]
    return spark.createDataFrame(rows, "epoch int, loss double")

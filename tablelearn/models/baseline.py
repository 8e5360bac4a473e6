"""Baselines that look at the targets only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, constant_array, distinct_values, stacked, to_col
from ..operators.position import shuffle_hash
from ..operators.quantile import exact_quantiles

ZERO_MODES = ("classification", "regression_mean", "regression_median")


class RandomModel(TableEstimator):
    """A draw from the distinct target values, by a hash of the seed and the row's key: a row keeps its draw
    under any partitioning. Every class is equally likely, however rare it is."""

    def __init__(self, target_cols, row_key, seed: int = 42, max_classes: int = 100_000):
        super().__init__()
        self.target_cols = as_list(target_cols)
        self.row_key = as_list(row_key)
        self.seed = seed
        self.max_classes = max_classes

    def _model(self, classes: list[list]) -> "RandomFitted":
        for c, values in zip(self.target_cols, classes):
            if len(values) > self.max_classes:
                raise ValueError(f"target {c} has more than {self.max_classes} classes")
        params = {"input_cols": [], "target_cols": self.target_cols, "row_key": self.row_key, "seed": self.seed}
        return RandomFitted(params, {"classes": classes})

    def _fit(self, dataset: DataFrame) -> "RandomFitted":
        found = distinct_values(dataset, [to_col(c) for c in self.target_cols], self.max_classes)
        if found is None:
            raise ValueError(f"a target of {self.target_cols} has more than {self.max_classes} classes")
        return self._model(found)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "RandomFitted"]:
        most = self.max_classes * len(folds) * len(self.target_cols)
        rows = stacked(df, [to_col(c) for c in self.target_cols], [to_col(fold_col).alias("f")]).distinct().limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a target of {self.target_cols} has more than {self.max_classes} classes, or there are more folds than given")
        per_target = [{i: sorted({r[f"c{j}"] for r in rows if r["i"] == j and r["f"] != i}) for i in folds} for j in range(len(self.target_cols))]
        return {i: self._model([t[i] for t in per_target]) for i in folds}


class RandomFitted(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        for j, (name, values) in enumerate(zip(self.prediction_cols, self.state["classes"])):
            # the first target uses the plain seed, further ones a seed of their own
            seed = self.params_["seed"] if j == 0 else f"{self.params_['seed']}.{j}"
            h = F.conv(F.substring(shuffle_hash(seed, self.params_["row_key"]), 1, 8), 16, 10).cast("bigint")
            draw = F.pmod(h, F.lit(len(values))).cast("int")
            dataset = dataset.withColumn(name, F.get(constant_array(values), draw))
        return dataset


class ZeroRule(TableEstimator):
    """One constant per target: the most frequent value (ties: the smallest), the mean, or the exact median."""

    def __init__(self, target_cols, mode: str = "classification"):
        super().__init__()
        if mode not in ZERO_MODES:
            raise ValueError(f"mode is one of {ZERO_MODES}")
        self.target_cols = as_list(target_cols)
        self.mode = mode

    def _model(self, values: list) -> "ZeroRuleFitted":
        params = {"input_cols": [], "target_cols": self.target_cols, "mode": self.mode}
        return ZeroRuleFitted(params, {"values": values})

    def _fit(self, dataset: DataFrame) -> "ZeroRuleFitted":
        if self.mode == "regression_mean":
            row = dataset.agg(*[F.avg(to_col(c)).cast("double").alias(f"v{i}") for i, c in enumerate(self.target_cols)]).first()
            return self._model(list(row))
        if self.mode == "regression_median":
            medians = exact_quantiles(dataset, self.target_cols, [0.5])
            return self._model([medians[c][0] for c in self.target_cols])
        cells = [f"c{j}" for j in range(len(self.target_cols))]
        counts = stacked(dataset, [to_col(c) for c in self.target_cols]).groupBy("i", *cells).agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(*[F.min(F.when(F.col("i") == j, F.struct(-F.col("n"), F.col(c).alias("v")))).alias(c) for j, c in enumerate(cells)]).first()
        return self._model([row[c]["v"] for c in cells])

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "ZeroRuleFitted"]:
        if self.mode == "regression_mean":
            rows = df.groupBy(to_col(fold_col).alias("f")).agg(
                *[F.sum(to_col(c)).cast("double").alias(f"s{i}") for i, c in enumerate(self.target_cols)],
                *[F.count(to_col(c)).alias(f"n{i}") for i, c in enumerate(self.target_cols)],
            ).collect()
            return {
                i: self._model([
                    sum(r[f"s{j}"] for r in rows if r["f"] != i) / sum(r[f"n{j}"] for r in rows if r["f"] != i)
                    for j in range(len(self.target_cols))
                ])
                for i in folds
            }
        if self.mode == "classification":
            cells = [f"c{j}" for j in range(len(self.target_cols))]
            parts = stacked(df, [to_col(c) for c in self.target_cols], [to_col(fold_col).alias("f")]).groupBy("f", "i", *cells).agg(F.count(F.lit(1)).alias("n"))
            # per value, its rows outside each fold; then the best value per target and fold
            totals = parts.groupBy("i", *cells).agg(
                *[F.coalesce(F.sum(F.when(F.col("f") != i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in folds]
            )
            best = [
                F.min(F.when(F.col("i") == j, F.struct(-F.col(f"n{i}"), F.col(c).alias("v")))).alias(f"b{j}_{i}") for j, c in enumerate(cells) for i in folds
            ]
            row = totals.agg(*best).first()
            return {i: self._model([row[f"b{j}_{i}"]["v"] for j in range(len(cells))]) for i in folds}
        # the medians of all folds in the scans of one: a target less a fold's rows is a column of its own
        less = {(i, j): F.when(to_col(fold_col) != i, to_col(c)).alias(f"t{j}_{n}") for n, i in enumerate(folds) for j, c in enumerate(self.target_cols)}
        found = exact_quantiles(df.select(*less.values()), [f"t{j}_{n}" for n in range(len(folds)) for j in range(len(self.target_cols))], [0.5])
        return {i: self._model([found[f"t{j}_{n}"][0] for j in range(len(self.target_cols))]) for n, i in enumerate(folds)}


class ZeroRuleFitted(TableModel):
    @classmethod
    def by_fold(cls, df: DataFrame, models: list["ZeroRuleFitted"], index: Column) -> DataFrame | None:
        names = models[0].prediction_cols
        return df.withColumns({n: F.get(constant_array([m.state["values"][j] for m in models]), index) for j, n in enumerate(names)})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {name: F.lit(v) for name, v in zip(self.prediction_cols, self.state["values"])}
        )

"""Scoring and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..base import TableEstimator, TableModel
from ..functions.columns import constant_array, to_col
from ..functions.metrics import accuracy, score
from ..operators.layout import cross_val_folds, train_test_split
from .baseline import RandomModel, ZeroRule

SAMPLING_METHODS = ("train_test_split", "cross_val")
BASELINE_SOLVERS = ("random", "classification", "regression_mean", "regression_median")


def predict(model: TableModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's predictions."""
    return model.transform(df)


def evaluate(model: TableModel, df: DataFrame, metrics=accuracy) -> DataFrame:
    """Predict, then one aggregate; one row with a column per metric."""
    return score(model.transform(df), model.target_cols, model.prediction_cols, metrics)


def evaluate_model(
    df: DataFrame,
    estimator: TableEstimator,
    row_key,
    metrics=accuracy,
    sampling: str = "train_test_split",
    ratio: float = 0.8,
    folds: int = 3,
    shuffle: bool = True,
    seed: int = 42,
    drop_remainder: bool = True,
) -> DataFrame:
    """Hold-out evaluation gives one row, k-fold evaluation a row per fold (``fold_id``).

    Folds are a column, not copies: the table is read by filters on it, and the scores of all folds come from
    one grouped aggregate. Estimators fitted by aggregates train all folds in one job.
    """
    if sampling not in SAMPLING_METHODS:
        raise ValueError(f"sampling is one of {SAMPLING_METHODS}")
    if sampling == "train_test_split":
        train, test = train_test_split(df, row_key, ratio, shuffle, seed)
        return evaluate(estimator.fit(train), test, metrics)
    folded = cross_val_folds(df, row_key, folds, shuffle, seed, drop_remainder)
    return evaluate_folds(folded, estimator, metrics)


def evaluate_folds(folded: DataFrame, estimator: TableEstimator, metrics=accuracy, fold_col: str = "fold_id") -> DataFrame:
    """Train on the other folds and score on each, for a table that has a fold column."""
    ids = sorted(r[0] for r in folded.select(fold_col).distinct().collect())
    models = estimator.fit_folds(folded, fold_col, ids)
    first = models[ids[0]]
    names = [fold_col, *first.target_cols, *first.prediction_cols]
    if all(m.row_local for m in models.values()):
        scored = _own_predictions(folded, models, fold_col)
    else:
        scored = reduce(
            DataFrame.unionByName,
            [m.transform(folded.filter(F.col(fold_col) == i)).select(*[to_col(c) for c in names]) for i, m in models.items()],
        )
    return score(scored, first.target_cols, first.prediction_cols, metrics, [fold_col])


def _own_predictions(folded: DataFrame, models: dict[int, TableModel], fold_col: str) -> DataFrame:
    """Every row scored by its own fold's model, in one pass over the table.

    Models with a form by fold keep their numbers in one constant table, and a row is scored once. Of others, a row's own
    fold's prediction is chosen among those of all.
    """
    first = next(iter(models.values()))
    index = F.array_position(constant_array(list(models)), F.col(fold_col)).cast("int") - 1
    scored = type(first).by_fold(folded.withColumn("__model", index), list(models.values()), F.col("__model"))
    if scored is not None:
        return scored.select(fold_col, *[to_col(c) for c in (*first.target_cols, *first.prediction_cols)])
    targets = next(iter(models.values())).target_cols
    names = next(iter(models.values())).prediction_cols
    df, chosen = folded, {name: F.lit(None) for name in names}
    for i, model in models.items():
        before = df.columns
        made = {name: f"__{name}_{i}" for name in names}
        df = model.transform(df).withColumnsRenamed(made).select(*[to_col(c) for c in before], *made.values())
        chosen = {n: F.when(F.col(fold_col) == i, F.col(made[n])).otherwise(c) for n, c in chosen.items()}
    return df.select(fold_col, *[to_col(c) for c in targets], *[c.alias(n) for n, c in chosen.items()])


def evaluate_baseline(
    df: DataFrame, target_cols, row_key, metrics, solver: str = "random", sampling: str = "train_test_split", **kwargs
) -> DataFrame:
    """E5: what a model that ignores its inputs scores."""
    if solver not in BASELINE_SOLVERS:
        raise ValueError(f"solver is one of {BASELINE_SOLVERS}")
    estimator = RandomModel(target_cols, row_key) if solver == "random" else ZeroRule(target_cols, solver)
    return evaluate_model(df, estimator, row_key, metrics, sampling, **kwargs)


def actual_vs_predicted(model: TableModel, df: DataFrame, input_col: str, target: int = 0) -> DataFrame:
    """One input, one target and its prediction."""
    return model.transform(df).select(
        to_col(input_col).alias("x"),
        to_col(model.target_cols[target]).alias("y"),
        to_col(model.prediction_cols[target]).alias("prediction"),
    )


def plot_ranges(points: DataFrame) -> DataFrame:
    """The axes of such a plot and the ends of its decision line."""
    y = F.least("y", "prediction"), F.greatest("y", "prediction")
    return points.agg(
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
        F.min(y[0]).alias("y_min"),
        F.max(y[1]).alias("y_max"),
        F.min(F.struct("x", "prediction"))["prediction"].alias("prediction_at_x_min"),
        F.max(F.struct("x", "prediction"))["prediction"].alias("prediction_at_x_max"),
    )



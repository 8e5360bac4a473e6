"""Scores as aggregate columns over actual and predicted values.

A metric is any callable ``(actual, predicted) -> Column`` built from aggregates. It works in
``df.agg`` for one score and in ``df.groupBy(...).agg`` for a score per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import as_list, to_col


def _pairs(actual, predicted) -> list[tuple[Column, Column]]:
    ys, ps = as_list(actual), as_list(predicted)
    if len(ys) != len(ps) or not ys:
        raise ValueError("actual and predicted must name the same number of columns")
    return [(to_col(y), to_col(p)) for y, p in zip(ys, ps)]


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def accuracy(actual, predicted) -> Column:
    """Share of rows where every target column matches."""
    hit = reduce(lambda a, b: a & b, [y.eqNullSafe(p) for y, p in _pairs(actual, predicted)])
    return F.avg(hit.cast("double"))


def mean_absolute_error(actual, predicted) -> Column:
    return F.avg(_total([F.abs(p - y) for y, p in _pairs(actual, predicted)]).cast("double"))


def mean_squared_error(actual, predicted) -> Column:
    return F.avg(_total([(p - y) * (p - y) for y, p in _pairs(actual, predicted)]).cast("double"))


def root_mean_squared_error(actual, predicted) -> Column:
    return F.sqrt(mean_squared_error(actual, predicted))


def _single(actual, predicted) -> tuple[Column, Column]:
    pairs = _pairs(actual, predicted)
    if len(pairs) != 1:
        raise ValueError("a binary score takes one target column")
    return pairs[0]


def precision(actual, predicted) -> Column:
    """Share of positive predictions that are right; labels are 0 and 1."""
    y, p = _single(actual, predicted)
    return F.try_divide(F.count_if((y == 1) & (p == 1)), F.count_if(y.isin(0, 1) & (p == 1)))


def recall(actual, predicted) -> Column:
    """Share of positive rows that are found; labels are 0 and 1."""
    y, p = _single(actual, predicted)
    return F.try_divide(F.count_if((y == 1) & (p == 1)), F.count_if((y == 1) & p.isin(0, 1)))


def f1_score(actual, predicted) -> Column:
    p, r = precision(actual, predicted), recall(actual, predicted)
    return F.try_divide(2 * p * r, p + r)


def r_squared(actual, predicted) -> Column:
    """(SST - SSE) / SST, with SST from variances rather than from raw sums of squares; over rows without a missing value."""
    pairs = _pairs(actual, predicted)
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for pair in pairs for c in pair])
    pairs = [(F.when(whole, y), F.when(whole, p)) for y, p in pairs]
    sse = F.sum(_total([(y - p) * (y - p) for y, p in pairs]).cast("double"))
    within = _total([F.var_pop(y) for y, _ in pairs])
    if len(pairs) > 1:
        grand = _total([F.avg(y) for y, _ in pairs]) / len(pairs)
        within = within + _total([F.pow(F.avg(y) - grand, 2) for y, _ in pairs])
    sst = within * F.count(F.when(whole, 1))
    return F.try_divide(sst - sse, sst)


def confusion_cells(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """The non-empty cells of the confusion matrix, one row each."""
    return df.groupBy(
        *[to_col(c) for c in by or []], to_col(predicted).alias("predicted"), to_col(actual).alias("actual")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, max_classes: int = 300) -> DataFrame:
    """Rows are predicted, columns actual classes; the classes are those of either side, cells without rows are 0.

    A missing label is a class of its own, the last one, with the column ``null``.
    """
    cells = confusion_cells(df, actual, predicted)
    found = cells.limit(max_classes**2 + 1).collect()  # one job; classes, not rows, set its size
    classes = sorted({c for r in found for c in (r["predicted"], r["actual"])}, key=lambda c: (c is None, 0 if c is None else c))
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} classes; use confusion_cells")
    counts = {(r["predicted"], r["actual"]): r["n"] for r in found}
    schema = T.StructType(
        [
            T.StructField("predicted", cells.schema["predicted"].dataType),
            *[T.StructField("null" if c is None else str(c), T.LongType(), False) for c in classes],
        ]
    )
    rows = [(p, *[counts.get((p, a), 0) for a in classes]) for p in classes]
    return df.sparkSession.createDataFrame(rows, schema)


METRICS = {
    f.__name__: f
    for f in (
        accuracy,
        mean_absolute_error,
        mean_squared_error,
        root_mean_squared_error,
        precision,
        recall,
        f1_score,
        r_squared,
    )
}


def score(df: DataFrame, actual, predicted, metrics, by: list[str] | None = None) -> DataFrame:
    """One row of scores, or one per group, from a single aggregate. ``metrics`` are callables or their names."""
    chosen = [METRICS[m] if isinstance(m, str) else m for m in as_list(metrics)]
    aggs = [m(actual, predicted).alias(m.__name__) for m in chosen]
    return df.groupBy(*[to_col(c) for c in by]).agg(*aggs) if by else df.agg(*aggs)

"""Repair of missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import present, resolve, to_col
from .quantile import exact_quantiles
from .sketch import approximate_quantiles, column_sketches


def fill_missing(df: DataFrame, key, strategy="mean", approximate: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(repaired table, dropped rows)``.

    ``strategy``: "mean", "median" (exact, or with ``approximate`` from a sketch in one scan, see ``sketch.rank_error``), "remove"
    (drop a row with a missing value in any listed column), or a constant, which is cast to the column's type. NULL and NaN
    are missing.
    """
    cols = resolve(df, key)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    clean = {c: present(c, dtypes[c]) for c in cols}

    if strategy == "remove":
        gap = reduce(lambda a, b: a | b, [clean[c].isNull() for c in cols])
        return df.filter(~gap), df.filter(gap)

    if strategy == "mean":
        row = df.agg(*[F.avg(clean[c]).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        fill = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    elif strategy == "median" and approximate:
        lines = column_sketches(df, cols)
        found = {r["column"]: r["q"] for r in lines.select("column", approximate_quantiles(lines, [0.5])[0].alias("q")).collect()}
        fill = {c: found[c] for c in cols}
    elif strategy == "median":
        fill = {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items()}
    else:
        fill = {c: strategy for c in cols}

    def repaired(c):
        # a mean of whole numbers is not whole, so such a column becomes DOUBLE
        if strategy in ("mean", "median"):
            return F.coalesce(clean[c].cast("double"), F.lit(fill[c]).cast("double")).alias(c)
        return F.coalesce(clean[c], F.lit(fill[c]).cast(dtypes[c])).alias(c)

    out = df.select(*[repaired(c) if c in clean else to_col(c) for c in df.columns])
    return out, df.limit(0)

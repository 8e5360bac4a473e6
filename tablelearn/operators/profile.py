"""Numeric and categorical profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import nan_to_null, resolve, to_col
from ..functions.typing import categorical_columns, numeric_columns
from .quantile import DIRECT_ROWS, exact_quantiles
from .sketch import column_sketches, distinct_of_sketches, profile_of_sketches

# The statistics of the numeric profile in their order of display.
NUMERIC_STATS = ("count", "mean", "std_dev", "min", "25%", "50%", "75%", "max")

# How a missing cell is shown and counted among the values of a categorical column.
MISSING_LABEL = "nan"


def numeric_profile(df: DataFrame, key=None, direct_rows: int = DIRECT_ROWS, approximate: bool = False) -> DataFrame:
    """One row per numeric column: type, non-missing count, mean, population deviation, min, exact quartiles, max.

    With ``approximate`` the quartiles come from sketches, in one scan (see ``sketch``).
    """
    if approximate and (key is not None or numeric_columns(df)):
        return profile_of_sketches(column_sketches(df, key if key is not None else numeric_columns(df)))
    cols = resolve(df, key) if key is not None else numeric_columns(df)
    fields = "column string, dtype string, count bigint, " + ", ".join(f"`{n}` double" for n in NUMERIC_STATS[1:])
    if not cols:
        return df.sparkSession.createDataFrame([], fields)
    types = dict(df.dtypes)
    clean = nan_to_null(df.select(*[to_col(c) for c in cols]))
    row = clean.agg(
        *[
            F.struct(
                F.count(to_col(c)).alias("count"),
                F.avg(to_col(c)).cast("double").alias("mean"),
                F.stddev_pop(to_col(c)).alias("std_dev"),
                F.min(to_col(c)).cast("double").alias("min"),
                F.max(to_col(c)).cast("double").alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(cols)
        ]
    ).first()
    stats = {c: row[f"s{i}"] for i, c in enumerate(cols)}
    bounds = {c: (s["count"], s["min"], s["max"]) for c, s in stats.items()}
    quartiles = exact_quantiles(clean, cols, [0.25, 0.5, 0.75], direct_rows, bounds)
    rows = [
        (c, types[c], s["count"], s["mean"], s["std_dev"], s["min"], *quartiles[c], s["max"]) for c, s in stats.items()
    ]
    return df.sparkSession.createDataFrame(rows, fields)  # one row per column


def value_frequencies(df: DataFrame, key=None) -> DataFrame:
    """``(column, value, n)`` for categorical columns, a missing cell as the value "nan".

    One shuffle serves all columns. Counts are partial before it, so a value that fills a third of the table
    arrives as one row per map task.
    """
    cols = resolve(df, key) if key is not None else categorical_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.coalesce(to_col(c).cast("string"), F.lit(MISSING_LABEL)).alias("value"))
            for c in cols
        ]
    )
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, key=None, approximate: bool = False) -> DataFrame:
    """Per categorical column the non-missing count, the distinct values (missing is one) and their ratio.

    With ``approximate`` the distinct values come from sketches, and nothing else is shuffled (see ``sketch``).
    """
    if approximate and (key is not None or categorical_columns(df)):
        return distinct_of_sketches(column_sketches(df, key if key is not None else categorical_columns(df)))
    freq = value_frequencies(df, key)
    return freq.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value") != MISSING_LABEL, F.col("n"))), F.lit(0)).alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.try_divide(
            F.count(F.lit(1)).cast("double"), F.sum(F.when(F.col("value") != MISSING_LABEL, F.col("n"))).cast("double")
        ).alias("freq"),
    )


def top_values(df: DataFrame, k: int = 3, key=None) -> DataFrame:
    """D3: the k most frequent values per categorical column, ties by value; short columns are padded with "-"."""
    cols = resolve(df, key) if key is not None else categorical_columns(df)
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    ranked = value_frequencies(df, cols).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    # at most k rows per column from here on
    found = ranked.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("value", "n")))).alias("top"))
    return found.select(
        "column", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"), "top"
    ).select(
        "column",
        "rank",
        F.coalesce(F.expr("try_element_at(top, rank).value"), F.lit("-")).alias("value"),
        F.expr("try_element_at(top, rank).n").alias("n"),
    )

"""Approximate profiles as tables of sketches that merge (opt-in for F2, D1 and D2).

A line holds what is known of one column in one part of a table: counts, moments, and two sketches, of quantiles (KLL) and of
distinct values (HyperLogLog). Lines of several parts, say of each day's file, merge into those of the whole without a look
at the rows again; so a saved profile and the sketches of new rows make the new profile.

Errors: a quantile lies within ``rank_error(k)`` of its rank with 99 % confidence, whatever the number of rows; a distinct count
is off by ``distinct_error(lg_k)`` (standard deviation). Counts, means, deviations, minima and maxima are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import as_list, present, resolve, to_col
from ..functions.typing import categorical_columns, numeric_columns

#: Larger sketches err less: some 16 KB and 8 KB a line.
KLL_K, HLL_LG_K = 1024, 13


def rank_error(k: int = KLL_K) -> float:
    """By which share of the values the rank of an approximate quantile may be off."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    """The relative standard deviation of an approximate distinct count."""
    return 1.04 / math.sqrt(2**lg_k)


def column_sketches(df: DataFrame, key=None, by=(), k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """A line per column of ``key`` (by default all numeric and text columns) and per group of ``by``: ``column``, ``dtype``,
    ``position``, ``rows``, ``count`` (not missing), ``mean``, ``m2`` (sum of squares about the mean), ``min``, ``max``, ``quantiles``, ``values``.

    One scan; a task sends a sketch per column and group. Text columns have no moments and no quantiles; a missing cell of
    theirs counts among the distinct values. Infinities count but lie in no quantile sketch.
    """
    cols = resolve(df, key) if key is not None else [c for c in df.columns if c in {*numeric_columns(df), *categorical_columns(df)}]
    groups = as_list(by)
    cols = [c for c in cols if c not in groups]
    types = {f.name: f.dataType for f in df.schema.fields}

    def line(i: int, c: str) -> Column:
        v, numeric = present(c, types[c]), not isinstance(types[c], T.StringType)
        x = v.cast("double") if numeric else F.lit(None).cast("double")
        finite = F.when(F.abs(x) < float("inf"), x)
        text = v.cast("string") if numeric else F.coalesce(v, F.lit("\0missing"))
        return F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c].simpleString()).alias("dtype"),
            F.lit(i).alias("position"),
            F.count(F.lit(1)).alias("rows"),
            F.count(v).alias("count"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            (F.kll_sketch_agg_double(finite, k) if numeric else F.lit(None).cast("binary")).alias("quantiles"),
            F.hll_sketch_agg(text, lg_k).alias("values"),
        )

    wide = df.groupBy(*[to_col(g) for g in groups]).agg(F.array(*[line(i, c) for i, c in enumerate(cols)]).alias("lines"))
    return wide.select(*[to_col(g) for g in groups], F.inline("lines"))


def merged_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """The lines of several parts as one line per column (and group of ``by``)."""
    groups = [*as_list(by), "column"]
    parts = F.filter(F.collect_list(F.struct("count", "mean", "m2")), lambda p: p["mean"].isNotNull())
    start = F.struct(F.lit(0).cast("bigint").alias("count"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["count"] + b["count"]
        gap = b["mean"] - a["mean"]
        mean = a["mean"] + gap * b["count"] / n
        m2 = a["m2"] + b["m2"] + gap * gap * a["count"].cast("double") * b["count"] / n
        return F.struct(n.alias("count"), mean.alias("mean"), m2.alias("m2"))

    # in the order of the numbers themselves, so that the result doesn't depend on who came first
    moments = F.aggregate(F.array_sort(parts), start, add)
    found = sketches.groupBy(*[to_col(g) for g in groups]).agg(
        F.first("dtype").alias("dtype"),
        F.min("position").alias("position"),
        F.sum("rows").alias("rows"),
        F.sum("count").alias("count"),
        moments.alias("moments"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("values").alias("values"),
    )
    some = F.col("moments.count") > 0
    columns = ["dtype", "position", "rows", "count", F.when(some, F.col("moments.mean")).alias("mean"), F.when(some, F.col("moments.m2")).alias("m2"), "min", "max"]
    numeric = F.when(F.col("dtype") != "string", F.col("quantiles")).alias("quantiles")
    return found.select(*[to_col(g) for g in groups], *columns, numeric, "values")


def approximate_quantiles(sketches: DataFrame, probs: list[float]) -> Column:
    """An array of quantiles of a line; null where it has no finite value."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    n = F.kll_sketch_get_n_double("quantiles")
    return F.when(n > 0, F.kll_sketch_get_quantile_double("quantiles", wanted))


def profile_of_sketches(sketches: DataFrame) -> DataFrame:
    """The numeric profile (D1) of merged lines; its quartiles are approximate."""
    numeric = sketches.filter("dtype <> 'string'")
    q = approximate_quantiles(numeric, [0.25, 0.5, 0.75])
    return numeric.select(
        "column", "dtype", "count", "mean", F.sqrt(F.col("m2") / F.nullif(F.col("count"), F.lit(0))).alias("std_dev"), "min",
        *[q[i].alias(name) for i, name in enumerate(("25%", "50%", "75%"))], "max",
    )


def distinct_of_sketches(sketches: DataFrame) -> DataFrame:
    """The categorical profile (D2) of merged lines; the distinct values are approximate."""
    text = sketches.filter("dtype = 'string'")
    unique = F.hll_sketch_estimate("values")
    return text.select("column", "count", unique.alias("unique"), F.try_divide(unique.cast("double"), F.col("count").cast("double")).alias("freq"))

"""Approximate profiles: their stated errors, and that parts merge into the whole."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from table_rows import rows

from tablelearn.operators import sketch
from tablelearn.operators.missing import fill_missing
from tablelearn.operators.profile import categorical_profile, numeric_profile

N = 40_000


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    return rng.lognormal(size=N).round(6), rng.integers(0, 9000, N)


@pytest.fixture(scope="module")
def df(spark, values):
    x, k = values
    data = [(i % 7, float(a) if i % 50 else None, int(b), f"word {b}" if i % 40 else None) for i, (a, b) in enumerate(zip(x, k))]
    return spark.createDataFrame(data, "day int, x double, k long, w string").repartition(6).persist()


def test_profile_within_its_error(df, values):
    x = np.sort(values[0][np.arange(N) % 50 != 0])
    row = numeric_profile(df, ["x"], approximate=True).first()
    exact = numeric_profile(df, ["x"], direct_rows=100).first()
    for name in ("column", "dtype", "count", "min", "max"):
        assert row[name] == exact[name]
    assert row["mean"] == pytest.approx(exact["mean"]) and row["std_dev"] == pytest.approx(exact["std_dev"])
    for name, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        assert abs(np.searchsorted(x, row[name]) / len(x) - p) <= sketch.rank_error() + 1 / len(x)
    assert sketch.rank_error() < 0.005 and sketch.distinct_error() < 0.012


def test_distinct_values_within_their_error(df):
    row, exact = categorical_profile(df, ["w"], approximate=True).first(), categorical_profile(df, ["w"]).first()
    assert row["count"] == exact["count"] and abs(row["unique"] / exact["unique"] - 1) <= 4 * sketch.distinct_error()


def test_a_saved_profile_and_new_rows_make_the_whole(spark, df, values, tmp_path):
    path = str(tmp_path / "sketches")
    sketch.column_sketches(df.filter("day < 5"), ["x", "k", "w"], by="day").write.parquet(path)
    old, new = spark.read.parquet(path), sketch.column_sketches(df.filter("day >= 5"), ["x", "k", "w"], by="day")
    assert old.count() == 15
    merged = sketch.merged_sketches(old.unionByName(new))
    whole = sketch.column_sketches(df, ["x", "k", "w"])
    exact = ["column", "dtype", "position", "rows", "count", "min", "max"]
    assert rows(merged, *exact) == rows(whole, *exact)
    m, w = ({r["column"]: r for r in sketch.profile_of_sketches(t).collect()} for t in (merged, whole))
    for c, x in (("x", values[0][np.arange(N) % 50 != 0]), ("k", values[1])):
        assert m[c]["mean"] == pytest.approx(w[c]["mean"]) and m[c]["std_dev"] == pytest.approx(np.std(x))
        assert abs(np.searchsorted(np.sort(x), m[c]["50%"]) / len(x) - 0.5) <= 2 * sketch.rank_error()
    # sketches of distinct values merge without any further error
    assert rows(sketch.distinct_of_sketches(merged)) == rows(sketch.distinct_of_sketches(whole))
    by_day = sketch.merged_sketches(old.unionByName(new), by="day")
    assert by_day.count() == 21


def test_odd_columns(spark):
    df = spark.createDataFrame([(None, float("nan"), None, 1), (math.inf, 1.0, "", 2), (-math.inf, 3.0, "a", 3)], "a double, b double, c string, d int")
    got = {r["column"]: r for r in numeric_profile(df, approximate=True).collect()}
    assert (got["a"]["count"], got["a"]["min"], got["a"]["max"], got["a"]["50%"]) == (2, -math.inf, math.inf, None)
    assert (got["b"]["count"], got["b"]["50%"], got["d"]["mean"]) == (2, 1.0, 2.0)
    none = spark.createDataFrame([(None, None)], "a double, w string")
    assert rows(numeric_profile(none, approximate=True)) == [("a", "double", 0, *[None] * 7)]
    assert numeric_profile(none.select("w"), approximate=True).count() == 0
    filled, _ = fill_missing(df, ["b", "d"], "median", approximate=True)
    assert rows(filled, "b", "d") == [(1.0, 1.0), (1.0, 2.0), (3.0, 3.0)]
    assert rows(sketch.merged_sketches(sketch.column_sketches(none)), "column", "rows", "count", "mean") == [("a", 1, 0, None), ("w", 1, 0, None)]

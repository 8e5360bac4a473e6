"""Scalers, encoders and metrics."""

import math

import pytest
from table_rows import rows
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tablelearn.base import load_model
from tablelearn.functions import metrics
from tablelearn.operators.encode import OneHotEncoder, OrdinalEncoder
from tablelearn.operators.scale import Scaler, fit_transform


@pytest.mark.parametrize("mode", ["normalize", "standardize"])
def test_scaling_and_back(spark, mode):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5), (None, 5), (math.nan, 5), (8.0, 5)], "x double, c int")
    model = Scaler(["x", "c"], mode).fit(df)
    out = model.transform(df)
    x = [r["x"] for r in out.collect() if r["x"] is not None]
    assert all(r["c"] is None for r in out.collect())
    mean, std = 4.0, math.sqrt((9 + 1 + 16) / 3)
    want = [0, 2 / 7, 1] if mode == "normalize" else [(v - mean) / std for v in (1, 3, 8)]
    assert sorted(x) == pytest.approx(want)
    back = sorted(r["x"] for r in model.translate(out).collect() if r["x"] is not None)
    assert back == pytest.approx([1, 3, 8])
    zero = fit_transform(Scaler("c", mode, constant="zero"), df)
    assert {r["c"] for r in zero.collect()} == {0.0}


def test_scaler_in_a_pipeline_keeps_inputs(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2.0)
    out = Pipeline(stages=[Scaler("x", output_cols="z"), OrdinalEncoder("x", "code")]).fit(df).transform(df)
    assert rows(out, "x", "code") == [(2.0 * i, i) for i in range(5)] and out.agg(F.sum("z")).first()[0] == pytest.approx(0)


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, 2)], "s string, n int")
    model = OneHotEncoder(["s", "n"]).fit(df)
    assert model.flat_names() == ["s_a", "s_b", "s_nan", "n_1", "n_2"]
    codes = model.transform(df)
    assert rows(codes) == [(0, 0, 1, 0, 1), (0, 1, 0, 0, 1), (1, 0, 0, 1, 0)]
    assert rows(model.translate(codes)) == rows(df)
    fresh = spark.createDataFrame([("q", 1)], "s string, n int")
    with pytest.raises(Exception, match="unseen"):
        model.transform(fresh).collect()
    lenient = OneHotEncoder(["s", "n"], unseen="zero").fit(df).transform(fresh)
    assert rows(lenient) == [(0, 0, 0, 1, 0)]
    with pytest.raises(Exception, match="exactly one"):
        model.translate(lenient).collect()
    with pytest.raises(ValueError):
        OneHotEncoder("s", max_categories=2).fit(df)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_ordinal_with_a_hot_value(spark, tmp_path, limit):
    """A third of the rows hold one value."""
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise(F.concat(F.lit("v"), "id")).alias("s")
    )
    model = OrdinalEncoder("s", "code", broadcast_bytes=limit, hot_values=2).fit(df)
    out = model.transform(df)
    values = sorted({r["s"] or "nan" for r in df.collect()})
    want = {r["id"]: values.index(r["s"] or "nan") for r in df.collect()}
    assert {r["id"]: r["code"] for r in out.collect()} == want
    assert rows(model.translate(out.drop("s")), "id", "s") == rows(df)
    model.save(str(tmp_path / "m"))
    assert rows(load_model(spark, str(tmp_path / "m")).transform(df)) == rows(out)
    with pytest.raises(Exception, match="unseen"):
        model.transform(spark.createDataFrame([(1, "q")], "id int, s string")).collect()
    with pytest.raises(Exception, match="unseen"):
        model.translate(spark.createDataFrame([(1, 10**6)], "id int, code bigint")).collect()


def test_numbers_are_encoded_in_their_own_order(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "n int")
    assert rows(OrdinalEncoder("n", "c").fit(df).transform(df)) == [(10, 1), (100, 2), (9, 0)]


def test_confusion_has_classes_of_either_side(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0), (1, 1)], "y int, p int")
    assert rows(metrics.confusion_matrix(df, "y", "p")) == [(0, 1, 1, 0), (1, 0, 1, 0), (2, 1, 0, 0)]
    never = spark.createDataFrame([(0, 0), (5, 0)], "y int, p int")
    assert rows(metrics.confusion_matrix(never, "y", "p")) == [(0, 1, 1), (5, 0, 0)]


def test_binary_scores(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1), (2, 1)], "y int, p int")
    row = metrics.score(df, "y", "p", ["precision", "recall", "f1_score", "accuracy"]).first()
    assert tuple(row) == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3 / 6))
    none = metrics.score(df.filter("y = 0 AND p = 0"), "y", "p", ["precision", "recall", "f1_score"]).first()
    assert tuple(none) == (None, None, None)


def test_errors_over_two_targets(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0, 4.0), (3.0, 5.0, 2.0, 5.0)], "a double, b double, pa double, pb double")
    row = metrics.score(df, ["a", "b"], ["pa", "pb"], ["mean_absolute_error", "mean_squared_error", "r_squared"]).first()
    values, sse = [1, 2, 3, 5], 0 + 4 + 1 + 0
    sst = sum((v - 2.75) ** 2 for v in values)
    assert tuple(row) == pytest.approx((1.5, 2.5, (sst - sse) / sst))
    with pytest.raises(ValueError):
        metrics.precision(["a", "b"], ["pa", "pb"])


def test_row_local_models_take_streams(spark, tmp_path):
    df = spark.range(20).select("id", (F.col("id") * 1.5).alias("x"))
    df.write.parquet(str(tmp_path / "in"))
    model = Scaler("x").fit(df)
    stream = model.transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    out = stream.writeStream.format("memory").queryName("scaled").trigger(availableNow=True).start()
    out.awaitTermination(60)
    assert rows(spark.table("scaled")) == rows(model.transform(df))

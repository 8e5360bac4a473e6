"""Whole flows as a user writes them: from a text file to scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.functions.metrics import mean_absolute_error
from tablelearn.models.baseline import ZeroRule
from tablelearn.models.bayes import NaiveBayesClassifier
from tablelearn.models.evaluate import actual_vs_predicted, evaluate, evaluate_baseline, plot_ranges
from tablelearn.models.knn import KNNClassifier, KNNRegressor
from tablelearn.models.lvq import LVQ
from tablelearn.models.training import LearningRateScheduler, loss_history
from tablelearn.models.tree import DecisionTreeClassifier
from tablelearn.operators.edit import head, info, select_rows
from tablelearn.operators.encode import OneHotEncoder, OrdinalEncoder
from tablelearn.operators.layout import assign_roles, train_test_split
from tablelearn.operators.profile import categorical_profile
from tablelearn.operators.scale import Scaler, fit_transform
from tablelearn.sources.delimited import load_delimited

#: Mean and deviation of four measurements of three kinds of flowers, of which the file is drawn.
KINDS = {
    "setosa": ((5.0, 3.4, 1.5, 0.2), (0.35, 0.38, 0.17, 0.11)),
    "versicolor": ((5.9, 2.8, 4.3, 1.3), (0.52, 0.31, 0.47, 0.2)),
    "virginica": ((6.6, 3.0, 5.6, 2.0), (0.64, 0.32, 0.55, 0.27)),
}


@pytest.fixture(scope="module")
def flowers(tmp_path_factory):
    rng = np.random.default_rng(20)
    lines = ["sepal_length,sepal_width,petal_length,petal_width,species"]
    for kind, (mean, deviation) in KINDS.items():
        lines += [",".join([*(f"{max(v, 0.1):.1f}" for v in rng.normal(mean, deviation)), kind]) for _ in range(50)]
    path = tmp_path_factory.mktemp("flows") / "flowers.csv"
    path.write_text("\n".join(lines))
    return str(path)


def keyed(df):
    """With a key, in the file's own order: it is one small file."""
    return df.withColumn("id", F.monotonically_increasing_id())


def test_naive_bayes_flow(spark, flowers):
    df = keyed(load_delimited(spark, flowers)).persist()
    table = {r["name"]: r for r in info(df).collect()}
    assert table["sepal_length"]["dtype"] == "double" and table["species"]["rows"] == table["species"]["non_missing"] == 150
    coded = OrdinalEncoder("species").fit(df).transform(df)
    assert {r[0] for r in coded.select("species").distinct().collect()} == {0, 1, 2}
    inputs, (target,) = assign_roles(coded.drop("id"), -1)
    model = NaiveBayesClassifier(inputs, target).fit(coded)
    assert evaluate(model, coded).first()["accuracy"] > 0.93
    first = select_rows(coded, slice(0, 10), row_key="id")
    assert first.count() == 10 and evaluate(model, first).first()["accuracy"] == 1.0
    points = actual_vs_predicted(model, coded, "sepal_length")
    ranges = plot_ranges(points).first()
    assert points.count() == 150 and (ranges["y_min"], ranges["y_max"]) == (0, 2)
    baseline = evaluate_baseline(coded, target, "id", "accuracy", "classification").first()
    assert baseline["accuracy"] < 0.5


def test_tree_flow(spark, flowers, tmp_path):
    path = tmp_path / "headless.csv"
    path.write_text("\n".join(open(flowers).read().split("\n")[1:]))
    df = keyed(load_delimited(spark, str(path), header=False)).persist()
    inputs, (target,) = assign_roles(df.drop("id"), -1)
    train, test = train_test_split(df, "id")
    assert (train.count(), test.count()) == (120, 30)
    model = DecisionTreeClassifier(inputs, target, max_depth=5, min_samples=10).fit(train)
    assert evaluate(model, test).first()["accuracy"] > 0.8
    root = model.report(train).orderBy("node").first()
    assert root["samples"] == 120 and root["depth"] == 1 and root["feature"] in inputs


def test_lvq_flow_with_one_hot_targets(spark, flowers):
    df = keyed(load_delimited(spark, flowers)).persist()
    kinds = categorical_profile(df).first()
    assert (kinds["count"], kinds["unique"]) == (150, 3)
    encoder = OneHotEncoder("species").fit(df)
    targets = encoder.flat_names()
    coded = encoder.transform(df).persist()
    train, test = train_test_split(coded, "id")
    inputs = [c for c in coded.columns if c not in {*targets, "id"}]
    trainer = LVQ(inputs, targets, "id", n_codebooks=20, learning_rate=0.03, epochs=4, batch_size=32, shuffle=True, callbacks=[LearningRateScheduler()])
    model = trainer.fit(train)
    history = loss_history(model, spark).collect()
    assert len(history) == 4 and history[-1]["loss"] > 0.8
    assert evaluate(model, test).first()["accuracy"] > 0.8
    back = encoder.translate(test)
    assert {r[0] for r in back.select("species").distinct().collect()} <= set(KINDS)


def test_neighbours_flow(spark, flowers):
    raw = keyed(load_delimited(spark, flowers)).persist()
    scaled = fit_transform(Scaler(["sepal_length", "sepal_width", "petal_length"]), raw)
    encoder = OneHotEncoder("species").fit(scaled)
    df = encoder.transform(scaled).persist()
    inputs = [*encoder.flat_names(), "sepal_length", "sepal_width", "petal_length"]
    error = evaluate(KNNRegressor(inputs, "petal_width", "id").fit(df), df, mean_absolute_error).first()[0]
    plain = evaluate(ZeroRule("petal_width", "regression_mean").fit(df), df, mean_absolute_error).first()[0]
    assert error < plain / 3
    classes = KNNClassifier(["sepal_length", "sepal_width", "petal_length"], "species", "id").fit(scaled)
    assert evaluate(classes, scaled).first()["accuracy"] > 0.9
    assert head(scaled, 3, "id").count() == 3

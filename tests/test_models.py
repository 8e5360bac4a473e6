"""Models against small brute-force versions, and the rules where simple ones go wrong."""

import math
import uuid
from collections import Counter

import numpy as np
import pytest
from table_rows import rows
from pyspark.sql import functions as F

from tablelearn.base import load_model
from tablelearn.functions import metrics
from tablelearn.models import cells, descent, knn, linear, lvq, training, tree
from tablelearn.models.baseline import RandomModel, ZeroRule
from tablelearn.models.bayes import NaiveBayesClassifier
from tablelearn.models.evaluate import evaluate, evaluate_baseline, evaluate_model
from tablelearn.models.lvq import LVQ
from tablelearn.models.training import EarlyStopping, LearningRateScheduler


@pytest.fixture(scope="module")
def flowers(spark):
    """Three classes of 50 rows around centres of their own."""
    random = np.random.default_rng(3)
    centres = [(5.0, 3.4, 1.5, 0.2), (5.9, 2.8, 4.3, 1.3), (6.6, 3.0, 5.6, 2.0)]
    data = [
        (c * 50 + i, *[round(float(v), 1) for v in random.normal(centre, 0.3)], "abc"[c])
        for c, centre in enumerate(centres) for i in range(50)
    ]
    return spark.createDataFrame(data, "id bigint, a double, b double, c double, d double, kind string")


INPUTS = ["a", "b", "c", "d"]


def test_classifiers_learn_the_flowers(flowers):
    for estimator in (
        NaiveBayesClassifier(INPUTS, "kind"),
        tree.DecisionTreeClassifier(INPUTS, "kind"),
        knn.KNNClassifier(INPUTS, "kind", "id"),
        LVQ(INPUTS, "kind", "id", n_codebooks=9, learning_rate=0.01, epochs=3, batch_size=40, shuffle=True, callbacks=[LearningRateScheduler()]),
    ):
        score = evaluate_model(flowers, estimator, "id").first()["accuracy"]
        assert score > 0.85, type(estimator).__name__
    guess = evaluate_baseline(flowers, "kind", "id", "accuracy", "random").first()["accuracy"]
    assert guess < 0.7


# -- baselines -------------------------------------------------------------------------------------


def test_zero_rule_ties_and_two_targets(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 9.0), ("a", 2.0)], "s string, v double")
    assert ZeroRule("s").fit(df).state["values"] == ["a"]
    assert ZeroRule(["s", "v"]).fit(df).state["values"] == ["a", 2.0]
    assert ZeroRule("v", "regression_mean").fit(df).state["values"] == [3.5]
    assert ZeroRule("v", "regression_median").fit(df).state["values"] == [2.0]
    with pytest.raises(ValueError):
        ZeroRule("v", "mode")


def test_random_model_draws_all_classes_evenly(spark):
    df = spark.range(4000).withColumn("y", F.when(F.col("id") == 0, "rare").otherwise("often"))
    counts = Counter(r["prediction"] for r in RandomModel("y", "id").fit(df).transform(df).collect())
    assert abs(counts["rare"] - 2000) < 200
    again = RandomModel("y", "id").fit(df).transform(df.repartition(7))
    assert rows(again, "id", "prediction") == rows(RandomModel("y", "id").fit(df).transform(df), "id", "prediction")


# -- linear ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plane(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(103, 3))
    y = x @ np.array([[1.0, -2.0], [0.5, 0.0], [3.0, 1.0]]) + np.array([4.0, -1.0]) + random.normal(scale=0.1, size=(103, 2))
    data = [(i, *map(float, x[i]), *map(float, y[i]), int(y[i, 0] > 4)) for i in range(103)]
    return x, y, spark.createDataFrame(data, "id bigint, x0 double, x1 double, x2 double, y0 double, y1 double, flag int")


XS = ["x0", "x1", "x2"]


@pytest.mark.parametrize("limit", [0, 400])
def test_normal_equation(plane, monkeypatch, limit):
    monkeypatch.setattr(linear, "MAX_SUM_EXPRESSIONS", limit)
    x, y, df = plane
    state = linear.LinearRegression(XS, ["y0", "y1"]).fit(df).state
    want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    np.testing.assert_allclose(state["bias"], want[0], atol=1e-9)
    np.testing.assert_allclose(state["coefs"], want[1:], atol=1e-9)


def test_normal_equation_far_from_zero(spark):
    df = spark.range(1000).select((F.col("id") + 1e9).alias("x"), (3 * F.col("id") + 7.0).alias("y"))
    assert linear.LinearRegression("x", "y").fit(df).state["coefs"][0][0] == pytest.approx(3, abs=1e-8)


def test_dependent_or_missing_inputs_are_errors(spark, plane):
    df = plane[2].withColumn("twice", 2 * F.col("x0"))
    with pytest.raises(ValueError, match="dependent"):
        linear.LinearRegression(["x0", "twice"], "y0").fit(df)
    with pytest.raises(Exception, match="missing value"):
        linear.LinearRegression("x0", "y0").fit(df.withColumn("x0", F.when(F.col("id") > 3, F.col("x0"))))


def descend(x, y, epochs, batch, rate, output=lambda z: z, rates=None):
    n, w, b, history = len(x), np.zeros(x.shape[1]), 0.0, []
    for e in range(epochs):
        losses = []
        for s in range(0, n, batch):
            xb, yb = x[s : s + batch], y[s : s + batch]
            p = output(xb @ w + b)
            losses.append(float(np.mean(np.abs(p - yb))))
            w = w - (rates[e] if rates else rate) / n * xb.T @ (p - yb)
            b = b - (rates[e] if rates else rate) / n * np.sum(p - yb)
        history.append(float(np.mean(losses)))
    return w, b, history


@pytest.mark.parametrize("ranges", [1024, 3])
@pytest.mark.parametrize("batch", [1, 10, 103, 500])
def test_descent_equals_row_by_row(plane, monkeypatch, ranges, batch):
    monkeypatch.setattr(linear, "max_ranges", lambda d: ranges)
    monkeypatch.setattr(descent, "max_ranges", lambda d: ranges)
    x, y, df = plane
    model = linear.LinearRegression(XS, "y0", "mbgd", "id", learning_rate=5.0, epochs=2, batch_size=batch).fit(df)
    w, b, history = descend(x, y[:, 0], 2, batch, 5.0)
    np.testing.assert_allclose([c[0] for c in model.state["coefs"]], w, rtol=1e-9)
    assert model.state["bias"][0] == pytest.approx(b) and model.state["history"] == pytest.approx(history)


def test_decay_and_logistic(plane):
    x, y, df = plane
    rates = [3.0, 3.0, 3.0 * (1 - 1 / 3)]
    model = linear.LinearRegression(
        XS, "y0", "mbgd", "id", learning_rate=3.0, epochs=3, batch_size=60, callbacks=[LearningRateScheduler()]
    ).fit(df)
    assert model.state["bias"][0] == pytest.approx(descend(x, y[:, 0], 3, 60, 0, rates=rates)[1])
    flag = (y[:, 0] > 4).astype(float)
    model = linear.LogisticClassifier(XS, "flag", "id", learning_rate=3.0, epochs=3, batch_size=60).fit(df)
    w, b, _ = descend(x, flag, 3, 60, 3.0, lambda z: 1 / (1 + np.exp(-z)))
    np.testing.assert_allclose(model.state["coefs"], w)
    assert evaluate(model, df).first()["accuracy"] > 0.85
    model = linear.Perceptron(XS, "flag", "id", threshold=0.25, learning_rate=3.0, epochs=2, batch_size=60).fit(df)
    w, b, _ = descend(x, flag, 2, 60, 3.0, lambda z: (z > 0.25).astype(float))
    np.testing.assert_allclose(model.state["coefs"], w)
    with pytest.raises(Exception, match="0 or 1"):
        linear.LogisticClassifier(XS, "y0", "id").fit(df)


class Recorded(EarlyStopping):
    def get_score(self, losses):
        return self.scores.pop(0)


def test_early_stopping_restores_the_best(plane):
    df = plane[2]
    stop = Recorded(patience=2, mode="min", min_delta=0.1)
    stop.scores = [5.0, 3.0, 2.95, 4.0, 1.0]
    fit = lambda **kw: linear.LinearRegression(XS, "y0", "mbgd", "id", learning_rate=1.0, batch_size=60, **kw).fit(df)
    model = fit(epochs=9, callbacks=[stop])
    assert len(model.state["history"]) == 4
    assert model.state["bias"] == pytest.approx(fit(epochs=2).state["bias"])
    kept = Recorded(patience=2, restore_best=False, min_delta=0.1)
    kept.scores = [5.0, 3.0, 2.95, 4.0, 1.0]
    assert fit(epochs=9, callbacks=[kept]).state["bias"] == pytest.approx(fit(epochs=4).state["bias"])


# -- naive Bayes -----------------------------------------------------------------------------------


def test_bayes_with_constant_features_and_ties(spark):
    df = spark.createDataFrame([(1.0, 0.0, 7), (2.0, 0.0, 7), (1.0, 3.0, 9), (2.0, 3.0, 9), (5.0, 5.0, 11)], "a double, b double, y int")
    model = NaiveBayesClassifier(["a", "b"], "y").fit(df)
    assert model.state["priors"] == [0.4, 0.4, 0.2]
    # b is constant in every class, so 7 and 9 tie and the smaller wins; class 11 has one row and no density at all
    out = model.transform(spark.createDataFrame([(1.5, 3.0)], "a double, b double")).first()
    assert out["prediction"] == 7
    floored = NaiveBayesClassifier(["a", "b"], "y", std_floor=0.5).fit(df)
    assert [r["prediction"] for r in floored.transform(df).collect()] == [7, 7, 9, 9, 11]
    total = floored.predict_proba(df, normalize=True).select((F.col("score_7") + F.col("score_9") + F.col("score_11")).alias("t"))
    assert [r["t"] for r in total.collect()] == pytest.approx([1.0] * 5)


def test_bayes_by_table_equals_bayes_by_expressions(flowers, monkeypatch, tmp_path, spark):
    from tablelearn.models import bayes

    model = NaiveBayesClassifier(INPUTS, "kind").fit(flowers)
    want = rows(model.transform(flowers), "id", "prediction")
    monkeypatch.setattr(bayes, "MAX_TERMS", 0)
    assert rows(model.transform(flowers), "id", "prediction") == want
    model.save(str(tmp_path / "m"))
    assert rows(load_model(spark, str(tmp_path / "m")).transform(flowers), "id", "prediction") == want


# -- nearest neighbours ----------------------------------------------------------------------------


def brute_neighbours(train, queries, k, skip_self):
    out = set()
    for qk, qv in queries:
        near = sorted((math.dist(qv, v), key) for key, v in train if not (skip_self and key == qk))[:k]
        out |= {(qk, key, round(d, 9), r + 1) for r, (d, key) in enumerate(near)}
    return out


@pytest.mark.parametrize("pivots,train_block,query_block", [(1, 10**6, 10**6), (1, 30, 50), (7, 25, 40), (50, 10, 10)])
@pytest.mark.parametrize("skip_self", [True, False])
def test_neighbours_with_copies_and_a_hot_spot(spark, pivots, train_block, query_block, skip_self):
    """A third of the rows are copies of one point, so distances tie and one cell is large."""
    random = np.random.default_rng(1)
    points = [(i, [1.0, 2.0] if i % 3 == 0 else [float(v) for v in random.integers(0, 6, 2)]) for i in range(240)]
    df = spark.createDataFrame(points, "id bigint, v array<double>")
    got = knn.nearest_neighbours(
        df, df, "v", 4, "id", "id", skip_self, pivots=pivots, train_block=train_block, query_block=query_block
    )
    assert {(r[0], r[1], round(r[2], 9), r[3]) for r in got.collect()} == brute_neighbours(points, points, 4, skip_self)


def exchanged(df):
    """The rows that the exchanges of an executed plan have written."""
    def below(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return below(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return below(plan.plan())
        mine = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        return mine + sum(below(plan.children().apply(i)) for i in range(plan.children().size()))

    df.collect()
    return below(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("pivots,train_block,query_block", [(12, 30, 50), (60, None, None)])
def test_rows_are_sent_by_tile_not_by_cell_or_block(spark, pivots, train_block, query_block):
    """Twelve inputs without structure: every query needs every cell."""
    n, random = 3000, np.random.default_rng(4)
    points = [(i, [float(v) for v in random.normal(size=12)]) for i in range(n)]
    df = spark.createDataFrame(points, "id bigint, v array<float>")
    got = knn.nearest_neighbours(
        df, df, "v", 3, "id", "id", True, pivots=pivots, train_block=train_block, query_block=query_block
    )
    cores = spark.sparkContext.defaultParallelism
    # rows once a group, queries once a bin, and k lines of a query from each of its bins
    assert 2 * n <= exchanged(got) <= n * (4 * cores + 10)
    few = [points[i] for i in range(0, n, 100)]
    floats = [(i, [float(np.float32(x)) for x in v]) for i, v in points]
    some = {(r[0], r[1], round(r[2], 9), r[3]) for r in got.filter("query % 100 = 0").collect()}
    assert some == brute_neighbours(floats, [floats[i] for i, _ in few], 3, True)


def test_tiles_hold_no_more_than_they_may(spark, monkeypatch):
    """Large cells are cut on both sides, and the result is that of one tile."""
    random = np.random.default_rng(5)
    points = [(i, [1.0, 2.0] if i % 2 else [float(v) for v in random.integers(0, 9, 2)]) for i in range(400)]
    df = spark.createDataFrame(points, "id bigint, v array<double>")
    want = brute_neighbours(points, points, 4, True)
    for pivots in (1, 9):
        with monkeypatch.context() as m:
            m.setattr(cells, "TILE_ROWS", 60)
            got = knn.nearest_neighbours(df, df, "v", 4, "id", "id", True, pivots=pivots)
        assert {(r[0], r[1], round(r[2], 9), r[3]) for r in got.collect()} == want
    loads = np.array([10, 0, 500, 5, 60])
    found = cells.shares(loads, np.array([4, 3, 2, 1, 0]), 100)
    numbers = Counter(int(found.of(np.array([c]), np.array([h]))[0]) for c, many in enumerate(loads) for h in range(many))
    assert len(numbers) == found.n == 7 and max(numbers.values()) <= 100


def test_queries_look_at_few_rows_of_a_cell_where_these_lie_apart(monkeypatch):
    random = np.random.default_rng(6)
    points, asked = random.random((4000, 2)), random.random((1500, 2))
    looked, squares = [], cells.squares
    monkeypatch.setattr(cells, "squares", lambda a, b: looked.append(len(a) * len(b)) or squares(a, b))
    keys, none = np.arange(len(points)), np.zeros((1, 1))
    index = cells.Cells(None, none, np.zeros(1, int), none, np.zeros(1), np.array([len(points)]))
    tile = cells.Tile(index, np.zeros(len(points), int), keys, keys, points, np.arange(len(asked)), asked, np.full(len(asked), np.inf), 1, False, 50_000, 10_000)
    who, at, far = tile.found(np.zeros(len(asked), int))
    every = np.sqrt(((asked[:, None] - points[None]) ** 2).sum(axis=2))
    assert who.tolist() == list(range(len(asked))) and at.tolist() == every.argmin(axis=1).tolist() and np.allclose(far, every.min(axis=1))
    assert sum(looked) < len(points) * len(asked) / 6


@pytest.mark.parametrize("width,k", [(2, 1), (12, 3)])
def test_a_block_is_one_product_and_keeps_few(monkeypatch, width, k):
    """Distances of all pairs are not filled in after the product, and of one neighbour no more than the nearest is sorted."""
    random = np.random.default_rng(6)
    points, asked = random.random((4000, width)), random.random((1500, width))
    looked, filled, kept = [], [], []
    block, squares, lexsort = cells.Tile._block, cells.squares, np.lexsort
    monkeypatch.setattr(cells.Tile, "_block", lambda self, who, own, rows, *more: looked.append(len(who) * len(rows)) or block(self, who, own, rows, *more))
    monkeypatch.setattr(cells, "squares", lambda a, b: filled.append(len(a) * len(b)) or squares(a, b))
    monkeypatch.setattr(np, "lexsort", lambda by: kept.append(len(by[0])) or lexsort(by))
    keys, none = np.arange(len(points)), np.zeros((1, 1))
    index = cells.Cells(None, none, np.zeros(1, int), none, np.zeros(1), np.array([len(points)]))
    tile = cells.Tile(index, np.zeros(len(points), int), keys, keys, points, np.arange(len(asked)), asked, np.full(len(asked), np.inf), k, False, 50_000, 10_000)
    who, at, far = tile.found(np.zeros(len(asked), int))
    every = np.sort(np.sqrt(((asked[:, None] - points[None]) ** 2).sum(axis=2)), axis=1)[:, :k]
    assert who.tolist() == np.repeat(np.arange(len(asked)), k).tolist() and np.allclose(far.reshape(-1, k), every)
    parts = 63  # the root of 4000
    assert sum(filled) <= parts * (len(points) + len(asked)) and sum(looked) <= len(points) * len(asked) / (10 if width == 2 else 1)
    assert k > 1 or sum(kept) <= 4 * len(asked)


def unstructured(spark, n):
    random = np.random.default_rng(7)
    return spark.createDataFrame([(i, [float(v) for v in random.normal(size=12)], "ab"[i % 2]) for i in range(n)], "id bigint, v array<float>, y string")


def test_a_classifier_sends_rows_by_tile(spark, monkeypatch):
    monkeypatch.setattr(cells, "ROWS_PER_CELL", 50)
    df = unstructured(spark, 3000)
    out = knn.KNNClassifier("v", "y", "id", 3, exclude_self=True).fit(df).transform(df)
    assert 2 * 3000 <= exchanged(out) <= 3000 * (4 * spark.sparkContext.defaultParallelism + 30)


def test_rows_sent_grow_with_the_table(spark, monkeypatch):
    """And not with the product of queries and cells."""
    monkeypatch.setattr(cells, "ROWS_PER_CELL", 50)
    few, many = (exchanged(knn.nearest_neighbours(df, df, "v", 3, exclude_self=True)) for df in (unstructured(spark, 1500), unstructured(spark, 3000)))
    assert many <= 2.5 * few


def test_a_loaded_classifier_sends_rows_by_tile(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(cells, "ROWS_PER_CELL", 50)
    df = unstructured(spark, 3000)
    model = knn.KNNClassifier("v", "y", "id", 3, exclude_self=True).fit(df)
    model.save(str(tmp_path / "m"))
    out = load_model(spark, str(tmp_path / "m")).transform(df)
    assert exchanged(out) <= 3000 * (4 * spark.sparkContext.defaultParallelism + 30)
    assert rows(out.filter("id % 100 = 0"), "id", "prediction") == rows(model.transform(df).filter("id % 100 = 0"), "id", "prediction")


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0, "b"), (2, 1.0, "a")], "id int, x double, y string")
    asked = spark.createDataFrame([(1, 0.1), (7, 9.0)], "id int, x double")
    # a query is not a training row just because it has the nearest one's place
    out = knn.KNNClassifier("x", "y", "id", k=5).fit(df).transform(asked)
    assert rows(out, "id", "prediction") == [(1, "a"), (7, "a")]
    alone = knn.KNNClassifier("x", "y", "id", k=5, exclude_self=True).fit(df).transform(asked)
    assert rows(alone, "id", "prediction") == [(1, "a"), (7, "a")]
    none = knn.KNNRegressor("x", "id", "id").fit(df.limit(0)).transform(asked)
    assert rows(none, "id", "prediction") == [(1, None), (7, None)]


def test_regressors(spark):
    df = spark.createDataFrame([(i, float(i), float(v)) for i, v in enumerate((1, 2, 9, 4))], "id int, x double, y double")
    asked = spark.createDataFrame([(0, 1.0)], "id int, x double")
    for strategy, want in (("mean", 4.0), ("median", 2.0)):
        model = knn.KNNRegressor("x", "y", "id", 3, strategy).fit(df)
        assert model.transform(asked).first()["prediction"] == want


# -- trees -----------------------------------------------------------------------------------------


def brute_tree(rows_, depth, max_depth, min_samples):
    """Nested (feature, threshold, left, right) or a label; also the set of labels below."""
    def gini(part):
        return 1 - sum((c / len(part)) ** 2 for c in Counter(y for *_, y in part).values()) if part else 0.0

    best = None
    for f in range(len(rows_[0]) - 1):
        for v in sorted({r[f] for r in rows_}):
            left, right = [r for r in rows_ if r[f] < v], [r for r in rows_ if r[f] >= v]
            g = round((gini(left) * len(left) + gini(right) * len(right)) / len(rows_), 12)
            if best is None or g < best[0]:
                best = (g, f, v, left, right)
    _, f, v, left, right = best
    counts = Counter(y for *_, y in rows_)
    label = min(counts, key=lambda k: (-counts[k], k))
    if not left or len(left) < min_samples or len(right) < min_samples or depth > max_depth:
        return label, {label}
    a, la = brute_tree(left, depth + 1, max_depth, min_samples)
    b, lb = brute_tree(right, depth + 1, max_depth, min_samples)
    return (label, {label}) if la | lb == {label} and len(la | lb) == 1 else ((f, v, a, b), la | lb)


def nested(nodes, classes, i=0):
    n = nodes[i]
    if n["feature"] is None:
        return classes[n["label"]]
    return (n["feature"], n["threshold"], nested(nodes, classes, n["left"]), nested(nodes, classes, n["right"]))


@pytest.mark.parametrize("per_range", [250_000, 15])
@pytest.mark.parametrize("max_depth,min_samples,seed", [(1, 5, 0), (3, 5, 1), (6, 1, 2)])
def test_tree_equals_brute_force(spark, monkeypatch, per_range, max_depth, min_samples, seed):
    monkeypatch.setattr(tree, "ROWS_PER_RANGE", per_range)
    random = np.random.default_rng(seed)
    data = []
    for _ in range(160):
        a, b = float(random.integers(0, 40)), 0.0 if random.random() < 0.35 else round(float(random.normal()), 2)
        data.append((a, b, "xyz"[int((a > 18) + (b > 0.3) * (random.random() < 0.8))]))
    df = spark.createDataFrame(data, "a double, b double, y string")
    model = tree.DecisionTreeClassifier(["a", "b"], "y", max_depth, min_samples).fit(df)
    want, _ = brute_tree(data, 1, max_depth, min_samples)
    assert nested(model.state["nodes"], model.state["classes"]) == want

    def predict(node, r):
        return node if isinstance(node, str) else predict(node[2] if r[node[0]] < node[1] else node[3], r)

    assert rows(model.transform(df)) == sorted(((*r, predict(want, r)) for r in data), key=repr)
    report = model.report(df).collect()
    assert next(r for r in report if r["node"] == 0)["samples"] == 160
    assert sum(r["samples"] for r in report if r["feature"] is None) == 160


def test_tree_ties_and_pure_tables(spark):
    df = spark.createDataFrame([(1.0, 1.0, "b"), (2.0, 2.0, "a")] * 3, "p double, q double, y string")
    nodes = tree.DecisionTreeClassifier(["p", "q"], "y", min_samples=1).fit(df).state["nodes"]
    assert (nodes[0]["feature"], nodes[0]["threshold"]) == (0, 2.0) and len(nodes) == 3
    pure = tree.DecisionTreeClassifier(["p"], "y").fit(df.filter("y = 'a'")).state["nodes"]
    assert len(pure) == 1 and pure[0]["feature"] is None
    with pytest.raises(ValueError):
        tree.DecisionTreeClassifier(["p"], "y", max_classes=1).fit(df)


# -- LVQ -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("terms", [0, 600])
def test_lvq_equals_batchwise_brute_force(spark, monkeypatch, terms):
    monkeypatch.setattr(lvq, "MAX_TERMS", terms)
    random = np.random.default_rng(9)
    x = random.normal(size=(60, 2)).round(3)
    y = (x.sum(axis=1) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, x[i]), int(y[i]), int(y[i])) for i in range(60)], "id int, a double, b double, y int, z int")
    trainer = LVQ(["a", "b"], ["y", "z"], "id", n_codebooks=4, learning_rate=0.05, epochs=2, batch_size=25)
    start = trainer.initial_state(
        df.selectExpr("a x0", "b x1", "y y0", "z y1", "id __key_id"), 60
    )
    books, labels = np.array(start["codebooks"]), [l[0] for l in start["labels"]]
    for _ in range(2):
        for s in range(0, 60, 25):
            part, kinds = x[s : s + 25], y[s : s + 25]
            hit = ((part[:, None] - books[None]) ** 2).sum(axis=2).argmin(axis=1)
            pull = np.zeros_like(books)
            for row, h, k in zip(part, hit, kinds):
                pull[h] += (1 if labels[h] == k else -1) * (row - books[h])
            books = books + 0.05 * pull
    model = trainer.fit(df)
    np.testing.assert_allclose(model.state["codebooks"], books, rtol=1e-9)
    out = model.transform(df)
    want = [labels[((r - books) ** 2).sum(axis=1).argmin()] for r in x]
    assert [r["prediction_y"] for r in out.orderBy("id").collect()] == want


def test_lvq_default_is_a_twentieth_at_any_size():
    assert [LVQ(["a"], "y", "id")._wanted(n) for n in (10, 6_000_000, 10**10)] == [3, 300_000, 500_000_000]


@pytest.mark.parametrize("init, batch, stop", [("rows", 40, False), ("columns", None, True)])
def test_codebooks_as_a_table_are_those_as_numbers(spark, tmp_path, init, batch, stop):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=2).round(3)), int(i % 3), "xy"[i % 2]) for i in range(110)], "id long, a double, b double, y int, z string").repartition(4)
    make = lambda **kw: LVQ(
        ["a", "b"], ["y", "z"], "id", n_codebooks=8, init=init, learning_rate=0.05, epochs=3, batch_size=batch,
        callbacks=[EarlyStopping(patience=1, mode="max", min_delta=2.0)] if stop else [], **kw,
    )
    numbers, table = make().fit(df), make(driver_codebooks=3).fit(df)
    assert isinstance(table, lvq.LVQTableModel) and table.state["history"] == pytest.approx(numbers.state["history"])
    flat = lambda m: np.array([[r["codebook"], *r["position"]] for r in m.codebooks(spark).orderBy("codebook").collect()])
    np.testing.assert_allclose(flat(table), flat(numbers), rtol=1e-9)
    assert rows(table.transform(df)) == rows(numbers.transform(df))
    table.save(str(tmp_path / "model"))
    assert rows(load_model(spark, str(tmp_path / "model")).transform(df)) == rows(numbers.transform(df))
    by_fold = make(driver_codebooks=3).fit_folds(df, "y", [0, 1])
    np.testing.assert_allclose(flat(by_fold[1]), flat(make().fit_folds(df, "y", [0, 1])[1]), rtol=1e-9)


# -- evaluation ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "make",
    [
        lambda: ZeroRule("kind"),
        lambda: RandomModel("kind", "id"),
        lambda: NaiveBayesClassifier(INPUTS, "kind"),
        lambda: knn.KNNClassifier(INPUTS, "kind", "id"),
        lambda: tree.DecisionTreeClassifier(INPUTS, "kind", max_depth=2),
    ],
)
def test_folds_in_one_job_equal_folds_one_by_one(flowers, make):
    from tablelearn.operators.layout import cross_val_folds

    got = {r[0]: r[1] for r in evaluate_model(flowers, make(), "id", sampling="cross_val", folds=4).collect()}
    folded = cross_val_folds(flowers, "id", 4, drop_remainder=True).cache()
    for i in range(4):
        model = make().fit(folded.filter(F.col("fold_id") != i))
        assert got[i] == pytest.approx(evaluate(model, folded.filter(F.col("fold_id") == i)).first()["accuracy"])
    folded.unpersist()


def test_linear_folds_and_mean(plane):
    df = plane[2]
    for estimator in (linear.LinearRegression(XS, ["y0", "y1"]), ZeroRule(["y0", "y1"], "regression_mean")):
        got = evaluate_model(df, estimator, "id", "root_mean_squared_error", "cross_val", folds=3).collect()
        assert len(got) == 3 and all(r[1] > 0 for r in got)
    one = {i: m for i, m in linear.LinearRegression(XS, "y0").fit_folds(df.withColumn("f", F.col("id") % 3), "f", [0, 1, 2]).items()}
    for i, m in one.items():
        alone = linear.LinearRegression(XS, "y0").fit(df.filter(F.col("id") % 3 != i))
        np.testing.assert_allclose(m.state["coefs"], alone.state["coefs"], atol=1e-10)


def test_exported_parameters_restore_a_model(plane):
    df = plane[2]
    model = linear.LinearRegression(XS, "y0").fit(df)
    other = linear.LinearRegression(XS, "y0").fit(df.limit(50))
    assert rows(other.set_params(model.get_params()).transform(df)) == rows(model.transform(df))
    with pytest.raises(ValueError):
        ZeroRule("y0").fit(df).set_params(model.get_params())


def test_metrics_are_callables(plane):
    model = linear.LinearRegression(XS, "y0").fit(plane[2])

    def bias(actual, predicted):
        return F.avg(F.col(predicted[0]) - F.col(actual[0]))

    row = evaluate(model, plane[2], [bias, metrics.r_squared]).first()
    assert row["bias"] == pytest.approx(0, abs=1e-9) and row["r_squared"] > 0.99


def test_folds_lose_no_group_and_fold_scores_equal_each_model_s_own(spark):
    random = np.random.default_rng(4)
    data = [(i, i % 300, float(random.normal(i % 2 * 3, 1)), float(random.normal()), i % 2) for i in range(3000)]
    df = spark.createDataFrame(data, "id bigint, fold_id int, a double, b double, y int")
    model = NaiveBayesClassifier(["a", "b"], "y", max_classes=2).fit_folds(df, "fold_id", list(range(300)))[0]
    rest = np.array([r[2] for r in data if r[1] != 0 and r[4] == 1])
    assert math.isclose(model.state["means"][1][0], rest.mean(), rel_tol=1e-9) and model.state["priors"] == [1490 / 2990, 1500 / 2990]
    with pytest.raises(ValueError):
        NaiveBayesClassifier(["a", "b"], "y", max_classes=1).fit_folds(df, "fold_id", list(range(300)))
    for estimator in (NaiveBayesClassifier(["a", "b"], "y"), ZeroRule("y"), linear.LinearRegression(["a", "b"], "y")):
        few = df.withColumn("fold_id", F.col("fold_id") % 3)
        models = estimator.fit_folds(few, "fold_id", [0, 1, 2])
        index = F.col("fold_id")
        got = {r["id"]: r["prediction"] for r in type(models[0]).by_fold(few, list(models.values()), index).collect()}
        for i, m in models.items():
            assert all(math.isclose(got[r["id"]], r["prediction"], rel_tol=1e-9) for r in m.transform(few.where(F.col("fold_id") == i)).collect())


def test_r_squared_and_confusion_with_missing_values(spark):
    pairs = [(1.0, 1.5), (2.0, 1.5), (4.0, 5.0), (7.0, 6.0)]
    df = spark.createDataFrame(pairs + [(None, 3.0), (9.0, None)], "y double, p double")
    y, p = np.array(pairs).T
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert math.isclose(df.agg(metrics.r_squared("y", "p")).first()[0], want)
    labels = spark.createDataFrame([("a", "a"), ("b", None), (None, "a")], "y string, p string")
    assert [tuple(r) for r in metrics.confusion_matrix(labels, "y", "p").collect()] == [("a", 1, 0, 1), ("b", 0, 0, 0), (None, 0, 1, 0)]


def test_models_with_dated_and_decimal_classes_are_saved(spark, tmp_path):
    import datetime
    import decimal
    import subprocess
    import sys

    for kind, values in (("date", [datetime.date(2020, 1, 2), datetime.date(2021, 1, 2)]), ("decimal(20,0)", [decimal.Decimal(1), decimal.Decimal(2)])):
        df = spark.createDataFrame([(float(i), values[i % 2]) for i in range(10)], f"a double, y {kind}")
        model = ZeroRule("y").fit(df)
        model.save(str(tmp_path / kind[:4]))
        assert load_model(spark, str(tmp_path / kind[:4])).state == model.state
    code = (
        "from tablelearn.session import local_session; from tablelearn.base import load_model; s = local_session(1);"
        f"print(type(load_model(s, {str(tmp_path / 'date')!r})).__name__)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=str(__import__("pathlib").Path(__file__).parents[1]))
    assert "ZeroRuleFitted" in out.stdout, out.stderr[-800:]


def test_k_can_be_chosen_at_prediction(spark, flowers):
    fitted = knn.KNNClassifier(INPUTS, "kind", "id").fit(flowers)
    for k in (1, 7):
        own = knn.KNNClassifier(INPUTS, "kind", "id", k=k).fit(flowers)
        assert rows(fitted.with_k(k).transform(flowers), "id", "prediction") == rows(own.transform(flowers), "id", "prediction")


def test_codebooks_are_found_alike_written_out_and_in_numpy(spark, monkeypatch):
    random = np.random.default_rng(8)
    df = spark.createDataFrame(random.integers(0, 4, (300, 2)).astype(float).tolist(), "a double, b double")  # many ties
    books = random.integers(0, 4, (9, 2)).astype(float).tolist()
    written = rows(df.select("a", "b", lvq.nearest_codebook([F.col("a"), F.col("b")], books).alias("cb")))
    monkeypatch.setattr(lvq, "MAX_TERMS", 0)
    assert written == rows(df.select("a", "b", lvq.nearest_codebook([F.col("a"), F.col("b")], books).alias("cb")))


# -- all folds at once ------------------------------------------------------------------------------


def fold_table(spark, n=157, folds=3, seed=2):
    rng = np.random.default_rng(seed)
    data = [(int(k), float(a), float(b), float(2 * a - b + rng.normal() / 10), int(a > b), "rgb"[int(3 * c)], int(rng.integers(folds))) for k, a, b, c in zip(rng.permutation(n) * 3, *rng.random((3, n)))]
    return spark.createDataFrame(data, "id long, a double, b double, t double, y int, kind string, fold int").repartition(5)


TRAINERS = {
    "descent": lambda **kw: linear.LinearRegression(["a", "b"], "t", "mbgd", "id", learning_rate=2.0, epochs=3, **kw),
    "logistic": lambda **kw: linear.LogisticClassifier(["a", "b"], "y", "id", learning_rate=3.0, epochs=3, **kw),
    "perceptron": lambda **kw: linear.Perceptron(["a", "b"], "y", "id", learning_rate=1.0, epochs=2, **kw),
    "lvq": lambda **kw: LVQ(["a", "b"], "kind", "id", n_codebooks=7, learning_rate=0.02, epochs=2, **kw),
}


@pytest.mark.parametrize("name", TRAINERS)
@pytest.mark.parametrize("small, shuffle", [(False, False), (True, True)])
def test_training_of_all_folds_at_once_is_that_of_each(spark, monkeypatch, name, small, shuffle):
    monkeypatch.setattr(training, "CHUNK_ROWS", 20)
    if small:
        monkeypatch.setattr(linear, "max_ranges", lambda d: 4)
        monkeypatch.setattr(descent, "max_ranges", lambda d: 4)
    batch = (9 if small else None) if name == "descent" else 55  # a job a step, but for descent
    df = fold_table(spark)
    make = lambda: TRAINERS[name](batch_size=batch, shuffle=shuffle, callbacks=[LearningRateScheduler(), EarlyStopping(patience=1)])
    together = make().fit_folds(df, "fold", [0, 1, 2])
    for i, model in together.items():
        if i == 1:
            continue
        alone = make().fit(df.filter(F.col("fold") != i))
        assert model.state["history"] == pytest.approx(alone.state["history"])
        for key in ("coefs", "bias", "codebooks"):
            if key in alone.state:
                np.testing.assert_allclose(np.array(model.state[key]), np.array(alone.state[key]), rtol=1e-9)
        assert model.state.get("labels") == alone.state.get("labels")


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_folds_take_the_steps_of_one_training(spark):
    df = fold_table(spark).persist()
    make = lambda epochs: linear.LogisticClassifier(["a", "b"], "y", "id", learning_rate=3.0, epochs=epochs, batch_size=55)
    one = [jobs_of(spark, lambda: make(e).fit(df.filter("fold <> 0"))) for e in (1, 4)]
    three = [jobs_of(spark, lambda: make(e).fit_folds(df, "fold", [0, 1, 2])) for e in (1, 4)]
    assert three[1] - three[0] <= 1.5 * (one[1] - one[0])  # three more epochs, of two steps; three trainings would be 3 times it


def test_trees_and_medians_of_all_folds_at_once(spark):
    df = fold_table(spark, 400)
    grown = tree.DecisionTreeClassifier(["a", "b"], "kind", max_depth=4)
    for i, model in grown.fit_folds(df, "fold", [0, 1, 2]).items():
        alone = grown.fit(df.filter(F.col("fold") != i))
        assert rows(model.rules(spark)) == rows(alone.rules(spark))
    medians = ZeroRule(["t", "a"], "regression_median")
    for i, model in medians.fit_folds(df, "fold", [0, 1, 2]).items():
        assert model.state["values"] == medians.fit(df.filter(F.col("fold") != i)).state["values"]


def test_small_batches_take_as_many_jobs_as_large_ones(spark, monkeypatch):
    df = fold_table(spark, 900).persist()
    monkeypatch.setattr(linear, "max_ranges", lambda d: 20)
    monkeypatch.setattr(descent, "max_ranges", lambda d: 20)
    fit = lambda batch, **kw: lambda: linear.LinearRegression(["a", "b"], "t", "mbgd", "id", learning_rate=1.0, epochs=8, batch_size=batch, **kw).fit(df)
    assert jobs_of(spark, fit(1)) <= 40 and jobs_of(spark, fit(30)) <= 40  # 7,200 steps, and 240
    seen = []
    watch = lambda ctx: seen.append((ctx.epoch, len(ctx.losses), len(ctx.history))) or True
    assert jobs_of(spark, fit(1, callbacks=[watch])) <= jobs_of(spark, fit(1)) + 6 * 8  # one grouped aggregate an epoch, of a few stages
    assert seen == [(e, 1, e + 1) for e in range(8)]


def test_the_record_is_found_by_a_rule():
    assert [training.best_epoch(s, "min", 0.1) for s in ([5.0, 3.0, 2.95, 4.0], [1.0], [3.0, 2.95, 2.85, 2.8])] == [1, 0, 2]
    assert training.best_epoch([1.0, 2.0, 2.05, 3.0], "max", 0.1) == 3


def test_binned_trees_split_as_trees_of_binned_values(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 2)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > -0.2)).astype(int) + (rng.random(700) < 0.1)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, y int").repartition(4)
    ends = [np.unique(np.quantile(x[:, j], [i / 8 for i in range(8)])) for j in range(2)]
    low = np.column_stack([ends[j][np.searchsorted(ends[j], x[:, j], "right") - 1] for j in range(2)])
    by_hand = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(low, y)], "a double, b double, y int")
    make = lambda **kw: tree.DecisionTreeClassifier(["a", "b"], "y", max_depth=5, **kw)
    model, want = make(max_bins=8).fit(df), make().fit(by_hand)
    assert rows(model.rules(spark).select("node", "feature", F.round("threshold", 9), "fit_samples", "label")) == rows(want.rules(spark).select("node", "feature", F.round("threshold", 9), "fit_samples", "label"))
    assert len({n["threshold"] for n in model.state["nodes"] if n["feature"] is not None}) > 3
    whole = make(max_bins=2000).fit(df)  # a bin a value
    assert [n["samples"] for n in whole.state["nodes"]] == [n["samples"] for n in make().fit(df).state["nodes"]]
    with pytest.raises(ValueError, match="2 bins"):
        make(max_bins=1)


def shard_twin(data, shards, batch, rate, epochs, output, shard_of):
    """Local descent by the plain definition; ``data``: key -> (x, y)."""
    t, history = np.zeros(3), []
    for _ in range(epochs):
        ends, sizes, losses = [], [], []
        for s in range(shards):
            mine = [data[k] for k in sorted(data) if shard_of[k] == s]
            w = t.copy()
            for i in range(0, len(mine), batch):
                u = np.array([[*x, 1.0] for x, _ in mine[i : i + batch]])
                y = np.array([v for _, v in mine[i : i + batch]], float)
                soft, hard = output(u @ w)
                losses.append(np.mean(hard == y))
                w = w - rate / len(mine) * u.T @ (soft - y)
            ends.append(w)
            sizes.append(len(mine))
        t = sum(n * w for n, w in zip(sizes, ends)) / sum(sizes)
        history.append(np.mean(losses))
    return t, history


@pytest.mark.parametrize("kind", ["logistic", "perceptron"])
def test_local_descent_against_a_twin_and_under_any_partitioning(spark, kind):
    df = fold_table(spark, 400)
    make = TRAINERS[kind]
    fit = lambda d, **kw: make(shards=5, batch_size=32, **kw).fit(d)
    one, eight = fit(df.coalesce(1)), fit(df.repartition(8))
    assert one.state == eight.state
    found = df.select("id", "a", "b", "y", F.pmod(F.xxhash64("id"), F.lit(5)).alias("s")).collect()
    data, shard_of = {r.id: ((r.a, r.b), r.y) for r in found}, {r.id: r.s for r in found}
    sigmoid = lambda z: (1 / (1 + np.exp(-z)), (z >= 0).astype(float))
    step = lambda z: ((z > 0).astype(float),) * 2
    rate, epochs, output = (3.0, 3, sigmoid) if kind == "logistic" else (1.0, 2, step)
    t, history = shard_twin(data, 5, 32, rate, epochs, output, shard_of)
    np.testing.assert_allclose([*one.state["coefs"], one.state["bias"]], t, rtol=1e-9)
    assert one.state["history"] == pytest.approx(history)
    plain, single = make(batch_size=50).fit(df), make(batch_size=50, shards=1).fit(df)
    np.testing.assert_allclose(single.state["coefs"], plain.state["coefs"], rtol=1e-9)
    assert single.state["history"] == pytest.approx(plain.state["history"])
    assert jobs_of(spark, lambda: fit(df)) <= 3 + 4 * epochs
    with pytest.raises(ValueError, match="shard"):
        make(shards=0)


class Breaks:
    """The driver's end, the first time that an epoch is over."""

    def __init__(self, epoch):
        self.epoch = epoch

    def __call__(self, ctx):
        if ctx.epoch == self.epoch:
            raise RuntimeError("gone")
        return True


RESUMED = {"descent": TRAINERS["descent"], "logistic": TRAINERS["logistic"], "shards": lambda **kw: TRAINERS["logistic"](shards=3, **kw), "table": lambda **kw: TRAINERS["lvq"](driver_codebooks=2, **kw)}


@pytest.mark.parametrize("name", RESUMED)
def test_a_broken_training_goes_on_from_its_last_epoch(spark, tmp_path, name):
    df = fold_table(spark)
    make = lambda *more, **kw: RESUMED[name](batch_size=60, callbacks=[LearningRateScheduler(), EarlyStopping(patience=2), *more], **kw)
    path = str(tmp_path / "progress")
    with pytest.raises(RuntimeError, match="gone"):
        make(Breaks(1), progress=path).fit(df)
    seen = []
    note = lambda ctx: seen.append(ctx.epoch) or True
    model, whole = make(note, progress=path).fit(df), make().fit(df)
    assert seen[0] == 1 and model.state["history"] == pytest.approx(whole.state["history"])
    if name == "table":
        got, want = (np.array([[r["codebook"], *r["position"]] for r in m.codebooks(spark).orderBy("codebook").collect()]) for m in (model, whole))
        np.testing.assert_allclose(got, want, rtol=1e-9)
    else:
        for key in ("coefs", "bias", "codebooks"):
            if key in whole.state:
                np.testing.assert_allclose(np.array(model.state[key]), np.array(whole.state[key]), rtol=1e-9)
    seen.clear()
    again = make(note, progress=path).fit(df)  # it is over; nothing is trained
    assert seen == [] and again.state["history"] == model.state["history"]
    with pytest.raises(ValueError, match="another training"):
        make(progress=path).fit(df.limit(100))

"""Evaluation, training control and extension points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..base import TableModel, load_model
from ..functions import metrics
from ..functions.columns import feature
from ..models.bayes import NaiveBayesClassifier
from ..models.baseline import ZeroRule
from ..models.evaluate import (
    actual_vs_predicted, evaluate, evaluate_baseline, evaluate_model, plot_ranges, predict,
)
from ..models.linear import LinearRegression, LogisticClassifier, Perceptron
from ..models.lvq import LVQ
from ..models.training import EarlyStopping, LearningRateScheduler, StepTrainer, TrainingContext
from ..models.knn import KNNClassifier
from ..models.tree import DecisionTreeClassifier
from .learning import (
    BAYES_COLS, BAYES_SQL, LVQ_RATE, NEAR, STEP_ROWS, TREE_COLS, TREE_TARGET, grown_tree_sql, half, step_sql, step_table, tree_table,
)
from .registry import query, rounded, scratch, shuffled_pos, table

_COEFS = """c AS (SELECT regr_slope(o_totalprice, o_custkey) AS w, regr_intercept(o_totalprice, o_custkey) AS b FROM orders),
            p AS (SELECT o_orderkey, o_custkey, o_totalprice, b + w * o_custkey AS prediction FROM orders, c)"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("predict", f"WITH {_COEFS} SELECT o_orderkey, o_custkey, o_totalprice, round(prediction, 2) + 0.0 AS prediction FROM p")
def predict_orders(spark, folder):
    o = _orders(spark, folder)
    return predict(LinearRegression("o_custkey", "o_totalprice").fit(o), o).withColumn("prediction", rounded("prediction", 2))


@query(
    "evaluate",
    f"""WITH {_COEFS}, m AS (SELECT avg(o_totalprice) AS m FROM orders)
        SELECT round(sqrt(avg(pow(o_totalprice - prediction, 2))), 3) + 0.0 AS root_mean_squared_error,
               round(avg(abs(o_totalprice - prediction)), 3) + 0.0 AS mean_absolute_error,
               round(1 - sum(pow(o_totalprice - prediction, 2)) / sum(pow(o_totalprice - m, 2)), 8) + 0.0 AS r_squared FROM p, m""",
)
def evaluate_orders(spark, folder):
    o = _orders(spark, folder)
    names = ["root_mean_squared_error", "mean_absolute_error", "r_squared"]
    out = evaluate(LinearRegression("o_custkey", "o_totalprice").fit(o), o, names)
    return out.select(*[rounded(n, 8 if n == "r_squared" else 3).alias(n) for n in names])


@query(
    "evaluate_holdout",
    f"""WITH t AS (SELECT *, {shuffled_pos('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders),
             c AS (SELECT regr_slope(o_totalprice, o_custkey) AS w, regr_intercept(o_totalprice, o_custkey) AS b
                   FROM t WHERE pos < floor(0.8 * n))
        SELECT round(sqrt(avg(pow(o_totalprice - (b + w * o_custkey), 2))), 3) + 0.0 AS root_mean_squared_error
        FROM t, c WHERE pos >= floor(0.8 * n)""",
)
def evaluate_holdout(spark, folder):
    out = evaluate_model(
        _orders(spark, folder), LinearRegression("o_custkey", "o_totalprice"), "o_orderkey", "root_mean_squared_error"
    )
    return out.select(rounded("root_mean_squared_error", 3).alias("root_mean_squared_error"))


_FOLDED = f"""t AS (SELECT * FROM (SELECT *, {shuffled_pos('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders)
                    WHERE pos // (n // 4) < n // (n // 4)),
              f AS (SELECT *, CAST(pos // (n // 4) AS INTEGER) AS fold_id FROM t),
              i AS (SELECT DISTINCT fold_id AS i FROM f)"""


@query(
    "evaluate_folds_linear",
    f"""WITH {_FOLDED}, c AS (SELECT i, regr_slope(o_totalprice, o_custkey) AS w, regr_intercept(o_totalprice, o_custkey) AS b
                              FROM f, i WHERE fold_id <> i GROUP BY 1)
        SELECT fold_id, round(sqrt(avg(pow(o_totalprice - (b + w * o_custkey), 2))), 3) + 0.0 AS root_mean_squared_error
        FROM f JOIN c ON fold_id = i GROUP BY 1""",
)
def evaluate_folds_linear(spark, folder):
    out = evaluate_model(
        _orders(spark, folder), LinearRegression("o_custkey", "o_totalprice"), "o_orderkey", "root_mean_squared_error",
        sampling="cross_val", folds=4,
    )
    return out.withColumn("root_mean_squared_error", rounded("root_mean_squared_error", 3))


@query(
    "evaluate_folds_bayes",
    f"""WITH {_FOLDED}, g AS (SELECT fold_id, o_orderkey, o_orderstatus AS y, o_custkey::DOUBLE AS a, o_totalprice AS b FROM f),
             m AS (SELECT i, y AS class, count(*) / sum(count(*)) OVER (PARTITION BY i) AS prior, avg(a) AS ma, stddev_pop(a) AS sa,
                          avg(b) AS mb, stddev_pop(b) AS sb FROM g, i WHERE fold_id <> i GROUP BY i, y),
             p AS (SELECT fold_id, o_orderkey, y, arg_max(class, ln(prior) - ln(sa) - pow((a - ma) / sa, 2) / 2 - ln(sb) - pow((b - mb) / sb, 2) / 2) AS p
                   FROM g JOIN m ON fold_id = i GROUP BY 1, 2, 3)
        SELECT fold_id, round(avg(CAST(y = p AS DOUBLE)), 8) + 0.0 AS accuracy FROM p GROUP BY 1""",
)
def evaluate_folds_bayes(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    out = evaluate_model(
        o, NaiveBayesClassifier(["o_custkey", "o_totalprice"], "o_orderstatus"), "o_orderkey", sampling="cross_val", folds=4
    )
    return out.withColumn("accuracy", rounded("accuracy", 8))


@query(
    "evaluate_folds_zero_rule",
    f"""WITH {_FOLDED}, v AS (SELECT i, o_orderpriority AS v, count(*) AS n FROM f, i WHERE fold_id <> i GROUP BY 1, 2),
             b AS (SELECT i, v FROM v QUALIFY row_number() OVER (PARTITION BY i ORDER BY n DESC, v) = 1)
        SELECT fold_id, round(avg(CAST(o_orderpriority = v AS DOUBLE)), 8) + 0.0 AS accuracy FROM f JOIN b ON fold_id = i GROUP BY 1""",
)
def evaluate_folds_zero_rule(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    out = evaluate_model(o, ZeroRule("o_orderpriority"), "o_orderkey", sampling="cross_val", folds=4)
    return out.withColumn("accuracy", rounded("accuracy", 8))


_TREE_DESCENT = "CASE b.f WHEN 0 THEN t.x0 WHEN 1 THEN t.x1 ELSE t.x2 END < b.v THEN 2 * t.node ELSE 2 * t.node + 1 END AS node"


@query(
    "evaluate_folds_tree",
    f"""WITH a AS (SELECT l_orderkey, max(l_quantity) AS x0, max(l_discount) AS x1, max(l_tax) AS x2, max({TREE_TARGET}) AS y FROM lineitem GROUP BY 1),
             f AS (SELECT *, ({shuffled_pos('l_orderkey')}) // (count(*) OVER () // 2) AS fold_id, count(*) OVER () AS n FROM a QUALIFY fold_id < n // (n // 2)),
             i AS (SELECT DISTINCT fold_id AS p FROM f), r AS (SELECT p, x0, x1, x2, y FROM f, i WHERE fold_id <> p),
             {grown_tree_sql('r', 3, 'abc', 2, 5)},
             t0 AS (SELECT fold_id AS p, x0, x1, x2, y, 1 AS node FROM f),
             t1 AS (SELECT t.* REPLACE (CASE WHEN b.f IS NULL THEN t.node WHEN {_TREE_DESCENT}) FROM t0 t LEFT JOIN b0 b ON b.p = t.p AND b.node = t.node),
             t2 AS (SELECT t.* REPLACE (CASE WHEN b.f IS NULL THEN t.node WHEN {_TREE_DESCENT}) FROM t1 t LEFT JOIN b1 b ON b.p = t.p AND b.node = t.node)
        SELECT t.p AS fold_id, round(avg(CAST(t.y = e.label AS DOUBLE)), 8) + 0.0 AS accuracy
        FROM t2 t JOIN ends e ON e.p = t.p AND e.leaf = t.node GROUP BY 1""",
)
def evaluate_folds_tree(spark, folder):
    """A model that is trained once per fold."""
    df = tree_table(spark, folder).groupBy("l_orderkey").agg(
        *[F.max(c).alias(c) for c in TREE_COLS], F.max("y").alias("y")
    )
    out = evaluate_model(df, DecisionTreeClassifier(TREE_COLS, "y", max_depth=2), "l_orderkey", sampling="cross_val", folds=2)
    return out.withColumn("accuracy", rounded("accuracy", 8))


@query(
    "evaluate_folds_bayes_many",
    f"""WITH f AS (SELECT *, ({shuffled_pos('o_orderkey')}) // (count(*) OVER () // 150) AS fold_id, count(*) OVER () AS n FROM orders
                   QUALIFY fold_id < n // (n // 150)),
             i AS (SELECT DISTINCT fold_id AS i FROM f), g AS (SELECT fold_id, o_orderkey, o_orderpriority AS y, o_custkey::DOUBLE AS a, o_totalprice AS b FROM f),
             m AS (SELECT i, y AS class, count(*) / sum(count(*)) OVER (PARTITION BY i) AS prior, avg(a) AS ma, stddev_pop(a) AS sa,
                          avg(b) AS mb, stddev_pop(b) AS sb FROM g, i WHERE fold_id <> i GROUP BY i, y),
             p AS (SELECT fold_id, o_orderkey, y, arg_max(class, ln(prior) - ln(sa) - pow((a - ma) / sa, 2) / 2 - ln(sb) - pow((b - mb) / sb, 2) / 2) AS p
                   FROM g JOIN m ON fold_id = i GROUP BY 1, 2, 3)
        SELECT fold_id, round(avg(CAST(y = p AS DOUBLE)), 8) + 0.0 AS accuracy FROM p GROUP BY 1""",
)
def evaluate_folds_bayes_many(spark, folder):
    """Very many folds, and no more classes allowed than there are: every group counts."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    model = NaiveBayesClassifier(["o_custkey", "o_totalprice"], "o_orderpriority", max_classes=5)
    out = evaluate_model(o, model, "o_orderkey", sampling="cross_val", folds=150)
    return out.withColumn("accuracy", rounded("accuracy", 8))


# Trainings by step on the rows of all folds but one (``i``), half the table to a batch.
_FOLD_STEPS = f"""f AS MATERIALIZED (SELECT *, ({shuffled_pos('o_orderkey')}) // (n // 3) AS fold_id FROM ({STEP_ROWS}) QUALIFY fold_id < n // (n // 3)),
    i AS MATERIALIZED (SELECT DISTINCT fold_id AS i FROM f),
    r AS MATERIALIZED (SELECT i, o_orderkey, a, b, y, (row_number() OVER (PARTITION BY i ORDER BY o_orderkey) - 1) // ((n + 1) // 2) AS batch,
                              count(*) OVER (PARTITION BY i) AS m FROM f, i WHERE fold_id <> i)"""


def _fold_logistic_sql(epochs: int, rate: float) -> str:
    parts = [_FOLD_STEPS, "w0 AS MATERIALIZED (SELECT i, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS w0 FROM i)"]
    for step in range(2 * epochs):
        moved = ", ".join(f"any_value({w}) - {rate} * sum(e * {x}) / any_value(m) AS {w}" for w, x in (("wa", "a"), ("wb", "b"), ("w0", "1.0")))
        error = "1 / (1 + exp(-(w0 + a * wa + b * wb))) - y AS e"
        parts.append(f"w{step + 1} AS MATERIALIZED (SELECT i, {moved} FROM (SELECT *, {error} FROM r JOIN w{step} USING (i) WHERE batch = {step % 2}) GROUP BY i)")
    return "WITH " + ",\n".join(parts)


@query(
    "evaluate_folds_logistic",
    _fold_logistic_sql(2, 2.0)
    + """ SELECT fold_id, round(avg(CAST(CAST(1 / (1 + exp(-(w0 + a * wa + b * wb))) >= 0.5 AS INTEGER) = y AS DOUBLE)), 8) + 0.0 AS accuracy
          FROM f JOIN w4 ON fold_id = i GROUP BY 1""",
)
def evaluate_folds_logistic(spark, folder):
    """Trained by step: all folds in one course of training."""
    df = step_table(spark, folder)
    trainer = LogisticClassifier(["a", "b"], "y", "o_orderkey", learning_rate=2.0, epochs=2, batch_size=half(df))
    return evaluate_model(df, trainer, "o_orderkey", sampling="cross_val", folds=3).withColumn("accuracy", rounded("accuracy", 8))


def _fold_lvq_sql(epochs: int) -> str:
    parts = [
        _FOLD_STEPS,
        """c0 AS MATERIALIZED (SELECT i, row_number() OVER (PARTITION BY i ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1 AS cb, a AS ca, b AS cc, y AS label
                               FROM r QUALIFY cb < 6)""",
    ]
    nearest = "arg_min({'cb': cb, 'label': label}, {'d': pow(a - ca, 2) + pow(b - cc, 2), 'cb': cb}) AS hit"
    for step in range(2 * epochs):
        parts.append(f"h{step} AS MATERIALIZED (SELECT i, o_orderkey, a, b, y, {nearest} FROM r JOIN c{step} USING (i) WHERE batch = {step % 2} GROUP BY ALL)")
        moved = ", ".join(f"c.{c} + {LVQ_RATE} * coalesce(sum(CASE WHEN h.y = c.label THEN {x} - {c} ELSE {c} - {x} END), 0) AS {c}" for c, x in (("ca", "a"), ("cc", "b")))
        parts.append(f"c{step + 1} AS MATERIALIZED (SELECT c.i, c.cb, c.label, {moved} FROM c{step} c LEFT JOIN h{step} h ON h.i = c.i AND h.hit.cb = c.cb GROUP BY c.i, c.cb, c.label, c.ca, c.cc)")
    parts.append(f"p AS (SELECT fold_id, o_orderkey, y, {nearest} FROM f JOIN c{2 * epochs} ON i = fold_id GROUP BY ALL)")
    return "WITH " + ",\n".join(parts)


@query("evaluate_folds_lvq", _fold_lvq_sql(1) + " SELECT fold_id, round(avg(CAST(y = hit.label AS DOUBLE)), 8) + 0.0 AS accuracy FROM p GROUP BY 1")
def evaluate_folds_lvq(spark, folder):
    df = step_table(spark, folder)
    trainer = LVQ(["a", "b"], "y", "o_orderkey", n_codebooks=6, learning_rate=LVQ_RATE, epochs=1, batch_size=half(df))
    return evaluate_model(df, trainer, "o_orderkey", sampling="cross_val", folds=3).withColumn("accuracy", rounded("accuracy", 8))


@query(
    "evaluate_folds_median",
    f"""WITH {_FOLDED}, v AS (SELECT i, median(o_totalprice) AS v FROM f, i WHERE fold_id <> i GROUP BY 1)
        SELECT fold_id, round(avg(abs(o_totalprice - v)), 4) + 0.0 AS mean_absolute_error FROM f JOIN v ON fold_id = i GROUP BY 1""",
)
def evaluate_folds_median(spark, folder):
    """All folds' medians from the scans of one."""
    out = evaluate_model(_orders(spark, folder), ZeroRule("o_totalprice", "regression_median"), "o_orderkey", "mean_absolute_error", sampling="cross_val", folds=4)
    return out.withColumn("mean_absolute_error", rounded("mean_absolute_error", 4))


_DRAW = "CAST(('0x' || substring(md5('42:' || o_orderkey), 1, 8))::BIGINT % len(v) AS INTEGER) + 1"


@query(
    "evaluate_baseline_random",
    f"""WITH t AS (SELECT *, {shuffled_pos('o_orderkey')} AS pos, count(*) OVER () AS n FROM orders),
             c AS (SELECT list_sort(list(DISTINCT o_orderpriority)) AS v FROM t WHERE pos < floor(0.8 * n))
        SELECT round(avg(CAST(v[{_DRAW}] = o_orderpriority AS DOUBLE)), 8) + 0.0 AS accuracy FROM t, c WHERE pos >= floor(0.8 * n)""",
)
def evaluate_baseline_random(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return evaluate_baseline(o, "o_orderpriority", "o_orderkey", "accuracy").select(rounded("accuracy", 8).alias("accuracy"))


@query(
    "evaluate_baseline_mean",
    f"""WITH {_FOLDED}, m AS (SELECT i, avg(o_totalprice) AS m FROM f, i WHERE fold_id <> i GROUP BY 1)
        SELECT fold_id, round(avg(abs(o_totalprice - m)), 3) + 0.0 AS mean_absolute_error FROM f JOIN m ON fold_id = i GROUP BY 1""",
)
def evaluate_baseline_mean(spark, folder):
    out = evaluate_baseline(
        _orders(spark, folder), "o_totalprice", "o_orderkey", "mean_absolute_error", "regression_mean", "cross_val", folds=4
    )
    return out.withColumn("mean_absolute_error", rounded("mean_absolute_error", 3))


# -- training control ------------------------------------------------------------------------------

# Rates of three epochs under the decay: the factor after epoch e is 1 - e/3, compounding.
_DECAYED = [0.5, 0.5 * (1 - 0 / 3), 0.5 * (1 - 0 / 3) * (1 - 1 / 3)]


@query(
    "learning_rate_decay",
    step_sql("z", "t", "avg(abs(p - target))", 0.5, 3, _DECAYED)
    + " SELECT o_orderkey, round(w0 + a * wa + b * wb, 6) + 0.0 AS prediction FROM t, w6",
)
def learning_rate_decay(spark, folder):
    df = step_table(spark, folder)
    model = LinearRegression(
        ["a", "b"], "t", "mbgd", "o_orderkey", learning_rate=0.5, epochs=3, batch_size=half(df), callbacks=[LearningRateScheduler()]
    ).fit(df)
    return model.transform(df).select("o_orderkey", rounded("prediction").alias("prediction"))


@query(
    "early_stopping",
    step_sql("1 / (1 + exp(-z))", "y", "avg(CAST((p >= 0.5)::INTEGER = target AS DOUBLE))", 2.0, 1)
    + " SELECT o_orderkey, round(1 / (1 + exp(-(w0 + a * wa + b * wb))), 6) + 0.0 AS probability FROM t, w2",
)
def early_stopping(spark, folder):
    """No epoch improves by 2, so training stops after the second and the first epoch's state is restored."""
    df = step_table(spark, folder)
    model = LogisticClassifier(
        ["a", "b"], "y", "o_orderkey", learning_rate=2.0, epochs=9, batch_size=half(df),
        callbacks=[EarlyStopping(patience=1, mode="max", min_delta=2.0)],
    ).fit(df)
    return model.transform(df).select("o_orderkey", rounded("probability").alias("probability"))


@query(
    "actual_vs_predicted",
    f"WITH {_COEFS} SELECT CAST(o_custkey AS BIGINT) AS x, o_totalprice AS y, round(prediction, 2) + 0.0 AS prediction FROM p",
)
def actual_predicted(spark, folder):
    o = _orders(spark, folder)
    out = actual_vs_predicted(LinearRegression("o_custkey", "o_totalprice").fit(o), o, "o_custkey")
    return out.withColumn("prediction", rounded("prediction", 2))


@query(
    "plot_ranges",
    f"""WITH {_COEFS} SELECT min(o_custkey) AS x_min, max(o_custkey) AS x_max, round(min(least(o_totalprice, prediction)), 2) + 0.0 AS y_min,
           round(max(greatest(o_totalprice, prediction)), 2) + 0.0 AS y_max,
           round(arg_min(prediction, o_custkey), 2) + 0.0 AS prediction_at_x_min,
           round(arg_max(prediction, o_custkey), 2) + 0.0 AS prediction_at_x_max FROM p""",
)
def ranges(spark, folder):
    o = _orders(spark, folder)
    out = plot_ranges(actual_vs_predicted(LinearRegression("o_custkey", "o_totalprice").fit(o), o, "o_custkey"))
    return out.withColumns({c: rounded(c, 2) for c in out.columns if not c.startswith("x_")})


@query(
    "save_and_load",
    f"""WITH {BAYES_SQL} SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, arg_max(class, score) AS prediction
        FROM s GROUP BY l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_quantity, l_discount, l_tax""",
)
def save_and_load(spark, folder):
    li = table(spark, folder, "lineitem")
    model = NaiveBayesClassifier(BAYES_COLS, "l_returnflag").fit(li)
    path = scratch(spark, "model")
    model.save(path)
    restored = model.set_params(load_model(spark, path).get_params())
    return restored.transform(li).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "prediction")


@query(
    "save_and_load_table",
    f"""WITH {NEAR}, n AS (SELECT query, label, count(*) AS votes FROM k GROUP BY 1, 2)
        SELECT query AS vec_id, label AS prediction FROM n QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, label) = 1""",
)
def save_and_load_table(spark, folder):
    """A model whose state is a table."""
    e = table(spark, folder, "embeddings")
    path = scratch(spark, "model")
    KNNClassifier("embedding", "label", "vec_id", 5, exclude_self=True).fit(e).save(path)
    return load_model(spark, path).transform(e).select("vec_id", "prediction")


# -- extension points ------------------------------------------------------------------------------


def largest_error(actual, predicted) -> Column:
    """A user's own metric: any aggregate over actual and predicted."""
    return F.max(F.abs(F.col(actual[0]) - F.col(predicted[0])))


@query("user_metric", f"WITH {_COEFS} SELECT round(max(abs(o_totalprice - prediction)), 2) + 0.0 AS largest_error FROM p")
def user_metric(spark, folder):
    o = _orders(spark, folder)
    out = evaluate(LinearRegression("o_custkey", "o_totalprice").fit(o), o, largest_error)
    return out.select(rounded("largest_error", 2).alias("largest_error"))


class CentreModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", F.lit(self.state["centre"]))


class CentreTrainer(StepTrainer):
    """A user's own model: a constant, pulled towards each batch's mean."""

    def columns(self):
        return {"y": feature(self.target_cols[0])}

    def initial_state(self, df, n):
        return {"centre": 0.0}

    def step(self, batch, state):
        scored = batch.withColumn("p", F.lit(state["centre"]))
        return scored.agg(F.avg(F.col("y") - F.col("p")).alias("gap"), self.loss("y", "p").alias("loss"))

    def update(self, state, rows, learning_rate, n):
        return {"centre": state["centre"] + learning_rate * rows[0]["gap"]}

    def make_model(self, state, history):
        return CentreModel({"input_cols": [], "target_cols": self.target_cols}, {**state, "history": history})


@query(
    "user_model",
    """WITH t AS (SELECT o_orderkey, o_totalprice AS y, (row_number() OVER (ORDER BY o_orderkey) - 1) // ((count(*) OVER () + 1) // 2) AS b FROM orders),
            m AS (SELECT avg(CASE WHEN b = 0 THEN y END) AS m0, avg(CASE WHEN b = 1 THEN y END) AS m1 FROM t),
            s1 AS (SELECT m0, m1, 0.3 * m0 AS c FROM m), s2 AS (SELECT m0, m1, c + 0.3 * (m1 - c) AS c FROM s1),
            s3 AS (SELECT m0, m1, c + 0.3 * (m0 - c) AS c FROM s2), s4 AS (SELECT c + 0.3 * (m1 - c) AS c FROM s3)
       SELECT o_orderkey, round(c, 3) + 0.0 AS prediction FROM orders, s4""",
)
def user_model(spark, folder):
    o = _orders(spark, folder)
    model = CentreTrainer(
        [], "o_totalprice", "o_orderkey", metrics.mean_absolute_error, learning_rate=0.3, epochs=2, batch_size=half(o)
    ).fit(o)
    return model.transform(o).select("o_orderkey", rounded("prediction", 3).alias("prediction"))


def halve_rate(ctx: TrainingContext) -> bool:
    """A user's own callback."""
    ctx.learning_rate /= 2
    return ctx.epoch < 1


@query(
    "user_callback",
    step_sql("CAST(z > 0 AS DOUBLE)", "y", "avg(CAST(p = target AS DOUBLE))", 1.0, 2, [1.0, 0.5])
    + " SELECT o_orderkey, CAST(w0 + a * wa + b * wb > 0 AS INTEGER) AS prediction FROM t, w4",
)
def user_callback(spark, folder):
    df = step_table(spark, folder)
    model = Perceptron(
        ["a", "b"], "y", "o_orderkey", learning_rate=1.0, epochs=7, batch_size=half(df), callbacks=[halve_rate]
    ).fit(df)
    return model.transform(df).select("o_orderkey", "prediction")

"""Models (B1-B4, R1-R4, N1-N3, K-NN1 to K-NN4, C1-C6, V1-V3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics
from ..models import tree
from ..models.baseline import RandomModel, ZeroRule
from ..models.bayes import NaiveBayesClassifier
from ..models.knn import KNNClassifier, KNNRegressor, nearest_neighbours
from ..models.linear import LinearRegression, LogisticClassifier, Perceptron
from ..models.lvq import LVQ
from ..models.training import loss_history
from ..operators.scale import Scaler
from .registry import natural_pos, query, rounded, table

# -- baselines -------------------------------------------------------------------------------------


@query(
    "random_baseline",
    """WITH c AS (SELECT list_sort(list(DISTINCT o_orderpriority)) AS v FROM orders)
       SELECT o_orderkey, v[CAST(('0x' || substring(md5('42:' || o_orderkey), 1, 8))::BIGINT % len(v) AS INTEGER) + 1] AS prediction
       FROM orders, c""",
)
def random_baseline(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return RandomModel("o_orderpriority", "o_orderkey").fit(o).transform(o).select("o_orderkey", "prediction")


@query(
    "zero_rule_classification",
    """WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
            d AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1)
       SELECT o_orderkey, (SELECT v FROM c ORDER BY n DESC, v LIMIT 1) AS prediction_o_orderpriority,
              (SELECT v FROM d ORDER BY n DESC, v LIMIT 1) AS prediction_o_orderstatus FROM orders""",
)
def zero_rule_classification(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    out = ZeroRule(["o_orderpriority", "o_orderstatus"]).fit(o).transform(o)
    return out.select("o_orderkey", "prediction_o_orderpriority", "prediction_o_orderstatus")


def _zero_rule(name: str, mode: str, expression: str):
    @query(name, f"SELECT o_orderkey, round((SELECT {expression} FROM orders), 4) + 0.0 AS prediction FROM orders")
    def run(spark, folder):
        o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
        out = ZeroRule("o_totalprice", mode).fit(o).transform(o)
        return out.select("o_orderkey", rounded("prediction", 4).alias("prediction"))

    return run


_zero_rule("zero_rule_mean", "regression_mean", "avg(o_totalprice)")
_zero_rule("zero_rule_median", "regression_median", "quantile_cont(o_totalprice, 0.5)")

# -- linear models ---------------------------------------------------------------------------------


@query(
    "linear_normal_equation",
    """WITH c AS (SELECT regr_slope(o_totalprice, o_custkey) AS w, regr_intercept(o_totalprice, o_custkey) AS b FROM orders)
       SELECT o_orderkey, round(b + w * o_custkey, 2) + 0.0 AS prediction FROM orders, c""",
)
def linear_normal_equation(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = LinearRegression("o_custkey", "o_totalprice").fit(o).transform(o)
    return out.select("o_orderkey", rounded("prediction", 2).alias("prediction"))


# Two inputs and two targets: each target's weights by Cramer's rule on centred sums.
def _two_inputs(target: str) -> str:
    return f"""SELECT (covar_pop({target}, a) * var_pop(b) - covar_pop({target}, b) * covar_pop(a, b))
                      / (var_pop(a) * var_pop(b) - pow(covar_pop(a, b), 2)) AS wa,
                      (covar_pop({target}, b) * var_pop(a) - covar_pop({target}, a) * covar_pop(a, b))
                      / (var_pop(a) * var_pop(b) - pow(covar_pop(a, b), 2)) AS wb,
                      avg(a) AS ma, avg(b) AS mb, avg({target}) AS mt FROM t"""


_LINES = """SELECT l_quantity AS a, l_extendedprice / 1000 AS b, 3 * l_quantity - l_tax * 100 + l_discount * 10 AS t1,
                   l_extendedprice / 500 + l_quantity * l_tax AS t2, l_extendedprice AS price FROM lineitem"""


def _lines(spark, folder):
    q, price, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    return table(spark, folder, "lineitem").select(
        q.alias("a"), (price / 1000).alias("b"), (3 * q - tax * 100 + F.col("l_discount") * 10).alias("t1"),
        (price / 500 + q * tax).alias("t2"), price.alias("price"),
    )


@query(
    "linear_two_targets",
    f"""WITH t AS ({_LINES}), c1 AS ({_two_inputs('t1')}), c2 AS ({_two_inputs('t2')})
        SELECT a, price, round(c1.mt + c1.wa * (a - c1.ma) + c1.wb * (b - c1.mb), 4) + 0.0 AS prediction_t1,
               round(c2.mt + c2.wa * (a - c2.ma) + c2.wb * (b - c2.mb), 4) + 0.0 AS prediction_t2 FROM t, c1, c2""",
)
def linear_two_targets(spark, folder):
    t = _lines(spark, folder)
    out = LinearRegression(["a", "b"], ["t1", "t2"]).fit(t).transform(t)
    return out.select(
        "a", "price", rounded("prediction_t1", 4).alias("prediction_t1"),
        rounded("prediction_t2", 4).alias("prediction_t2"),
    )


# Step-trained models: the same few steps written out as one SQL step after another. Half the rows make a batch.
STEP_ROWS = f"""SELECT o_orderkey, a, b, CAST(b > 1.5 + a AS INTEGER) AS y, b * 2 - 4 AS t, p // ((n + 1) // 2) AS batch, n
                FROM (SELECT o_orderkey, o_custkey * 10.0::DOUBLE / count(*) OVER () AS a, o_totalprice / 100000.0::DOUBLE AS b,
                             {natural_pos('o_orderkey')} AS p, count(*) OVER () AS n FROM orders)"""


def step_table(spark, folder):
    """Inputs of about the same size at every scale, so that a few steps stay in range."""
    o = table(spark, folder, "orders")
    a, b = F.col("o_custkey") * 10.0 / o.count(), F.col("o_totalprice") / 100000.0
    return o.select(
        "o_orderkey", a.alias("a"), b.alias("b"), (b > 1.5 + a).cast("int").alias("y"), (b * 2 - 4).alias("t")
    )


def step_sql(output: str, target: str, loss: str, rate: float, epochs: int, rates: list[float] | None = None) -> str:
    """CTEs ``t``, ``w0`` .. and ``loss0`` ..: weights before each step, and the loss of the step's batch.

    ``output`` maps ``z`` to what the error is taken from; ``loss`` uses ``y`` and ``p``.
    """
    parts = [f"t AS MATERIALIZED ({STEP_ROWS})", "w0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS w0)"]
    step = 0
    for epoch in range(epochs):
        r = rates[epoch] if rates else rate
        for b in range(2):
            parts.append(
                f"s{step} AS MATERIALIZED (SELECT *, {target} AS target, {output} AS p FROM "
                f"(SELECT t.*, w0 + a * wa + b * wb AS z, wa, wb, w0 FROM t, w{step} WHERE batch = {b}))"
            )
            parts.append(f"loss{step} AS MATERIALIZED (SELECT {loss} AS loss FROM s{step})")
            parts.append(
                f"w{step + 1} AS MATERIALIZED (SELECT any_value(wa) - {r} / any_value(n) * sum((p - target) * a) AS wa, "
                f"any_value(wb) - {r} / any_value(n) * sum((p - target) * b) AS wb, "
                f"any_value(w0) - {r} / any_value(n) * sum(p - target) AS w0 FROM s{step})"
            )
            step += 1
    return "WITH " + ",\n".join(parts)


def half(df) -> int:
    return (df.count() + 1) // 2


@query(
    "linear_descent",
    step_sql("z", "t", "avg(abs(p - target))", 0.5, 3)
    + " SELECT o_orderkey, round(w0 + a * wa + b * wb, 6) + 0.0 AS prediction FROM t, w6",
)
def linear_descent(spark, folder):
    df = step_table(spark, folder)
    model = LinearRegression(["a", "b"], "t", "mbgd", "o_orderkey", learning_rate=0.5, epochs=3, batch_size=half(df)).fit(df)
    return model.transform(df).select("o_orderkey", rounded("prediction").alias("prediction"))


@query(
    "loss_history",
    step_sql("z", "t", "avg(abs(p - target))", 0.5, 3)
    + " SELECT CAST(0 AS INTEGER) AS epoch, round(((SELECT loss FROM loss0) + (SELECT loss FROM loss1)) / 2, 8) + 0.0 AS loss"
    + " UNION ALL SELECT 1, round(((SELECT loss FROM loss2) + (SELECT loss FROM loss3)) / 2, 8) + 0.0"
    + " UNION ALL SELECT 2, round(((SELECT loss FROM loss4) + (SELECT loss FROM loss5)) / 2, 8) + 0.0",
)
def linear_loss_history(spark, folder):
    df = step_table(spark, folder)
    model = LinearRegression(["a", "b"], "t", "mbgd", "o_orderkey", learning_rate=0.5, epochs=3, batch_size=half(df)).fit(df)
    return loss_history(model, spark).withColumn("loss", rounded("loss", 8))


# Batches of 32 rows, step by step in a recursion over the sums of each batch.
SMALL_BATCH, SMALL_EPOCHS = 32, 2
_SMALL_STEPS = f"""WITH RECURSIVE t AS MATERIALIZED (SELECT * REPLACE (p // {SMALL_BATCH} AS batch) FROM (SELECT *, {natural_pos('o_orderkey')} AS p FROM ({STEP_ROWS}))),
    g AS MATERIALIZED (SELECT batch, count(*) AS c, sum(a) AS sa, sum(b) AS sb, sum(t) AS st, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb,
                              sum(a * t) AS sat, sum(b * t) AS sbt, any_value(n) AS n, (any_value(n) + {SMALL_BATCH - 1}) // {SMALL_BATCH} AS batches FROM t GROUP BY batch),
    w AS (SELECT 0::BIGINT AS step, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS w0
          UNION ALL SELECT step + 1, wa - 0.5 / n * (saa * wa + sab * wb + sa * w0 - sat), wb - 0.5 / n * (sab * wa + sbb * wb + sb * w0 - sbt),
                           w0 - 0.5 / n * (sa * wa + sb * wb + c * w0 - st)
          FROM w JOIN g ON g.batch = step % batches WHERE step < {SMALL_EPOCHS} * batches)"""


def small_batches(spark, folder):
    df = step_table(spark, folder)
    return df, LinearRegression(["a", "b"], "t", "mbgd", "o_orderkey", learning_rate=0.5, epochs=SMALL_EPOCHS, batch_size=SMALL_BATCH).fit(df)


@query(
    "linear_small_batches",
    _SMALL_STEPS + " SELECT o_orderkey, round(w0 + a * wa + b * wb, 6) + 0.0 AS prediction FROM t, w WHERE step = (SELECT max(step) FROM w)",
)
def linear_small_batches(spark, folder):
    df, model = small_batches(spark, folder)
    return model.transform(df).select("o_orderkey", rounded("prediction").alias("prediction"))


@query(
    "linear_small_batches_history",
    _SMALL_STEPS
    + """, l AS (SELECT step, step // any_value(batches) AS epoch, avg(abs(w0 + a * wa + b * wb - t)) AS loss
             FROM w JOIN g ON g.batch = step % batches JOIN t ON t.batch = g.batch GROUP BY step)
         SELECT CAST(epoch AS INTEGER) AS epoch, round(avg(loss), 8) + 0.0 AS loss FROM l WHERE epoch < """
    + f"{SMALL_EPOCHS} GROUP BY epoch",
)
def linear_small_batches_history(spark, folder):
    return loss_history(small_batches(spark, folder)[1], spark).withColumn("loss", rounded("loss", 8))


@query(
    "logistic_classifier",
    step_sql("1 / (1 + exp(-z))", "y", "avg(CAST((p >= 0.5)::INTEGER = target AS DOUBLE))", 2.0, 2)
    + """ SELECT o_orderkey, round(1 / (1 + exp(-(w0 + a * wa + b * wb))), 6) + 0.0 AS probability,
                 CAST(1 / (1 + exp(-(w0 + a * wa + b * wb))) >= 0.5 AS INTEGER) AS prediction FROM t, w4""",
)
def logistic(spark, folder):
    df = step_table(spark, folder)
    model = LogisticClassifier(["a", "b"], "y", "o_orderkey", learning_rate=2.0, epochs=2, batch_size=half(df)).fit(df)
    return model.transform(df).select("o_orderkey", rounded("probability").alias("probability"), "prediction")


_PERCEPTRON = step_sql("CAST(z > 0 AS DOUBLE)", "y", "avg(CAST(p = target AS DOUBLE))", 1.0, 2)


@query(
    "perceptron",
    _PERCEPTRON + " SELECT o_orderkey, CAST(w0 + a * wa + b * wb > 0 AS INTEGER) AS prediction FROM t, w4",
)
def perceptron(spark, folder):
    df = step_table(spark, folder)
    model = Perceptron(["a", "b"], "y", "o_orderkey", learning_rate=1.0, epochs=2, batch_size=half(df)).fit(df)
    return model.transform(df).select("o_orderkey", "prediction")


@query(
    "perceptron_history",
    _PERCEPTRON
    + " SELECT CAST(0 AS INTEGER) AS epoch, round(((SELECT loss FROM loss0) + (SELECT loss FROM loss1)) / 2, 8) + 0.0 AS loss"
    + " UNION ALL SELECT 1, round(((SELECT loss FROM loss2) + (SELECT loss FROM loss3)) / 2, 8) + 0.0",
)
def perceptron_history(spark, folder):
    df = step_table(spark, folder)
    model = Perceptron(["a", "b"], "y", "o_orderkey", learning_rate=1.0, epochs=2, batch_size=half(df)).fit(df)
    return loss_history(model, spark).withColumn("loss", rounded("loss", 8))


# -- naive Bayes -----------------------------------------------------------------------------------

BAYES_COLS = ["l_quantity", "l_discount", "l_tax"]
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in BAYES_COLS)
_LOG_SCORE = "ln(prior)" + "".join(
    f" - ln(s_{c}) - 0.5 * ln(2 * pi()) - 0.5 * pow(({c} - m_{c}) / s_{c}, 2)" for c in BAYES_COLS
)
BAYES_SQL = f"""m AS (SELECT l_returnflag AS class, count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS prior, {_MOMENTS}
                      FROM lineitem GROUP BY 1),
                r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem),
                s AS (SELECT r.*, class, {_LOG_SCORE} AS score FROM r, m)"""
_BEST = """p AS (SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_returnflag, arg_max(class, score) AS prediction
                 FROM s GROUP BY ALL)"""


@query(
    "naive_bayes_fit",
    "SELECT l_returnflag AS class, round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 8) + 0.0 AS prior, "
    + ", ".join(f"round(avg({c}), 6) + 0.0 AS mean_{c}, round(stddev_pop({c}), 6) + 0.0 AS std_{c}" for c in BAYES_COLS)
    + " FROM lineitem GROUP BY 1",
)
def naive_bayes_fit(spark, folder):
    state = NaiveBayesClassifier(BAYES_COLS, "l_returnflag").fit(table(spark, folder, "lineitem")).state
    rows = [
        (c, p, *[v for pair in zip(means, stds) for v in pair])
        for c, p, means, stds in zip(state["classes"], state["priors"], state["means"], state["stds"])
    ]
    fields = ", ".join(f"mean_{c} double, std_{c} double" for c in BAYES_COLS)
    out = spark.createDataFrame(rows, f"class string, prior double, {fields}")
    return out.withColumns({c: rounded(c, 8 if c == "prior" else 6) for c in out.columns if c != "class"})


@query(
    "naive_bayes_scores",
    f"""WITH {BAYES_SQL} SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
        {', '.join(f"round(max(CASE WHEN class = '{k}' THEN exp(score) END), 7) + 0.0 AS score_{k}" for k in 'ANR')}
        FROM s GROUP BY ALL""",
)
def naive_bayes_scores(spark, folder):
    li = table(spark, folder, "lineitem")
    out = NaiveBayesClassifier(BAYES_COLS, "l_returnflag").fit(li).predict_proba(li)
    return out.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        *[rounded(f"score_{k}", 7).alias(f"score_{k}") for k in "ANR"],
    )


@query(
    "naive_bayes_predict",
    f"WITH {BAYES_SQL}, {_BEST} SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, prediction FROM p",
)
def naive_bayes_predict(spark, folder):
    li = table(spark, folder, "lineitem")
    out = NaiveBayesClassifier(BAYES_COLS, "l_returnflag").fit(li).transform(li)
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "prediction")


@query(
    "naive_bayes_confusion",
    f"WITH {BAYES_SQL}, {_BEST} SELECT prediction AS predicted, l_returnflag AS actual, count(*) AS n FROM p GROUP BY 1, 2",
)
def naive_bayes_confusion(spark, folder):
    """The flagship: standardise, fit, predict, count the confusion cells."""
    li = table(spark, folder, "lineitem").select(*BAYES_COLS, "l_returnflag")
    scaled = Scaler(BAYES_COLS).fit(li).transform(li)
    predicted = NaiveBayesClassifier(BAYES_COLS, "l_returnflag").fit(scaled).transform(scaled)
    return metrics.confusion_cells(predicted, "l_returnflag", "prediction")


# -- nearest neighbours ----------------------------------------------------------------------------

NEAR = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
          d AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, b.label, list_distance(a.v, b.v) AS distance
                FROM e a, e b WHERE a.vec_id <> b.vec_id),
          k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank FROM d QUALIFY rank <= 5)"""


@query(
    "nearest_neighbours",
    f"WITH {NEAR} SELECT query, neighbour, round(distance, 6) + 0.0 AS distance, CAST(rank AS INTEGER) AS rank FROM k",
)
def neighbours(spark, folder):
    e = table(spark, folder, "embeddings")
    out = nearest_neighbours(e, e, "embedding", 5, "vec_id", "vec_id", exclude_self=True)
    return out.withColumn("distance", rounded("distance"))


@query(
    "nearest_neighbours_pruned",
    f"WITH {NEAR} SELECT query, neighbour, round(distance, 6) + 0.0 AS distance, CAST(rank AS INTEGER) AS rank FROM k",
)
def neighbours_pruned(spark, folder):
    """The same through many cells and small blocks, as large tables take it."""
    e = table(spark, folder, "embeddings")
    out = nearest_neighbours(
        e, e, "embedding", 5, "vec_id", "vec_id", exclude_self=True, pivots=12, train_block=120, query_block=200
    )
    return out.withColumn("distance", rounded("distance"))


@query(
    "knn_classifier",
    f"""WITH {NEAR}, n AS (SELECT query, label, count(*) AS votes FROM k GROUP BY 1, 2)
        SELECT query AS vec_id, label AS prediction FROM n QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, label) = 1""",
)
def knn_classifier(spark, folder):
    e = table(spark, folder, "embeddings")
    model = KNNClassifier("embedding", "label", "vec_id", 5, exclude_self=True).fit(e)
    return model.transform(e).select("vec_id", "prediction")


# Orders are asked about customers' balances: another table, two plain inputs, so nothing is excluded.
_CROSS = """c AS (SELECT c_custkey, c_acctbal / 1000 AS a, c_nationkey / 5.0::DOUBLE AS b, c_acctbal AS y FROM customer),
            s AS (SELECT s_suppkey AS c_custkey, s_acctbal / 1000 AS a, s_nationkey / 5.0::DOUBLE AS b FROM supplier),
            k AS (SELECT s.c_custkey AS q, c.y, row_number() OVER (PARTITION BY s.c_custkey
                         ORDER BY sqrt(pow(s.a - c.a, 2) + pow(s.b - c.b, 2)), c.c_custkey) AS rank FROM s, c QUALIFY rank <= 4)"""


def _regression(name: str, strategy: str, expression: str):
    @query(name, f"WITH {_CROSS} SELECT q AS c_custkey, round({expression}, 4) + 0.0 AS prediction FROM k GROUP BY 1")
    def run(spark, folder):
        c = table(spark, folder, "customer").select(
            "c_custkey", (F.col("c_acctbal") / 1000).alias("a"), (F.col("c_nationkey") / 5.0).alias("b"),
            F.col("c_acctbal").alias("y"),
        )
        s = table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("c_custkey"), (F.col("s_acctbal") / 1000).alias("a"), (F.col("s_nationkey") / 5.0).alias("b")
        )
        out = KNNRegressor(["a", "b"], "y", "c_custkey", 4, strategy).fit(c).transform(s)
        return out.select("c_custkey", rounded("prediction", 4).alias("prediction"))

    return run


_regression("knn_regressor_mean", "mean", "avg(y)")
_regression("knn_regressor_median", "median", "quantile_cont(y, 0.5)")

# -- trees -----------------------------------------------------------------------------------------

TREE_COLS = ["l_quantity", "l_discount", "l_tax"]
TREE_TARGET = "CASE WHEN l_quantity + 100 * l_discount < 20 THEN 'a' WHEN l_quantity + 100 * l_discount < 35 THEN 'b' ELSE 'c' END"
_TREE_ROWS = f"""SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity AS x0, l_discount AS x1, l_tax AS x2,
                        {TREE_TARGET} AS y FROM lineitem"""


def tree_table(spark, folder):
    reach = F.col("l_quantity") + 100 * F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", *TREE_COLS,
        F.when(reach < 20, "a").when(reach < 35, "b").otherwise("c").alias("y"),
    )


def _splits_sql(rows: str, name: str, keys: str = "node", inputs: int = 3, labels: str = "abc") -> str:
    """CTEs ``<name>`` with all candidate splits and ``<name>_best`` with each node's best, for ``rows(node, x0.., y)``."""
    stacked = " UNION ALL ".join(f"SELECT {keys}, {j} AS f, x{j} AS v, y FROM {rows}" for j in range(inputs))
    counts = ", ".join(f"count(CASE WHEN y = '{k}' THEN 1 END) AS c_{k}" for k in labels)
    left = ", ".join(
        f"coalesce(sum(c_{k}) OVER (PARTITION BY {keys}, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS l_{k}"
        for k in labels
    )
    total = ", ".join(f"sum(c_{k}) OVER (PARTITION BY {keys}, f)::DOUBLE AS t_{k}" for k in labels)

    def side(prefix: str) -> tuple[str, str]:
        terms = [f"({c})" for c in ([f"l_{k}" for k in labels] if prefix == "l" else [f"t_{k} - l_{k}" for k in labels])]
        n = " + ".join(terms)
        squares = " + ".join(f"{t} * {t}" for t in terms)
        return f"({n})", f"CASE WHEN ({n}) > 0 THEN 1 - ({squares}) / (({n}) * ({n})) ELSE 0 END"

    (nl, gl), (nr, gr) = side("l"), side("r")
    return f"""{name}_h AS (SELECT {keys}, f, v, {counts} FROM ({stacked}) GROUP BY ALL),
               {name}_c AS (SELECT {keys}, f, v, {left}, {total} FROM {name}_h),
               {name} AS (SELECT *, ({gl}) * {nl} / ({nl} + {nr}) + ({gr}) * {nr} / ({nl} + {nr}) AS gini, {nl} AS n_left, {nl} + {nr} AS n
                          FROM {name}_c),
               {name}_best AS (SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round(gini, 12), f, v) = 1)"""


def grown_tree_sql(rows: str, inputs: int, labels: str, depth: int, min_samples: int) -> str:
    """CTEs of whole trees with their stop rules, one per part ``p`` of ``rows(p, x0.., y)``.

    Nodes are numbered from 1, the children of n are 2n and 2n + 1. ``g<depth>`` has the rows with their leaf, ``split`` the
    splits made, ``ends`` for each leaf the node it collapses into, ``label`` what each of these predicts.
    """
    parts = [f"g0 AS MATERIALIZED (SELECT *, 1 AS node FROM {rows})"]
    for k in range(depth):
        parts.append(f"o{k} AS (SELECT * FROM g{k} WHERE node >= {2**k})")
        parts.append(_splits_sql(f"o{k}", f"s{k}", "p, node", inputs, labels))
        parts.append(f"b{k} AS MATERIALIZED (SELECT p, node, f, v, gini, n FROM s{k}_best WHERE n_left >= {min_samples} AND n - n_left >= {min_samples})")
        x = "CASE b.f " + " ".join(f"WHEN {j} THEN g.x{j}" for j in range(inputs)) + " END"
        parts.append(
            f"""g{k + 1} AS MATERIALIZED (SELECT g.* REPLACE (CASE WHEN b.f IS NULL THEN g.node WHEN {x} < b.v THEN 2 * g.node ELSE 2 * g.node + 1 END AS node)
                FROM g{k} g LEFT JOIN b{k} b ON b.p = g.p AND b.node = g.node)"""
        )
    parts.append("split AS (" + " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(depth)) + ")")
    parts.append(f"leaf AS (SELECT p, node, arg_max(y, {{'n': n, 'y': -ascii(y)}}) AS label FROM (SELECT p, node, y, count(*) AS n FROM g{depth} GROUP BY ALL) GROUP BY ALL)")
    above = f"unnest(range({depth + 1}))"
    parts.append(f"up AS (SELECT p, node AS leaf, label, node >> j AS node FROM (SELECT *, {above} AS j FROM leaf) WHERE node >> j > 0)")
    parts.append("same AS (SELECT p, node FROM up GROUP BY ALL HAVING count(DISTINCT label) = 1)")
    parts.append("ends AS (SELECT p, leaf, min(node) AS node, any_value(label) AS label FROM up JOIN same USING (p, node) GROUP BY p, leaf)")
    return ",\n".join(parts)


@query(
    "gini_splits",
    f"WITH r AS (SELECT 0 AS node, * FROM ({_TREE_ROWS})), {_splits_sql('r', 's')} "
    "SELECT CAST(f AS INTEGER) AS f, v, round(gini, 9) + 0.0 AS gini, CAST(n_left AS BIGINT) AS n_left FROM s",
)
def gini_splits(spark, folder):
    rows, classes = tree.training_rows(tree_table(spark, folder), TREE_COLS, "y", 10)
    histogram = tree.class_histogram(rows.withColumn("node", F.lit(0)), 3, len(classes))
    scores = tree.split_scores(histogram, len(classes), tree.value_ranges(rows, 3, depth=3))
    return scores.select("f", "v", rounded("gini", 9).alias("gini"), (F.col("l0") + F.col("l1") + F.col("l2")).alias("n_left"))


@query(
    "best_split",
    f"WITH r AS (SELECT 0 AS node, * FROM ({_TREE_ROWS})), {_splits_sql('r', 's')} "
    "SELECT CAST(f AS INTEGER) AS f, v, round(gini, 9) + 0.0 AS gini FROM s_best",
)
def best_split(spark, folder):
    rows, classes = tree.training_rows(tree_table(spark, folder), TREE_COLS, "y", 10)
    histogram = tree.class_histogram(rows.withColumn("node", F.lit(0)), 3, len(classes))
    best = tree.best_splits(tree.split_scores(histogram, len(classes), [[]] * 3), len(classes))
    return best.select("f", "v", rounded("gini", 9).alias("gini"))


# Two levels of splits: the root is node 0, its children 1 and 2, theirs 3 to 6. Where both children of 1 or of 2
# predict one class they collapse into it.
_DEPTH2 = f"""r AS MATERIALIZED (SELECT 0 AS node, * FROM ({_TREE_ROWS})), {_splits_sql('r', 's0')},
    r1 AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN (CASE b.f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) < b.v THEN 1 ELSE 2 END AS node)
           FROM r, s0_best b), {_splits_sql('r1', 's1')},
    r2 AS MATERIALIZED (SELECT r1.* REPLACE (CASE WHEN (CASE b.f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) < b.v THEN 1 ELSE 2 END
           + r1.node * 2 AS node) FROM r1 JOIN s1_best b ON r1.node = b.node), {_splits_sql('r2', 's2')},
    leaf AS (SELECT node, y, count(*) AS n FROM r2 GROUP BY 1, 2),
    label AS (SELECT node, y AS label FROM leaf QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, y) = 1),
    same AS (SELECT (node - 1) // 2 AS node, any_value(label) AS label FROM label GROUP BY 1 HAVING count(DISTINCT label) = 1)"""


@query(
    "tree_leaves",
    f"""WITH {_DEPTH2} SELECT l.label, CAST(b.n AS BIGINT) AS samples, round(b.gini, 9) + 0.0 AS gini
        FROM s2_best b JOIN label l USING (node) WHERE (node - 1) // 2 NOT IN (SELECT node FROM same)
        UNION ALL SELECT same.label, CAST(b.n AS BIGINT), round(b.gini, 9) + 0.0 FROM s1_best b JOIN same USING (node)""",
)
def tree_leaves(spark, folder):
    model = tree.DecisionTreeClassifier(TREE_COLS, "y", max_depth=2, min_samples=5).fit(tree_table(spark, folder))
    leaves = model.rules(spark).filter("feature IS NULL")
    return leaves.select("label", F.col("fit_samples").alias("samples"), rounded("fit_gini", 9).alias("gini"))


@query(
    "tree_inner_nodes",
    f"""WITH {_DEPTH2}, i AS (SELECT 1 AS depth, * FROM s0_best
            UNION ALL SELECT 2, * FROM s1_best WHERE node NOT IN (SELECT node FROM same))
        SELECT CAST(depth AS INTEGER) AS depth, ['l_quantity', 'l_discount', 'l_tax'][f + 1] AS feature, v AS threshold,
               round(gini, 9) + 0.0 AS gini, CAST(n AS BIGINT) AS samples FROM i""",
)
def tree_inner_nodes(spark, folder):
    model = tree.DecisionTreeClassifier(TREE_COLS, "y", max_depth=2, min_samples=5).fit(tree_table(spark, folder))
    inner = model.rules(spark).filter("feature IS NOT NULL")
    return inner.select("depth", "feature", "threshold", rounded("fit_gini", 9).alias("gini"), F.col("fit_samples").alias("samples"))


@query(
    "tree_predict",
    f"""WITH {_DEPTH2} SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, label AS prediction
        FROM r2 JOIN label USING (node)""",
)
def tree_predict(spark, folder):
    df = tree_table(spark, folder)
    model = tree.DecisionTreeClassifier(TREE_COLS, "y", max_depth=2, min_samples=5).fit(df)
    return model.transform(df).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "prediction")


@query(
    "tree_report",
    f"""WITH {_DEPTH2},
        path AS (SELECT *, 0 AS a FROM r2 UNION ALL SELECT *, (node - 1) // 2 FROM r2
                 UNION ALL SELECT *, node FROM r2 WHERE (node - 1) // 2 NOT IN (SELECT node FROM same)),
        mix AS (SELECT a, y, count(*) AS n FROM path GROUP BY 1, 2),
        top AS (SELECT a, y AS label FROM mix QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, y) = 1)
        SELECT label, CAST(sum(n) AS BIGINT) AS samples, round(1 - sum(n * n) / pow(sum(n), 2), 9) + 0.0 AS impurity,
               CAST(sum(CASE WHEN y = label THEN n ELSE 0 END) AS BIGINT) AS correct
        FROM mix JOIN top USING (a) GROUP BY a, label""",
)
def tree_report(spark, folder):
    df = tree_table(spark, folder)
    model = tree.DecisionTreeClassifier(TREE_COLS, "y", max_depth=2, min_samples=5).fit(df)
    return model.report(df).select("label", "samples", rounded("impurity", 9).alias("impurity"), "correct")


@query(
    "tree_deep",
    f"""WITH r AS (SELECT 0 AS p, l_quantity AS x0, l_discount AS x1, l_returnflag AS y FROM lineitem), {grown_tree_sql('r', 2, 'ANR', 3, 5)},
        e AS (SELECT g.y, ends.node FROM g3 g JOIN ends ON ends.leaf = g.node),
        mix AS (SELECT a AS node, y, count(*) AS n FROM (SELECT y, node >> j AS a FROM (SELECT *, unnest(range(4)) AS j FROM e) WHERE node >> j > 0) GROUP BY ALL),
        top AS (SELECT node, y AS label FROM mix QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, y) = 1),
        inner_nodes AS (SELECT DISTINCT node >> j AS node FROM (SELECT *, unnest(range(1, 4)) AS j FROM e) WHERE node >> j > 0)
        SELECT CAST(floor(log2(node)) + 1 AS INTEGER) AS depth, CASE WHEN i.node IS NOT NULL THEN ['l_quantity', 'l_discount'][s.f + 1] END AS feature,
               CASE WHEN i.node IS NOT NULL THEN s.v END AS threshold, label, CAST(sum(mix.n) AS BIGINT) AS samples,
               round(1 - sum(mix.n * mix.n) / pow(sum(mix.n), 2), 9) + 0.0 AS impurity, CAST(sum(CASE WHEN y = label THEN mix.n ELSE 0 END) AS BIGINT) AS correct
        FROM mix JOIN top USING (node) LEFT JOIN split s USING (node) LEFT JOIN inner_nodes i USING (node)
        GROUP BY node, s.f, s.v, i.node, label""",
)
def tree_deep(spark, folder):
    """Default stop rules on labels that the inputs cannot tell."""
    li = table(spark, folder, "lineitem")
    nodes = tree.DecisionTreeClassifier(["l_quantity", "l_discount"], "l_returnflag").fit(li).report(li)
    return nodes.select("depth", "feature", "threshold", "label", "samples", rounded("impurity", 9).alias("impurity"), "correct")


_BINS = 6


def _binned_sql(columns: list[str], inputs: list[str]) -> str:
    """CTE ``ends`` (j, e): the ends of the bins, exact quantiles. ``inputs``: what the columns are called then."""
    probs = "[" + ", ".join(repr(i / _BINS) for i in range(_BINS)) + "]"
    ends = " UNION ".join(f"SELECT {j} AS j, unnest(quantile_cont({c}::DOUBLE, {probs})) AS e FROM lineitem" for j, c in enumerate(columns))
    low = ", ".join(f"(SELECT max(e) FROM ends WHERE j = {j} AND e <= {c}) AS {x}" for j, (c, x) in enumerate(zip(columns, inputs)))
    return f"ends AS MATERIALIZED ({ends}), r AS MATERIALIZED (SELECT 0 AS p, {low}, l_returnflag AS y FROM lineitem)"


@query(
    "tree_binned",
    f"""WITH {_binned_sql(['l_quantity', 'l_extendedprice'], ['x0', 'x1']).replace('ends ', 'bin_ends ').replace('FROM ends', 'FROM bin_ends')},
        {grown_tree_sql('r', 2, 'ANR', 3, 5)},
        e AS (SELECT g.y, ends.node FROM g3 g JOIN ends ON ends.leaf = g.node),
        mix AS (SELECT a AS node, y, count(*) AS n FROM (SELECT y, node >> j AS a FROM (SELECT *, unnest(range(4)) AS j FROM e) WHERE node >> j > 0) GROUP BY ALL),
        inner_nodes AS (SELECT DISTINCT node >> j AS node FROM (SELECT *, unnest(range(1, 4)) AS j FROM e) WHERE node >> j > 0)
        SELECT CAST(floor(log2(node)) + 1 AS INTEGER) AS depth, CASE WHEN i.node IS NOT NULL THEN ['l_quantity', 'l_extendedprice'][s.f + 1] END AS feature,
               CASE WHEN i.node IS NOT NULL THEN round(s.v, 6) + 0.0 END AS threshold, CAST(sum(mix.n) AS BIGINT) AS samples,
               round(1 - sum(mix.n * mix.n) / pow(sum(mix.n), 2), 9) + 0.0 AS impurity
        FROM mix LEFT JOIN split s USING (node) LEFT JOIN inner_nodes i USING (node)
        GROUP BY node, s.f, s.v, i.node""",
)
def tree_binned(spark, folder):
    """Candidates at quantiles only; of siblings the smaller one is counted."""
    li = table(spark, folder, "lineitem")
    nodes = tree.DecisionTreeClassifier(["l_quantity", "l_extendedprice"], "l_returnflag", max_bins=_BINS).fit(li).report(li)
    return nodes.select("depth", "feature", rounded("threshold").alias("threshold"), "samples", rounded("impurity", 9).alias("impurity"))


# -- learning vector quantization ------------------------------------------------------------------

LVQ_RATE = 0.001


def _lvq_sql(epochs: int, batches: int = 2, codebooks: str = "6") -> str:
    """CTEs ``t`` (rows), ``c0`` .. (codebooks ``cb, ca, cc, label`` before each step)."""
    parts = [
        f"t AS MATERIALIZED ({STEP_ROWS})",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1 AS cb, a AS ca, b AS cc, y AS label
                  FROM t QUALIFY cb < {codebooks})""",
    ]
    step = 0
    for _ in range(epochs):
        for b in range(batches):
            parts.append(
                f"""h{step} AS MATERIALIZED (SELECT o_orderkey, a, b, y, arg_min({{'cb': cb, 'label': label}}, {{'d': pow(a - ca, 2) + pow(b - cc, 2), 'cb': cb}}) AS hit
                    FROM t, c{step} WHERE batch = {b} GROUP BY ALL)"""
            )
            parts.append(
                f"""c{step + 1} AS MATERIALIZED (SELECT c.cb, c.label, c.ca + {LVQ_RATE} * coalesce(sum(CASE WHEN h.y = c.label THEN a - ca ELSE ca - a END), 0) AS ca,
                    c.cc + {LVQ_RATE} * coalesce(sum(CASE WHEN h.y = c.label THEN b - cc ELSE cc - b END), 0) AS cc
                    FROM c{step} c LEFT JOIN h{step} h ON h.hit.cb = c.cb GROUP BY c.cb, c.label, c.ca, c.cc)"""
            )
            step += 1
    return "WITH " + ",\n".join(parts)


def lvq_model(spark, folder, epochs: int, init: str = "rows"):
    df = step_table(spark, folder)
    trainer = LVQ(
        ["a", "b"], "y", "o_orderkey", n_codebooks=6, init=init, learning_rate=LVQ_RATE, epochs=epochs, batch_size=half(df)
    )
    return df, trainer.fit(df)


def _codebook_rows(model, spark):
    return model.codebooks(spark).select(
        "codebook", rounded(F.col("position")[0]).alias("a"), rounded(F.col("position")[1]).alias("b")
    )


@query(
    "lvq_codebooks",
    f"""WITH t AS ({STEP_ROWS}),
            ra AS (SELECT a, row_number() OVER (ORDER BY md5('42:x0:' || o_orderkey), o_orderkey) - 1 AS i FROM t QUALIFY i < 6),
            rb AS (SELECT b, row_number() OVER (ORDER BY md5('42:x1:' || o_orderkey), o_orderkey) - 1 AS i FROM t QUALIFY i < 6)
       SELECT CAST(i AS INTEGER) AS codebook, round(a, 6) + 0.0 AS a, round(b, 6) + 0.0 AS b FROM ra JOIN rb USING (i)""",
)
def lvq_codebooks(spark, folder):
    """Columns sampled each on their own, before any step."""
    return _codebook_rows(lvq_model(spark, folder, 0, "columns")[1], spark)


@query(
    "lvq_train",
    _lvq_sql(2) + " SELECT CAST(cb AS INTEGER) AS codebook, round(ca, 6) + 0.0 AS a, round(cc, 6) + 0.0 AS b FROM c4",
)
def lvq_train(spark, folder):
    return _codebook_rows(lvq_model(spark, folder, 2)[1], spark)


@query(
    "lvq_predict",
    _lvq_sql(1)
    + """ SELECT o_orderkey, arg_min(label, {'d': pow(a - ca, 2) + pow(b - cc, 2), 'cb': cb}) AS prediction
          FROM t, c2 GROUP BY 1""",
)
def lvq_predict(spark, folder):
    df, model = lvq_model(spark, folder, 1)
    return model.transform(df).select("o_orderkey", "prediction")


@query(
    "lvq_codebook_table",
    _lvq_sql(1, codebooks="n // 20")
    + """ SELECT o_orderkey, arg_min(label, {'d': pow(a - ca, 2) + pow(b - cc, 2), 'cb': cb}) AS prediction FROM t, c2 GROUP BY o_orderkey""",
)
def lvq_codebook_table(spark, folder):
    """A twentieth of the rows as codebooks, kept and moved as a table."""
    df = step_table(spark, folder)
    trainer = LVQ(["a", "b"], "y", "o_orderkey", learning_rate=LVQ_RATE, epochs=1, batch_size=half(df), driver_codebooks=0)
    return trainer.fit(df).transform(df).select("o_orderkey", "prediction")

"""Fitted column transforms and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics
from ..operators.encode import OneHotEncoder, OrdinalEncoder
from ..operators.scale import Scaler
from .registry import query, rounded, table

_COLS = ["l_quantity", "l_extendedprice", "l_tax"]


def _scaled_sql(first: str, second: str) -> str:
    cells = ", ".join(f"round(({c} - {first}({c}) OVER ()) / ({second.format(c=c)}), 6) + 0.0 AS {c}" for c in _COLS)
    return f"SELECT l_orderkey, l_partkey, {cells} FROM lineitem"


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *_COLS)


def _round_all(df, digits=6):
    return df.withColumns({c: rounded(c, digits) for c in _COLS})


@query("scale_normalize", _scaled_sql("min", "max({c}) OVER () - min({c}) OVER ()"))
def scale_normalize(spark, folder):
    df = _lines(spark, folder)
    return _round_all(Scaler(_COLS, "normalize").fit(df).transform(df))


_SAME = f"SELECT l_orderkey, l_partkey, {', '.join(f'round({c}, 4) + 0.0 AS {c}' for c in _COLS)} FROM lineitem"


@query("scale_normalize_reverse", _SAME)
def scale_normalize_reverse(spark, folder):
    df = _lines(spark, folder)
    model = Scaler(_COLS, "normalize").fit(df)
    return _round_all(model.translate(model.transform(df)), 4)


@query("scale_standardize", _scaled_sql("avg", "stddev_pop({c}) OVER ()"))
def scale_standardize(spark, folder):
    df = _lines(spark, folder)
    return _round_all(Scaler(_COLS, "standardize").fit(df).transform(df))


@query("scale_standardize_reverse", _SAME)
def scale_standardize_reverse(spark, folder):
    df = _lines(spark, folder)
    model = Scaler(_COLS, "standardize").fit(df)
    return _round_all(model.translate(model.transform(df)), 4)


_FLAGS = ", ".join(
    f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, vs in (("l_returnflag", "ANR"), ("l_linestatus", "FO")) for v in vs
)


@query("one_hot", f"SELECT l_orderkey, l_partkey, {_FLAGS} FROM lineitem")
def one_hot(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    return OneHotEncoder(["l_returnflag", "l_linestatus"]).fit(df).transform(df)


@query(
    "one_hot_names",
    """SELECT 'l_returnflag_' || l_returnflag AS name, count(*) AS n FROM lineitem GROUP BY 1
       UNION ALL SELECT 'l_linestatus_' || l_linestatus, count(*) FROM lineitem GROUP BY 1""",
)
def one_hot_names(spark, folder):
    df = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    model = OneHotEncoder(["l_returnflag", "l_linestatus"]).fit(df)
    names = model.flat_names()
    sums = model.transform(df).agg(*[F.sum(n).alias(n) for n in names])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in names])))


@query("one_hot_reverse", "SELECT l_orderkey, l_partkey, l_returnflag, l_linestatus FROM lineitem")
def one_hot_reverse(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    model = OneHotEncoder(["l_returnflag", "l_linestatus"]).fit(df)
    return model.translate(model.transform(df))


@query(
    "ordinal",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS priority,
              CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS cust FROM orders""",
)
def ordinal(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    model = OrdinalEncoder(["o_orderpriority", "o_custkey"], ["priority", "cust"]).fit(df)
    return model.transform(df).select("o_orderkey", "priority", "cust")


@query(
    "ordinal_large_dictionary",
    "SELECT doc_id, CAST(dense_rank() OVER (ORDER BY text) - 1 AS BIGINT) AS code FROM documents",
)
def ordinal_large_dictionary(spark, folder):
    """The way of dictionaries too large to broadcast: frequent values apart, the rest by a shuffle."""
    df = table(spark, folder, "documents").select("doc_id", "text")
    return OrdinalEncoder("text", "code", broadcast_bytes=0, hot_values=10).fit(df).transform(df).select("doc_id", "code")


@query("ordinal_reverse", "SELECT o_orderkey, o_orderpriority, o_custkey FROM orders")
def ordinal_reverse(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    model = OrdinalEncoder(["o_orderpriority", "o_custkey"], ["priority", "cust"]).fit(df)
    coded = model.transform(df).select("o_orderkey", "priority", "cust")
    return model.translate(coded).select("o_orderkey", "o_orderpriority", "o_custkey")


# -- metrics ---------------------------------------------------------------------------------------


@query("accuracy", "SELECT round(avg(CAST(quality = toxic AS DOUBLE)), 8) + 0.0 AS accuracy FROM labels")
def accuracy(spark, folder):
    out = metrics.score(table(spark, folder, "labels"), "quality", "toxic", "accuracy")
    return out.select(rounded("accuracy", 8).alias("accuracy"))


@query(
    "accuracy_all_targets",
    """SELECT round(avg(CAST(l_returnflag = CASE WHEN l_quantity > 25 THEN 'N' ELSE 'R' END
                             AND l_linestatus = CASE WHEN l_tax > 0.04 THEN 'F' ELSE 'O' END AS DOUBLE)), 8) + 0.0 AS accuracy
       FROM lineitem""",
)
def accuracy_all_targets(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_quantity") > 25, "N").otherwise("R").alias("flag"),
        F.when(F.col("l_tax") > 0.04, "F").otherwise("O").alias("status"),
    )
    out = metrics.score(df, ["l_returnflag", "l_linestatus"], ["flag", "status"], "accuracy")
    return out.select(rounded("accuracy", 8).alias("accuracy"))


_PRIORITY_GUESS = """CASE WHEN o_totalprice < 100000 THEN '1-URGENT' WHEN o_totalprice < 300000 THEN '3-MEDIUM' ELSE '5-LOW' END"""


@query(
    "confusion_matrix",
    f"""WITH t AS (SELECT o_orderpriority AS y, {_PRIORITY_GUESS} AS p FROM orders), c AS (SELECT y AS c FROM t UNION SELECT p FROM t)
        SELECT c AS predicted, """
    + ", ".join(
        f"""CAST((SELECT count(*) FROM t WHERE p = c AND y = '{v}') AS BIGINT) AS "{v}" """
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM c",
)
def confusion_matrix(spark, folder):
    price = F.col("o_totalprice")
    df = table(spark, folder, "orders").withColumn(
        "guess", F.when(price < 100000, "1-URGENT").when(price < 300000, "3-MEDIUM").otherwise("5-LOW")
    )
    return metrics.confusion_matrix(df, "o_orderpriority", "guess")


# Actual price against a guess from the quantity: two numeric columns that are never equal.
_GUESS = "SELECT l_extendedprice AS y, l_quantity * 2000.0 + 3000.0 AS p, l_returnflag FROM lineitem"


def _guess(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000.0 + 3000.0).alias("p"), "l_returnflag"
    )


def _one_score(name: str, expression: str, digits: int = 4):
    @query(name, f"WITH t AS ({_GUESS}) SELECT round({expression}, {digits}) + 0.0 AS {name} FROM t")
    def run(spark, folder):
        return metrics.score(_guess(spark, folder), "y", "p", name).select(rounded(name, digits).alias(name))

    return run


_R2 = "(sum(pow(y - m, 2)) - sum(pow(y - p, 2))) / sum(pow(y - m, 2))"
_one_score("mean_absolute_error", "avg(abs(p - y))")
_one_score("mean_squared_error", "avg(pow(p - y, 2))", 2)
_one_score("root_mean_squared_error", "sqrt(avg(pow(y - p, 2)))")


@query(
    "r_squared",
    f"WITH t AS ({_GUESS}), u AS (SELECT *, avg(y) OVER () AS m FROM t) SELECT round({_R2}, 6) + 0.0 AS r_squared FROM u",
)
def r_squared(spark, folder):
    return metrics.score(_guess(spark, folder), "y", "p", "r_squared").select(rounded("r_squared").alias("r_squared"))


@query(
    "scores_by_group",
    f"""WITH t AS ({_GUESS}), u AS (SELECT *, avg(y) OVER (PARTITION BY l_returnflag) AS m FROM t)
        SELECT l_returnflag, round(avg(abs(p - y)), 4) + 0.0 AS mean_absolute_error, round({_R2}, 6) + 0.0 AS r_squared
        FROM u GROUP BY 1""",
)
def scores_by_group(spark, folder):
    out = metrics.score(_guess(spark, folder), "y", "p", ["mean_absolute_error", "r_squared"], ["l_returnflag"])
    return out.withColumns({"mean_absolute_error": rounded("mean_absolute_error", 4), "r_squared": rounded("r_squared")})


_BINARY = """SELECT quality AS y, CAST(doc_id % 3 = 0 OR toxic = 1 AS INTEGER) AS p FROM labels"""
_TP = "count(CASE WHEN y = 1 AND p = 1 THEN 1 END)"
_PRECISION = f"{_TP} / CAST(count(CASE WHEN p = 1 AND y IN (0, 1) THEN 1 END) AS DOUBLE)"
_RECALL = f"{_TP} / CAST(count(CASE WHEN y = 1 AND p IN (0, 1) THEN 1 END) AS DOUBLE)"


def _binary_score(name: str, expression: str):
    @query(name, f"WITH t AS ({_BINARY}) SELECT round({expression}, 8) + 0.0 AS {name} FROM t")
    def run(spark, folder):
        df = table(spark, folder, "labels").select(
            F.col("quality").alias("y"), ((F.col("doc_id") % 3 == 0) | (F.col("toxic") == 1)).cast("int").alias("p")
        )
        return metrics.score(df, "y", "p", name).select(rounded(name, 8).alias(name))

    return run


_binary_score("precision", _PRECISION)
_binary_score("recall", _RECALL)
_binary_score("f1_score", f"2 * ({_PRECISION}) * ({_RECALL}) / (({_PRECISION}) + ({_RECALL}))")

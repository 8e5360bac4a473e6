"""Missing values and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import missing, profile
from ..operators.sketch import column_sketches, merged_sketches, profile_of_sketches
from .registry import query, rounded, table

# Orders with holes: the tables themselves have none, so both sides punch the same ones.
_GAPS = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
                  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS cust,
                  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders"""


def gaps(spark, folder):
    o = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(key % 14 == 0, F.lit(None)).when(key % 7 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(key % 3 != 0, F.col("o_custkey")).alias("cust"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
    )


@query(
    "fill_mean",
    f"""WITH t AS ({_GAPS}) SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM t)), 4) + 0.0 AS price,
               round(coalesce(cust, (SELECT avg(cust) FROM t)), 4) + 0.0 AS cust, priority FROM t""",
)
def fill_mean(spark, folder):
    out = missing.fill_missing(gaps(spark, folder), ["price", "cust"], "mean")[0]
    return out.withColumns({"price": rounded("price", 4), "cust": rounded("cust", 4)})


@query(
    "fill_median",
    f"""WITH t AS ({_GAPS}) SELECT o_orderkey, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)), 4) + 0.0 AS price,
               round(coalesce(cust, (SELECT quantile_cont(cust, 0.5) FROM t)), 4) + 0.0 AS cust, priority FROM t""",
)
def fill_median(spark, folder):
    out = missing.fill_missing(gaps(spark, folder), ["price", "cust"], "median")[0]
    return out.withColumns({"price": rounded("price", 4), "cust": rounded("cust", 4)})


@query(
    "fill_constant",
    f"WITH t AS ({_GAPS}) SELECT o_orderkey, price, coalesce(cust, -1) AS cust, priority FROM t WHERE price IS NOT NULL",
)
def fill_constant(spark, folder):
    out = missing.fill_missing(gaps(spark, folder), "cust", -1)[0]
    return missing.fill_missing(out, "price", "remove")[0]


@query("fill_remove", f"WITH t AS ({_GAPS}) SELECT * FROM t WHERE price IS NOT NULL AND priority IS NOT NULL")
def fill_remove(spark, folder):
    return missing.fill_missing(gaps(spark, folder), ["price", "priority"], "remove")[0]


@query(
    "fill_remove_dropped",
    f"WITH t AS ({_GAPS}) SELECT o_orderkey, cust, priority FROM t WHERE cust IS NULL OR priority IS NULL",
)
def fill_remove_dropped(spark, folder):
    dropped = missing.fill_missing(gaps(spark, folder), ["cust", "priority"], "remove")[1]
    return dropped.select("o_orderkey", "cust", "priority")


def _profile_sql(source: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS "count", round(avg({c}), 4) + 0.0 AS mean,
                   round(stddev_pop({c}), 4) + 0.0 AS std_dev, CAST(min({c}) AS DOUBLE) AS min,
                   round(quantile_cont({c}, 0.25), 4) + 0.0 AS q25, round(quantile_cont({c}, 0.5), 4) + 0.0 AS q50,
                   round(quantile_cont({c}, 0.75), 4) + 0.0 AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(parts)


def _shown(df):
    return df.select(
        "column", "dtype", "count", rounded("mean", 4).alias("mean"), rounded("std_dev", 4).alias("std_dev"), "min",
        rounded("25%", 4).alias("q25"), rounded("50%", 4).alias("q50"), rounded("75%", 4).alias("q75"), "max",
    )


_LINE_NUMBERS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
}


@query("numeric_profile", _profile_sql("lineitem", _LINE_NUMBERS))
def numeric_profile(spark, folder):
    return _shown(profile.numeric_profile(table(spark, folder, "lineitem")))


@query(
    "numeric_profile_gaps",
    f"WITH t AS ({_GAPS}) " + _profile_sql("t", {"price": "double", "cust": "bigint"}),
)
def numeric_profile_gaps(spark, folder):
    return _shown(profile.numeric_profile(gaps(spark, folder), ["price", "cust"]))


@query(
    "quantiles_by_narrowing",
    _profile_sql("lineitem", {"l_extendedprice": "double", "l_quantity": "double", "l_tax": "double"}),
)
def quantiles_by_narrowing(spark, folder):
    """The same profile by the way that serves columns too large for one task."""
    li = table(spark, folder, "lineitem")
    return _shown(profile.numeric_profile(li, ["l_extendedprice", "l_quantity", "l_tax"], direct_rows=0))


def _category_sql(columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{shown}' AS "column", count({c}) AS "count", count(DISTINCT coalesce({c}, 'nan')) AS "unique",
                   round(count(DISTINCT coalesce({c}, 'nan')) / nullif(count({c}), 0), 8) + 0.0 AS freq FROM {source}"""
        for c, shown in columns.items()
    )


@query(
    "categorical_profile",
    f"WITH t AS ({_GAPS}) " + _category_sql({"priority": "priority"}, "t") + " UNION ALL "
    + _category_sql({"event_type": "event_type", "props": "props"}, "events"),
)
def categorical_profile(spark, folder):
    a = profile.categorical_profile(gaps(spark, folder))
    b = profile.categorical_profile(table(spark, folder, "events").select("event_type", "props"))
    return a.unionByName(b).withColumn("freq", rounded("freq", 8))


_FREQ = f"""WITH t AS ({_GAPS}), f AS (SELECT 'priority' AS "column", coalesce(priority, 'nan') AS value, count(*) AS n FROM t GROUP BY 1, 2),
            r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rank FROM f)"""


@query(
    "top_values",
    _FREQ
    + """, s AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1, 2),
           rs AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rank FROM s),
           k AS (SELECT unnest([1, 2, 3, 4]) AS rank)
       SELECT 'priority' AS "column", CAST(k.rank AS INTEGER) AS rank, coalesce(r.value, '-') AS value, r.n
       FROM k LEFT JOIN r ON k.rank = r.rank
       UNION ALL SELECT 'o_orderstatus', CAST(k.rank AS INTEGER), coalesce(rs.value, '-'), rs.n
       FROM k LEFT JOIN rs ON k.rank = rs.rank""",
)
def top_values(spark, folder):
    a = profile.top_values(gaps(spark, folder), 4, "priority")
    return a.unionByName(profile.top_values(table(spark, folder, "orders"), 4, "o_orderstatus"))


@query(
    "value_frequencies",
    """SELECT 'lang' AS "column", lang AS value, count(*) AS n FROM documents GROUP BY 2
       UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2
       UNION ALL SELECT 'text', text, count(*) FROM documents GROUP BY 2""",
)
def value_frequencies(spark, folder):
    return profile.value_frequencies(table(spark, folder, "documents"), ["lang", "source", "text"])


def _moments(column: str) -> str:
    return f"SELECT '{column}' AS column, count({column}) AS count, round(avg({column}), 4) + 0.0 AS mean, round(stddev_pop({column}), 4) + 0.0 AS std_dev, min({column})::DOUBLE AS min, max({column})::DOUBLE AS max FROM orders"


@query("merged_sketches", _moments("o_totalprice") + " UNION ALL " + _moments("o_custkey"))
def merged_sketches_query(spark, folder):
    """The exact part of a profile that is merged from the sketches of each order status."""
    lines = column_sketches(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"], by="o_orderstatus")
    profile = profile_of_sketches(merged_sketches(lines))
    return profile.select("column", "count", rounded("mean", 4).alias("mean"), rounded("std_dev", 4).alias("std_dev"), "min", "max")

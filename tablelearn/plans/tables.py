"""Sources, types and edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import typing
from ..operators import edit
from ..operators.position import positional
from ..operators.stored import StoredTable
from ..sources import declare_schema, load_delimited
from .registry import natural_pos, query, scratch, table


@query(
    "load_delimited",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
              c_acctbal, c_mktsegment FROM customer""",
)
def load_delimited_text(spark, folder):
    path = scratch(spark, "customer-text")
    table(spark, folder, "customer").write.option("sep", "|").option("header", True).csv(path)
    df = load_delimited(spark, path, header=True, sep="|")
    return typing.cast_columns(df, {"c_custkey": "bigint", "c_nationkey": "bigint", "c_acctbal": "double"})


@query(
    "load_delimited_headerless",
    """SELECT CAST(s_suppkey AS BIGINT) AS "0", s_name AS "1", CAST(s_nationkey AS BIGINT) AS "2", s_acctbal AS "3"
       FROM supplier""",
)
def load_delimited_headerless(spark, folder):
    path = scratch(spark, "supplier-text")
    table(spark, folder, "supplier").write.option("sep", ";").option("header", False).csv(path)
    df = load_delimited(spark, path, header=False, sep=";")
    return typing.cast_columns(df, {"0": "bigint", "2": "bigint", "3": "double"})


@query(
    "declare_schema",
    """SELECT CAST(p_partkey AS BIGINT) AS key, p_name AS name, p_brand AS brand, p_type AS kind,
              CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part""",
)
def declared(spark, folder):
    text = table(spark, folder, "part").select([F.col(f"p_{c}").cast("string") for c in
                                                ("partkey", "name", "brand", "type", "size", "retailprice")])
    return declare_schema(
        text, ["key", "name", "brand", "kind", "size", "price"], ["bigint", None, None, None, "double", None]
    )


@query(
    "normalise_missing",
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 7 < 2 THEN NULL ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders""",
)
def normalised(spark, folder):
    o = table(spark, folder, "orders")
    dirty = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, "").when(F.col("o_orderkey") % 7 == 1, "nan")
        .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 5 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return typing.normalise_missing(dirty)


def _integer_type(c: str) -> str:
    return f"""CASE WHEN min({c}) >= 0 AND max({c}) <= 255 THEN 'smallint'
                    WHEN min({c}) >= 0 AND max({c}) <= 65535 THEN 'int'
                    WHEN min({c}) >= 0 AND max({c}) <= 4294967295 THEN 'bigint'
                    WHEN min({c}) >= 0 THEN 'decimal(20,0)'
                    WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint'
                    WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
                    WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END"""


@query(
    "infer_types",
    f"""WITH t AS (SELECT *, p_size - 20 AS signed, p_partkey * 70000 AS large FROM part)
        SELECT 'p_partkey' AS name, {_integer_type('p_partkey')} AS type FROM t
        UNION ALL SELECT 'p_size', {_integer_type('p_size')} FROM t
        UNION ALL SELECT 'signed', {_integer_type('signed')} FROM t
        UNION ALL SELECT 'large', {_integer_type('large')} FROM t
        UNION ALL SELECT 'p_retailprice',
            CASE WHEN bool_and(p_retailprice % 1 = 0) THEN {_integer_type('p_retailprice')} ELSE 'double' END FROM t
        UNION ALL SELECT 'p_name', 'string' UNION ALL SELECT 'p_brand', 'string' UNION ALL SELECT 'p_type', 'string'""",
)
def inferred(spark, folder):
    p = table(spark, folder, "part").withColumns(
        {"signed": F.col("p_size") - 20, "large": F.col("p_partkey") * 70000}
    )
    text = p.select([F.col(c).cast("string") for c in p.columns])
    found = typing.infer_types(text)
    # the types are facts about the whole table, held by its schema; show them per column
    shown = typing.cast_columns(text, found)
    return edit.info(shown).select("name", F.col("dtype").alias("type"))


@query(
    "infer_and_cast",
    """SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_brand, CAST(p_size AS DOUBLE) AS p_size, p_retailprice
       FROM part""",
)
def inferred_and_cast(spark, folder):
    p = table(spark, folder, "part")
    text = p.select([F.col(c).cast("string") for c in ("p_partkey", "p_brand", "p_size", "p_retailprice")])
    return typing.to_common_numeric(typing.infer_and_cast(text), ["p_partkey", "p_size"])


@query(
    "cast_columns",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
              CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_tax FROM lineitem""",
)
def cast_some(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_tax")
    return typing.cast_columns(li, {"l_quantity": "int", "l_linenumber": "string"})


@query(
    "common_numeric",
    """SELECT CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_returnflag
       FROM lineitem""",
)
def common_numeric(spark, folder):
    li = table(spark, folder, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag")
    return typing.to_common_numeric(li, ["l_partkey", "l_linenumber"])


# -- edits -----------------------------------------------------------------------------------------


@query("select_columns", "SELECT o_totalprice, o_orderkey, o_orderpriority FROM orders")
def select_columns(spark, folder):
    return edit.select_columns(table(spark, folder, "orders"), [3, "o_orderkey", -1])


@query(
    "select_rows_slice",
    f"""WITH t AS (SELECT *, {natural_pos('event_id')} AS p, count(*) OVER () AS n FROM events)
        SELECT event_id, event_type, CAST((p - n // 4) // 3 AS BIGINT) AS pos FROM t
        WHERE p >= n // 4 AND (p - n // 4) % 3 = 0""",
)
def select_rows_slice(spark, folder):
    e = table(spark, folder, "events")
    return edit.select_rows(e, slice(e.count() // 4, None, 3), ["event_id", "event_type"], "event_id")


@query(
    "select_rows_list",
    f"""WITH t AS (SELECT *, {natural_pos('o_orderkey')} AS p, count(*) OVER () AS n FROM orders),
             w AS (SELECT CAST(i AS BIGINT) AS pos, CASE WHEN v < 0 THEN v + (SELECT count(*) FROM orders) ELSE v END AS p
                   FROM (VALUES (0, 11), (1, 3), (2, 3), (3, -1), (4, 120)) x(i, v))
        SELECT o_orderkey, o_totalprice, w.pos FROM t JOIN w USING (p)""",
)
def select_rows_list(spark, folder):
    o = table(spark, folder, "orders")
    return edit.select_rows(o, [11, 3, 3, -1, 120], ["o_orderkey", "o_totalprice"], "o_orderkey")


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, folder):
    return edit.drop_columns(table(spark, folder, "customer"), ["c_name", 4])[0]


@query("drop_columns_taken", "SELECT c_name, c_mktsegment FROM customer")
def drop_columns_taken(spark, folder):
    return edit.drop_columns(table(spark, folder, "customer"), ["c_name", 4])[1]


_DROPPED = f"""WITH t AS (SELECT o_orderkey, o_custkey, CAST({natural_pos('o_orderkey')} AS BIGINT) AS pos FROM orders)
               SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY pos) - 1 AS pos FROM t WHERE """


@query("drop_rows_list", _DROPPED + "pos NOT IN (0, 5, 77)")
def drop_rows_list(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return edit.drop_rows(o, [77, 0, 5, 5], row_key="o_orderkey")[0]


@query("drop_rows_slice", _DROPPED + "NOT (pos >= 10 AND pos % 2 = 0)")
def drop_rows_slice(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return edit.drop_rows(o, slice(10, None, 2), row_key="o_orderkey")[0]


@query("drop_rows_taken", _DROPPED + "pos >= 10 AND pos % 2 = 0")
def drop_rows_taken(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return edit.drop_rows(o, slice(10, None, 2), row_key="o_orderkey")[1]


# After a removal, positions are dense again: what follows reads them as those of the rows that stayed.
_LEFT = f"""WITH t AS (SELECT o_orderkey, o_custkey, {natural_pos('o_orderkey')} AS old FROM orders),
                  k AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY old) - 1 AS pos FROM t
                        WHERE old NOT IN (0, 1, 2) AND old % 5 <> 4),
                  n AS (SELECT count(*) AS n FROM k) """


def _left(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    kept = edit.drop_rows(o, slice(4, None, 5), row_key="o_orderkey")[0]
    return edit.drop_rows(kept, [0, 1, 2])[0]


@query("drop_then_select", _LEFT + "SELECT o_orderkey, CAST(CASE WHEN pos = 0 THEN 0 WHEN pos = n - 1 THEN 1 ELSE 2 END AS BIGINT) AS pos FROM k, n WHERE pos IN (0, 7, n - 1)")
def drop_then_select(spark, folder):
    return edit.select_rows(_left(spark, folder), [0, -1, 7], ["o_orderkey"])


@query("drop_then_join", _LEFT + "SELECT o_orderkey, o_custkey AS other, pos FROM k")
def drop_then_join(spark, folder):
    kept = _left(spark, folder)
    return edit.join_columns(kept.drop("o_custkey"), kept.select(F.col("o_custkey").alias("other"), "pos"), None, None)


@query(
    "drop_then_batch",
    _LEFT + "SELECT o_orderkey, pos, pos // 32 AS batch_id, CAST(pos % 32 AS INTEGER) AS batch_pos FROM k, n WHERE pos // 32 < n // 32",
)
def drop_then_batch(spark, folder):
    from ..operators.layout import batch

    return batch(_left(spark, folder).drop("o_custkey"), 32, drop_remainder=True)


@query("drop_then_set_cells", _LEFT + "SELECT o_orderkey, CASE WHEN pos IN (0, n - 1) THEN -1 ELSE o_custkey END AS o_custkey, pos FROM k, n")
def drop_then_set_cells(spark, folder):
    return edit.set_cells(_left(spark, folder), [0, -1], ["o_custkey"], -1)


@query(
    "add_columns",
    """SELECT s_suppkey, round(s_acctbal * 2, 4) AS "0", s_name, CAST(s_nationkey + 1 AS BIGINT) AS next_nation,
              s_nationkey, s_acctbal FROM supplier""",
)
def add_columns(spark, folder):
    s = table(spark, folder, "supplier")
    return edit.add_columns(
        s, [F.round(F.col("s_acctbal") * 2, 4), F.col("s_nationkey") + 1], [None, "next_nation"], [None, "bigint"], [1, 2]
    )


@query(
    "add_rows_block",
    f"""WITH t AS (SELECT c_custkey AS k, c_acctbal AS v, {natural_pos('c_custkey')} AS p FROM customer),
             s AS (SELECT s_suppkey AS k, s_acctbal AS v, {natural_pos('s_suppkey')} AS p FROM supplier)
        SELECT k, v, CAST(CASE WHEN p >= 100 THEN p + (SELECT count(*) FROM s) ELSE p END AS BIGINT) AS pos FROM t
        UNION ALL SELECT k, v, CAST(p + 100 AS BIGINT) FROM s""",
)
def add_rows_block(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    return edit.add_rows(c, s, "k", "k", at=100)


@query(
    "add_rows_scattered",
    f"""WITH t AS (SELECT c_custkey AS k, c_acctbal AS v, {natural_pos('c_custkey')} AS place, 1 AS old, 0 AS seq FROM customer),
             s AS (SELECT s_suppkey AS k, s_acctbal AS v, s_suppkey % 50 AS place, 0 AS old,
                          {natural_pos('s_suppkey')} AS seq FROM supplier),
             u AS (SELECT * FROM t UNION ALL SELECT * FROM s)
        SELECT k, v, CAST(row_number() OVER (ORDER BY place, old, seq) - 1 AS BIGINT) AS pos FROM u""",
)
def add_rows_scattered(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    s = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"), (F.col("s_suppkey") % 50).alias("place")
    )
    return edit.add_rows(c, s, "k", "k", at="place")


@query(
    "join_columns",
    f"""WITH a AS (SELECT o_orderkey, o_totalprice, {natural_pos('o_orderkey')} AS p FROM orders),
             b AS (SELECT o_orderkey AS other_key, o_custkey AS other_cust, {natural_pos('o_orderdate, o_orderkey')} AS p FROM orders)
        SELECT o_orderkey, other_key, other_cust, o_totalprice, CAST(p AS BIGINT) AS pos FROM a JOIN b USING (p)""",
)
def join_columns(spark, folder):
    o = table(spark, folder, "orders")
    left = o.select("o_orderkey", "o_totalprice")
    ordered = positional(o, ["o_orderdate", "o_orderkey"])
    right = ordered.select(F.col("o_orderkey").alias("other_key"), F.col("o_custkey").alias("other_cust"), "pos")
    return edit.join_columns(left, right, "o_orderkey", None, at=1)


@query(
    "append_rows",
    """SELECT c_custkey AS key, c_acctbal AS balance FROM customer
       UNION ALL SELECT CAST(s_suppkey AS BIGINT), CAST(s_nationkey AS DOUBLE) FROM supplier""",
)
def append_rows(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    return edit.append_rows(c, table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"))


@query(
    "set_columns",
    """SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 2 AS INTEGER) AS doubled, round(l_tax + l_discount, 4) AS l_tax,
              l_discount FROM lineitem""",
)
def set_columns(spark, folder):
    li = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("doubled"), "l_tax", "l_discount"
    )
    return edit.set_columns(
        li, {"doubled": F.col("l_linenumber") * 2.0, "l_tax": F.round(F.col("l_tax") + F.col("l_discount"), 4)}
    )


@query(
    "set_cells_slice",
    f"""WITH t AS (SELECT event_id, event_type, value, CAST({natural_pos('event_id')} AS BIGINT) AS pos FROM events)
        SELECT event_id, CASE WHEN pos % 4 = 0 THEN 'edited' ELSE event_type END AS event_type,
               CASE WHEN pos % 4 = 0 THEN -1.0 ELSE value END AS value, pos FROM t""",
)
def set_cells_slice(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type", "value")
    return edit.set_cells(e, slice(None, None, 4), ["event_type", "value"], ["edited", -1], "event_id")


@query(
    "set_cells_table",
    f"""WITH t AS (SELECT event_id, value, CAST({natural_pos('event_id')} AS BIGINT) AS pos FROM events)
        SELECT event_id, CASE WHEN pos % 3 = 1 THEN (CASE WHEN pos % 2 = 0 THEN NULL ELSE CAST(pos AS DOUBLE) END)
               ELSE value END AS value, pos FROM t""",
)
def set_cells_table(spark, folder):
    e = positional(table(spark, folder, "events").select("event_id", "value"), "event_id")
    new = e.filter(F.col("pos") % 3 == 1).select(
        "pos", F.when(F.col("pos") % 2 != 0, F.col("pos").cast("double")).alias("value")
    )
    return edit.set_cells(e, None, "value", new)


@query("split_by_kind_categorical", "SELECT o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def split_categorical(spark, folder):
    return edit.split_by_kind(table(spark, folder, "orders"))[0]


@query("split_by_kind_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def split_numeric(spark, folder):
    return edit.split_by_kind(table(spark, folder, "orders"))[1]


@query("head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head(spark, folder):
    return edit.head(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 5, "o_orderkey")


@query(
    "info",
    """WITH t AS (SELECT count(*) AS n, count(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END) AS m FROM orders)
       SELECT CAST(0 AS INTEGER) AS idx, 'o_orderkey' AS name, 'bigint' AS dtype, n AS rows, n AS non_missing FROM t
       UNION ALL SELECT 1, 'price', 'double', n, m FROM t
       UNION ALL SELECT 2, 'o_orderpriority', 'string', n, n FROM t""",
)
def info(spark, folder):
    o = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
        "o_orderpriority",
    )
    return edit.info(o)


_STORED = f"""WITH a AS (SELECT o_orderkey, o_totalprice, {natural_pos('o_orderkey')} AS p, count(*) OVER () AS n FROM orders),
    b AS (SELECT o_orderkey, o_totalprice, p - 10 AS p FROM a WHERE p BETWEEN 10 AND n - 11),
    c AS (SELECT o_orderkey, o_totalprice, p - 100 AS p FROM b WHERE p >= 100),
    d AS (SELECT o_orderkey, o_totalprice, p - CASE WHEN p > 7 THEN 2 WHEN p > 5 THEN 1 ELSE 0 END AS p FROM c WHERE p NOT IN (5, 7)),
    e AS (SELECT o_orderkey, o_totalprice, CASE WHEN p >= 50 THEN p + 3 ELSE p END AS p FROM d
          UNION ALL SELECT o_orderkey, o_totalprice, 50 + p FROM a WHERE p < 3)
    SELECT o_orderkey, CASE WHEN p BETWEEN 20 AND 51 THEN 0.0 ELSE o_totalprice END AS o_totalprice, p // 2 AS pos FROM e WHERE p % 2 = 0"""


@query("stored_edits", _STORED)
def stored_edits(spark, folder):
    """Six edits of a table stored by position: its keys are read once, and its rows once."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    first = edit.head(o, 3, "o_orderkey")
    kept = StoredTable.write(o, "o_orderkey").select(slice(10, -10)).drop(slice(0, 100)).drop([5, 7]).insert(first, 50, "o_orderkey")
    return kept.set(slice(20, 52), "o_totalprice", 0.0).select(slice(None, None, 2)).rows()

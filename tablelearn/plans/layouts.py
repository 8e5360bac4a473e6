"""Training layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout
from ..operators.position import file_position_key, positional
from .registry import natural_pos, query, shuffled_pos, table

_O = "o_orderkey"


@query(
    "assign_roles",
    """SELECT 'input' AS role, unnest(['o_orderkey', 'o_orderstatus', 'o_orderdate', 'o_orderpriority']) AS name,
              (SELECT count(*) FROM orders) AS rows
       UNION ALL SELECT 'target', unnest(['o_custkey', 'o_totalprice']), (SELECT count(*) FROM orders)""",
)
def assign_roles(spark, folder):
    o = table(spark, folder, "orders")
    inputs, targets = layout.assign_roles(o, [1, "o_totalprice"])
    named = [F.struct(F.lit(r).alias("role"), F.lit(c).alias("name")) for r, cs in (("input", inputs), ("target", targets)) for c in cs]
    return o.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*named)), "rows")


@query("data_block", "SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem")
def data_block(spark, folder):
    li = table(spark, folder, "lineitem").select("l_quantity", "l_linenumber", "l_partkey")
    return layout.data_block(li, -1)


@query("target_block", "SELECT CAST(l_partkey AS DOUBLE) AS l_partkey FROM lineitem")
def target_block(spark, folder):
    li = table(spark, folder, "lineitem").select("l_quantity", "l_linenumber", "l_partkey")
    return layout.target_block(li, -1)


@query(
    "positional_natural",
    f"SELECT o_orderkey, CAST({natural_pos('o_orderdate, o_orderkey')} AS BIGINT) AS pos FROM orders",
)
def positional_natural(spark, folder):
    return positional(table(spark, folder, "orders"), ["o_orderdate", _O]).select(_O, "pos")


@query(
    "positional_by_file",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(row_number() OVER () - 1 AS BIGINT) AS pos FROM lineitem""",
)
def positional_by_file(spark, folder):
    """A table without a key, in the order of its file."""
    li = file_position_key(table(spark, folder, "lineitem"))
    return positional(li, ["file_path", "row_index"]).select("l_orderkey", "l_partkey", "l_linenumber", "pos")


_BATCH = f"""WITH t AS (SELECT event_id, CAST({natural_pos('event_id')} AS BIGINT) AS pos, count(*) OVER () AS n FROM events)
             SELECT event_id, pos, pos // 32 AS batch_id, CAST(pos % 32 AS INTEGER) AS batch_pos FROM t"""


@query("batch", _BATCH)
def batch(spark, folder):
    return layout.batch(table(spark, folder, "events").select("event_id"), 32, row_key="event_id")


@query("batch_drop_remainder", _BATCH.replace("32", "97") + " WHERE pos // 97 < n // 97")
def batch_drop_remainder(spark, folder):
    return layout.batch(table(spark, folder, "events").select("event_id"), 97, True, "event_id")


@query("repeat", "SELECT c_custkey, CAST(e AS INTEGER) AS epoch FROM customer, unnest([0, 1, 2]) u(e)")
def repeat(spark, folder):
    return layout.repeat(table(spark, folder, "customer").select("c_custkey"), 3)


@query(
    "box_shuffle",
    f"""WITH t AS (SELECT event_id, {natural_pos('event_id')} AS p FROM events), b AS (SELECT *, p // 1000 AS box FROM t)
        SELECT event_id, CAST(box * 1000 + row_number() OVER (PARTITION BY box ORDER BY md5('42:' || event_id), event_id) - 1 AS BIGINT) AS pos
        FROM b""",
)
def box_shuffle(spark, folder):
    return layout.box_shuffle(table(spark, folder, "events").select("event_id"), "event_id", 1000, 42)


@query("full_shuffle", f"SELECT o_orderkey, CAST({shuffled_pos(_O)} AS BIGINT) AS pos FROM orders")
def full_shuffle(spark, folder):
    return layout.full_shuffle(table(spark, folder, "orders").select(_O), _O, 42)


@query(
    "epoch_plan",
    f"""WITH t AS (SELECT o_orderkey, {natural_pos(_O)} AS p, count(*) OVER () AS n FROM orders),
             r AS (SELECT t.*, e AS epoch, p // 700 AS box FROM t, unnest([0, 1, 2]) u(e)),
             s AS (SELECT o_orderkey, epoch, n, box * 700 + row_number() OVER (PARTITION BY epoch, box
                          ORDER BY md5('7:' || epoch || ':' || o_orderkey), o_orderkey) - 1 AS p FROM r)
        SELECT o_orderkey, CAST(epoch AS INTEGER) AS epoch, CAST(p AS BIGINT) AS pos, CAST(p // 64 AS BIGINT) AS batch_id,
               CAST(p % 64 AS INTEGER) AS batch_pos FROM s WHERE p // 64 < n // 64""",
)
def epoch_plan(spark, folder):
    return layout.epoch_plan(table(spark, folder, "orders").select(_O), _O, 3, 64, 700, 7, True)


_SPLIT = f"WITH t AS (SELECT o_orderkey, o_totalprice, {shuffled_pos(_O)} AS p, count(*) OVER () AS n FROM orders) "


@query("train_test_split_train", _SPLIT + "SELECT o_orderkey, o_totalprice FROM t WHERE p < floor(0.8 * n)")
def split_train(spark, folder):
    return layout.train_test_split(table(spark, folder, "orders").select(_O, "o_totalprice"), _O)[0]


@query("train_test_split_test", _SPLIT + "SELECT o_orderkey, o_totalprice FROM t WHERE p >= floor(0.8 * n)")
def split_test(spark, folder):
    return layout.train_test_split(table(spark, folder, "orders").select(_O, "o_totalprice"), _O)[1]


@query(
    "train_test_split_ordered",
    f"WITH t AS (SELECT o_orderkey, {natural_pos(_O)} AS p, count(*) OVER () AS n FROM orders) "
    "SELECT o_orderkey FROM t WHERE p < floor(0.35 * n)",
)
def split_ordered(spark, folder):
    return layout.train_test_split(table(spark, folder, "orders").select(_O), _O, 0.35, shuffle=False)[0]


@query("cross_val_folds", _SPLIT + "SELECT o_orderkey, CAST(p // (n // 7) AS INTEGER) AS fold_id FROM t")
def folds(spark, folder):
    return layout.cross_val_folds(table(spark, folder, "orders").select(_O), _O, 7)


@query(
    "cross_val_folds_dropped",
    _SPLIT + "SELECT o_orderkey, CAST(p // (n // 7) AS INTEGER) AS fold_id FROM t WHERE p // (n // 7) < n // (n // 7)",
)
def folds_dropped(spark, folder):
    return layout.cross_val_folds(table(spark, folder, "orders").select(_O), _O, 7, drop_remainder=True)


@query("cross_val_folds_balanced", _SPLIT + "SELECT o_orderkey, CAST(p * 7 // n AS INTEGER) AS fold_id FROM t")
def folds_balanced(spark, folder):
    return layout.cross_val_folds(table(spark, folder, "orders").select(_O), _O, 7, balanced=True)

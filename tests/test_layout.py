"""Positions, splits, folds, batches and shuffles."""

import hashlib

import pytest
from table_rows import rows
from pyspark.sql import functions as F

from tablelearn.operators import layout, position


def shuffled(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n", [1, 10, 11, 900, 901, 1500])
def test_positions_are_dense_and_ordered(spark, n):
    df = spark.range(n).withColumn("k", 2 * F.col("id") + 5)
    got = {r["k"]: r["pos"] for r in position.positional(df, "k").collect()}
    assert got == {2 * i + 5: i for i in range(n)}
    got = {r["id"]: r["pos"] for r in position.positional(df, "id", 42).collect()}
    assert got == {k: i for i, k in enumerate(shuffled(range(n)))}


@pytest.fixture
def small_buckets(monkeypatch):
    """Few rows per bucket, so that small tables take the ways of large ones."""
    monkeypatch.setattr(position, "ROWS_PER_BUCKET", 20)


def test_many_buckets(spark, small_buckets):
    df = spark.range(5000).select((F.col("id") * F.col("id")).alias("k"), F.lit("x").alias("s"))
    keys = [i * i for i in range(5000)]
    assert {r["k"]: r["pos"] for r in position.positional(df, ["s", "k"]).collect()} == {k: i for i, k in enumerate(keys)}
    assert {r["k"]: r["pos"] for r in position.positional(df, "k", 7).collect()} == {k: i for i, k in enumerate(shuffled(keys, 7))}
    boxed = layout.box_shuffle(df.select("k"), "k", 1000, 3).collect()
    want = {}
    for b in range(5):
        part = keys[b * 1000 : (b + 1) * 1000]
        want.update({k: b * 1000 + i for i, k in enumerate(shuffled(part, 3))})
    assert {r["k"]: r["pos"] for r in boxed} == want


@pytest.mark.parametrize("key", ["text", "day", "at", "number"])
def test_keys_of_any_type(spark, small_buckets, key):
    df = spark.range(700).select(
        F.col("id"),
        F.format_string("%05d", "id").alias("text"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.timestamp_micros(F.col("id") * 3).alias("at"),
        (F.col("id") / 7).cast("decimal(12,3)").alias("number"),
    )
    assert all(r["pos"] == r["id"] for r in position.positional(df, key).collect())
    train, test = layout.train_test_split(df, key, 0.3, shuffle=False)
    assert [r["id"] for r in train.orderBy("id").collect()] == list(range(210)) and test.count() == 490


def test_positions_do_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    one = rows(position.positional(df.repartition(1), "id", 5))
    many = rows(position.positional(df.repartition(13, F.rand(1)), "id", 5))
    assert one == many


def test_repeated_keys_are_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError):
        position.require_unique(df, "k")
    position.require_unique(df.distinct(), "k")
    with pytest.raises(ValueError):
        position.positional(df, None)


@pytest.mark.parametrize("n", [10, 11, 1500])
def test_split_is_exact_and_whole(spark, n):
    df = spark.range(n)
    train, test = layout.train_test_split(df, "id", 0.8)
    order = shuffled(range(n))
    cut = int(0.8 * n)
    assert {r[0] for r in train.collect()} == set(order[:cut]) and {r[0] for r in test.collect()} == set(order[cut:])


def test_folds_may_outnumber_the_wanted_ones(spark):
    df = spark.range(11)
    order = shuffled(range(11))
    got = {r["id"]: r["fold_id"] for r in layout.cross_val_folds(df, "id", 4).collect()}
    assert got == {k: i // 2 for i, k in enumerate(order)}
    full = layout.cross_val_folds(df, "id", 4, drop_remainder=True)
    assert full.groupBy("fold_id").count().count() == 5 and full.count() == 10
    sizes = [r[1] for r in layout.cross_val_folds(df, "id", 4, balanced=True).groupBy("fold_id").count().collect()]
    assert sorted(sizes) == [2, 3, 3, 3]
    with pytest.raises(ValueError):
        layout.cross_val_folds(df, "id", 11)


def test_more_folds_than_thresholds(spark):
    df = spark.range(1000)
    got = {r["id"]: r["fold_id"] for r in layout.cross_val_folds(df, "id", 250).collect()}
    assert got == {k: i // 4 for i, k in enumerate(shuffled(range(1000)))}
    even = {r["id"]: r["fold_id"] for r in layout.cross_val_folds(df, "id", 300, balanced=True).collect()}
    assert even == {k: i * 300 // 1000 for i, k in enumerate(shuffled(range(1000)))}


def test_split_plan_shuffles_no_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    train, _ = layout.train_test_split(df, "o_orderkey")
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_batches(spark):
    df = spark.range(10)
    kept = layout.batch(df, 4, row_key="id").groupBy("batch_id").count()
    assert rows(kept) == [(0, 4), (1, 4), (2, 2)]
    assert rows(layout.batch(df, 4, True, "id").groupBy("batch_id").count()) == [(0, 4), (1, 4)]
    assert layout.steps_per_epoch(10, 4) == 3 and layout.steps_per_epoch(10, 4, True) == 2
    for bad in (0, 2.5, True):
        with pytest.raises(ValueError):
            layout.batch(df, bad, row_key="id")


def test_every_epoch_is_a_permutation(spark):
    df = spark.range(901)
    plan = layout.epoch_plan(df, "id", epochs=3, batch_size=1000, box=2000, seed=1)
    orders = []
    for e in range(3):
        got = plan.filter(F.col("epoch") == e).orderBy("pos").collect()
        assert [r["pos"] for r in got] == list(range(901)) and {r["batch_id"] for r in got} == {0}
        orders.append([r["id"] for r in got])
        assert sorted(orders[-1]) == list(range(901))
    assert orders[0] != orders[1] != orders[2]


def test_roles_and_blocks(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert layout.assign_roles(df, -1) == (["a", "b"], ["c"])
    assert layout.data_block(df).columns == ["a", "b", "c"] and layout.target_block(df).columns == []
    assert dict(layout.target_block(df, ["a"]).dtypes) == {"a": "double"}

"""Sources, types, edits, repair and profiles on hand-worked tables."""

import math

import numpy as np
import pytest
from table_rows import rows
from pyspark.sql import functions as F

from tablelearn.functions import typing
from tablelearn.operators import edit, missing, profile
from tablelearn.operators.quantile import exact_quantiles
from tablelearn.sources import declare_schema, load_delimited


@pytest.fixture
def typed(spark, tmp_path):
    (tmp_path / "typed.csv").write_text(
        " u8,u16,u32,u64,i8,i16,i32,i64,f,s,e,n,z\n"
        "0,0,0,0,-128,-32768,-2147483648,-9223372036854775808,1.5,\"a\",,nan,\n"
        "255,65535,4294967295,18446744073709551615,127,32767,2147483647,9223372036854775807,2,b,7,3.0, \n"
    )
    return load_delimited(spark, str(tmp_path / "typed.csv"))


def test_types_at_their_limits(typed):
    assert dict(typed.dtypes) == {
        "u8": "smallint", "u16": "int", "u32": "bigint", "u64": "decimal(20,0)", "i8": "tinyint", "i16": "smallint",
        "i32": "int", "i64": "bigint", "f": "double", "s": "string", "e": "smallint", "n": "smallint", "z": "string",
    }
    low, high = sorted(typed.collect(), key=lambda r: r["u8"])
    assert low["i64"] == -(2**63) and high["i64"] == 2**63 - 1 and high["u64"] == 2**64 - 1
    assert low["s"] == '"a"' and low["e"] is None and low["n"] is None and high["n"] == 3 and high["z"] is None


def test_narrow_floats_and_oversized_numbers(spark):
    df = spark.createDataFrame([("1.5", "1e40", "9" * 30, "9" * 50)], "a string, b string, c string, d string")
    assert typing.infer_types(df, narrow_floats=True) == {"a": "float", "b": "string", "c": "decimal(38,0)", "d": "string"}


def test_load_without_header_names_columns_by_position(spark, tmp_path):
    (tmp_path / "x.txt").write_text("  1; 2;x \n3;4;y\n")
    df = load_delimited(spark, str(tmp_path / "x.txt"), header=False, sep=";")
    assert df.columns == ["0", "1", "2"] and rows(df) == [(1, 2, "x"), (3, 4, "y")]


def test_ragged_line_fails(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception):
        load_delimited(spark, str(tmp_path / "x.txt")).collect()


def test_declare_schema_checks(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert dict(declare_schema(df, ["k", "v"], [None, "string"]).dtypes) == {"k": "smallint", "v": "string"}
    assert dict(declare_schema(df, dtypes="string").dtypes) == {"0": "string", "1": "string"}
    for bad in (dict(columns=["k"]), dict(dtypes=["int"]), dict(columns=["k", "k"])):
        with pytest.raises(ValueError):
            declare_schema(df, **bad)
    with pytest.raises(ValueError):
        declare_schema(df.limit(0))


def test_selection_by_index_list_and_slice(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 10)

    def picked(which, **kw):
        got = edit.select_rows(df, which, row_key="id", **kw).orderBy("pos").collect()
        assert [r["pos"] for r in got] == list(range(len(got)))
        return [r["id"] for r in got]

    values = list(range(10))
    assert picked(3) == [3] and picked(-1) == [9] and picked([4, 1, 1, -2]) == [4, 1, 1, 8]
    for s in (slice(2, 7), slice(None, None, 3), slice(None, None, -2), slice(-3, None), slice(7, 2, -1), slice(5, 5)):
        assert picked(s) == values[s]
    with pytest.raises(IndexError):
        edit.select_rows(df, [10], row_key="id")
    assert edit.select_rows(df, 2, "v", "id").first()["v"] == 20


def test_drop_rows_keeps_and_returns(spark):
    df = spark.range(6)
    kept, taken = edit.drop_rows(df, [0, -1], row_key="id")
    assert rows(kept, "id") == [(1,), (2,), (3,), (4,)] and rows(taken, "id") == [(0,), (5,)]
    kept, taken = edit.drop_rows(df, slice(1, 3), delete=False, row_key="id")
    assert kept.count() == 6 and rows(taken, "id") == [(1,), (2,)]


def test_add_columns_orders_names_and_types(spark):
    df = spark.createDataFrame([(1, "7")], "a int, `0` string")
    out = edit.add_columns(df, [F.lit("5"), F.lit(2.5), F.lit(3)], [None, "x", None], [None, None, "string"], [0, 2, 0])
    assert out.columns == ["1", "2", "a", "0", "x"]
    assert dict(out.dtypes)["1"] == "smallint" and dict(out.dtypes)["2"] == "string"
    assert edit.add_columns(df, F.lit(1), "z").columns == ["a", "0", "z"]
    with pytest.raises(ValueError):
        edit.add_columns(df, F.lit(1), "a")


def test_add_rows_like_a_list_insert(spark):
    df = spark.range(5).withColumn("v", F.col("id").cast("string"))
    new = spark.createDataFrame([(100, 0), (101, 3), (102, 3), (103, -1)], "id bigint, place int").select(
        "id", F.col("id").alias("v"), "place"
    )
    got = [r["id"] for r in edit.add_rows(df, new, "id", "id", at="place").orderBy("pos").collect()]
    assert got == [100, 0, 1, 2, 101, 102, 3, 103, 4]
    block = edit.add_rows(df, new.drop("place"), "id", "id", at=2).orderBy("pos").collect()
    assert [r["id"] for r in block] == [0, 1, 100, 101, 102, 103, 2, 3, 4]
    assert [r["pos"] for r in block] == list(range(9))
    end = edit.add_rows(df, new.drop("place"), "id", "id").orderBy("pos").collect()
    assert [r["id"] for r in end][-1] == 103
    with pytest.raises(Exception):
        edit.add_rows(df, new.select(F.lit("tree").alias("id"), "v"), "id", "v").collect()


def test_join_columns_needs_equal_lengths(spark):
    a, b = spark.range(4), spark.range(10, 14).withColumnRenamed("id", "other")
    assert rows(edit.join_columns(a, b, "id", "other", at=0), "other", "id") == [(10, 0), (11, 1), (12, 2), (13, 3)]
    with pytest.raises(ValueError):
        edit.join_columns(a, b.limit(3), "id", "other")


def test_append_set_and_cells(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    b = spark.createDataFrame([("3", 4)], "p string, q int")
    assert rows(edit.append_rows(a, b)) == [(1, "x"), (2, "y"), (3, "4")]
    with pytest.raises(Exception):
        edit.append_rows(a, spark.createDataFrame([("tree", 4)], "p string, q int")).collect()
    assert edit.set_columns(a, {0: F.col("k") * 1.9}).schema["k"].dataType.simpleString() == "int"
    assert edit.set_columns(a, {"k": F.lit("z")}, retype=True).schema["k"].dataType.simpleString() == "string"
    assert rows(edit.set_cells(a, -1, ["s"], "new", row_key="k"), "k", "s") == [(1, "x"), (2, "new")]


def test_column_keys_are_checked(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert edit.select_columns(df, [-1, "a"]).columns == ["c", "a"]
    for bad, error in ((5, IndexError), ("q", KeyError), (1.5, TypeError)):
        with pytest.raises(error):
            edit.select_columns(df, bad)


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, None, "b"), (3, math.nan, None), (4, 4.0, "a"), (5, 100.0, None)], "id int, x double, k string"
    )


def test_fill(gaps):
    assert [r["x"] for r in missing.fill_missing(gaps, "x", "mean")[0].orderBy("id").collect()] == [1, 35, 35, 4, 100]
    assert [r["x"] for r in missing.fill_missing(gaps, "x", "median")[0].orderBy("id").collect()] == [1, 4, 4, 4, 100]
    assert [r["k"] for r in missing.fill_missing(gaps, "k", "z")[0].orderBy("id").collect()] == ["a", "b", "z", "a", "z"]
    kept, dropped = missing.fill_missing(gaps, ["x", "k"], "remove")
    assert rows(kept, "id") == [(1,), (4,)] and rows(dropped, "id") == [(2,), (3,), (5,)]
    filled = missing.fill_missing(gaps.select("id"), "id", 2.0)[0]
    assert filled.schema["id"].dataType.simpleString() == "int"


def test_profiles_count_missing_as_a_value(gaps):
    (num,) = profile.numeric_profile(gaps, "x").collect()
    assert (num["count"], num["mean"], num["min"], num["25%"], num["50%"], num["75%"], num["max"]) == (3, 35, 1, 2.5, 4, 52, 100)
    assert num["std_dev"] == pytest.approx(math.sqrt((34**2 + 31**2 + 65**2) / 3))
    (cat,) = profile.categorical_profile(gaps).collect()
    assert (cat["count"], cat["unique"], cat["freq"]) == (3, 3, 1.0)
    top = profile.top_values(gaps, 5).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in top] == [("a", 2), ("nan", 2), ("b", 1), ("-", None), ("-", None)]


@pytest.mark.parametrize("direct", [0, 10**6])
def test_quantiles_survive_odd_columns(spark, direct):
    n = 40_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("hot"),
        F.pow(F.lit(1.01), F.col("id") / 10).alias("steep"),
        F.lit(5).alias("same"),
        F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") == 0, float("-inf")).when(F.col("id") == 1, float("inf")).otherwise(F.col("id").cast("double")).alias("open"),
    )
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = exact_quantiles(df, df.columns, probs, direct)
    want = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in df.columns]).first()
    assert got["none"] == [None] * 5 and got["same"] == [5.0] * 5
    for c in ("hot", "steep", "open"):
        assert got[c] == pytest.approx(list(want[c]))


def test_quantiles_take_few_scans_whatever_the_distribution(spark, monkeypatch):
    from tablelearn.operators import quantile

    random = np.random.default_rng(0)
    n = 5000
    data = {
        "uniform": random.random(n),
        "wide": 10.0 ** random.uniform(-260, 260, n),
        "half_one_value": np.where(random.random(n) < 0.5, 3.0, random.random(n) * 10),
        "one_value": np.full(n, 7.0),
        "endless": np.where(random.random(n) < 0.4, np.inf, random.standard_normal(n)),
        "last_before_a_block": np.r_[np.arange(n // 2), np.full(n - n // 2, 1e9)].astype(float),
        "gaps": np.where(random.random(n) < 0.3, np.nan, random.random(n)),
    }
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), ", ".join(f"{c} double" for c in data))
    probs, rounds, one_round = [0, 0.001, 0.25, 0.5, 0.75, 1.0], [], quantile._one_round
    monkeypatch.setattr(quantile, "_one_round", lambda *a: rounds.append(1) or one_round(*a))
    for accuracy, fetch, most in ((50_000, 10_000, 1), (200, 30, 4), (50, 5, 10)):
        monkeypatch.setattr(quantile, "ACCURACY", accuracy)
        monkeypatch.setattr(quantile, "FETCH_ROWS", fetch)
        rounds.clear()
        got = exact_quantiles(df, df.columns, probs, 10)
        assert len(rounds) <= most
        for c, v in data.items():
            v = np.sort(v[~np.isnan(v)])
            at = [p * (len(v) - 1) for p in probs]
            low, high = [v[math.floor(a)] for a in at], [v[math.ceil(a)] for a in at]
            want = [x if x == y else x * (1 - a % 1) + y * (a % 1) for x, y, a in zip(low, high, at)]
            assert np.allclose(got[c], want, rtol=1e-12)


def test_removed_rows_leave_dense_positions(spark):
    df = spark.range(10)
    kept, taken = edit.drop_rows(df, [0, 1, 2], row_key="id")
    assert edit.select_rows(kept, 0).first()["id"] == 3 and edit.select_rows(kept, -1).first()["id"] == 9
    assert sorted(map(tuple, taken.collect())) == [(0, 0), (1, 1), (2, 2)]
    again = edit.drop_rows(kept, slice(6, 0, -2))[0]
    assert sorted(map(tuple, again.collect())) == [(3, 0), (4, 1), (6, 2), (8, 3)]
    joined = edit.join_columns(kept, kept.withColumnRenamed("id", "other"), None, None)
    assert joined.count() == 7 and joined.where("id = other").count() == 7
    with pytest.raises(ValueError, match="dense"):
        edit.select_rows(kept.where("pos <> 2"), 0)


def test_one_row_shuffles_only_its_bucket(spark):
    plan = edit.select_rows(spark.range(1000).withColumn("v", F.lit("x")), 5, row_key="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.rindex("Filter"), plan


def test_column_slices(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert edit.select_columns(df, slice(1, 3)).columns == ["b", "c"]
    assert [x.columns for x in edit.drop_columns(df, slice(None, None, 2))] == [["b", "d"], ["a", "c"]]


def test_numbers_are_read_strictly(spark):
    df = spark.createDataFrame([("1d", "0x1p3", "3.0", "1e2", " 7 "), ("2f", "8", "4", "12", "-.5")], "a string, b string, c string, d string, e string")
    assert typing.infer_types(df) == {"a": "string", "b": "string", "c": "smallint", "d": "smallint", "e": "double"}
    assert typing.cast_columns(df, {"c": "int", "d": "bigint"}).select("c", "d").collect()[0] == (3, 100)
    for column, kind in (("e", "int"), ("a", "double"), ("a", "int"), ("b", "decimal(10,2)")):
        with pytest.raises(Exception, match="not a"):
            typing.cast_columns(df, {column: kind}).collect()


@pytest.mark.parametrize("infer", [True, False])
def test_ragged_and_doubled_headers_fail(spark, tmp_path, infer):
    (tmp_path / "ragged.csv").write_text("a,b,c\n1,2,3\n4,5\n")
    with pytest.raises(Exception):
        load_delimited(spark, str(tmp_path / "ragged.csv"), infer=infer).select("a").collect()
    (tmp_path / "twice.csv").write_text("a,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="duplicate"):
        load_delimited(spark, str(tmp_path / "twice.csv"), infer=infer)


def test_profiles_of_tables_without_such_columns(spark):
    assert profile.numeric_profile(spark.createDataFrame([("a",)], "s string")).collect() == []
    assert profile.categorical_profile(spark.range(3)).collect() == [] and profile.top_values(spark.range(3)).collect() == []


def test_inserts_as_a_list_and_sorted_in_give_the_same(spark, monkeypatch):
    df, new = spark.range(50), spark.createDataFrame([(100 + i, (i * 7) % 51) for i in range(20)], "id bigint, place bigint")
    listed = sorted(map(tuple, edit.add_rows(df, new, "id", "id", at="place").select("pos", "id").collect()))
    monkeypatch.setattr(edit, "LISTED_INSERTS", 0)
    assert listed == sorted(map(tuple, edit.add_rows(df, new, "id", "id", at="place").select("pos", "id").collect()))
    assert [p for p, _ in listed] == list(range(70))

"""Tables stored by position, against Python lists."""

import random

import pytest
from pyspark.sql import functions as F

from tablelearn.operators import stored
from tablelearn.operators.stored import StoredTable


def listed(table):
    out = sorted(table.rows().collect(), key=lambda r: r.pos)
    assert [r.pos for r in out] == list(range(table.n))
    return [(r.k, r.v) for r in out]


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(i * 3, f"v{i}") for i in range(200)], "k long, v string").repartition(5)


def test_a_chain_of_edits_is_that_of_a_list(spark, source):
    want = [(i * 3, f"v{i}") for i in range(200)]
    t = StoredTable.write(source, "k")
    assert listed(t) == want
    t, want = t.select(slice(10, -10)), want[10:-10]
    t, want = t.drop([5, -1, 7, 5]), [r for i, r in enumerate(want) if i not in (5, 7, 179)]
    t, want = t.drop(slice(100, 120)), want[:100] + want[120:]
    new = spark.createDataFrame([(2, "new 2"), (1, "new 1")], "a int, b string")
    t, want = t.insert(new, 50, "a"), want[:50] + [(1, "new 1"), (2, "new 2")] + want[50:]
    t, want = t.set(slice(48, 53), ["v"], "set"), [(k, "set") if 48 <= i < 53 else (k, v) for i, (k, v) in enumerate(want)]
    t, want = t.set([0, 50], [0, 1], [7, None]), [(7, None) if i in (0, 50) else r for i, r in enumerate(want)]
    t, want = t.select(slice(None, None, -3)), want[::-3]
    t, want = t.select([3, 3, 0, -1]), [want[3], want[3], want[0], want[-1]]
    assert listed(t) == want and listed(t.drop(slice(None))) == []


def test_edits_take_no_job_and_the_keys_are_read_once(spark, source):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("edits", "edits")
    t = StoredTable.write(source, "k")
    before = len(tracker.getJobIdsForGroup("edits"))
    for i in range(10):
        t = t.drop(slice(i, 2 * i)).set(slice(3, 9), "v", f"{i}").select(slice(1, None))
    assert len(tracker.getJobIdsForGroup("edits")) == before
    plan = t.rows()._jdf.queryExecution().executedPlan().toString()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("Scan parquet") <= 2 and "Exchange" not in plan and "GreaterThanOrEqual(pos" in plan


@pytest.mark.parametrize("most", [10_000, 6])
def test_random_edits(spark, source, monkeypatch, most):
    monkeypatch.setattr(stored, "MAX_PIECES", most)
    rng = random.Random(most)
    want = [(i * 3, f"v{i}") for i in range(200)]
    t = StoredTable.write(source, "k")
    for step in range(8):
        n = len(want)
        a, b, s = rng.randrange(n), rng.randrange(n), rng.choice([1, 1, 2, -1, 3])
        kind = rng.choice(["select", "drop", "set", "drop list"])
        rows = slice(min(a, b) // 2, n - max(a, b) // 8) if s > 0 else slice(None, None, s)
        rows = slice(rows.start, rows.stop, s)
        hit = set(range(n)[rows])
        if kind == "select":
            t, want = t.select(rows), want[rows]
        elif kind == "drop" and len(hit) < n - 5:
            t, want = t.drop(rows), [r for i, r in enumerate(want) if i not in hit]
        elif kind == "set":
            t, want = t.set(rows, "v", f"set {step}"), [(k, f"set {step}") if i in hit else (k, v) for i, (k, v) in enumerate(want)]
        else:
            t, want = t.drop([0, n // 2]), [r for i, r in enumerate(want) if i not in (0, n // 2)]
        if len(want) < 10:
            break
    assert listed(t) == want


def test_what_is_out_of_range_is_an_error(spark, source):
    t = StoredTable.write(source.filter("k < 9"), "k")
    with pytest.raises(IndexError):
        t.select(3)
    with pytest.raises(IndexError):
        t.insert(source, 5, "k")
    with pytest.raises(ValueError, match="columns"):
        t.insert(source.select("k"), 0, "k")
    empty = StoredTable.write(source.limit(0), "k")
    assert empty.n == 0 and listed(empty.select(slice(None))) == [] and listed(empty.insert(source.filter("k < 6"), -1, "k")) == [(0, "v0"), (3, "v1")]
    assert listed(empty.drop(slice(None)).insert(source.limit(0), 0, "k")) == []
    assert t.rows().select(F.sum("pos")).first()[0] == 3

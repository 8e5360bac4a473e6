import duckdb
import numpy as np
import pytest
from llm_data import SF

from tablelearn.llm import neighbours
from tablelearn.llm.queries import QUERIES


def brute(rows, queries, k=5):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in queries:
        for a in np.flatnonzero(ids == q):
            s = x @ x[a]
            out[q] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != q][:k]
    return out


def check(got, want, least):
    hit = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == {q for q, v in want.items() if v}
    for q, near in want.items():
        mine = sorted(by.get(q, []))
        assert [n for n, *_ in mine] == list(range(1, len(near) + 1)) and all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
        hit, total = hit + len({v for _, v, _ in mine} & {v for v, _ in near}), total + len(near)
        true = dict(near)
        assert all(abs(s - true[v]) < 1e-9 for _, v, s in mine if v in true)
    assert hit >= least * total


def test_query_recall(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    check(QUERIES["op9_nearest_neighbours"](spark, SF).collect(), brute(rows, [i for i, _ in rows if i % 50 == 0]), 0.95)


def test_odd_rows_and_a_vector_that_many_share(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(6).round(3).tolist()) for i in range(150)]
    good += [(200 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]) for i in range(100)] + [(500, [2.0, 4.0, 6.0, 0.0, 0.0, 2.0]), good[3]]
    bad = [(900, None), (950, []), (951, [0.0] * 6), (952, [None] * 6), (953, [float("nan")] * 6), (954, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in good + bad], "vec_id long, embedding array<float>, node int, rank int")
    queries = [0, 50, 200, 250, 299, 500, 900, 950, 951]
    got = neighbours.nearest(table, table.where(table.vec_id.isin(queries))).collect()
    check(got, brute([(i, np.float32(v)) for i, v in good], [q for q in queries if q < 900]), 1.0)


def test_small_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert neighbours.nearest(one, one).collect() == []
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(three, three).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (1, 1, 0, 1.0), (1, 2, 2, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0)]
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest(none, none).collect() == []


def test_perturbed_copies_keep_their_order(spark):
    """A third of the rows are copies of one vector with noise of 0.0005: closer together than bytes can tell."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    x = np.concatenate([rng.standard_normal((800, 32)), centre + 0.0005 * rng.standard_normal((400, 32))]).astype(np.float32)
    order = rng.permutation(len(x))
    rows = [(i, x[j].tolist()) for i, j in enumerate(order)]
    copies = [i for i, j in enumerate(order) if j >= 800][::10]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(neighbours.nearest(table, table.where(table.vec_id.isin(copies))).collect(), brute(rows, copies), 0.95)


@pytest.mark.parametrize("size", [1e200, 1e-170, 5e-324, 1.0])
def test_scores_of_very_large_and_very_small_components(spark, size):
    data = [(0, [size, 0.0]), (1, [size, size]), (2, [0.0, size]), (3, [-size, 0.0])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    rows = neighbours.nearest(vectors, vectors.where("vec_id = 0")).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 1), (2, 2), (3, 3)]
    assert sorted((r.score for r in rows), reverse=True) == pytest.approx([0.5**0.5, 0.0, -1.0], abs=1e-15)

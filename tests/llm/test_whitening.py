from fractions import Fraction
from math import floor, isfinite

import duckdb
import numpy as np
import pytest
from llm_data import SF

from tablelearn.llm import whitening
from tablelearn.llm.queries import QUERIES


def brute_force(data, k=16):
    """Per (vec_id, x): n, exact deviation, and the covariance and centred rows in doubles."""
    rows = [(i, tuple(floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in data if v is not None and all(c is not None and isfinite(c) for c in v)]
    distinct = sorted({x for _, x in rows})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(d)]
    centred = np.array([[float(Fraction(x[j]) - Fraction(sums[j], n)) for j in range(d)] for x in distinct])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = [j for j in range(d) if values[j] > 1e-10 * values.sum()][:k]
    out = {}
    for i, x in rows:
        y = np.array([float(Fraction(x[j]) - Fraction(sums[j], n)) for j in range(d)])
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
        out.setdefault(i, []).append((n, deviation, [(y @ axes[:, j] / np.sqrt(values[j]), values[j] / values.sum()) for j in kept]))
    return out


def check(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    assert got.keys() == want.keys()
    signs = {}
    for i, cases in want.items():
        n, deviation, parts = cases[0]
        assert len(got[i]) == len(cases) * len(parts)
        for r in got[i]:
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            value, share = parts[r.component - 1]
            assert r.explained == pytest.approx(share, rel=1e-6)
            if abs(value) > 1e-4:
                sign = signs.setdefault(r.component, np.sign(value * r.whitened))
                assert r.whitened * sign == pytest.approx(value, rel=1e-5, abs=1e-6)


def test_query_against_exact_arithmetic(spark):
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    check(rows, brute_force(data))
    assert [t for _, t in QUERIES["op13_embedding_whitening"](spark, SF).dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def fitted(spark, data, kind="array<float>"):
    vectors = spark.createDataFrame([(i, v, 1, b"w") for i, v in data], f"vec_id long, embedding {kind}, n long, whitened binary").repartition(3)
    return whitening.whiten(vectors, whitening.fit(vectors)).collect()


def test_odd_vectors_take_no_part_and_copies_count_once(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    data += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, [])] + [(105, [1.0, 2.0])]
    data += [(200 + i % 7, data[3][1]) for i in range(60)] + [(None, data[5][1]), (None, data[5][1])]
    want = brute_force([(i, v) for i, v in data if i is None or i < 100 or i >= 200])
    check(fitted(spark, data, "array<double>"), want)


def test_nothing_to_fit(spark):
    for data in ([], [(1, None)], [(1, []), (2, [])], [(1, [3.0, 4.0]), (2, [3.0, 4.0])]):
        assert fitted(spark, data) == []


def test_fewer_components_than_entries(spark):
    rng = np.random.default_rng(6)
    plane = rng.integers(-50, 50, size=(30, 2)) @ np.array([[1, 2, 0, -1], [0, 1, 1, 1]])
    rows = fitted(spark, list(enumerate((plane / 1.0).tolist())))
    assert {r.component for r in rows} == {1, 2} and max(r.identity_error for r in rows) < 1e-12


def test_large_entries_are_exact(spark):
    data = [(i, [float(2**40 + 3 * i), float(i * i) * 2.0**30, -float(i)]) for i in range(12)]
    check(fitted(spark, data, "array<double>"), brute_force(data))
    with pytest.raises(Exception, match="too large for the grid"):
        fitted(spark, [(1, [1e30]), (2, [2.0])])


@pytest.mark.parametrize("gap", [1e-3, 1e-7, 1e-10])
def test_clustered_eigenvalues_are_told_apart(gap):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ ((np.eye(24) - q.T @ q) / 2)
    values = 1 + np.arange(24).astype(np.longdouble)[::-1] / 7
    values[4:9] = values[4] - np.arange(5) * np.longdouble(gap)
    found, axes = whitening.eigenvectors(q @ np.diag(values) @ q.T)
    assert np.abs(found - values).max() < 1e-16
    assert np.abs(axes.T @ axes - np.eye(24)).max() < 1e-17
    assert np.abs(np.abs((q * axes).sum(axis=0)) - 1).max() < 1e-15  # the float32 solver alone is off by 1e-8 / gap


def test_products_and_quotients_are_exact():
    rng = np.random.default_rng(2)
    for top in (10, 2**20, 2**27, 2**45):
        y = rng.integers(-top, top, size=(500, 3))
        assert (whitening.exact_product(y) == y.astype(object).T @ y.astype(object)).all()
    for a, b in ((1, 3), (-(10**50), 7), (2**70 + 1, 2**70), (0, 5)):
        assert abs(Fraction(*float(whitening._quotient(a, b)).as_integer_ratio()) - Fraction(a, b)) <= abs(Fraction(a, b)) * Fraction(1, 2**52)

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import merkle

FIELDS = ["doc_id", "source", "text"]
SCHEMA = "doc_id long, source string, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """The root, and for each leaf its runs as (left, right)."""
    nodes, at, proofs = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // 3 * 3
            proofs[i].append(("".join(nodes[run:a]), "".join(nodes[a + 1 : run + 3])))
            at[i] = a // 3
        nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def expected(data):
    """Rows (key, leaf, position, subroot, root, proof) by the plain definition."""
    groups = {}
    for r in data:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(r)
    trees = []
    for name in sorted(groups):
        rows = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((rows, *tree([leaf(r) for r in rows])))
    root, above = tree([t[1] for t in trees])
    return [(r[0], leaf(r), i, sub, root, p + above[g]) for g, (rows, sub, proofs) in enumerate(trees) for i, (r, p) in enumerate(zip(rows, proofs))]


def found(df):
    return [(r.doc_id, r.leaf, r.position, r.subroot, r.root, [tuple(x) for x in r.proof]) for r in df.collect()]


ODD = [(3, None, "x"), (3, None, "y"), (None, None, "z"), (None, "", None), (None, "", ""), (None, "", "a"), (5, "b", "same"), (5, "b", "same"), (5, "b", "same")]
ODD += [(-1, "b", "Ärger\n"), (-64, "b", ""), (2**62, "b", "y" * 50_000), (-(2**63), "b", None), (5, "é", "other"), (5, "z", "alone"), (4, "b", "same")]


@pytest.mark.parametrize("steps", [1, 2, 7])
def test_manifest_against_the_definition(spark, monkeypatch, steps):
    monkeypatch.setattr(merkle, "STEPS", steps)
    monkeypatch.setattr(merkle, "BLOCK", 3**steps)
    data = ODD + [(i * i % 97 - 40, f"s{i % 4 * (i % 3)}", f"text {i}") for i in range(150)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert sorted(found(merkle.manifest(docs, "doc_id", "source", FIELDS)), key=repr) == sorted(expected(data), key=repr)


@pytest.mark.parametrize("data", [[], [(None, None, None)], [(7, "a", "x")], [(1, "a", "x"), (2, "a", "y")]])
def test_manifest_of_few_rows(spark, data):
    assert sorted(found(merkle.manifest(spark.createDataFrame(data, SCHEMA), "doc_id", "source", FIELDS))) == sorted(expected(data) if data else [])


def test_many_rows_of_one_key_take_all_places_once(spark):
    docs = spark.range(3000).selectExpr("CAST(if(id % 3 = 0, NULL, id % 5) AS LONG) AS doc_id", "'a' AS source", "CAST(id % 700 AS STRING) AS text")
    rows = merkle.manifest(docs, "doc_id", "source", FIELDS).select("position", "doc_id", "leaf").collect()
    assert [r.position for r in sorted(rows)] == list(range(3000))
    assert sorted(rows) == sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.leaf, r.position))


def test_only_rows_that_were_changed_fail(spark):
    data = [(i, f"s{i % 3}", f"a\n{i}" if i % 4 else "whole") for i in range(60)]
    docs = spark.createDataFrame([(*r, 9, b"k") for r in data], SCHEMA + ", position long, claimed binary")
    changed = merkle.leaf_of([F.col("doc_id"), F.col("source"), F.replace("text", F.lit("\n"), F.lit(""))])
    rows = merkle.manifest(docs, "doc_id", "source", FIELDS, claimed=F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, changed))
    folded = rows.select("doc_id", (merkle.fold(F.coalesce("claimed", "leaf"), F.col("proof")) == F.col("root")).alias("ok"), merkle.proof_digest(F.col("proof")).alias("d"))
    proofs = {r[0]: digest(*(a + b for a, b in r[5])) for r in expected(data)}
    for r in folded.collect():
        assert r.ok == (crc32(str(r.doc_id).encode()) % 2 == 1 or r.doc_id % 4 == 0)
        assert r.d == proofs[r.doc_id]

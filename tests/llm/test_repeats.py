import hashlib
import random

import pytest
from llm_data import ODD, SF, docs_of

from tablelearn.llm import repeats
from tablelearn.llm.queries import QUERIES


def brute(data, n=50):
    """(key, bytes, removed marks) by each row's windows and the least key that has them."""
    order = lambda k: float("inf") if k is None else k
    texts = [(k, (t or "").encode()) for k, t in data]
    least = {}
    for k, t in texts:
        for i in range(len(t) - n + 1):
            least[t[i : i + n]] = min(order(k), least.get(t[i : i + n], float("inf")))
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if least[t[i : i + n]] < order(k):
                gone[i : i + n] = b"\1" * n
        spans = [i for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((k, len(t), sum(gone), len(spans), hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        [(r.doc_id, r.n_bytes, sum(s["end"] - s["first"] for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()], key=repr
    )


def test_query_against_brute_force(spark, documents):
    assert sorted(map(tuple, QUERIES["op6_suffix_array_dedup"](spark, SF).collect()), key=repr) == brute([(k, t) for k, t, _ in documents])


def passages(seed):
    """Documents of few letters, cut from each other, so that repeats nest, overlap and end everywhere."""
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abé ") for _ in range(600))
    out = []
    for k in range(60):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            a, n = rnd.randrange(600), rnd.choice([10, 49, 50, 51, 70, 200])
            parts += [base[a : a + n], rnd.choice(["", "x", "yy"])]
        out.append((rnd.randrange(80), "".join(parts)))
    return out + [(90 + i, "ab" * rnd.randint(20, 80)) for i in range(6)] + [(7, "one" * 40), (7, "one" * 40), (None, base), (None, base)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("cell", [500, 8 << 20])
def test_passages_against_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(repeats, "CELL_BYTES", cell)
    if cell == 500:
        monkeypatch.setattr(repeats, "STEP_BYTES", 64)
        monkeypatch.setattr(repeats, "_POWERS", [])
    data = passages(seed)
    docs = docs_of(spark, [(k, t, 1, "x") for k, t in data], "doc_id long, text string, cell int, kept string").repartition(3)
    assert found(repeats.remove_repeats(docs)) == brute(data)


def test_odd_rows_and_kept_columns(spark):
    docs = docs_of(spark, [(k, t, i, "x", "y") for i, (k, t) in enumerate(ODD)], "doc_id long, text string, n int, __key string, `0` string")
    assert found(repeats.remove_repeats(docs)) == brute(ODD)
    kept = repeats.remove_repeats(docs, keep=True)
    assert kept.columns == docs.columns
    rows = {r.n: r for r in kept.collect()}
    assert len(rows) == len(ODD) and all((r["__key"], r["0"], r.doc_id) == ("x", "y", ODD[n][0]) for n, r in rows.items())
    assert rows[0].text == ""


def test_whole_characters_are_kept(spark):
    shared = "é" * 30
    docs = docs_of(spark, [(1, "a" + shared), (2, "\u00e8" + shared[:-1] + "\u00ea"), (3, "b" + shared + "c")])
    texts = {r.doc_id: r.text for r in repeats.remove_repeats(docs, keep=True).collect()}
    assert texts[1] == "a" + shared and texts[3] == "bc" and texts[2].startswith("è") and texts[2].endswith("ê")


def test_empty_table(spark):
    assert repeats.remove_repeats(docs_of(spark, [])).collect() == []
    assert repeats.remove_repeats(docs_of(spark, []), keep=True).collect() == []


def test_intervals_and_maximal_repeats_against_all_pairs():
    rnd = random.Random(1)
    for _ in range(60):
        core = bytes(rnd.choice(b"ab") for _ in range(20))
        contexts = list({(bytes(rnd.choice(b"xy") for _ in range(rnd.randint(0, 30))), core + bytes(rnd.choice(b"pq") for _ in range(rnd.randint(0, 30)))) for _ in range(12)})
        contexts += [(contexts[0][0][:k] + b"z" * 3, contexts[0][1][: 20 + k]) for k in range(0, 30, 5)]
        contexts = list(dict.fromkeys(contexts))
        groups = list(repeats.maximal_repeats(contexts))
        for left, right, inside in groups:  # all have it, and no other does
            a = contexts[inside[0]]
            assert left + right >= 50
            assert set(inside) == {i for i, c in enumerate(contexts) if c[0][:left] == a[0][:left] and c[1][:right] == a[1][:right] and len(c[0]) >= left and len(c[1]) >= right}
        for i, a in enumerate(contexts):
            for j, b in enumerate(contexts[:i]):
                left, right = repeats.common(a[0], b[0]), repeats.common(a[1], b[1])
                if left + right >= 50:
                    assert any(x == left and y == right and i in m and j in m for x, y, m in groups)

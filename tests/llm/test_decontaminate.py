import hashlib
import random

import duckdb
import pytest
from llm_data import ODD, SF, docs_of

from tablelearn.llm import decontaminate
from tablelearn.llm.queries import QUERIES


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[tuple(w[i : i + n])] - {"None", None}
        out.append((key, len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w), tuple(sorted(hit))))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    out = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated, tuple(i for s in r.spans for i in range(s["first"], s["last"] + 1))) for r in rows]
    for r in rows:
        assert all(a["last"] < b["first"] - 1 for a, b in zip(r.spans, r.spans[1:]))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = [
        (k, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), c) for k, n, h, ids, c, _ in brute([(k, t) for k, t, _ in documents], items)
    ]
    got = QUERIES["op4_benchmark_decontamination"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(r.contaminated for r in got)


def tables():
    rnd = random.Random(5)
    word = lambda: rnd.choice("ab") * rnd.randint(1, 2)
    items = [(i, " ".join(word() for _ in range(rnd.randint(0, 40)))) for i in range(12)] + [(50, None), (51, "..."), (52, "One two"), (53, "x"), (None, "a b")]
    docs = [(i, ", ".join(word().upper() if rnd.random() < 0.3 else word() for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    for i in range(20):  # passages inside other words
        docs.append((100 + i, "zz " * rnd.randint(0, 300) + (items[i % 12][1] or "") + " zz" * rnd.randint(0, 30)))
    return docs + ODD + [(3, "one  TWO-three")], items


@pytest.mark.parametrize("block", [None, 300])
def test_small_alphabet_in_one_block_and_in_many(spark, monkeypatch, block):
    docs, items = tables()
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    df = docs_of(spark, [(k, t, 0, "x") for k, t in docs], "doc_id long, text string, n_words long, items string")
    got = found(decontaminate.find_passages(df, docs_of(spark, [(*i, 1) for i in items], "item_id long, text string, doc_id long")))
    assert got == brute(docs, items)


def test_an_item_without_id_counts_for_hits(spark):
    words = " ".join(f"w{i}" for i in range(20))
    out = decontaminate.find_passages(docs_of(spark, [(1, words)]), docs_of(spark, [(None, words)], "item_id long, text string")).first()
    assert (out.n_hit, out["items"], out.contaminated) == (20, [], True)


def test_empty_tables(spark):
    no_items = docs_of(spark, [], "item_id long, text string")
    assert decontaminate.find_passages(docs_of(spark, []), docs_of(spark, [(1, "a b")], "item_id long, text string")).collect() == []
    rows = decontaminate.find_passages(docs_of(spark, [(1, "a b"), (2, None)]), no_items).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows) == [(1, 2, 0, False), (2, 0, 0, False)]


def test_a_passage_does_not_cross_documents(spark):
    docs = docs_of(spark, [(1, "alpha beta"), (2, "gamma delta")])
    out = decontaminate.find_passages(docs, docs_of(spark, [(1, "beta gamma")], "item_id long, text string"))
    assert all(r.n_hit == 0 for r in out.collect())

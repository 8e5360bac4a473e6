from zlib import crc32

import numpy as np
import pytest
from llm_data import ODD, SF, docs_of

from tablelearn.llm import language
from tablelearn.llm.queries import QUERIES


def brute_scores(net, text):
    """The network on each window, filter by filter."""
    total, weight = 0, 0
    for i in range(0, max(1, len(text)), language.WINDOW):
        part = text[i : i + language.WINDOW]
        x = net.embed[np.frombuffer(part.ljust(language.WINDOW, b"\0"), np.uint8)]
        pooled = []
        for w, f, o in zip(language.WIDTHS, net.filters, net.offsets):
            out = np.stack([x[t : t + w].reshape(-1) @ f for t in range(len(x) - w + 1)])
            pooled.append(np.maximum(out.max(axis=0) + o, 0))
        z = np.concatenate(pooled) @ net.dense + net.dense_offset
        p = np.exp(z - z.max())
        n = max(1, len(part))
        total, weight = total + n * p / p.sum(), weight + n
    return total / weight


def test_query_learns_only_from_the_others_and_is_right_on_held_out_rows(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()}
    assert all(r.held_out == (crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    import duckdb

    truth = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [k for k, r in rows.items() if r.held_out]
    assert sum(rows[k].lang_pred == truth[k] for k in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_training_never_sees_held_out_or_unlabelled_rows(spark):
    rows = [(i, ("kept " if crc32(str(i).encode()) % 4 == 2 else "free ") * 20, "x" if i % 5 else None) for i in range(200)]
    seen = language.training_windows(docs_of(spark, rows, "doc_id long, text string, lang string"))
    assert seen and all(lang == "x" and "kept" not in t for lang, t in seen)


def test_a_text_that_comes_again_hides_no_language(spark):
    rows = [(i, "der gleiche Text in Deutsch", "de") for i in range(4000)] + [(5000 + i, f"some other text, number {i}", "en") for i in range(1500)]
    seen = language.training_windows(docs_of(spark, rows, "doc_id long, text string, lang string"))
    assert sum(lang == "de" for lang, _ in seen) == 1 and 400 <= sum(lang == "en" for lang, _ in seen) <= 2 * language.SAMPLE_DOCS


def test_dirty_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="over 3 values"):
        language.training_windows(docs_of(spark, [(i, "a text", f"label {i}") for i in range(40)], "doc_id long, text string, lang string"))


def test_scores_against_brute_force(spark, documents):
    net = language.fit_network([(lang, t[:256]) for _, t, lang in documents[:60]])
    scorer = language.Scorer(net)
    texts = [t.encode() for _, t, _ in documents[60:75]] + [b"", b"a", b"\0" * 300, "é".encode() * 200]
    assert np.allclose(scorer.texts(texts), [brute_scores(net, t) for t in texts], atol=1e-4)


def test_odd_rows(spark, documents):
    net = language.fit_network([(lang, t[:256]) for _, t, lang in documents[:60]])
    docs = docs_of(spark, [(k, t, "x", 3) for k, t in ODD], "doc_id long, text string, lang_pred string, __text int")
    out = language.identify(docs, net).collect()
    assert len(out) == len(ODD)
    letters = {t: any(c.isalpha() for c in t or "") for _, t in ODD}
    kept = language.identify(docs, net, keep=True)
    assert kept.columns == ["doc_id", "text", "__text", "lang_pred", "score"]
    for r in kept.collect():
        assert (r.lang_pred != "und") == letters[r.text] and r["__text"] == 3
    assert language.identify(docs_of(spark, []), net).collect() == []


def test_no_labelled_rows(spark):
    docs = docs_of(spark, [(1, "some text", None), (3, None, "x")], "doc_id long, text string, lang string")
    net = language.fit_network(language.training_windows(docs))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, net).collect()} == {("und", 0.0)}

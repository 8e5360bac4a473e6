import zlib

import corpus_pipeline
import duckdb
import public_tokenizers
from llm_data import SF, docs_of
from test_decontaminate import brute as contaminated
from test_repeats import brute as repeated
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, docs, folder=SF):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows := (df := stage(spark, docs, folder)).collect(), df.schema)
        out.append(rows)
    return out


def test_each_stage_against_brute_force_on_its_own_input(spark, documents):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    language, near, passages, clean, tokens = stages(spark, table)
    assert {r.doc_id for r in language} == {k for k, t, _ in documents if any(c.isalpha() for c in t)}
    ids = [(r.doc_id, brute_fingerprint(r.text)) for r in language]
    assert sorted(r.doc_id for r in near) == sorted({k for (k, _), root in zip(ids, brute_components(ids)) if k == root})
    assert {r.doc_id: (r.text, r.lang, r.source) for r in language}.items() >= {r.doc_id: (r.text, r.lang, r.source) for r in near}.items()
    marks = {k: (n, gone) for k, n, gone, *_ in repeated([(r.doc_id, r.text) for r in near])}
    for r in passages:
        n, gone = marks[r.doc_id]
        assert n - gone <= len(r.text.encode()) <= n - gone + 200 and (gone or len(r.text.encode()) == n) and r.n_chars == len(r.text)
    assert sorted(r.doc_id for r in passages) == sorted(marks)
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    bad = {k for k, *_, c, _ in contaminated([(r.doc_id, r.text) for r in passages], items) if c}
    assert {r.doc_id for r in clean} == {r.doc_id for r in passages} - bad
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r, c in zip(sorted(tokens, key=lambda r: r.doc_id), sorted(clean, key=lambda r: r.doc_id), strict=True):
        ids = library.encode(c.text, add_special_tokens=False).ids
        assert (r.doc_id, bytes(r.ids), r.text, r.n_tokens) == (c.doc_id, b"".join(i.to_bytes(4, "little") for i in ids), c.text, len(ids))


def test_odd_rows(spark, documents):
    text = documents[0][1]
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (1, "another text of the same number", None, None, None), (None, "no number here", "en", None, 1)]
    rows += [(2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, "12 34", None, "s", 5), (5, text + " end", "en", "s", 5), (None, text, "en", "s", 5)]
    docs = docs_of(spark, [(*r, "x", 1) for r in rows], SCHEMA + ", __doc string, __copy int")
    language, near, passages, clean, tokens = stages(spark, docs)
    assert len(language) == 6 and set(near[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}
    assert sorted((str(r.doc_id), r.text[:12]) for r in near) == sorted([("1", "another text"), ("None", "no number he"), ("None", text[:12])])
    assert len(passages) == 3 and len(tokens) == len(clean)


def test_documents_stay_where_no_language_can_be_learned(spark, documents):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 4 == 2)
    for lang_of_held in (None, "en"):
        rows = [(held, "held-out text", lang_of_held, "s", 1), (1000, "plain text", None, "s", 1), (1001, "12 34", None, "s", 1), (1002, None, None, "s", 0)]
        kept = corpus_pipeline.identify_language(spark, docs_of(spark, rows, SCHEMA), SF).collect()
        assert sorted(tuple(r) for r in kept) == sorted(rows[:2])


def test_empty_table(spark):
    assert all(rows == [] for rows in stages(spark, docs_of(spark, [], SCHEMA)))


def test_run_gives_what_the_stages_give(spark):
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.n_tokens) for r in stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1])

import hashlib
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm_data import ODD, SF, docs_of
from tokenizers import Tokenizer

from tablelearn.llm import bpe, token_store
from tablelearn.llm.common import Memo, scratch
from tablelearn.llm.queries import QUERIES

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
OURS, OURS_BY_WORD = bpe.Bpe(open(BYTES, encoding="utf-8").read()), token_store.Encoder(open(WORDS, encoding="utf-8").read())

texts = st.lists(
    st.sampled_from(["a", "B", " ", "  ", "\n", "\t", "é", "ñ", "ß", "İ", "Σ", "'s", "'ll", "12", "³", "<|endoftext|>", "<|startoftext|>", "—", "日", "́", "\x1c", "\x85", " ", "the", "ing", ".", "!!", "ﬁ", "Å", "՘", "𞤀"])
    | st.characters(exclude_categories=["Cs"])
).map("".join)


@given(texts)
@settings(max_examples=400, deadline=None)
def test_ids_are_the_library_s(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    packed = OURS.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert OURS.decode(packed) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert np.frombuffer(OURS_BY_WORD.encode([text])[0], "<u4").tolist() == WORD_LIBRARY.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_and_both_merge_loops(documents):
    m = OURS.merges
    assert 0 < sum(m.joined) < 1 << 16
    for _, text, _ in documents[:40]:
        for word in text.split():
            raw = word.encode()
            assert list(m.fragment(raw)) == m.long_fragment([m.single[b] for b in raw])


def test_a_memo_forgets_but_stays_right():
    made = []
    memo = Memo(lambda k: made.append(k) or k.encode(), limit=3, longest=4)
    for k in "a b c a d a e f g toolong toolong a".split():
        assert memo[k] == k.encode()
    assert made.count("toolong") == 2 and len(memo) <= 3


def test_bpe_query_against_the_library(spark, documents):
    want = []
    for k, t, _ in documents:
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.append((k, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op7_bpe"](spark, SF).collect())) == want


def test_bpe_odd_rows(spark):
    docs = docs_of(spark, [(k, t, b"x", 1) for k, t in ODD], "doc_id long, text string, ids binary, n_tokens long")
    tokens = bpe.encode(docs, BYTES)
    assert sorted([(r.doc_id, r.text) for r in bpe.decode(tokens, BYTES).collect()], key=repr) == sorted([(k, t or "") for k, t in ODD], key=repr)
    assert bpe.encode(docs_of(spark, []), BYTES).collect() == [] and bpe.decode(docs_of(spark, [], "doc_id long, ids binary"), BYTES).collect() == []
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), BYTES).first().text == ""


def stored(data):
    start, out = 0, []
    for k, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = WORD_LIBRARY.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((k, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_query_against_the_library(spark, documents):
    assert sorted(map(tuple, QUERIES["op3_token_id_output"](spark, SF).collect())) == stored([(k, t) for k, t, _ in documents])


@pytest.mark.parametrize("files", [1, 3])
def test_store_odd_rows(spark, files):
    path = scratch(spark, "odd")
    docs = docs_of(spark, [(k, t, [1], 5) for k, t in ODD], "doc_id long, text string, ids array<int>, start long")
    token_store.write_tokens(docs, path, WORDS, end_id=2, files=files)
    got = token_store.with_crc32(token_store.read_tokens(spark, path)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted(stored(ODD), key=repr)


def test_store_reads_some_keys_and_metadata_only(spark):
    path = scratch(spark, "some")
    docs = docs_of(spark, [(i, f"document {i} " * (i % 7)) for i in range(500)])
    token_store.write_tokens(docs, path, WORDS, end_id=2)
    whole = {r.doc_id: r for r in token_store.read_tokens(spark, path).collect()}
    some = token_store.read_tokens(spark, path, keys=[3, 400]).collect()
    assert {r.doc_id: (r.start, r.ids) for r in some} == {k: (whole[k].start, whole[k].ids) for k in (3, 400)}
    plan = token_store.read_tokens(spark, path, keys=[3], ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan and "In(doc_id" in plan or "EqualTo(doc_id" in plan


def test_store_layout(spark):
    import pyarrow.parquet as pq

    path = scratch(spark, "layout")
    token_store.write_tokens(docs_of(spark, [(i, "some words to store " * 20) for i in range(3000)]), path, WORDS, end_id=2, files=1)
    local = path.removeprefix("file:")
    import glob

    meta = pq.ParquetFile(max(glob.glob(f"{local}/*.parquet"), key=lambda f: pq.ParquetFile(f).metadata.num_rows)).metadata
    group = meta.row_group(0)
    by_name = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings and by_name["doc_id"].has_column_index
    ids = next(c for n, c in by_name.items() if n.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings


def test_store_of_an_empty_table(spark):
    path = scratch(spark, "empty")
    token_store.write_tokens(docs_of(spark, []), path, WORDS, end_id=2)
    assert token_store.read_tokens(spark, path).collect() == []


def test_store_of_more_files_than_their_padded_numbers(spark):
    """Task 100000 writes part-100000, which sorts before part-99999 as text."""
    import glob
    import os
    import shutil

    path, late = scratch(spark, "few"), scratch(spark, "late")
    docs = docs_of(spark, [(i, f"document {i} " * (i % 7)) for i in range(60)])
    token_store.write_tokens(docs, path, WORDS, end_id=2, files=2)
    os.makedirs(late.removeprefix("file:"))
    parts = sorted(f for f in glob.glob(f"{path.removeprefix('file:')}/part-*"))
    for number, part in zip(range(100_001 - len(parts), 100_001), parts):
        shutil.copy(part, f"{late.removeprefix('file:')}/part-{number:05d}{os.path.basename(part)[10:]}")
    assert len(parts) == 2
    assert sorted(token_store.read_tokens(spark, late).collect()) == sorted(token_store.read_tokens(spark, path).collect())

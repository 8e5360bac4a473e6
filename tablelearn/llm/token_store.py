"""Token ids in Parquet list columns, in key order, with controlled encodings, row groups and page indexes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import Memo, kept_by_worker, per_slice, require

#: A row per file is sent to the tasks up to here; beyond it the same join is left to the planner.
MAX_FILES = 100_000
#: Entries of a generation of each memo: some 230 bytes an entry, and two generations.
CHUNKS, PIECES = 450_000, 50_000
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 * 2**20, 64 * 2**10, 1000
#: Below U+0300 (but for one capital that lowers to two characters) and in general punctuation, NFC changes nothing and
#: lower-casing goes character by character, so such texts may be cut into words before they are normalised.
_PLAIN = re.compile(r"[\x00-\u012f\u0131-\u02ff\u2010-\u2027]*")
#: UTF-8 bytes of which all characters below U+0300 are made.
_LOW_BYTES = bytes(range(0xCC))
#: White space to Python, but not to the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def is_plain(text: str) -> bool:
    """Whether ``_PLAIN`` matches; most texts need no search character by character."""
    if text.isascii() or ("\u0130" not in text and not text.encode().translate(None, _LOW_BYTES)):
        return True
    return _PLAIN.fullmatch(text) is not None

#: Fixed value: how the vocabulary's pre-tokenizer splits a normalised text.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_words(spec: dict) -> bool:
    """Whether the vocabulary normalises and pre-tokenizes as ``Encoder.words`` does."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and cuts[0]["pattern"] == {"Regex": _WORD_SPLIT}
    )


class Encoder:
    """Encodes texts with the tokenizers library, words that come again from a bounded memo.

    A vocabulary for which ``splits_words`` holds encodes words independently, so the ids of a text are those of its words.
    Other vocabularies, and texts in which normalising might reach across words, are encoded whole.
    """

    def __init__(self, spec: str) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.by_word = splits_words(json.loads(spec))
        self.split = regex.compile(_WORD_SPLIT)
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.memo, self.pieces = Memo(self.chunk, CHUNKS), Memo(self.word, PIECES)

    def word(self, word: str) -> bytes:
        """A word's bytes, in the vocabulary's alphabet, straight to the library's model."""
        if not (word.isascii() and word.isprintable()):  # else each byte stands for itself
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(word)])

    def chunk(self, text: str) -> bytes:
        """A run without white space: its words. Most runs are letters, or letters and one mark, and need no search; what they
        have in common with other runs is looked up among these, so no word is kept twice."""
        lower = text.lower()
        if lower.isalpha():
            return self.word(lower) if lower == text else self.memo[lower]
        if lower[:-1].isalpha() and not lower[-1].isalnum():
            return self.memo[lower[:-1]] + self.pieces[lower[-1]]
        return b"".join(map(self.pieces.__getitem__, self.split.findall(lower)))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self.by_word and "<|" not in t and is_plain(t) and not any(c in t for c in _SEPARATORS) for t in texts]
        known = self.memo.__getitem__
        odd = [i for i, p in enumerate(plain) if not p]
        whole = self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)
        rest = {i: np.array(e.ids, "<u4").tobytes() for i, e in zip(odd, whole)}
        return [b"".join(map(known, t.split())) if p else rest[i] for i, (t, p) in enumerate(zip(texts, plain))]


def _list_of(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", files: int | None = None) -> None:
    """Writes the ids of every document to Parquet files at ``path``, in ascending order of ``key`` within and across files.

    Columns: ``key``, ``start_in_file`` (ids before the document in its file), ``n_tokens`` and ``ids`` (list of int, the end id
    included). Ids are dictionary-encoded and bit-packed; keys, starts and counts are delta-encoded. Row groups and pages are
    small and carry minima and maxima, so a reader of some keys opens few pages, and a reader of metadata no ids at all.

    Texts are shuffled once, by ranges of the key; each task sorts, encodes and writes its range as a stream. A range of
    equal keys is one task's stream, never held whole.

    Null or empty text: the end id alone. Null keys come first. Rows with equal keys go by text. Empty table: no rows. Other
    columns are not read.
    """
    require(docs, key, text)
    spec = docs.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = kept_by_worker(Encoder, spec.value), 0

        def one(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            nonlocal start
            ids = [x + end for x in encoder.encode([t.decode() for t in texts])]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            starts = start + np.cumsum(counts) - counts
            start += int(counts.sum())
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(starts), pa.array(counts), _list_of(ids)], ["__key", "start_in_file", "n_tokens", "ids"])

        yield from per_slice(batches, one)

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    ranged = rows.repartitionByRange(files, "__key") if files else rows.repartitionByRange("__key")
    kind = rows.schema["__key"].dataType.simpleString()
    encoded = ranged.sortWithinPartitions("__key", "__text").mapInArrow(work, f"__key {kind}, start_in_file long, n_tokens long, ids array<int>")
    (
        encoded.withColumnRenamed("__key", key)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option(f"parquet.enable.dictionary#{key}", "false")
        .option("parquet.enable.dictionary#start_in_file", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", keys: Sequence[int] | None = None, ids: bool = True) -> DataFrame:
    """The stored documents: ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and, if wanted, ``ids``.

    ``keys`` are pushed down to row groups and pages. Starts come from the files' totals, a row per file; these are sent to
    the tasks as long as there are at most ``MAX_FILES`` files, so that ids are not shuffled.
    """
    # tasks are numbered in key order; their numbers outgrow the five digits that names are padded to
    stored = spark.read.parquet(path).withColumn("__file", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"))
    totals = stored.groupBy("__file").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    if len(stored.inputFiles()) <= MAX_FILES:
        offsets = F.broadcast(offsets)
    if keys is not None:
        stored = stored.where(F.col(key).isin(list(keys)))
    columns = [key, (F.col("__before") + F.col("start_in_file")).alias("start"), "n_tokens", *(["ids"] if ids else [])]
    return stored.join(offsets, "__file").select(*columns)


def with_crc32(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored documents with the checksum of their ids as little-endian unsigned 32-bit integers, in place of the ids."""
    from zlib import crc32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy().tolist()
            values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [crc32(values[4 * i : 4 * j]) for i, j in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["__key", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema[key].dataType.simpleString()
    narrow = tokens.select(F.col(key).alias("__key"), "start", "n_tokens", "ids")
    return narrow.mapInArrow(work, f"__key {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("__key", key)

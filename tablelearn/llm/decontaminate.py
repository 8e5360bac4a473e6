"""Passages of benchmark items in documents: a prefix-filtered set join with exact verification.

A window is 13 consecutive words of an item (a shorter item is one window); a window is a set of shingles of five words. To
be contained in a document, a window needs all its shingles there, so one shingle is a sufficient prefix: the rarest in the
corpus, which gives the fewest candidates. A document's shingles are joined with the prefixes; a match fixes the window's
place (positional bound), which must lie inside the document (length bound); then the words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean_worker, per_slice, require, saved

WINDOW, SHINGLE = 13, 5
#: Documents are worked on in slices that stay in a core's cache.
SLICE_BYTES = 2**18
#: Windows go to the tasks in blocks of so many bytes at most; the documents are scanned once per block.
BLOCK_BYTES = 32 * 2**20
_WORD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_FOLD_BITS = 20

#: A-Z lower-cased; everything below 0x80 that is no letter or digit separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPANS_SCHEMA = "__key {key}, n_words long, spans array<struct<first:int,last:int>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of several documents in one buffer, each word followed by one space."""

    def __init__(self, texts: list[bytes]) -> None:
        split = [words_of(t) for t in texts]
        self.counts = np.array([len(x) for x in split], np.int64)
        self.buffer = b" ".join(b" ".join(x) for x in split if x) + b" " if self.counts.any() else b""
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        raw = np.frombuffer(self.buffer, np.uint8)
        self.ends = np.flatnonzero(raw == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from running sums over the bytes."""
        if not len(self.ends):
            return np.zeros(0, np.uint64)
        raw = np.frombuffer(self.buffer, np.uint8).astype(np.uint64) + np.uint64(1)
        odd = 0x5851F42D4C957F2D
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * _powers(odd, len(raw)))])
        back = _powers(pow(odd, -1, 2**64), len(raw))
        h = (sums[self.ends] - sums[self.starts]) * back[self.starts]
        h ^= h >> np.uint64(29)
        h *= _MIX
        return h ^ (h >> np.uint64(32))

    def shingles(self, n: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of ``n`` words that lies in one document, and its first word."""
        if len(words) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        last = len(words) - n + 1
        h = np.full(last, n, np.uint64)
        for i in range(n):
            h = (h ^ words[i : i + last]) * _WORD
            h ^= h >> np.uint64(31)
        at = np.flatnonzero(self.doc[:last] == self.doc[n - 1 :])
        return h[at], at


class Lookup:
    """Finds hashes in a sorted set; a table over some of their bits turns most others away."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << _FOLD_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _FOLD_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of those that are in the set, and their places in the set."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _FOLD_BITS)])
        where = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[where] == hashes[at]
        return at[same], where[same]


def _windows(items: list[tuple[str | None, str]]) -> dict[bytes, list[str]]:
    """The normalised windows of items (id, text), each with the ids of the items that have it; null is no id."""
    out: dict[bytes, set[str]] = {}
    for item, text in items:
        words = words_of((text or "").encode())
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            out.setdefault(b" ".join(words[i : i + WINDOW]), set()).update([] if item is None else [item])
    return {w: sorted(ids) for w, ids in out.items()}


def _window_shingles(window: bytes) -> np.ndarray:
    words = Words([window])
    return words.shingles(min(SHINGLE, len(words.ends)), words.hashes())[0]


def _item_rows(items: DataFrame, item: str, text: str) -> tuple[DataFrame, int]:
    """The items (item, text), and in how many blocks they go to the tasks."""
    cost = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") * (WINDOW + 4)  # each word lies in up to 13 windows
    rows = items.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(cost)).first()[0] or 0
    return rows, int(total // (BLOCK_BYTES // 2)) + 1


def _item_blocks(rows: DataFrame, blocks: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks whose windows take at most ``BLOCK_BYTES``; an item of many windows is cut, windows kept whole.

    The driver holds one block at a time.
    """
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        held, size = [], 0
        for r in part.toLocalIterator():
            words = words_of((r.text or "").encode())
            step = max(WINDOW, BLOCK_BYTES // (64 * WINDOW))
            for i in range(0, max(1, len(words) - WINDOW + 1), step):
                piece = b" ".join(words[i : i + step + WINDOW - 1]).decode()
                held.append((r.item, piece))
                size += len(piece) * (WINDOW + 4)
                if size > BLOCK_BYTES and blocks > 1:
                    yield held
                    held, size = [], 0
        if held:
            yield held


def _frequencies(docs: DataFrame, shingles: dict[int, Lookup]) -> dict[int, np.ndarray]:
    """In how many places of the whole corpus each shingle of the block occurs, by shingle length."""
    shared = docs.sparkSession.sparkContext.broadcast({n: x.keys for n, x in shingles.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        sets = {n: Lookup(k) for n, k in shared.value.items()}
        totals = {n: np.zeros(len(x.keys), np.int64) for n, x in sets.items()}

        def tally(_: pa.RecordBatch, texts: list[bytes]) -> None:
            words = Words(texts)
            hashes = words.hashes()
            for n, x in sets.items():
                found = x.find(words.shingles(n, hashes)[0])[1]
                totals[n] += np.bincount(found, minlength=len(x.keys))

        for _ in per_slice(batches, tally, 0, SLICE_BYTES):
            pass
        for n, t in totals.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at), pa.array(t[at])], ["n", "at", "count"])

    counted = docs.select("__text").mapInArrow(work, "n int, at long, count long").groupBy("n", "at").agg(F.sum("count").alias("count"))
    out = {n: np.zeros(len(x.keys), np.int64) for n, x in shingles.items()}
    for r in counted.toLocalIterator():  # a row per shingle of the block at most
        out[r.n][r.at] = r["count"]
    return out


def _prefixes(windows: list[bytes], docs: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle length: the prefix shingle's hash, the window and the shingle's offset in it, sorted by hash."""
    of = [_window_shingles(w) for w in windows]
    sizes = [min(SHINGLE, w.count(b" ") + 1) for w in windows]
    sets = {n: Lookup(np.concatenate([h for h, m in zip(of, sizes) if m == n])) for n in set(sizes)}
    counts = _frequencies(docs, sets)
    out = {}
    for n, x in sets.items():
        hashes, owners, offsets = [], [], []
        for i, (h, m) in enumerate(zip(of, sizes)):
            if m == n:
                at = np.searchsorted(x.keys, h)
                best = int(np.lexsort((h, counts[n][at]))[0])  # the rarest; then the smallest hash
                hashes.append(h[best])
                owners.append(i)
                offsets.append(best)
        order = np.argsort(np.array(hashes, np.uint64), kind="stable")
        out[n] = np.array(hashes, np.uint64)[order], np.array(owners)[order], np.array(offsets)[order]
    return out


def _search(docs: DataFrame, block: list[tuple[str, str]], key_type: str) -> DataFrame:
    """Per document: its words, the merged spans of words that windows of the block hit, and the items they are of."""
    by_window = _windows(block)
    windows = list(by_window)
    shared = docs.sparkSession.sparkContext.broadcast((windows, list(by_window.values()), _prefixes(windows, docs)))
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        windows, owners, prefixes = shared.value
        lookups = {n: Lookup(p[0]) for n, p in prefixes.items()}
        lengths = np.array([w.count(b" ") + 1 for w in windows], np.int64)

        def look(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            words = Words(texts)
            hashes = words.hashes()
            delta = np.zeros(len(words.ends) + 1, np.int32)
            items: list[set] = [set() for _ in texts]
            for n, (keys, owner, offset) in prefixes.items():
                h, first = words.shingles(n, hashes)
                at, where = lookups[n].find(h)
                low = np.searchsorted(keys, lookups[n].keys[where])
                many = np.searchsorted(keys, lookups[n].keys[where], "right") - low
                at, low = np.repeat(at, many), np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                begin = first[at] - offset[low]
                end = begin + lengths[owner[low]]
                doc = words.doc[first[at]]
                inside = (begin >= words.first[doc]) & (end <= words.first[doc + 1])
                for b, e, w, d in zip(begin[inside].tolist(), end[inside].tolist(), owner[low][inside].tolist(), doc[inside].tolist()):
                    if words.buffer[words.starts[b] : words.ends[e - 1]] == windows[w]:
                        delta[b] += 1
                        delta[e] -= 1
                        items[d].update(owners[w])
            covered = np.cumsum(delta[:-1]) > 0
            edge = np.ones(len(covered), bool)  # a span ends where its document does
            edge[1:] = (covered[1:] != covered[:-1]) | (words.doc[1:] != words.doc[:-1])
            begins = np.flatnonzero(edge)
            ends = np.append(begins[1:], len(covered))
            hit = covered[begins] if len(begins) else np.zeros(0, bool)
            begins, ends = begins[hit], ends[hit]
            spans: list[list] = [[] for _ in texts]
            for b, e, d in zip(begins.tolist(), ends.tolist(), words.doc[begins].tolist()):
                base = int(words.first[d])
                spans[d].append({"first": b - base, "last": e - 1 - base})
            arrays = [part.column(0), pa.array(words.counts), pa.array(spans, spans_type), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(arrays, ["__key", "n_words", "spans", "items"])

        yield from per_slice(batches, look, limit=SLICE_BYTES)

    return docs.select("__key", "__text").mapInArrow(work, SPANS_SCHEMA.format(key=key_type))


def find_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Where windows of benchmark items occur in documents.

    Returns one row per document row: ``key``, ``n_words``, ``n_hit`` (words inside any occurrence), ``spans`` (disjoint runs of
    hit words, first and last word counted from 0), ``items`` (ids with an occurring window, as sorted strings) and
    ``contaminated`` (some word is hit, and at least one in twenty).

    Documents stay where they are: the join's small side, the windows, is sent to the tasks in blocks of bounded bytes, and
    the corpus is scanned twice per block, for the shingles' counts and for the matches. With one block nothing but counts is
    shuffled. Several blocks are searched one after the other, each one's matches written before the next is read, so neither
    the driver nor a task holds more than one; the matches, with copies counted once, then meet by key and text hash. A common
    passage costs each document its own matches only.

    Null or empty texts: no words, never contaminated. Items without id count for hits, but not in ``items``. Repeated
    documents are judged each. Empty tables: no rows, or rows without hits. Other columns are not read.
    """
    require(docs, key, text)
    require(items, item, item_text)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    key_type = rows.schema["__key"].dataType.simpleString()
    item_rows, n_blocks = _item_rows(items, item, item_text)
    if n_blocks == 1:
        found = _search(rows, next(_item_blocks(item_rows, 1), []), key_type)
    else:
        found = _in_turn(rows, item_rows, n_blocks)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    counted = found.withColumn("n_hit", hit)
    return counted.select(
        F.col("__key").alias(key),
        "n_words",
        "n_hit",
        "spans",
        F.array_sort("items").alias("items"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _in_turn(rows: DataFrame, item_rows: DataFrame, blocks: int) -> DataFrame:
    """``_search`` for several blocks, one after the other; a document's spans of all blocks are merged."""
    keyed = rows.withColumn("__key", F.struct("__key", F.xxhash64("__text").alias("__hash")))
    key_type = keyed.schema["__key"].dataType.simpleString()
    everyone = saved(_search(keyed, [], key_type).select("__key", "n_words"), "decontaminate-rows")
    hits = None
    for block in _item_blocks(item_rows, blocks):
        part = saved(_search(keyed, block, key_type).where(F.size("spans") > 0).distinct(), "decontaminate-hits")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = _search(keyed, [], key_type).where(F.lit(False))
    # a list per block that hits the document, and no longer than the document
    hits = hits.groupBy("__key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def last(done: Column) -> Column:
        return F.get(done, F.size(done) - 1)

    def add(done: Column, s: Column) -> Column:
        wider = F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["last"], s["last"]).alias("last"))
        touches = (F.size(done) > 0) & (last(done)["last"] >= s["first"] - 1)
        return F.when(touches, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(s)))

    none = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    merged = hits.select(F.col("__key").alias("__hit"), F.aggregate(F.array_sort("spans"), none, add).alias("spans"), "items")
    met = everyone.join(merged, F.col("__key").eqNullSafe(F.col("__hit")), "left")
    no_items = F.expr("cast(array() as array<string>)")
    return met.select(F.col("__key.__key").alias("__key"), "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", no_items).alias("items"))

"""Repeated passages by suffix arrays, and their removal.

Strings of ``LENGTH`` bytes that occur in several documents are found in three rounds over cells, each some megabytes of whole
documents packed into one row:

1. Every window of ``LENGTH`` bytes has an anchor: the place of its least hash among its strings of ``ANCHOR`` bytes. Equal
   windows have equal anchors at equal places, and about one position in 16 is an anchor. A cell sends the hashes of its
   anchors, each once, to buckets; those that several documents have come back.
2. Around each anchor that came back lies a context, the bytes of the windows that it is the anchor of. A cell sends each
   distinct context once, with the least key of the documents that have it.
3. A bucket makes the suffix array of the contexts of an anchor (by what follows it) with the common prefixes of
   neighbours, and scans it with a stack, which gives the tree of common-prefix intervals. In each interval, left
   extensions (what precedes the anchor) are tested for diversity in the same way: contexts that go on to the left alike form
   one group, ending where their bytes differ. Such a group is a maximal repeat with all its contexts; if it has ``LENGTH``
   bytes, every context in it learns of the repeat and of the least key that has it.

The comparison is of bytes throughout; hashes only decide what is compared. A passage that a third of all documents share
is one context per cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import hidden, lean_worker, lengths_of, require, rows_of, saved, slices, texts_of

LENGTH, ANCHOR = 50, 20
CELL_BYTES, BUCKET_BYTES, STEP_BYTES = 4 * 2**20, 16 * 2**20, 2**18
NO_KEY = np.iinfo(np.int64).max
_SPAN = LENGTH - ANCHOR + 1
_BASE, _LOW = 0x5851F42D4C957F2D, 22
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(n, base, np.uint64)
            p[:1] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; equal bytes of 8-byte numbers are put together."""
    parts = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        kind = a.dtype.str.encode().ljust(4)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes()
        parts += [kind, len(a).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(3).compress(b"".join(parts))


def _unpacked(value: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(value), 4, []
    for _ in range(int.from_bytes(raw[:4], "little")):
        kind, n = np.dtype(raw[at : at + 4].strip().decode()), int.from_bytes(raw[at + 4 : at + 12], "little")
        at += 12
        part = np.frombuffer(raw, np.uint8, n * kind.itemsize, at)
        out.append(part.reshape(kind.itemsize, n).T.copy().view(kind).reshape(-1) if kind.itemsize > 1 else part.view(kind))
        at += n * kind.itemsize
    return out


def _rising(values: np.ndarray) -> np.ndarray:
    """Sorted numbers as steps, which pack better; ``np.cumsum`` undoes it."""
    return np.diff(values, prepend=np.uint64(0))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted set."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Cell:
    """Some whole documents: keys, and their bytes in one buffer."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray, buffer: bytes) -> None:
        self.keys, self.lengths, self.buffer = keys, lengths, buffer
        self.ends = np.cumsum(lengths)

    @staticmethod
    def of(value: bytes) -> Cell:
        keys, lengths, raw = _unpacked(value)
        return Cell(keys, lengths, raw.tobytes())

    def packed(self) -> bytes:
        return _packed(self.keys, self.lengths, np.frombuffer(self.buffer, np.uint8))

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Of each anchor: its hash, document, place, and where the windows that it is the anchor of begin and end."""
        parts = [self._anchors(a, min(len(self.buffer), a + STEP_BYTES + LENGTH - 1)) for a in range(0, len(self.buffer), STEP_BYTES)]
        empty = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
        return tuple(np.concatenate(c) for c in zip(empty, *parts))

    def _anchors(self, begin: int, end: int) -> tuple[np.ndarray, ...]:
        n = end - begin
        if n < LENGTH:
            return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
        power, back = _powers(STEP_BYTES + LENGTH)
        raw = np.frombuffer(self.buffer, np.uint8, n, begin).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * power[:n])])
        m = n - ANCHOR + 1
        h = (sums[ANCHOR:] - sums[:m]) * back[:m]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        low = h >> np.uint64(_LOW) << np.uint64(_LOW) | np.arange(m, dtype=np.uint64)
        for width in (1, 2, 4, 8, _SPAN - 16):  # the least in each run of _SPAN
            low = np.minimum(low[:-width], low[width:])
        start = np.arange(begin, begin + len(low))
        doc = np.searchsorted(self.ends, start, "right")
        inside = start + LENGTH <= self.ends[doc]
        start, doc = start[inside], doc[inside]
        place = begin + (low[inside] & np.uint64((1 << _LOW) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]) if len(place) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(place)][: len(first)] - 1
        return h[place[first] - begin], doc[first], place[first], start[first], start[last] + LENGTH

    def contexts(self, shared: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
        """The distinct contexts of shared anchors: anchors' hashes, contexts (bytes before the anchor, then the context), least
        keys; then document, place, begin and end of each occurrence, and the number of its context."""
        h, doc, place, begin, end = self.anchors()
        at = np.flatnonzero(_among(h >> np.uint64(8), np.sort(shared)))
        h, doc, place, begin, end = h[at], doc[at], place[at], begin[at], end[at]
        number: dict[bytes, int] = {}
        of = np.empty(len(at), np.int64)
        for i, (a, p, z) in enumerate(zip(begin.tolist(), place.tolist(), end.tolist())):
            of[i] = number.setdefault(bytes((p - a,)) + self.buffer[a:z], len(number))
        least = np.full(len(number), NO_KEY)
        np.minimum.at(least, of, self.keys[doc])
        hashes = np.zeros(len(number), np.uint64)
        hashes[of] = h >> np.uint64(8)
        return hashes, list(number), least, (doc, place, begin, end), of


def _cells(docs: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """Documents packed into cells; the columns to keep lie beside them as a batch of their own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        part, made = TaskContext.get().partitionId(), 0

        def cell(parts: list[pa.RecordBatch], texts: list[bytes]) -> pa.RecordBatch:
            nonlocal made
            rows = pa.Table.from_batches(parts).combine_chunks()
            lengths = np.array([len(t) for t in texts], np.int64)
            row = Cell(np.asarray(rows.column(0).fill_null(NO_KEY)), lengths, b"".join(texts))
            made += 1
            rest = pa.BufferOutputStream()
            with pa.ipc.new_stream(rest, rows.schema) as out:
                out.write_table(rows)
            values = [part << 32 | made], [row.packed()], [len(row.buffer)], [rest.getvalue().to_pybytes()]
            columns = [pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.binary(), pa.int64(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["cell", "docs", "bytes", "rest"])

        parts, texts, size = [], [], 0
        for batch in batches:
            rest = pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:]], [str(i) for i in range(batch.num_columns - 1)])
            lengths = lengths_of(batch.column(1))
            for i, j in slices(lengths, STEP_BYTES):
                if texts and size + sum(lengths[i:j]) > CELL_BYTES:
                    yield cell(parts, texts)
                    parts, texts, size = [], [], 0
                parts.append(rest.slice(i, j - i))
                texts += texts_of(batch.column(1).slice(i, j - i))
                size += sum(lengths[i:j])
        if texts:
            yield cell(parts, texts)

    rows = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"), *hidden(docs, keep))
    return rows.mapInArrow(work, "cell long, docs binary, bytes long, rest binary")


def _shared_anchors(cells: DataFrame, buckets: int) -> DataFrame:
    """``cell``, ``anchors``: of each cell, the hashes of anchors that several documents have, in packed parts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for cell, docs in rows_of(batches):
            c = Cell.of(docs)
            h, doc, *_ = c.anchors()
            h >>= np.uint64(8)
            order = np.lexsort((c.keys[doc], h))
            h, key = h[order], c.keys[doc][order]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            last = np.r_[first[1:], len(h)][: len(first)] - 1
            once, several = h[first], key[first] != key[last]
            bucket, rest = (once % np.uint64(buckets)).astype(np.int64), once // np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, rest, several = bucket[order], rest[order], several[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = [(b, _packed(_rising(rest[i:j][~several[i:j]]), _rising(rest[i:j][several[i:j]]))) for b, (i, j) in enumerate(zip(edges, edges[1:])) if i < j]
            if rows:
                arrays = [pa.array([r[0] for r in rows], pa.int64()), pa.array([cell] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["bucket", "cell", "anchors"])

    def meet(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        sent = [[np.cumsum(x, dtype=np.uint64) for x in _unpacked(v)] for v in group.column("anchors").to_pylist()]
        values, counts = np.unique(np.concatenate([x for s in sent for x in (s[0], s[1], s[1])]), return_counts=True)
        shared, cells, out = values[counts > 1], [], []
        for cell, (one, several) in zip(group.column("cell").to_pylist(), sent):
            found = np.sort(np.concatenate([one[_among(one, shared)], several]))
            if len(found):
                cells.append(cell)
                out.append(_packed(_rising(found * np.uint64(buckets) + np.uint64(bucket))))
        return pa.table([pa.array(cells, pa.int64()), pa.array(out, pa.binary())], ["cell", "anchors"])

    sent = cells.select("cell", "docs").mapInArrow(send, "bucket long, cell long, anchors binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "cell long, anchors binary")
    return met.groupBy("cell").agg(F.collect_list("anchors").alias("anchors"))


def common(a: bytes, b: bytes) -> int:
    """How many bytes two strings begin with in common."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low : low + 1] != b[low : low + 1] else low + 1


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """The tree of common-prefix intervals, inner ones first, by a stack: (length, first, last).

    ``prefixes[i]`` is the common prefix of the sorted strings i - 1 and i.
    """
    stack = [(0, 0)]
    for i in range(1, len(prefixes) + 1):
        h = prefixes[i] if i < len(prefixes) else 0
        first = i - 1
        while h < stack[-1][0]:
            length, first = stack.pop()
            yield length, first, i - 1
        if h > stack[-1][0]:
            stack.append((h, first))


def maximal_repeats(contexts: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, list[int]]]:
    """The maximal repeats of at least ``LENGTH`` bytes among distinct contexts (reversed left part, right part) of one anchor.

    Gives bytes before the anchor, bytes from the anchor on, and all contexts that have the repeat.
    """
    by_right = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    prefixes = [0, *[common(contexts[a][1], contexts[b][1]) for a, b in zip(by_right, by_right[1:])]]
    by_left = {i: n for n, i in enumerate(sorted(range(len(contexts)), key=lambda i: contexts[i][0]))}
    for right, first, last in intervals(prefixes):
        if right < ANCHOR:
            continue
        inside = sorted(by_right[first : last + 1], key=by_left.__getitem__)
        lefts = [0, *[common(contexts[a][0], contexts[b][0]) for a, b in zip(inside, inside[1:])]]
        for left, low, high in intervals(lefts):
            if left + right >= LENGTH:
                yield left, right, inside[low : high + 1]
        if right >= LENGTH and min(lefts[1:]) == 0:  # nothing is common to the left of all
            yield 0, right, inside


def _repeats_met(group: pa.Table) -> pa.Table:
    """For each cell in a bucket: the least key of each of its contexts, and the repeats its contexts have with lesser keys."""
    number: dict[tuple[int, bytes], int] = {}
    least: list[int] = []
    sent = []
    for cell, value in zip(group.column("cell").to_pylist(), group.column("contexts").to_pylist()):
        index, hashes, keys, lengths, raw = _unpacked(value)
        buffer, at, of = raw.tobytes(), 0, []
        for h, k, n in zip(hashes.tolist(), keys.tolist(), lengths.tolist()):
            g = number.setdefault((h, buffer[at : at + n]), len(least))
            at += n
            if g == len(least):
                least.append(k)
            elif k < least[g]:
                least[g] = k
            of.append(g)
        sent.append((cell, index, keys, of))
    by_anchor: dict[int, list[int]] = {}
    split: list[tuple[bytes, bytes]] = []
    for g, (h, c) in enumerate(number):
        by_anchor.setdefault(h, []).append(g)
        split.append((c[c[0] : 0 : -1], c[1 + c[0] :]))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for members in by_anchor.values():
        if len(members) == 1:
            continue
        for left, right, inside in maximal_repeats([split[g] for g in members]):
            low = min(least[members[i]] for i in inside)
            for i in inside:
                g = members[i]
                if low < least[g]:
                    have = found.setdefault(g, [])
                    if not any(x >= left and y >= right and k <= low for x, y, k in have):
                        have.append((left, right, low))
    cells, out = [], []
    for cell, index, keys, of in sent:
        lesser = [(i, least[g]) for i, k, g in zip(index.tolist(), keys.tolist(), of) if least[g] < k]
        parts = [(i, *r) for i, g in zip(index.tolist(), of) for r in found.get(g, ())]
        if lesser or parts:
            a, b = np.array(lesser, np.int64).reshape(-1, 2), np.array(parts, np.int64).reshape(-1, 4)
            cells.append(cell)
            out.append(_packed(*[np.ascontiguousarray(c) for c in (*a.T, *b.T)]))
    return pa.table([pa.array(cells, pa.int64()), pa.array(out, pa.binary())], ["cell", "repeats"])


def _spans(cell: Cell, anchors: list[bytes] | None, repeats: list[bytes] | None) -> np.ndarray:
    """Which bytes of the cell a repeat with a lesser key covers."""
    delta = np.zeros(len(cell.buffer) + 1, np.int32)
    if anchors:
        shared = np.concatenate([np.cumsum(_unpacked(v)[0], dtype=np.uint64) for v in anchors])
        _, _, least, (doc, place, begin, end), of = cell.contexts(shared)
        lists = [_unpacked(v) for v in repeats or []]
        for index, key, *_ in lists:
            least[index] = key
        covered = cell.keys[doc] > least[of]
        np.add.at(delta, begin[covered], 1)
        np.add.at(delta, end[covered], -1)
        entries = [np.concatenate(c) for c in zip(*[x[2:] for x in lists])] if lists else [np.zeros(0, np.int64)] * 4
        context, left, right, key = entries
        if len(context):
            order = np.argsort(of, kind="stable")  # the occurrences of each context
            low, high = np.searchsorted(of[order], context), np.searchsorted(of[order], context, "right")
            many = high - low
            at = order[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            left, right, key = np.repeat(left, many), np.repeat(right, many), np.repeat(key, many)
            lesser = key < cell.keys[doc[at]]
            np.add.at(delta, (place[at] - left)[lesser], 1)
            np.add.at(delta, (place[at] + right)[lesser], -1)
    return np.cumsum(delta[:-1], dtype=np.int32) > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Removes every byte covered by a string of 50 bytes that also starts in a document with a smaller key.

    Returns per document row: ``key``, ``n_bytes``, ``spans`` (maximal removed runs, first byte and the byte after the last) and
    ``kept`` (the other bytes). Strings never cross documents and are judged on the input. With ``keep``, returns the table's own
    columns instead, the text without what is removed; there a character is removed only if all its bytes are.

    ``key`` must be an integer. Null keys count as greater than all others and not smaller than each other. Rows with
    equal keys never make each other's strings repeats. Null text: no bytes. Texts below 50 bytes keep all. Equal texts: the
    least key keeps its own. Repeated rows get equal results. Texts of any length: they are worked on in overlapping steps.
    Empty table: no rows. Without ``keep``, other columns are not read.
    """
    require(docs, key, text)
    rest = [c for c in docs.columns if c != text] if keep else []
    cells = saved(_cells(docs, key, text, rest), "cells")
    buckets = int((cells.agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES) + 8
    shared = saved(_shared_anchors(cells, buckets), "anchors")
    marked = cells.select("cell", "docs").join(shared, "cell")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for cell, docs, anchors in rows_of(batches):
            hashes, contexts, least, *_ = Cell.of(docs).contexts(np.concatenate([np.cumsum(_unpacked(v)[0], dtype=np.uint64) for v in anchors]))
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            numbers, values = [], []
            for b, (i, j) in enumerate(zip(edges, edges[1:])):
                if i < j:
                    own = order[i:j]
                    texts = [contexts[x] for x in own.tolist()]
                    lengths = np.array([len(t) for t in texts], np.uint8)
                    numbers.append(b)
                    values.append(_packed(own, hashes[own], least[own], lengths, np.frombuffer(b"".join(texts), np.uint8)))
            arrays = [pa.array(numbers, pa.int64()), pa.array([cell] * len(numbers), pa.int64()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "cell", "contexts"])

    sent = marked.select("cell", "docs", "anchors").mapInArrow(send, "bucket long, cell long, contexts binary")
    met = sent.groupBy("bucket").applyInArrow(_repeats_met, "cell long, repeats binary")
    repeats = saved(met.groupBy("cell").agg(F.collect_list("repeats").alias("repeats")), "repeats")

    span_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    own = T.StructType([T.StructField("__key", T.LongType()), T.StructField("n_bytes", T.LongType())])
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    own = own.add("spans", T.ArrayType(span)).add("kept", T.BinaryType())
    schema = T.StructType([docs.schema[c] if c != text else T.StructField(text, T.StringType()) for c in docs.columns]) if keep else own

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for docs, others, anchors, repeats in rows_of(batches):
            cell = Cell.of(docs)
            gone = _spans(cell, anchors, repeats)
            raw = np.frombuffer(cell.buffer, np.uint8)
            if keep and len(raw):  # whole characters: a byte 10xxxxxx goes on with the one before
                character = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)
                left = np.zeros(character[-1] + 1, bool)
                left[character[~gone]] = True
                gone = ~left[character]
            table = pa.ipc.open_stream(others).read_all().combine_chunks()
            bounds = np.r_[0, cell.ends]
            for i, j in slices(cell.lengths.tolist(), STEP_BYTES):
                marks = [(raw[a:z], gone[a:z]) for a, z in zip(bounds[i:j].tolist(), bounds[i + 1 : j + 1].tolist())]
                kept = pa.array([r[~m].tobytes() for r, m in marks], pa.binary())
                part = table.slice(i, j - i)
                if keep:
                    arrays = [kept.cast(pa.string()) if c == text else part.column(1 + rest.index(c)).combine_chunks() for c in schema.names]
                else:
                    edges = [np.flatnonzero(np.diff(m.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist() for _, m in marks]
                    spans = pa.array([[{"first": a, "end": b} for a, b in e] for e in edges], span_type)
                    arrays = [part.column(0).combine_chunks(), pa.array(cell.lengths[i:j]), spans, kept]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    whole = cells.select("cell", "docs", "rest").join(shared, "cell", "left").join(repeats, "cell", "left").select("docs", "rest", "anchors", "repeats")
    out = whole.mapInArrow(cut, schema)
    return out if keep else out.withColumn("__key", F.col("__key").cast(docs.schema[key].dataType)).withColumnRenamed("__key", key)

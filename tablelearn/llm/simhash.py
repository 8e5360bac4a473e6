"""Near duplicates by SimHash: fingerprints, a byte-position inverted index with count filtering, and components.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share at least 5
positional bytes. Lists of a single positional byte would hold 1/256 of all fingerprints each, so the index lists what
every qualifying pair must share at least: of any 5 positions, 3 lie in the same half, so each pair meets in a list of
3 positional bytes of one half (8 lists per fingerprint). In a list, the shared positional bytes of a pair are tallied over
all 8 positions; pairs that reach 5 are verified by their differing bits. Long lists are cut again by two more positional
bytes, which the count guarantees as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import lean_worker, per_slice, removed, require, saved

SHINGLE, SEED, MAX_BITS = 3, 42, 3
MIN_SHARED = 8 - MAX_BITS
#: Lists of more fingerprints are cut by two more bytes; the pairs found are the same.
LONG_LIST = 64
_HALVES = (tuple(combinations(range(4), 3)), tuple(combinations(range(4, 8), 3)))
TRIPLES = _HALVES[0] + _HALVES[1]
_CHUNK = 1 << 16


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a text: the bits set in over half its shingles' hashes; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only; 0x20 and 0x09-0x0D separate
    if not words:
        return 0
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(joined)]
    n = max(1, len(words) - SHINGLE + 1)
    ends = ends[min(SHINGLE, len(words)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + _CHUNK], ends[i : i + _CHUNK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row. Null or no words: 0."""
    require(docs, key, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["__key", "fp"])

        lean_worker()
        yield from per_slice(batches, one)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(work, f"__key {kind}, fp long").withColumnRenamed("__key", key)


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _masked(fp: Column, positions: tuple[int, ...]) -> Column:
    return fp.bitwiseAND(F.lit(_mask(positions)))


def _first(differ: Column, lists: list[tuple[int, ...]]) -> Column:
    """The number of the first list that both fingerprints of a pair are in, so that a pair counts once."""
    return F.coalesce(*[F.when(_masked(differ, p) == 0, F.lit(i)) for i, p in enumerate(lists)])


def _close(differ: Column) -> Column:
    shared = sum((F.when(_masked(differ, (p,)) == 0, 1).otherwise(0) for p in range(1, 8)), F.when(_masked(differ, (0,)) == 0, 1).otherwise(0))
    return (shared >= MIN_SHARED) & (F.bit_count(differ) <= MAX_BITS)


def _pairs(lists: DataFrame, keys: list[str]) -> DataFrame:
    a, b = lists.alias("a"), lists.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    condition = (F.col("a.fp") < F.col("b.fp")) & _close(differ)
    for s in same:
        condition = condition & s
    return a.join(b, condition).select(*[F.col(f"a.{k}") for k in keys], F.col("a.fp").alias("x"), F.col("b.fp").alias("y"))


def links(classes: DataFrame) -> DataFrame:
    """All pairs (x < y) of distinct fingerprints that differ in at most 3 bits, each once. ``classes``: distinct ``fp``."""
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("list"), _masked(F.col("fp"), p).alias("bytes")) for i, p in enumerate(TRIPLES)]))
    postings = saved(classes.select("fp", entry.alias("e")).select("fp", "e.list", "e.bytes"), "simhash-index")
    sizes = postings.groupBy("list", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    shared = postings.join(sizes, ["list", "bytes"])
    differ = F.col("x").bitwiseXOR(F.col("y"))
    first = _first(differ, list(TRIPLES))
    short = _pairs(shared.where(F.col("n") <= LONG_LIST).select("fp", "list", "bytes"), ["list", "bytes"]).where(first == F.col("list"))

    cuts, order = [], None
    for i, triple in enumerate(TRIPLES):
        more = [tuple(sorted(triple + p)) for p in combinations([q for q in range(8) if q not in triple], MIN_SHARED - 3)]
        cuts.append(F.array(*[F.struct(F.lit(j).alias("cut"), _masked(F.col("fp"), p).alias("bytes")) for j, p in enumerate(more)]))
        chosen = F.when(F.col("list") == i, _first(differ, more))
        order = chosen if order is None else F.coalesce(order, chosen)
    long = shared.where(F.col("n") > LONG_LIST)
    again = long.select("fp", "list", F.explode(F.element_at(F.array(*cuts), F.col("list") + 1)).alias("e")).select("fp", "list", "e.cut", "e.bytes")
    cut = _pairs(again, ["list", "cut", "bytes"]).where((first == F.col("list")) & (order == F.col("cut")))
    return short.select("x", "y").unionByName(cut.select("x", "y"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that an edge (x, y) touches.

    Large-star and small-star steps in turn, until nothing changes: the number of rounds grows with the logarithm of the
    size. Each round is written to the shared folder. Minima are combined before the shuffle, so a hub is no burden.
    """
    spark = edges.sparkSession
    now = saved(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct(), "stars")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = saved(small.select("e.u", "e.v").where("u <> v").distinct(), "stars")
        found = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        removed(spark, now)
        now = after
        if tuple(found) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(found)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: ``key``, ``fingerprint`` (16 lowercase hex digits), ``component_id``, ``n_links``.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are three words, repeats included (fewer words: the
    whole sequence). Fingerprints link at 3 or fewer differing bits; ``component_id`` is the smallest key reachable;
    ``n_links`` counts the other distinct fingerprints within 3 bits of the row's own.

    Rows with one fingerprint are one class, counted before any shuffle, so copies are never paired. Classes meet in lists of
    positional bytes; no list yields pairs beyond true links.

    Null, empty or blank texts have fingerprint zero and link as any other. Null keys take part; a component of null keys
    only has a null id. Repeated rows get the same values. Empty table: no rows. Other columns are not read.
    """
    prints = saved(fingerprints(docs, key, text).select(F.col(key).alias("__key"), "fp"), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("__key").alias("least")), "simhash-classes")
    pairs = saved(links(classes.select("fp")), "simhash-links")
    roots = components(pairs)
    counts = pairs.select(F.explode(F.array("x", "y")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").join(counts, "fp", "left").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return prints.join(named, "fp").select(F.col("__key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")

"""Row positions: a dense, 0-based, reproducible order over a distributed table.

Spark rows have no order, so every positional operator takes a unique ``row_key`` and derives ``pos`` from it:
by the key itself, or by ``md5(seed:key)`` for a shuffle. Rows are spread over many buckets that follow the
order; a count per bucket gives each bucket's offset, and rows are numbered inside their bucket. So there is
one shuffle of the rows, no global sort and no window over the whole table. Positions depend on keys alone and
stay the same under another partitioning or after a lost executor.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from ..functions.columns import as_list, long_array, search_bucket, to_col

ROWS_PER_BUCKET = 250_000
MAX_HEX_DIGITS = 4
MAX_RANGE_DEPTH = 14
SAMPLES_PER_BUCKET = 20
SAMPLE_BYTES = 32 * 2**20

MAX_STARTS = 100

_BUCKET = "__bucket"
_HASH = "__hash"
_KEY = "__key"


def shuffle_hash(seed, row_key: list[str], *middle: Column) -> Column:
    """``md5('seed:...:key')``: the order of a seeded shuffle, the same in any engine that has md5."""
    return F.md5(
        F.concat_ws(":", F.lit(str(seed)), *middle, *[to_col(k).cast("string") for k in row_key]).cast("binary")
    )


def hex_bucket(hashed: Column, digits: int) -> Column:
    """The first hex digits of a hash as a number; it ascends with the hash."""
    if digits == 0:
        return F.lit(0)
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("int")


def _offsets(counts: dict[int, int], size: int) -> list[int]:
    out, running = [], 0
    for b in range(size):
        out.append(running)
        running += counts.get(b, 0)
    return out


def _check_key(df: DataFrame, row_key: list[str]) -> None:
    if not row_key:
        raise ValueError("a positional operator needs row_key, a column or columns that tell every row apart")
    missing = [k for k in row_key if k not in df.columns]
    if missing:
        raise KeyError(f"row_key columns {missing} are not in the table")


def require_unique(df: DataFrame, row_key) -> None:
    """Raise unless the key tells every row apart; one grouped count, only on request as it costs a shuffle."""
    keys = as_list(row_key)
    twice = df.groupBy(*[to_col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"row_key {keys} repeats, so positions would not be reproducible")


@dataclass
class _Buckets:
    """Rows with a bucket that ascends with the wanted order, and the number of rows before each bucket."""

    rows: DataFrame
    offsets: list[int]
    order: list[Column]
    helpers: list[str]
    n: int

    def numbered(self, pos: str, only: list[int] | None = None) -> DataFrame:
        rows = self.rows
        if only is not None and only and only[-1] - only[0] == len(only) - 1:
            rows = rows.filter(F.col(_BUCKET).between(only[0], only[-1]))
        elif only is not None:
            rows = rows.filter(F.col(_BUCKET).isin(only))
        base = F.get(long_array(self.offsets), F.col(_BUCKET))
        rank = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*self.order)) - 1
        return rows.withColumn(pos, (rank + base).cast("bigint")).drop(_BUCKET, *self.helpers)


def _hash_buckets(df: DataFrame, row_key: list[str], seed) -> _Buckets:
    hashed = df.withColumn(_HASH, shuffle_hash(seed, row_key))
    fine = hashed.groupBy(hex_bucket(F.col(_HASH), MAX_HEX_DIGITS).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    fine_counts = {r["b"]: r["n"] for r in fine.collect()}  # at most 16**4 rows
    n = sum(fine_counts.values())
    digits = 1
    while digits < MAX_HEX_DIGITS and n / 16**digits > ROWS_PER_BUCKET:
        digits += 1
    counts: dict[int, int] = {}
    for b, c in fine_counts.items():
        coarse = b >> (4 * (MAX_HEX_DIGITS - digits))
        counts[coarse] = counts.get(coarse, 0) + c
    rows = hashed.withColumn(_BUCKET, hex_bucket(F.col(_HASH), digits))
    order = [F.col(_HASH), *[to_col(k) for k in row_key]]
    return _Buckets(rows, _offsets(counts, 16**digits), order, [_HASH], n)


def _range_buckets(df: DataFrame, row_key: list[str]) -> _Buckets:
    texts = [to_col(k) for k in row_key if isinstance(df.schema[k].dataType, T.StringType)]
    lengths = [F.avg(F.octet_length(c)).alias(f"l{i}") for i, c in enumerate(texts)]
    size = df.agg(F.count(F.lit(1)).alias("n"), *lengths).first()
    n, key_bytes = size["n"], 16 * len(row_key) + sum(size[f"l{i}"] or 0 for i in range(len(texts)))
    depth = 4
    while (
        depth < MAX_RANGE_DEPTH
        and n / 2**depth > ROWS_PER_BUCKET
        and 2 ** (depth + 1) * SAMPLES_PER_BUCKET * key_bytes <= SAMPLE_BYTES
    ):
        depth += 1
    buckets = 2**depth
    key = F.struct(*[to_col(k).alias(f"k{i}") for i, k in enumerate(row_key)])
    ddl = T.StructType(
        [T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(row_key)]
    ).simpleString()

    # a sample chosen by the key's own hash: the same rows on every run, about SAMPLES_PER_BUCKET per bucket
    stride = max(1, n // (buckets * SAMPLES_PER_BUCKET))
    sample = df.select(key.alias("k"))
    if stride > 1:
        sample = sample.filter(F.pmod(F.xxhash64("k"), F.lit(stride)) == 0)
    texts = [r[0] for r in sample.sort("k").select(F.to_json("k")).collect()]
    if not texts:
        return _Buckets(df.withColumn(_BUCKET, F.lit(0)), [0], [to_col(k) for k in row_key], [], n)
    picks = [texts[min(len(texts) - 1, (i * len(texts)) // buckets)] for i in range(1, buckets)]
    # the text form may round a bound (a timestamp's micros); any ascending bounds serve, as all passes share them
    bounds = F.from_json(F.lit("[" + ",".join(picks) + "]"), f"array<{ddl}>")

    rows = search_bucket(df.withColumn(_KEY, key), F.col(_KEY), lambda i: F.get(bounds, i), depth, _BUCKET)
    counted = rows.groupBy(F.col(_BUCKET).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return _Buckets(rows, _offsets({r["b"]: r["n"] for r in counted}, buckets), [F.col(_KEY)], [_KEY], n)


def _buckets(df: DataFrame, row_key: list[str], seed) -> _Buckets:
    _check_key(df, row_key)
    return _hash_buckets(df, row_key, seed) if seed is not None else _range_buckets(df, row_key)


def positional(df: DataFrame, row_key, seed=None, pos: str = "pos") -> DataFrame:
    """Add ``pos`` = 0..n-1, in key order or, with a seed, in the order of ``md5(seed:key)``."""
    return positional_with_count(df, row_key, seed, pos)[0]


def positional_with_count(df: DataFrame, row_key, seed=None, pos: str = "pos") -> tuple[DataFrame, int]:
    """``positional`` and the number of rows, which its counting pass finds on the way.

    Without ``row_key`` the table must already have ``pos``, dense from 0: gaps, as a filter leaves them, are an error.
    """
    keys = as_list(row_key)
    if not keys and pos in df.columns:
        found = df.agg(F.count(F.lit(1)).alias("n"), F.count(pos).alias("m"), F.min(pos).alias("low"), F.max(pos).alias("high")).first()
        if found.n and (found.m, found.low, found.high) != (found.n, 0, found.n - 1):
            raise ValueError(f"column {pos} isn't dense: {found.n} rows from {found.low} to {found.high}; give a row_key")
        return df, found.n
    df = df.drop(pos) if pos in df.columns and pos not in keys else df
    found = _buckets(df, keys, seed)
    return found.numbered(pos), found.n


def positional_part(df: DataFrame, row_key, wanted: Callable[[int], list[range]], pos: str = "pos") -> tuple[DataFrame, int]:
    """The rows of the buckets that hold the positions in ``wanted(n)``, with ``pos``; and n.

    Only those buckets are shuffled and numbered. Other rows of theirs come along; the caller filters by ``pos``.
    """
    keys = as_list(row_key)
    found = _buckets(df.drop(pos) if pos in df.columns and pos not in keys else df, keys, None)
    only = set()
    for r in wanted(found.n):
        if len(r):
            first, last = (bisect_right(found.offsets, x) - 1 for x in (min(r[0], r[-1]), max(r[0], r[-1])))
            only |= set(range(first, last + 1))
    return found.numbered(pos, sorted(only)), found.n


def rank_groups(
    df: DataFrame, row_key, seed, starts: Callable[[int], Sequence[int]], out: str
) -> tuple[DataFrame, int]:
    """``out`` = how many of the ascending positions ``starts(n)`` are at or before the row's position; and n.

    For splits, folds and large batches, which need no position of their own: the keys at the few start positions
    are looked up, and then every row is placed by comparing its key with them. The rows themselves are not
    shuffled; only the keys of the buckets that hold a start are.
    """
    keys = as_list(row_key)
    found = _buckets(df.select(*[to_col(k) for k in keys]), keys, seed)
    cuts = starts(found.n)
    if len(cuts) > MAX_STARTS:
        placed = _buckets(df, keys, seed).numbered("__pos")
        if isinstance(cuts, range) and cuts.start == cuts.step:
            group = F.floor(F.col("__pos") / cuts.step).cast("int")
        else:
            passed = F.transform(long_array(cuts), lambda c: F.when(F.col("__pos") >= c, 1).otherwise(0))
            group = F.aggregate(passed, F.lit(0), lambda a, b: a + b)
        return placed.withColumn(out, group).drop("__pos"), found.n
    inside = [c for c in cuts if 0 < c < found.n]
    at = {}
    if inside:
        only = sorted({bisect_right(found.offsets, c) - 1 for c in inside})
        at = {r["__pos"]: r for r in found.numbered("__pos", only).filter(F.col("__pos").isin(inside)).collect()}
    types = dict(df.dtypes)

    def order_of(values: list[Column]) -> Column:
        if seed is not None:
            text = F.concat_ws(":", F.lit(str(seed)), *[v.cast("string") for v in values])
            values = [F.md5(text.cast("binary")), *values]
        return F.struct(*[v.alias(f"o{i}") for i, v in enumerate(values)])

    placed = df.withColumn(_KEY, order_of([to_col(k) for k in keys]))
    group = F.lit(sum(1 for c in cuts if c < found.n))
    for i, cut in reversed(list(enumerate(cuts))):
        if cut in at:
            first = order_of([F.lit(at[cut][k]).cast(types[k]) for k in keys])
            group = F.when(F.col(_KEY) < first, i).otherwise(group)
    return placed.withColumn(out, group).drop(_KEY), found.n


def lowest_hashes(df: DataFrame, hashed: Column, row_key: list[str], wanted: int, n: int) -> list[Row]:
    """The ``wanted`` rows of least hash, out of n.

    A bound on the hash lets a few times as many rows through, so that the final sort is as small as its result
    and does not grow with the number of tasks.
    """
    order = [F.col(_HASH), *[to_col(k) for k in row_key]]
    marked = df.withColumn(_HASH, hashed)
    share = (4 * wanted + 100) / n if n else 1.0
    if share < 1:
        few = marked.filter(F.col(_HASH) < f"{int(share * 2**32):08x}")
        rows = few.orderBy(*order).limit(wanted).collect()
        if len(rows) == wanted:
            return rows
    return marked.orderBy(*order).limit(wanted).collect()


def file_position_key(df: DataFrame, path_col: str = "file_path", index_col: str = "row_index") -> DataFrame:
    """A unique key for a file-backed table that has none: the file and the row's place in it."""
    return df.select(
        "*", F.col("_metadata.file_path").alias(path_col), F.col("_metadata.row_index").alias(index_col)
    )


def numbered_within(df: DataFrame, group: list[str], hashed: str, row_key: list[str], group_rows: int, out: str) -> DataFrame:
    """0-based rank by ``(hashed, key)`` inside each group.

    Groups of up to ``ROWS_PER_BUCKET`` rows are numbered in one window. Larger ones are cut by the leading hex
    digits of the hash, so that no task takes a whole group; offsets come from counts per cut, pre-aggregated.
    """
    digits = 0
    while digits < MAX_HEX_DIGITS and group_rows / 16**digits > ROWS_PER_BUCKET:
        digits += 1
    order = [F.col(hashed), *[to_col(k) for k in row_key]]
    if digits == 0:
        return df.withColumn(out, (F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1).cast("bigint"))
    cut = df.withColumn(_BUCKET, hex_bucket(F.col(hashed), digits))
    totals = cut.groupBy(*group, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, _BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = F.row_number().over(Window.partitionBy(*group, _BUCKET).orderBy(*order)) - 1
    return (
        cut.withColumn("__inside", inside)
        .join(offsets, [*group, _BUCKET])
        .withColumn(out, (F.col("__inside") + F.col("__off")).cast("bigint"))
        .drop("__inside", "__off", _BUCKET)
    )

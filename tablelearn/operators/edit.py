"""Projection, selection by position and editing (P1-P13). Every edit returns a new DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_list, long_array, nan_to_null, resolve, search_bucket, to_col
from ..functions.typing import cast_columns, categorical_columns, infer_types, normalise_missing, numeric_columns
from .position import positional, positional_part, positional_with_count

# A list of row numbers comes from the driver; up to this many travel as a broadcast table.
BROADCAST_ROWS = 1_000_000
# Up to so many inserted rows, their places travel as one constant; more are sorted in with the table, with the same result.
LISTED_INSERTS = 100_000


# -- columns ---------------------------------------------------------------------------------------


def select_columns(df: DataFrame, key) -> DataFrame:
    """One or many columns by name or index."""
    return df.select(*[to_col(c) for c in resolve(df, key)])


def drop_columns(df: DataFrame, key, delete: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(what stays, what was taken)``; with ``delete=False`` everything stays."""
    taken = resolve(df, key)
    kept = df.select(*[to_col(c) for c in df.columns if c not in taken]) if delete else df
    return kept, df.select(*[to_col(c) for c in taken])


def next_name(names: list[str]) -> str:
    """The smallest whole number not yet used as a column name."""
    i = 0
    while str(i) in names:
        i += 1
    return str(i)


def _column_order(existing: list[str], added: list[str], at) -> list[str]:
    """Places ``added`` before the given original positions; -1 appends, one number inserts a block."""
    width = len(existing)
    places = list(at) if isinstance(at, (list, tuple)) else [at] * len(added)
    if len(places) != len(added):
        raise ValueError(f"{len(places)} positions for {len(added)} columns")
    places = [width if p == -1 and not isinstance(at, (list, tuple)) else (p + width if p < 0 else p) for p in places]
    if any(not 0 <= p <= width for p in places):
        raise IndexError(f"column positions {places} are outside 0..{width}")
    out = []
    for i in range(width + 1):
        out += [a for a, p in zip(added, places) if p == i]
        if i < width:
            out.append(existing[i])
    return out


def add_columns(df: DataFrame, values: list[Column] | Column, columns=None, dtypes=None, at=-1) -> DataFrame:
    """P5: derived columns at the end, at one index, or at one index each. Unnamed ones get the smallest free
    number; untyped text is inferred, other untyped expressions keep the type Spark gives them."""
    values = as_list(values)
    columns = as_list(columns) or [None] * len(values)
    dtypes = list(dtypes) if isinstance(dtypes, (list, tuple)) else [dtypes] * len(values)
    if not len(values) == len(columns) == len(dtypes):
        raise ValueError("values, columns and dtypes must be of one length")
    names: list[str] = []
    for c in columns:
        names.append(c if c is not None else next_name(df.columns + names))
    if len(set(df.columns + names)) < len(df.columns) + len(names):
        raise ValueError(f"a name in {names} is taken")
    wide = df.select(
        "*", *[(v.cast(t) if t is not None else v).alias(n) for v, n, t in zip(values, names, dtypes)]
    )
    untyped = [n for n, t in zip(names, dtypes) if t is None and dict(wide.dtypes)[n] == "string"]
    if untyped:
        wide = normalise_missing(wide, untyped)
        wide = cast_columns(wide, infer_types(wide, untyped))
    return wide.select(*[to_col(c) for c in _column_order(df.columns, names, at)])


def join_columns(left: DataFrame, right: DataFrame, left_key, right_key, at=-1, pos: str = "pos") -> DataFrame:
    """Put two tables of equal length side by side, row i with row i. Keeps ``pos`` as the row identity."""
    a, n = positional_with_count(left, left_key, pos=pos)
    b, m = positional_with_count(right, right_key, pos=pos)
    if n != m:
        raise ValueError(f"the tables have {n} and {m} rows")
    old = [c for c in left.columns if c != pos]
    added = [c for c in right.columns if c != pos]
    clash = set(old) & set(added)
    if clash:
        raise ValueError(f"both tables have columns {sorted(clash)}")
    return a.join(b, pos).select(*[to_col(c) for c in _column_order(old, added, at)], pos)


def set_columns(df: DataFrame, values: dict[str | int, Column], retype: bool = False) -> DataFrame:
    """Overwrite whole columns; values are cast to the old type unless ``retype``."""
    types = dict(df.dtypes)
    new = {}
    for key, value in values.items():
        (name,) = resolve(df, key)
        new[name] = value if retype else value.cast(types[name])
    return df.select(*[new[c].alias(c) if c in new else to_col(c) for c in df.columns])


def split_by_kind(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(categorical columns, numeric columns)``."""
    return (
        df.select(*[to_col(c) for c in categorical_columns(df)]),
        df.select(*[to_col(c) for c in numeric_columns(df)]),
    )


# -- rows ------------------------------------------------------------------------------------------


def _slice_predicate(rows: slice, n: int, pos: str) -> tuple[Column, Column]:
    start, stop, step = rows.indices(n)
    p = F.col(pos)
    if step > 0:
        hit = (p >= start) & (p < stop) & (F.pmod(p - start, F.lit(step)) == 0)
        return hit, ((p - start) / step).cast("bigint")
    hit = (p <= start) & (p > stop) & (F.pmod(F.lit(start) - p, F.lit(-step)) == 0)
    return hit, ((F.lit(start) - p) / -step).cast("bigint")


def _row_numbers(rows, n: int) -> list[int]:
    out = [r + n if r < 0 else r for r in as_list(rows)]
    bad = [r for r in out if not 0 <= r < n]
    if bad:
        raise IndexError(f"row numbers {bad[:5]} are outside 0..{n - 1}")
    return out


def _wanted_rows(df: DataFrame, numbers: list[int], pos: str) -> DataFrame:
    listed = F.posexplode(long_array(numbers)).alias("out_pos", pos)
    table = df.sparkSession.range(1).select(listed).withColumn("out_pos", F.col("out_pos").cast("bigint"))
    return F.broadcast(table) if len(numbers) <= BROADCAST_ROWS else table


def select_rows(df: DataFrame, rows, columns=None, row_key=None, pos: str = "pos") -> DataFrame:
    """Rows by index, list (its order and repeats are kept) or slice, and some or all columns.

    The result carries ``pos``, its own 0-based order.
    """
    wanted = resolve(df, columns) if columns is not None else [c for c in df.columns if c != pos]
    if as_list(row_key):
        def ranges(n: int) -> list[range]:
            return [range(n)[rows]] if isinstance(rows, slice) else [range(r, r + 1) for r in _row_numbers(rows, n)]

        placed, n = positional_part(df, row_key, ranges, pos)
    else:
        placed, n = positional_with_count(df, row_key, pos=pos)
    if isinstance(rows, slice):
        hit, new_pos = _slice_predicate(rows, n, pos)
        return placed.filter(hit).select(*[to_col(c) for c in wanted], new_pos.alias(pos))
    numbers = _row_numbers(rows, n)
    if len(numbers) == 1:
        return placed.filter(F.col(pos) == numbers[0]).select(*[to_col(c) for c in wanted], F.lit(0).cast("bigint").alias(pos))
    return (
        placed.join(_wanted_rows(df, numbers, pos), pos)
        .select(*[to_col(c) for c in wanted], F.col("out_pos").alias(pos))
    )


def drop_rows(df: DataFrame, rows, delete: bool = True, row_key=None, pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """``(what stays, what was taken)``, each numbered anew from 0 in the old order.

    A new position follows from the old one and the number of taken rows before it, so nothing is shuffled for it.
    """
    placed, n = positional_with_count(df, row_key, pos=pos)
    if isinstance(rows, slice):
        taken = range(n)[rows]
        taken = taken if taken.step > 0 else taken[::-1]
        hit, _ = _slice_predicate(slice(taken.start, taken.stop, taken.step), n, pos)
        before = F.greatest(F.lit(0), F.least(F.lit(len(taken)), F.ceil((F.col(pos) - taken.start) / taken.step))).cast("bigint")
        placed = placed.withColumn("__before", before)
    else:
        numbers = sorted(set(_row_numbers(rows, n)))
        depth = max(1, len(numbers).bit_length())
        listed = long_array(numbers + [n] * (2**depth - len(numbers)))
        placed = search_bucket(placed, F.col(pos) - 1, lambda i: F.get(listed, i), depth, "__before")
        hit = F.get(listed, F.col("__before")) == F.col(pos)
    kept = placed.filter(~hit).withColumn(pos, F.col(pos) - F.col("__before")) if delete else placed
    return kept.drop("__before"), placed.filter(hit).withColumn(pos, F.col("__before").cast("bigint")).drop("__before")


def add_rows(
    df: DataFrame, rows: DataFrame, row_key=None, new_key=None, at: int | str = -1, pos: str = "pos"
) -> DataFrame:
    """Insert ``rows`` before a position, or each before the position in its column ``at``; -1 appends.

    New cells are cast to the column types, column by column, and a bad one fails the job. The result is
    ordered by a fresh dense ``pos``.
    """
    placed, n = positional_with_count(df, row_key, pos=pos)
    fresh, m = positional_with_count(rows, new_key, pos="__seq")
    names = [c for c in df.columns if c != pos]
    values = [c for c in rows.columns if c not in ("__seq", at)]
    if len(values) != len(names):
        raise ValueError(f"new rows have {len(values)} columns, the table has {len(names)}")
    types = dict(df.dtypes)
    cells = [to_col(v).cast(types[c]).alias(c) for v, c in zip(values, names)]
    if isinstance(at, int):
        start = n if at == -1 else (at + n if at < 0 else at)
        if not 0 <= start <= n:
            raise IndexError(f"row position {at} is outside 0..{n}")
        moved = F.when(F.col(pos) >= start, F.col(pos) + m).otherwise(F.col(pos)).alias(pos)
        old = placed.select(*[to_col(c) for c in names], moved)
        return old.unionByName(fresh.select(*cells, (F.col("__seq") + start).alias(pos)))
    place = to_col(at).cast("bigint")
    place = F.when(place < 0, place + n).otherwise(place)
    place = F.when(place.between(0, n), place).otherwise(
        F.raise_error(F.lit(f"an insert position is outside 0..{n}")).cast("bigint")
    )
    if m <= LISTED_INSERTS:
        return _scattered(placed, fresh.select(*cells, place.alias("__at"), "__seq"), names, m, n, pos)
    old = placed.select(*[to_col(c) for c in names], F.col(pos).alias("__at"), F.lit(1).alias("__old"), F.lit(0).cast("bigint").alias("__seq"))
    new = fresh.select(*cells, place.alias("__at"), F.lit(0).alias("__old"), F.col("__seq"))
    return positional(old.unionByName(new), ["__at", "__old", "__seq"], pos=pos).drop("__at", "__old", "__seq")


def _scattered(placed: DataFrame, fresh: DataFrame, names: list[str], m: int, n: int, pos: str) -> DataFrame:
    """Old rows move by the inserts at or before them, looked up in the sorted list of insert places."""
    ordered = fresh.select("__at", "__seq").sort("__at", "__seq").collect()  # LISTED_INSERTS rows at most
    depth = max(1, m.bit_length())
    places = long_array([r["__at"] for r in ordered] + [n + 1] * (2**depth - m))
    moved = search_bucket(placed, F.col(pos), lambda i: F.get(places, i), depth, "__before")
    old = moved.select(*[to_col(c) for c in names], (F.col(pos) + F.col("__before")).cast("bigint").alias(pos))
    rank = [0] * m
    for i, r in enumerate(ordered):
        rank[r["__seq"]] = i
    new_pos = F.col("__at") + F.get(long_array(rank), F.col("__seq").cast("int"))
    return old.unionByName(fresh.select(*[to_col(c) for c in names], new_pos.cast("bigint").alias(pos)))


def append_rows(top: DataFrame, bottom: DataFrame) -> DataFrame:
    """One table under the other, by column position, cast to the upper table's types. Duplicates stay."""
    if len(top.columns) != len(bottom.columns):
        raise ValueError(f"the tables have {len(top.columns)} and {len(bottom.columns)} columns")
    cast = [
        to_col(b).cast(f.dataType).alias(f.name) for b, f in zip(bottom.columns, top.schema.fields)
    ]
    return top.union(bottom.select(*cast))


def set_cells(df: DataFrame, rows, columns, values, row_key=None, pos: str = "pos") -> DataFrame:
    """P10: overwrite the cells of some rows and columns, cast to the column types.

    ``values`` is one value, one per column, or a DataFrame with the table's ``pos`` and the columns' new
    values (then ``rows`` is not used: a row is hit when it is listed).
    """
    placed, n = positional_with_count(df, row_key, pos=pos)
    names = resolve(df, columns)
    types = dict(df.dtypes)
    if isinstance(values, DataFrame):
        new = values.select(pos, *[to_col(c).cast(types[c]).alias(f"__new_{c}") for c in names], F.lit(True).alias("__hit"))
        joined = placed.join(new, pos, "left")
        out = {c: F.when(F.col("__hit"), to_col(f"__new_{c}")).otherwise(to_col(c)) for c in names}
        return joined.select(*[out[c].alias(c) if c in out else to_col(c) for c in placed.columns])
    per_column = list(values) if isinstance(values, (list, tuple)) else [values] * len(names)
    if len(per_column) != len(names):
        raise ValueError(f"{len(per_column)} values for {len(names)} columns")
    if isinstance(rows, slice):
        hit, _ = _slice_predicate(rows, n, pos)
    else:
        numbers = sorted(set(_row_numbers(rows, n)))
        placed = placed.join(
            _wanted_rows(df, numbers, pos).select(pos, F.lit(True).alias("__hit")), pos, "left"
        )
        hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = {c: F.when(hit, F.lit(v).cast(types[c])).otherwise(to_col(c)) for c, v in zip(names, per_column)}
    shown = [c for c in placed.columns if c != "__hit"]
    return placed.select(*[out[c].alias(c) if c in out else to_col(c) for c in shown])


def head(df: DataFrame, n: int = 5, row_key=None) -> DataFrame:
    """The first n rows in key order."""
    keys = as_list(row_key)
    return (df.orderBy(*[to_col(k) for k in keys]) if keys else df).limit(n)


# -- report ----------------------------------------------------------------------------------------


def info(df: DataFrame) -> DataFrame:
    """Per column its index, name and type, the rows of the table and the column's non-missing cells."""
    counts = nan_to_null(df).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(to_col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(i).alias("idx"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col("rows"),
                F.col(f"c{i}").alias("non_missing"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.inline(per_column))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)

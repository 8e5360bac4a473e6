"""Small column helpers shared by the operators."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

ColumnLike = Column | str


def as_list(value) -> list:
    if value is None:
        return []
    if isinstance(value, (list, tuple)):
        return list(value)
    return [value]


def to_col(value: ColumnLike) -> Column:
    return F.col(quoted(value)) if isinstance(value, str) else value


def quoted(name: str) -> str:
    """A column name that may hold dots or be a number, as ``load_delimited`` makes them."""
    return "`" + name.replace("`", "``") + "`"


def resolve(df: DataFrame, key) -> list[str]:
    """Column names for a name, an index (negatives count from the end), a slice of indexes, or a list of these."""
    names = df.columns
    out = []
    for item in as_list(key):
        if isinstance(item, slice):
            out += names[item]
            continue
        if isinstance(item, bool) or not isinstance(item, (int, str)):
            raise TypeError(f"a column is given by name, index or slice, got {item!r}")
        if isinstance(item, int):
            if not -len(names) <= item < len(names):
                raise IndexError(f"column index {item} is outside 0..{len(names) - 1}")
            out.append(names[item])
        elif item in names:
            out.append(item)
        else:
            raise KeyError(f"no column {item!r}; there are {names}")
    return out


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN turned into NULL, so aggregates skip it."""
    c = to_col(name)
    return F.when(~F.isnan(c), c) if is_floating(dtype) else c


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    wanted = set(df.columns if cols is None else cols)
    return df.select(
        *[
            present(f.name, f.dataType).alias(f.name) if f.name in wanted else to_col(f.name)
            for f in df.schema.fields
        ]
    )


def feature(name: str) -> Column:
    """A model input as DOUBLE; a missing one fails the job, as models define no value for it."""
    c = to_col(name).cast("double")
    return F.when(c.isNotNull() & ~F.isnan(c), c).otherwise(
        F.raise_error(F.lit(f"missing value in model column {name}; repair it first")).cast("double")
    )


def literal_table(rows: Sequence, ddl: str) -> Column:
    """A bounded table held by the driver, as one constant.

    It travels as a single JSON literal, which the optimizer folds into an array object, so
    thousands of entries cost neither thousands of expressions nor a join.
    """
    return F.from_json(F.lit(json.dumps(rows)), ddl)


def double_array(values: Sequence[float]) -> Column:
    """``repr`` keeps every bit of a double, and the cast reads it back exactly."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def long_array(values: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>")


def stacked(df: DataFrame, values: Sequence[Column], extra: Sequence[Column] = ()) -> DataFrame:
    """Several columns under each other in one scan: ``i`` says which, and its cell is in ``c<i>``; missing cells are left out."""
    wide = df.select(*extra, *[v.alias(f"c{i}") for i, v in enumerate(values)])
    kinds = {f.name: f.dataType for f in wide.schema.fields}

    def row(i: int) -> Column:
        cells = [F.col(c) if c == f"c{i}" else F.lit(None).cast(kinds[c]) for c in (f"c{j}" for j in range(len(values)))]
        return F.when(F.col(f"c{i}").isNotNull(), F.struct(F.lit(i).alias("i"), *[x.alias(f"c{j}") for j, x in enumerate(cells)]))

    rest = wide.columns[: len(wide.columns) - len(values)]
    rows = F.filter(F.array(*[row(i) for i in range(len(values))]), lambda r: r.isNotNull())
    return wide.select(*[to_col(c) for c in rest], F.inline(rows))


def distinct_values(df: DataFrame, values: Sequence[Column], most: int) -> list[list] | None:
    """The sorted distinct values of each column, found in one scan; None if any has more than ``most``.

    A task drops what it has seen before, and sends ``most + 1`` values of a column at most.
    """
    wide = df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)])
    schema = T.StructType([T.StructField("i", T.IntegerType()), *[T.StructField(f.name, f.dataType) for f in wide.schema.fields]])

    def unseen(batches):
        kept = {}
        for batch in batches:
            if batch.num_rows:
                for i, column in enumerate(batch.columns):
                    if i not in kept or len(kept[i]) <= most:
                        new = column.unique() if i not in kept else pa.concat_arrays([kept[i], column.unique()]).unique()
                        kept[i] = new.drop_null()[: most + 1]
        for i, found in kept.items():
            number = pa.array([i] * len(found), pa.int32())
            others = [found if j == i else pa.nulls(len(found), kept[j].type) for j in sorted(kept)]
            yield pa.RecordBatch.from_arrays([number, *others], ["i", *[f"c{j}" for j in sorted(kept)]])

    rows = wide.mapInArrow(unseen, schema).distinct().limit((most + 1) * len(values)).collect()
    out: list[list] = [[] for _ in values]
    for r in rows:
        out[r["i"]].append(r[f"c{r['i']}"])
    # if rows were left out, one of the columns has more than most
    return None if any(len(x) > most for x in out) else [sorted(x) for x in out]


def constant_array(values: Sequence) -> Column:
    """Values of one kind as one constant; text and numbers travel as one literal, other kinds as an array of literals."""
    if values and all(isinstance(v, str) for v in values):
        return F.from_json(F.lit(json.dumps(list(values))), "array<string>")
    if values and all(isinstance(v, int) and not isinstance(v, bool) and -(2**63) <= v < 2**63 for v in values):
        wide = any(not -(2**31) <= v < 2**31 for v in values)
        return F.from_json(F.lit(json.dumps(list(values))), "array<bigint>" if wide else "array<int>")
    if values and all(isinstance(v, float) and math.isfinite(v) for v in values):
        return double_array(values)
    return F.array(*[F.lit(v) for v in values])


def search_bucket(df: DataFrame, probe: Column, bounds, depth: int, out: str) -> DataFrame:
    """``out`` = how many of the ``2**depth - 1`` sorted bounds are at or below ``probe``.

    ``bounds(i)`` gives the i-th bound (0-based) as a column. A binary search is unrolled into ``depth``
    projections, each reading the last one's result, so it stays in generated code and needs no join.
    """
    df = df.withColumn(out, F.lit(0))
    for step in reversed(range(depth)):
        jump = 1 << step
        df = df.withColumn(
            out,
            F.when(probe >= bounds(F.col(out) + (jump - 1)), F.col(out) + jump).otherwise(F.col(out)),
        )
    return df

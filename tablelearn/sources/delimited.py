"""Delimited text (S1) and schema declaration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import to_col
from ..functions.typing import cast_columns, infer_types, normalise_missing


def load_delimited(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    sep: str = ",",
    infer: bool = True,
    narrow_floats: bool = False,
) -> DataFrame:
    """Read separated text without quoting or escaping: a line is trimmed, then split at each separator.

    Any path Spark reads works: files, folders, globs, object stores. Without a header the columns are named by
    their position. A row of another width fails the read. With ``infer`` each column gets its narrowest type;
    that costs one aggregate pass, so a caller who knows the types turns it off and uses ``declare_schema``.
    """
    df = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .option("inferSchema", False)
        .option("columnPruning", False)  # else a row of another width passes where not all columns are asked for
        .csv(path)
    )
    if header:
        first = spark.read.text(path).where(F.trim("value") != "").first()
        given = [x.strip() for x in first[0].strip().split(sep)] if first else []
        if len(set(given)) < len(given):  # Spark has renamed them by now
            raise ValueError(f"duplicate column names in {given}")
        names = [n.strip() if i in (0, len(df.columns) - 1) else n for i, n in enumerate(df.columns)]
    else:
        names = [str(i) for i in range(len(df.columns))]
    if len(set(names)) < len(names):
        raise ValueError(f"duplicate column names in {names}")
    df = df.toDF(*names)
    # trimming the line touches the outer edges of its first and last cell only
    edges = {names[0]: F.ltrim, names[-1]: F.rtrim}
    if len(names) == 1:
        edges = {names[0]: F.trim}
    df = df.select(*[edges[n](to_col(n)).alias(n) if n in edges else to_col(n) for n in names])
    df = normalise_missing(df)
    return cast_columns(df, infer_types(df, narrow_floats=narrow_floats)) if infer else df


def declare_schema(
    df: DataFrame,
    columns: list[str] | None = None,
    dtypes: list | str | T.DataType | None = None,
) -> DataFrame:
    """Name and type a table. One type serves every column; a missing one (None) is inferred."""
    width = len(df.columns)
    if width == 0:
        raise ValueError("a table needs at least one column")
    if columns is not None and len(columns) != width:
        raise ValueError(f"{len(columns)} names for {width} columns")
    if columns is not None and len(set(columns)) < width:
        raise ValueError(f"duplicate column names in {columns}")
    if dtypes is not None and not isinstance(dtypes, (list, tuple)):
        dtypes = [dtypes] * width
    if dtypes is not None and len(dtypes) != width:
        raise ValueError(f"{len(dtypes)} types for {width} columns")
    if df.isEmpty():
        raise ValueError("the table has no rows")
    named = df.toDF(*(columns or [str(i) for i in range(width)]))
    given = {c: t for c, t in zip(named.columns, dtypes or [None] * width) if t is not None}
    named = normalise_missing(named)
    free = [c for c in named.columns if c not in given]
    if free:
        given.update(infer_types(named, free))
    return cast_columns(named, given)

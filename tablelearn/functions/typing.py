"""Empty-cell normalisation, type inference and narrowing, casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .columns import is_numeric, quoted, to_col

# The tokens read as a missing cell.
MISSING_TOKENS = ("", "nan")

# Fixed values: (name, smallest, largest, Spark type), tried in this order; the first that holds the range wins.
INTEGER_RANGES = (
    ("uint8", 0, 2**8 - 1, "smallint"),
    ("uint16", 0, 2**16 - 1, "int"),
    ("uint32", 0, 2**32 - 1, "bigint"),
    ("uint64", 0, 2**64 - 1, "decimal(20,0)"),
    ("int8", -(2**7), 2**7 - 1, "tinyint"),
    ("int16", -(2**15), 2**15 - 1, "smallint"),
    ("int32", -(2**31), 2**31 - 1, "int"),
    ("int64", -(2**63), 2**63 - 1, "bigint"),
)

# A number in text: what Spark's own casts read besides (suffixes as in 1d, hexadecimal floats) is no number here.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"

FLOAT32_MAX = 3.4028234663852886e38
EXACT_INTEGER_LIMIT = 2**53


def normalise_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The tokens ``""`` and ``"nan"`` in text columns, and NaN in floating columns, become NULL."""
    wanted = set(df.columns if cols is None else cols)

    def repaired(field: T.StructField):
        c = to_col(field.name)
        if field.name not in wanted:
            return c
        if isinstance(field.dataType, T.StringType):
            return F.when(~F.lower(F.trim(c)).isin(*MISSING_TOKENS), c).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(field.name)
        return c

    return df.select(*[repaired(f) for f in df.schema.fields])


def infer_types(df: DataFrame, cols: list[str] | None = None, narrow_floats: bool = False) -> dict[str, str]:
    """The narrowest type of each text or numeric column, from one aggregate over all of them."""
    wanted = set(df.columns if cols is None else cols)
    fields = [
        f for f in df.schema.fields if f.name in wanted and (isinstance(f.dataType, T.StringType) or is_numeric(f))
    ]
    if not fields:
        return {}
    clean = normalise_missing(df.select(*[to_col(f.name) for f in fields]))
    aggs = []
    for i, f in enumerate(fields):
        as_double = F.expr(f"try_cast({quoted(f.name)} AS DOUBLE)")
        if isinstance(f.dataType, T.StringType):
            as_double = F.when(to_col(f.name).rlike(NUMBER), as_double)
        aggs += [
            F.count(to_col(f.name)).alias(f"cells{i}"),
            F.count(as_double).alias(f"numbers{i}"),
            F.min(as_double).alias(f"low{i}"),
            F.max(as_double).alias(f"high{i}"),
            F.bool_and(as_double % 1 == 0).alias(f"integral{i}"),
        ]
    row = clean.agg(*aggs).first()

    def whole(i: int) -> bool:
        return 0 < row[f"cells{i}"] == row[f"numbers{i}"] and bool(row[f"integral{i}"])

    def wide(i: int) -> bool:
        return max(abs(row[f"low{i}"]), abs(row[f"high{i}"])) > EXACT_INTEGER_LIMIT

    # doubles tell such numbers only roughly, so their ends are found once more as decimals
    exact = {}
    rough = [i for i in range(len(fields)) if whole(i) and wide(i)]
    if rough:
        decimals = {i: F.expr(f"try_cast({quoted(fields[i].name)} AS DECIMAL(38,0))") for i in rough}
        ends = clean.agg(
            *[agg(d).alias(f"{n}{i}") for i, d in decimals.items() for n, agg in (("n", F.count), ("lo", F.min), ("hi", F.max))]
        ).first()
        exact = {i: (ends[f"n{i}"], ends[f"lo{i}"], ends[f"hi{i}"]) for i in rough}

    out = {}
    for i, f in enumerate(fields):
        if row[f"cells{i}"] == 0:
            out[f.name] = f.dataType.simpleString()
        elif row[f"numbers{i}"] < row[f"cells{i}"]:
            out[f.name] = "string"
        elif whole(i):
            count, low, high = exact.get(i, (row[f"cells{i}"], row[f"low{i}"], row[f"high{i}"]))
            if count < row[f"cells{i}"]:  # beyond any decimal
                out[f.name] = f.dataType.simpleString()
                continue
            out[f.name] = next(
                (spark for _, least, most, spark in INTEGER_RANGES if least <= int(low) and int(high) <= most),
                "decimal(38,0)",
            )
        elif narrow_floats and max(abs(row[f"low{i}"]), abs(row[f"high{i}"])) <= FLOAT32_MAX:
            out[f.name] = "float"
        else:
            out[f.name] = "double"
    return out


def cast_columns(df: DataFrame, types: dict[str, str | T.DataType] | T.StructType | str) -> DataFrame:
    """Explicit types for some columns, or for all through a schema; a bad cell fails the job. So does text with a
    fraction, such as "3.7", for an integer type."""
    if isinstance(types, str):
        types = T.StructType.fromDDL(types)
    if isinstance(types, T.StructType):
        types = {f.name: f.dataType for f in types.fields}
    unknown = set(types) - set(df.columns)
    if unknown:
        raise KeyError(f"no columns {sorted(unknown)}")

    integer_names = {"tinyint", "smallint", "int", "bigint"}

    def cast(field: T.StructField):
        target = types.get(field.name)
        if target is None:
            return to_col(field.name)
        name = target if isinstance(target, str) else target.simpleString()
        c = to_col(field.name)
        if isinstance(field.dataType, T.StringType) and (name in integer_names or name in ("float", "double") or name.startswith("decimal")):
            bad = F.raise_error(F.concat(F.lit(f"column {field.name}: not a {name}: "), c))
            number = F.when(c.rlike(NUMBER), c).when(c.isNotNull(), bad.cast("string"))
            if name not in integer_names:
                return number.cast(target).alias(field.name)
            # text such as "3.0" or "1e5" is a whole number, but no integer literal
            whole = number.cast("decimal(38,18)")
            return F.when(whole % 1 == 0, whole.cast(name)).when(whole.isNotNull(), bad.cast(name)).alias(field.name)
        return c.cast(target).alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def infer_and_cast(df: DataFrame, cols: list[str] | None = None, narrow_floats: bool = False) -> DataFrame:
    """T1 then T2 then T3."""
    clean = normalise_missing(df, cols)
    return cast_columns(clean, infer_types(clean, cols, narrow_floats))


def to_common_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """T4: the given columns share one numeric type, DOUBLE."""
    return cast_columns(df, {c: "double" for c in cols})


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric(f)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f)]

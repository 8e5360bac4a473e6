"""One-hot and ordinal encoders and their reverse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, distinct_values, stacked, to_col
from ..session import dropped, written
from .position import positional

# A missing text cell is a category of its own, under this name.
MISSING_LABEL = "nan"

UNSEEN_RULES = ("error", "zero")

# What an entry of a dictionary takes besides its text, and how much of a large dictionary may be broadcast.
ENTRY_BYTES = 40
HOT_BYTES = 8 * 2**20


def category(df: DataFrame, name: str) -> Column:
    """The column as a category: a missing text cell is the category "nan"."""
    c = to_col(name)
    return F.coalesce(c, F.lit(MISSING_LABEL)) if isinstance(df.schema[name].dataType, T.StringType) else c


def _unseen(name: str, value: Column, dtype: str) -> Column:
    return F.raise_error(
        F.concat(F.lit(f"unseen value in column {name}: "), F.coalesce(value.cast("string"), F.lit("NULL")))
    ).cast(dtype)


class OneHotEncoder(TableEstimator):
    """One 0/1 column per class, classes in ascending order, named ``column_value``.

    The classes become columns, so their number is bounded by ``max_categories`` per column, and more is an error.
    """

    def __init__(self, input_cols, max_categories: int = 1000, unseen: str = "error", drop_input: bool = True):
        super().__init__()
        if unseen not in UNSEEN_RULES:
            raise ValueError(f"unseen is one of {UNSEEN_RULES}")
        self.input_cols = as_list(input_cols)
        self.max_categories = max_categories
        self.unseen = unseen
        self.drop_input = drop_input

    def _fit(self, dataset: DataFrame) -> "OneHotModel":
        classes = distinct_values(dataset, [category(dataset, c) for c in self.input_cols], self.max_categories)
        if classes is None:
            raise ValueError(f"a column of {self.input_cols} has more than {self.max_categories} classes; use OrdinalEncoder")
        params = {
            "input_cols": self.input_cols,
            "target_cols": [],
            "unseen": self.unseen,
            "drop_input": self.drop_input,
            "types": [dataset.schema[c].dataType.simpleString() for c in self.input_cols],
        }
        return OneHotModel(params, {"classes": classes})


class OneHotModel(TableModel):
    def flat_names(self) -> list[str]:
        """The names of all code columns in order."""
        return [f"{c}_{v}" for c, values in zip(self.input_cols, self.state["classes"]) for v in values]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cells = []
        for c, values in zip(self.input_cols, self.state["classes"]):
            v = category(dataset, c)
            for i, known in enumerate(values):
                code = F.when(v == F.lit(known), 1).otherwise(0)
                if i == 0 and self.params_["unseen"] == "error":
                    # one check per column is enough to fail the job
                    code = F.when(v.isin(values), code).otherwise(_unseen(c, to_col(c), "int"))
                cells.append(code.alias(f"{c}_{known}"))
        kept = [x for x in dataset.columns if not (self.params_["drop_input"] and x in self.input_cols)]
        return dataset.select(*[to_col(x) for x in kept], *cells)

    def translate(self, df: DataFrame) -> DataFrame:
        """Codes back to values; a row must have exactly one 1 per encoded column."""
        names = set(self.flat_names())
        out = []
        for c, values, dtype in zip(self.input_cols, self.state["classes"], self.params_["types"]):
            codes = [to_col(f"{c}_{v}") for v in values]
            ones = sum((F.when(code == 1, 1).otherwise(0) for code in codes[1:]), F.when(codes[0] == 1, 1).otherwise(0))
            value = F.coalesce(*[F.when(code == 1, F.lit(v)) for code, v in zip(codes, values)])
            value = F.when(ones == 1, value).otherwise(
                F.raise_error(F.lit(f"not exactly one code is set for column {c}")).cast(dtype)
            )
            if dtype == "string":
                value = F.nullif(value, F.lit(MISSING_LABEL))
            out.append(value.cast(dtype).alias(c))
        return df.select(*[to_col(x) for x in df.columns if x not in names], *out)


class OrdinalEncoder(TableEstimator):
    """Each distinct value becomes its rank among the sorted distinct values.

    The dictionary is a table, so it may be larger than a driver. It is written to the shared folder once, for all
    columns, as it is read at every use. Up to ``broadcast_bytes`` it is broadcast. Beyond that the rows whose value is among the most
    frequent ones use a small broadcast part, as one value may fill a large share of the rows, and only the rest
    are shuffled to the dictionary.
    """

    def __init__(self, input_cols, output_cols=None, broadcast_bytes: int = 32 * 2**20, hot_values: int = 1000):
        super().__init__()
        self.input_cols = as_list(input_cols)
        self.output_cols = as_list(output_cols) or self.input_cols
        if len(self.output_cols) != len(self.input_cols):
            raise ValueError("one output column per input column")
        self.broadcast_bytes = broadcast_bytes
        self.hot_values = hot_values

    def _fit(self, dataset: DataFrame) -> "OrdinalModel":
        # the values of all columns are counted in one grouping and numbered in one ranking, by column and value
        cells = [f"c{i}" for i in range(len(self.input_cols))]
        counts = stacked(dataset, [category(dataset, c) for c in self.input_cols]).groupBy("i", *cells).agg(F.count(F.lit(1)).alias("n"))
        counted = written(counts, "values")
        ranked = written(positional(counted, ["i", *cells], pos="place"), "dictionary")
        dropped(counted)
        weights = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cells]
        weight = reduce(lambda a, b: a + b, weights) + ENTRY_BYTES
        summary = {r["i"]: r for r in ranked.groupBy("i").agg(F.sum(weight).alias("b"), F.min("place").alias("first")).collect()}
        tables, sizes, hot = {}, [], []
        for i, c in enumerate(cells):
            found = summary.get(i, {"b": 0, "first": 0})
            own = ranked.filter(F.col("i") == i).select(F.col(c).alias("value"), "n", (F.col("place") - found["first"]).alias("code"))
            tables[f"values_{i}"] = own
            sizes.append(int(found["b"]))
            own_weight = F.octet_length(F.col("value").cast("string")) + ENTRY_BYTES
            hot.append(self._hot_codes(own.withColumn("weight", own_weight)) if sizes[-1] > self.broadcast_bytes else [])
        params = {
            "input_cols": self.input_cols,
            "output_cols": self.output_cols,
            "target_cols": [],
            "broadcast_bytes": self.broadcast_bytes,
        }
        return OrdinalModel(params, {"bytes": sizes, "hot": hot}, tables)

    def _hot_codes(self, weighed: DataFrame) -> list[int]:
        """The codes of the most frequent values, as many as fit a broadcast."""
        top = weighed.select("code", "n", "weight").orderBy(F.desc("n"), "code").limit(self.hot_values).collect()
        out, left = [], HOT_BYTES
        for r in top:
            if r["weight"] <= left:
                out.append(r["code"])
                left -= r["weight"]
        return out


class OrdinalModel(TableModel):
    row_local = False

    def dictionary(self, column: str) -> DataFrame:
        return self.tables[f"values_{self.input_cols.index(column)}"].select("value", "code")

    def _looked_up(self, df: DataFrame, i: int, probe: Column, key: str, found: str) -> DataFrame:
        """``df`` with ``found``, the dictionary's other column where ``key`` equals ``probe``, or NULL."""
        table = self.tables[f"values_{i}"]
        pair = table.select(F.col(key).alias("__key"), F.col("code" if key == "value" else "value").alias(found))
        probed = df.withColumn("__probe", probe)
        on = F.col("__probe") == F.col("__key")
        if self.state["bytes"][i] <= self.params_["broadcast_bytes"]:
            return probed.join(F.broadcast(pair), on, "left").drop("__probe", "__key")
        hot = table.filter(F.col("code").isin(self.state["hot"][i])).select(
            F.col(key).alias("__hot_key"), F.col("code" if key == "value" else "value").alias("__hot")
        )
        split = probed.join(F.broadcast(hot), F.col("__probe") == F.col("__hot_key"), "left")
        quick = split.filter(F.col("__hot_key").isNotNull() | F.col("__probe").isNull())
        slow = split.filter(F.col("__hot_key").isNull() & F.col("__probe").isNotNull())
        out = [to_col(c) for c in df.columns]
        return quick.select(*out, F.col("__hot").alias(found)).unionByName(
            slow.join(pair, on, "left").select(*out, F.col(found))
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        for i, (c, out) in enumerate(zip(self.input_cols, self.params_["output_cols"])):
            v = category(df, c)
            df = self._looked_up(df, i, v, "value", "__code")
            code = F.when(F.col("__code").isNotNull(), F.col("__code")).otherwise(_unseen(c, v, "bigint"))
            df = df.withColumn(out, code).drop("__code")
        return df

    def translate(self, df: DataFrame) -> DataFrame:
        """Codes back to values."""
        for i, (c, out) in enumerate(zip(self.input_cols, self.params_["output_cols"])):
            dtype = self.tables[f"values_{i}"].schema["value"].dataType
            code = to_col(out).cast("bigint")
            df = self._looked_up(df, i, code, "code", "__value")
            value = F.when(F.col("__value").isNotNull(), F.col("__value")).otherwise(
                _unseen(out, code, dtype.simpleString())
            )
            if isinstance(dtype, T.StringType):
                value = F.nullif(value, F.lit(MISSING_LABEL))
            df = df.withColumn(c, value).drop("__value")
        return df

"""Exact k nearest neighbours (K-NN1 to K-NN4) as a pruned, block-wise join.

No pair of rows is emitted unless it is among a block's k nearest. The training rows lie in the cells of a metric index (see
``cells``). The rows nearest to a pivot bound how far a query's k-th neighbour can be, and by the triangle inequality a query
needs only the cells that reach into that radius; it meets those and no others (after Lu, Shen, Chen and Ooi, "Efficient
Processing of k Nearest Neighbor Joins using MapReduce", VLDB 2012). Large cells are cut on both sides, so a cell that
holds a third of all rows is many tasks. Within a tile of both numpy keeps the k best per query, and a last grouping merges the
tiles. The result is exact and complete whatever the pivots are; they only decide how much work is saved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, feature, to_col
from .cells import Cells, Tile, ask, build, from_numbers, index_numbers, matrix, tiles

BLOCK_BYTES = 32 * 2**20
BLOCK_ROWS = 50_000
MAX_TASKS = 20_000


def feature_vector(df: DataFrame, cols: list[str]) -> Column:
    """The inputs as one array of DOUBLE; a single array column is taken as it is, one of FLOAT as such."""
    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, T.ArrayType):
        kind = "array<float>" if isinstance(df.schema[cols[0]].dataType.elementType, T.FloatType) else "array<double>"
        c = to_col(cols[0]).cast(kind)
        return F.when(c.isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x)), c).otherwise(
            F.raise_error(F.lit(f"missing value in model column {cols[0]}; repair it first")).cast(kind)
        )
    return F.array(*[feature(c) for c in cols])


def nearest_neighbours(
    train: DataFrame,
    queries: DataFrame,
    input_cols,
    k: int = 5,
    train_key: str = "id",
    query_key: str = "id",
    exclude_self: bool = False,
    payload: str | None = None,
    pivots: int | None = None,
    train_block: int | None = None,
    query_block: int | None = None,
    index: Cells | None = None,
) -> DataFrame:
    """``(query, neighbour, distance, rank[, payload])`` for the k nearest training rows of every query.

    Euclidean; ties go to the smaller key. ``exclude_self`` leaves out the training row with the query's own key.
    Keys are unique. Fewer than k training rows give fewer neighbours. ``index`` is that of ``train``, where it is built already.
    ``train_block`` and ``query_block`` are the most rows that are compared at once.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    cols = as_list(input_cols)
    s = indexable(train, cols, train_key, payload)
    q = queries.select(to_col(query_key).alias("q_key"), feature_vector(queries, cols).alias("q_vec"))
    q_type, s_type = dict(q.dtypes)["q_key"], dict(s.dtypes)["s_key"]
    names = f"query {q_type}, neighbour {s_type}, distance double, rank int" + (
        f", payload {dict(s.dtypes)['payload']}" if payload else ""
    )
    need = k + (1 if exclude_self else 0)  # a query's own row may be among the nearest to a pivot
    if index is None:
        index = index_of(s, need, pivots)
    if index is None:
        return train.sparkSession.createDataFrame([], names)
    fits = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, index.width))))
    train_block, query_block = train_block or fits, query_block or max(1, fits // 5)
    sc = train.sparkSession.sparkContext
    left, right, n = tiles(index, ask(index, q, need), sc.defaultParallelism)
    spec = sc.broadcast(index_numbers(index))

    fields = f"q_key {q_type}, s_key {s_type}, distance double" + (f", payload {dict(s.dtypes)['payload']}" if payload else "")

    def best(train_part: pa.Table, query_part: pa.Table) -> pa.Table:
        taken = {"q_key": query_part.column("q_key"), "s_key": train_part.column("s_key")}
        taken |= {"payload": train_part.column("payload")} if payload else {}
        who, at, how_far = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if train_part.num_rows and query_part.num_rows:
            keys = train_part.column("s_key").to_pandas()
            order = np.empty(len(keys), int)  # of the keys, as ties fall to the smaller one
            order[keys.reset_index(drop=True).sort_values(kind="stable").index.to_numpy()] = np.arange(len(keys))
            cell = train_part.column("cell").to_numpy()
            sort = np.lexsort((order, cell))
            home = query_part.column("home").to_numpy()
            tile = Tile(
                from_numbers(spec.value), cell[sort], keys.to_numpy()[sort], order[sort], matrix(train_part.column("s_vec"))[sort],
                query_part.column("q_key").to_pandas().to_numpy(), matrix(query_part.column("q_vec")),
                query_part.column("bound").to_numpy(), k, exclude_self, train_block, query_block,
            )
            who, at, how_far = tile.found(home)
            at = sort[at]
        places = {"q_key": who, "s_key": at, "payload": at}
        columns = {c: v.take(pa.array(places[c])) for c, v in taken.items()}
        names = ["q_key", "s_key", "distance"] + (["payload"] if payload else [])
        return pa.table({c: columns[c] if c in columns else pa.array(how_far) for c in names})

    # tiles are few bytes and much work, so their number, not their size, sets the tasks
    tasks = min(MAX_TASKS, max(1, 2 * n))
    left, right = left.repartition(tasks, "tile"), right.repartition(tasks, "tile")
    partial = left.groupBy("tile").cogroup(right.groupBy("tile")).applyInArrow(best, fields)
    order = Window.partitionBy("q_key").orderBy("distance", "s_key")
    return (
        partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select(
            F.col("q_key").alias("query"), F.col("s_key").alias("neighbour"), "distance", "rank",
            *(["payload"] if payload else []),
        )
    )


def indexable(train: DataFrame, cols: list[str], key: str, payload: str | None) -> DataFrame:
    return train.select(
        to_col(key).alias("s_key"), feature_vector(train, cols).alias("s_vec"), *([to_col(payload).alias("payload")] if payload else [])
    )


def index_of(s: DataFrame, need: int, pivots: int | None = None) -> Cells | None:
    """The metric index of rows (s_key, s_vec, ...), to be asked for ``need`` neighbours at most; None for no rows."""
    size = s.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("s_vec")).alias("width")).first()
    if size["n"] == 0:
        return None
    index = build(s, size["n"], size["width"], need, pivots)
    index.width = size["width"]
    return index


class _NearestEstimator(TableEstimator):
    """Fitting keeps the training table, and writes its metric index once it is asked; all further questions use that.

    ``row_key`` identifies rows on both sides. With ``exclude_self`` a scored row never counts itself, found by key.
    """

    vote = "class"

    def __init__(self, input_cols, target_cols, row_key: str, k: int = 5, exclude_self: bool = False):
        super().__init__()
        self.input_cols = as_list(input_cols)
        self.target_cols = as_list(target_cols)
        if len(self.target_cols) != 1:
            raise ValueError("nearest neighbours take one target")
        self.row_key = row_key
        self.k = k
        self.exclude_self = exclude_self

    def _fit(self, dataset: DataFrame) -> "NearestModel":
        kept = dataset.select(*[to_col(c) for c in dict.fromkeys([self.row_key, *self.input_cols, *self.target_cols])])
        params = {
            "input_cols": self.input_cols,
            "target_cols": self.target_cols,
            "row_key": self.row_key,
            "k": self.k,
            "exclude_self": self.exclude_self,
            "vote": self.vote,
        }
        return NearestModel(params, {}, {"train": kept})


class KNNClassifier(_NearestEstimator):
    """K-NN2: the most frequent target among the neighbours, the smallest on ties."""


class KNNRegressor(_NearestEstimator):
    """K-NN3 and K-NN4: the mean or the median of the neighbours' targets."""

    def __init__(self, input_cols, target_cols, row_key: str, k: int = 5, strategy: str = "mean", exclude_self: bool = False):
        if strategy not in ("mean", "median"):
            raise ValueError("strategy is mean or median")
        super().__init__(input_cols, target_cols, row_key, k, exclude_self)
        self.strategy = strategy

    @property
    def vote(self) -> str:
        return self.strategy


class NearestModel(TableModel):
    row_local = False

    def with_k(self, k: int) -> "NearestModel":
        """The same fitted table with another number of neighbours; nothing is fitted anew."""
        if k < 1:
            raise ValueError("k is at least 1")
        model = NearestModel({**self.params_, "k": k}, self.state, self.tables)
        model._index = self._index  # shared: a list of what was built so far
        return model

    def __init__(self, params, state, tables=None):
        super().__init__(params, state, tables)
        self._index: list[tuple[int, Cells | None]] = []

    def index(self, need: int) -> Cells | None:
        """The training table's index, built at the first question and again only for one that needs more neighbours."""
        if not self._index or self._index[-1][0] < need:
            s = indexable(self.tables["train"], self.input_cols, self.params_["row_key"], self.target_cols[0])
            self._index.append((need, index_of(s, need)))
        return self._index[-1][1]

    def neighbours(self, df: DataFrame) -> DataFrame:
        p = self.params_
        return nearest_neighbours(
            self.tables["train"], df, self.input_cols, p["k"], p["row_key"], p["row_key"], p["exclude_self"], self.target_cols[0],
            index=self.index(p["k"] + (1 if p["exclude_self"] else 0)),
        )

    def predictions(self, df: DataFrame) -> DataFrame:
        """``(query, prediction)``."""
        found = self.neighbours(df)
        if self.params_["vote"] == "class":
            votes = found.groupBy("query", "payload").agg(F.count(F.lit(1)).alias("n"))
            best = F.min(F.struct((-F.col("n")).alias("n"), F.col("payload").alias("label")))
            return votes.groupBy("query").agg(best.alias("b")).select("query", F.col("b.label").alias("prediction"))
        y = F.col("payload").cast("double")
        # at most k values per query
        value = F.avg(y) if self.params_["vote"] == "mean" else F.percentile(y, F.lit(0.5))
        return found.groupBy("query").agg(value.alias("prediction"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = self.predictions(dataset).withColumnRenamed("query", "__query")
        return dataset.join(scored, to_col(self.params_["row_key"]) == F.col("__query"), "left").drop("__query")

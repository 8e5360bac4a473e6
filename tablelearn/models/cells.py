"""A metric index: rows in cells around pivots, and pivots around pivots of their own.

There is about one pivot for every ``ROWS_PER_CELL`` rows, so cells don't grow with the table; pivots are limited only by what they
take in memory. They hang below a few top pivots, and both a row's cell and the cells that a query needs are found by way of
these. Which rows a cell holds doesn't matter for the result: what is known of a cell is the least and greatest distance of its
rows to its pivot, and by the triangle inequality that tells whether it can hold a neighbour.

Distances to pivots come from matrix products, which lose some digits. All bounds are widened by what can get lost.

Queries meet rows in tiles: a group of queries that lie in neighbouring cells, and a bin of neighbouring cells. A row is sent once to
a tile, however many of its queries need the row's cell, and a query once, however many of its cells are there. So what is sent
depends on the number of tiles, and that on their size in bytes and on the cores; inside a tile every query still looks at
the cells it needs only, and in these at the parts around points of their own that may hold something nearer than what was found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.position import lowest_hashes, shuffle_hash
from ..session import written

ROWS_PER_CELL = 2_000
PIVOT_BYTES = 64 * 2**20
# A distance from a matrix product is off by less than this share of the points' size.
LOST = 1e-6
# A side of a tile has at most so many bytes of coordinates, and there are so many tiles for a core, where rows suffice.
TILE_BYTES = 64 * 2**20
TILE_ROWS = 2**17
TILES_PER_CORE = 4
SMALL_GROUP = 200
# Cells of more rows are looked at in parts, unless queries need most of them.
UNDIVIDED = 128
MOST_PARTS = 0.3
# Distances at once: a matrix of these stays in a core's cache.
BLOCK_CELLS = 500_000


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared distances of all rows of ``a`` to all rows of ``b``, up to rounding."""
    out = a @ b.T
    out *= -2
    out += (a * a).sum(axis=1)[:, None]
    out += (b * b).sum(axis=1)[None, :]
    return np.maximum(out, 0, out=out)


def pivots_for(rows: int, width: int) -> int:
    return max(1, min(rows // ROWS_PER_CELL, PIVOT_BYTES // (8 * max(1, width))))


@dataclass
class Cells:
    """``rows``: s_key, s_vec, payload, cell. The arrays have an entry a cell; ``near`` the distances of its innermost rows."""

    rows: DataFrame
    pivots: np.ndarray
    parent: np.ndarray
    top: np.ndarray
    centre: np.ndarray
    counts: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    near: list[np.ndarray] | None = None
    width: int = 1

    def __len__(self) -> int:
        return len(self.counts)

    def children(self) -> list[np.ndarray]:
        return [np.flatnonzero(self.parent == t) for t in range(len(self.top))]

    def locate(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each point, by way of its nearest top pivot, and the distance to the cell's pivot."""
        points = points - self.centre
        above = squares(points, self.top).argmin(axis=1)
        cell, reach = np.empty(len(points), np.int32), np.empty(len(points))
        for t, below in enumerate(self.children()):
            at = np.flatnonzero(above == t)
            if len(at):
                d = squares(points[at], self.pivots[below])
                best = d.argmin(axis=1)
                cell[at], reach[at] = below[best], np.sqrt(d[np.arange(len(at)), best])
        return cell, reach

    def slack(self, points: np.ndarray) -> np.ndarray:
        """By how much distances of (centred) points to pivots may be off."""
        return LOST * (np.sqrt((points * points).sum(axis=1)) + np.sqrt((self.pivots**2).sum(axis=1).max()) + 1e-3)

    def bounds(self, points: np.ndarray, need: int) -> np.ndarray:
        """How far the ``need``-th nearest row of each point is at most."""
        points = points - self.centre
        return self._bounds(points, np.sqrt(squares(points, self.top)), self.children(), need) + self.slack(points)

    @cached_property
    def hulls(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The cells below each top pivot that have rows, and how far a row of theirs lies from it at most: no farther than the
        cell's own pivot and its reach together."""
        below = [c[self.counts[c] > 0] for c in self.children()]
        return below, np.array([max((np.sqrt(((self.pivots[cs] - self.top[t]) ** 2).sum(axis=1)) + self.high[cs]), default=-np.inf) for t, cs in enumerate(below)])

    def wanted(self, points: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) pairs: the cells that may hold a row within a point's bound."""
        if len(self) == 1:
            return np.arange(len(points)), np.zeros(len(points), np.int64)
        points = points - self.centre
        limit = bound + self.slack(points)
        to_top = np.sqrt(squares(points, self.top))
        who, cells = [], []
        for t, (cs, hull) in enumerate(zip(*self.hulls)):
            at = np.flatnonzero(to_top[:, t] - hull <= limit) if len(cs) else []
            if len(at):
                d = np.sqrt(squares(points[at], self.pivots[cs]))
                p, c = np.nonzero((d - self.high[cs] <= limit[at, None]) & (self.low[cs] - d <= limit[at, None]))
                who.append(at[p])
                cells.append(cs[c])
        return (np.concatenate(who), np.concatenate(cells)) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _bounds(self, points: np.ndarray, to_top: np.ndarray, below: list[np.ndarray], need: int) -> np.ndarray:
        """How far a point's ``need``-th nearest row is at most: rows whose distance to a pivot is known are within the sum of both
        distances. Pivots below the nearest top pivot are looked at, and all where those have too few rows."""
        out = np.full(len(points), np.inf)
        first = to_top.argmin(axis=1)
        for t, cs in enumerate(below):
            at = np.flatnonzero(first == t)
            if len(at):
                out[at] = self._bound(points[at], cs, need)
        rest = np.flatnonzero(np.isinf(out))
        if len(rest):
            out[rest] = self._bound(points[rest], np.arange(len(self)), need)
        return out

    def _bound(self, points: np.ndarray, cells: np.ndarray, need: int) -> np.ndarray:
        known = sum(len(self.near[c]) for c in cells)
        if known < need:
            return np.full(len(points), np.inf)
        reach = np.concatenate([self.near[c] for c in cells])
        column = np.repeat(np.arange(len(cells)), [len(self.near[c]) for c in cells])
        out = np.empty(len(points))
        step = max(1, 4_000_000 // known)
        for a in range(0, len(points), step):
            d = np.sqrt(squares(points[a : a + step], self.pivots[cells]))
            out[a : a + step] = np.partition(d[:, column] + reach, need - 1, axis=1)[:, need - 1]
        return out


def one_cell(rows: DataFrame, n: int) -> Cells:
    empty = np.zeros((1, 1))
    return Cells(rows.withColumn("cell", F.lit(0)), empty, np.zeros(1, int), empty, np.zeros(1), np.array([n]))


def build(train: DataFrame, n: int, width: int, need: int, pivots: int | None = None) -> Cells:
    """The index of ``train`` (s_key, s_vec, ...), for up to ``need`` neighbours: one pass over it, whose rows are written with
    their cell, and a scan of what was written."""
    size = pivots or pivots_for(n, width)
    if size == 1:
        return one_cell(train, n)
    picked = lowest_hashes(train.select("s_key", "s_vec"), shuffle_hash("pivot", ["s_key"]), ["s_key"], size, n)
    points = np.array([r["s_vec"] for r in picked], dtype="float64")
    centre = points.mean(axis=0)
    points -= centre
    top = points[: max(1, math.isqrt(len(points)))]
    parent = np.concatenate([squares(points[a : a + 4096], top).argmin(axis=1) for a in range(0, len(points), 4096)])
    index = Cells(train, points, parent, top, centre, np.zeros(len(points), np.int64))
    spec = train.sparkSession.sparkContext.broadcast(index_numbers(index))

    def nearest(vec: pd.Series) -> pd.DataFrame:
        if len(vec) == 0:
            return pd.DataFrame({"cell": np.array([], dtype="int32"), "reach": np.array([], dtype="float64")})
        cell, reach = from_numbers(spec.value).locate(np.stack(vec.to_numpy()).astype("float64", copy=False))
        return pd.DataFrame({"cell": cell, "reach": reach})

    found = F.pandas_udf(nearest, "cell int, reach double")
    placed = written(train.withColumn("c", found("s_vec")).select("*", "c.cell", "c.reach").drop("c"), "cells")
    index.rows = placed.drop("reach")
    index.low, index.high = np.full(len(points), np.inf), np.full(len(points), -np.inf)
    near: list[np.ndarray] = [np.zeros(0)] * len(points)
    # the ``need`` innermost rows of a cell, found task by task and then among these
    inner = placed.select("cell", "reach").mapInPandas(_innermost(need), "cell int, reach double, n long, high double")
    per_cell = inner.groupBy("cell").agg(F.sum("n").alias("n"), F.max("high").alias("high"), F.slice(F.array_sort(F.collect_list("reach")), 1, need).alias("near"))
    for r in per_cell.collect():  # a row per pivot
        c = r["cell"]
        index.counts[c], index.high[c], near[c] = r["n"], r["high"], np.array(r["near"])
        index.low[c] = near[c][0]
    index.near = near
    return index


def _innermost(need: int):
    """Per cell the least distances of a task's rows, and with the first of them their number and the greatest."""

    def work(batches):
        kept: dict[int, np.ndarray] = {}
        n: dict[int, int] = {}
        high: dict[int, float] = {}
        for part in batches:
            for c, reach in part.groupby("cell")["reach"]:
                values = reach.to_numpy()
                both = np.concatenate([kept[c], values]) if c in kept else values
                kept[c] = np.sort(both)[:need]
                n[c], high[c] = n.get(c, 0) + len(values), max(high.get(c, 0.0), float(values.max()))
        rows = [(c, float(v), n[c] if i == 0 else 0, high[c]) for c, values in kept.items() for i, v in enumerate(values)]
        yield pd.DataFrame(rows, columns=["cell", "reach", "n", "high"])

    return work


def index_numbers(index: Cells) -> tuple:
    """All but the rows, for the tasks."""
    return (index.pivots, index.parent, index.top, index.centre, index.counts, index.low, index.high, index.near)


def from_numbers(numbers: tuple) -> Cells:
    return Cells(None, *numbers)


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one width as rows of doubles."""
    if len(vectors) == 0:
        return np.zeros((0, 1))
    lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
    if lengths["min"] != lengths["max"]:
        raise ValueError(f"vectors of {lengths['min']} to {lengths['max']} numbers")
    return pc.list_flatten(vectors).to_numpy().reshape(len(vectors), lengths["max"]).astype("float64", copy=False)


def ask(index: Cells, queries: DataFrame, need: int) -> DataFrame:
    """Each query (q_key, q_vec) with the cell it lies in itself (``home``), how far its neighbours are at most, and a hash."""
    keyed = queries.withColumn("h", F.xxhash64("q_key"))
    if len(index) == 1:
        return keyed.select("*", F.lit(0).alias("home"), F.lit(math.inf).alias("bound"))
    spec = queries.sparkSession.sparkContext.broadcast(index_numbers(index))

    def placed(batches):
        cells = from_numbers(spec.value)
        for part in batches:
            if part.num_rows:
                points = matrix(part.column("q_vec"))
                home, bound = pa.array(cells.locate(points)[0], pa.int32()), pa.array(cells.bounds(points, need))
                yield pa.RecordBatch.from_arrays([*part.columns, home, bound], [*part.schema.names, "home", "bound"])

    schema = T.StructType([*keyed.schema.fields, T.StructField("home", T.IntegerType()), T.StructField("bound", T.DoubleType())])
    # read several times: for the cells' loads, for what groups need, and for the tiles
    return written(keyed.mapInArrow(placed, schema), "asked")


@dataclass
class Shares:
    """Cells in runs (or a large cell in pieces) that are dealt numbers from 0: the first number of each cell, and its pieces."""

    first: np.ndarray
    pieces: np.ndarray
    n: int

    def of(self, cell: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        return self.first[cell] + hashed % self.pieces[cell]


def shares(loads: np.ndarray, order: np.ndarray, most: int) -> Shares:
    """Runs of cells, in this order, that have up to ``most`` rows together; a cell of more is cut into pieces."""
    first, pieces = np.zeros(len(loads), np.int64), np.ones(len(loads), np.int64)
    number, load = 0, 0
    for c in order:
        if loads[c] > most:
            number += load > 0
            first[c], pieces[c] = number, -(-loads[c] // most)
            number, load = number + pieces[c], 0
        else:
            if load and load + loads[c] > most:
                number, load = number + 1, 0
            first[c], load = number, load + loads[c]
    return Shares(first, pieces, int(number + (load > 0)) or 1)


def tiling(index: Cells, loads: np.ndarray, cores: int) -> tuple[Shares, Shares]:
    """Groups of queries and bins of rows. A side of a tile is bounded in bytes; more tiles than that needs are made for the cores,
    so that both sides are sent about as often."""
    n, m = int(index.counts.sum()), int(loads.sum())
    most = max(1, min(TILE_ROWS, TILE_BYTES // (8 * max(1, index.width))))
    tiles = TILES_PER_CORE * cores
    groups = max(-(-m // most), min(math.ceil(math.sqrt(tiles * m / n)), tiles, m // SMALL_GROUP), 1)
    bins = max(-(-n // most), min(-(-tiles // groups), n // ROWS_PER_CELL), 1)
    # neighbouring cells follow each other: by top pivot, along the widest coordinate
    wide = np.ptp(index.pivots, axis=0).argmax()
    order = np.lexsort((index.pivots[:, wide], index.parent, index.top[index.parent, wide]))
    return shares(loads, order, max(1, -(-m // groups))), shares(index.counts, order, max(1, -(-n // bins)))


def tiles(index: Cells, asked: DataFrame, cores: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows and queries with their ``tile``, each as often as it has some; and the number of tiles."""
    loads = np.zeros(len(index), np.int64)
    for r in asked.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per cell
        loads[r["home"]] = r["n"]
    groups, bins = tiling(index, loads, cores)
    sc = asked.sparkSession.sparkContext
    # plain values: a class would have to be known where a broadcast is read
    spec = sc.broadcast((index_numbers(index), (groups.first, groups.pieces, groups.n), (bins.first, bins.pieces, bins.n)))
    size = len(index)

    def wanted(part, cells: Cells, groups: Shares) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        home, hashed = part.column("home").to_numpy(), part.column("h").to_numpy()
        return groups.of(home, hashed), *cells.wanted(matrix(part.column("q_vec")), part.column("bound").to_numpy())

    def needs(batches):
        numbers, groups, _ = spec.value
        cells, groups, seen = from_numbers(numbers), Shares(*groups), np.zeros(0, np.int64)
        for part in batches:
            group, who, cell = wanted(part, cells, groups)
            seen = np.union1d(seen, group[who] * size + cell)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64())], ["need"])

    # at most a number for each group and cell
    pairs = np.sort(asked.mapInArrow(needs, "need long").distinct().toArrow().column("need").to_numpy()) if size > 1 else np.arange(groups.n)
    cell_of, group_of = pairs % size, pairs // size
    by_cell = np.argsort(cell_of, kind="stable")
    starts = np.searchsorted(cell_of[by_cell], np.arange(size + 1))
    sent = sc.broadcast((group_of[by_cell], starts))

    def rows_out(batches):
        bins = Shares(*spec.value[2])
        groups_of, starts = sent.value
        for part in batches:
            cell = part.column("cell").to_numpy()
            own = bins.of(cell, part.column("h").to_numpy())
            copies = starts[cell + 1] - starts[cell]
            who = np.repeat(np.arange(len(cell)), copies)
            at = np.arange(len(who)) - np.repeat(np.cumsum(copies) - copies, copies)
            yield from _sent(part, who, groups_of[starts[cell[who]] + at] * bins.n + own[who])

    def queries_out(batches):
        numbers, groups, bins = spec.value
        cells, groups, bins = from_numbers(numbers), Shares(*groups), Shares(*bins)
        for part in batches:
            group, who, cell = wanted(part, cells, groups)
            pieces = bins.pieces[cell]
            first = np.repeat(np.cumsum(pieces) - pieces, pieces)
            own = np.repeat(bins.first[cell], pieces) + np.arange(len(first)) - first
            code = np.unique(np.repeat(who, pieces) * bins.n + own)
            who = code // bins.n
            yield from _sent(part, who, group[who] * bins.n + code % bins.n)

    place = lambda df: T.StructType([*df.schema.fields, T.StructField("tile", T.LongType())])
    rows = index.rows.withColumn("h", F.xxhash64("s_key"))
    left = rows.mapInArrow(rows_out, place(rows)).drop("h")
    right = asked.mapInArrow(queries_out, place(asked)).drop("h")
    return left, right, len(np.unique(group_of * bins.n + bins.first[cell_of])) + groups.n * int((bins.pieces - 1).sum())


def _sent(part: pa.RecordBatch, who: np.ndarray, tile: np.ndarray):
    step = 20_000
    for a in range(0, len(who), step):
        copies = part.take(pa.array(who[a : a + step]))
        yield pa.RecordBatch.from_arrays([*copies.columns, pa.array(tile[a : a + step], pa.int64())], [*part.schema.names, "tile"])


class Tile:
    """The rows and queries that met: of each query the ``k`` nearest rows so far. Ties go to the smaller key.

    ``keys`` are sorted within each cell. A matrix product leaves a short list, whose distances are then taken from the differences.
    ``rows_at_once`` and ``queries_at_once`` bound that product.
    """

    def __init__(
        self, index: Cells, cell: np.ndarray, keys: np.ndarray, order: np.ndarray, points: np.ndarray, q_keys: np.ndarray,
        asked: np.ndarray, bound: np.ndarray, k: int, exclude_self: bool, rows_at_once: int, queries_at_once: int,
    ):
        self.index, self.cell, self.keys, self.points, self.q_keys, self.asked = index, cell, keys, points, q_keys, asked
        self.order, self.k, self.exclude_self = order, k, exclude_self
        self.rows_at_once, self.queries_at_once = rows_at_once, queries_at_once
        self.limit = bound.copy()
        self.distance = np.full((len(asked), k), np.inf)
        self.place = np.full((len(asked), k), -1)
        if len(index) > 1:
            self.there = asked - index.centre
            self.size, self.slack = (self.there**2).sum(axis=1), index.slack(self.there)

    def found(self, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) places, cell by cell, first the cells in which most queries lie themselves."""
        cells, starts = np.unique(self.cell, return_index=True)
        stops = np.append(starts[1:], len(self.cell))
        inside = np.bincount(home, minlength=cells[-1] + 1)
        for i in np.argsort(-inside[cells], kind="stable"):
            who = self._asking(cells[i])
            if len(who):
                self._cell(starts[i], stops[i], who)
        who, at = np.nonzero(self.place >= 0)
        return who, self.place[who, at], self.distance[who, at]

    def _asking(self, c: int) -> np.ndarray:
        """The queries that may have one of their nearest in a cell, by what is found so far."""
        index = self.index
        if len(index) == 1:
            return np.arange(len(self.asked))
        d = np.sqrt(np.maximum(self.size - 2 * (self.there @ index.pivots[c]) + (index.pivots[c] ** 2).sum(), 0))
        limit = np.minimum(self.limit, self.distance[:, -1]) + self.slack
        return np.flatnonzero((d - index.high[c] <= limit) & (index.low[c] - d <= limit))

    def _cell(self, start: int, stop: int, who: np.ndarray) -> None:
        rows, points = np.arange(start, stop), self.points[start:stop]
        own = np.full(len(who), -1)
        if self.exclude_self:
            at = np.minimum(np.searchsorted(self.keys[start:stop], self.q_keys[who]), stop - start - 1)
            own = np.where(self.keys[start:stop][at] == self.q_keys[who], start + at, -1)
        parts = math.isqrt(len(rows))
        if len(rows) <= UNDIVIDED or len(who) <= parts:  # finding the parts would cost more
            return self._all(who, own, rows)
        at = np.linspace(0, len(rows) - 1, parts).astype(int)
        centre = points.mean(axis=0)
        middle = points[at] - centre
        shifted = points - centre
        near, reach = np.empty(len(rows), np.int64), np.empty(len(rows))
        step = max(1, 4_000_000 // parts)
        for a in range(0, len(rows), step):
            d = squares(shifted[a : a + step], middle)
            near[a : a + step] = d.argmin(axis=1)
            reach[a : a + step] = np.sqrt(d.min(axis=1))
        low, high = np.full(parts, np.inf), np.full(parts, -np.inf)
        np.minimum.at(low, near, reach)
        np.maximum.at(high, near, reach)
        members = np.split(np.argsort(near, kind="stable"), np.searchsorted(np.sort(near), np.arange(1, parts)))
        need = self.k + self.exclude_self
        step = max(1, 4_000_000 // parts)
        for a in range(0, len(who), step):
            q, mine = who[a : a + step], own[a : a + step]
            there = self.asked[q] - centre
            d = np.sqrt(squares(there, middle))
            slack = LOST * (np.sqrt((there * there).sum(axis=1)) + np.sqrt((middle * middle).sum(axis=1).max()) + 1e-3)
            if parts >= need:  # the points in the middle are rows themselves
                self.limit[q] = np.minimum(self.limit[q], np.partition(d, need - 1, axis=1)[:, need - 1] + slack)
            limit = (np.minimum(self.limit[q], self.distance[q, -1]) + slack)[:, None]
            asks = (d - high <= limit) & (low - d <= limit)
            if asks.mean() > MOST_PARTS:
                self._all(q, mine, rows)
                continue
            for p in np.argsort(d.min(axis=0)):
                w = np.flatnonzero(asks[:, p])
                w = w[d[w, p] - high[p] <= np.minimum(self.limit[q[w]], self.distance[q[w], -1]) + slack[w]]
                if len(w) and len(members[p]):
                    self._all(q[w], mine[w], start + members[p])

    def _all(self, who: np.ndarray, own: np.ndarray, rows: np.ndarray) -> None:
        """Queries against rows, block by block. ``own`` is the row that a query leaves out."""
        for b in range(0, len(rows), self.rows_at_once):
            some = rows[b : b + self.rows_at_once]
            points = self.points[some]
            centre = points.mean(axis=0)
            points = points - centre
            size = (points * points).sum(axis=1)
            # a query (x, 1) times a column (-2 y, y.y) is the squared distance less x.x, which is the same for all rows
            columns = np.concatenate([-2 * points, size[:, None]], axis=1).T
            step = max(1, min(self.queries_at_once, BLOCK_CELLS // len(some)))
            for a in range(0, len(who), step):
                self._block(who[a : a + step], own[a : a + step], some, centre, columns, size.max())

    def _block(self, who: np.ndarray, own: np.ndarray, rows: np.ndarray, centre: np.ndarray, columns: np.ndarray, size: float) -> None:
        k, asked = self.k, self.asked[who]
        a = np.ones((len(who), asked.shape[1] + 1))
        np.subtract(asked, centre, out=a[:, :-1])
        less = (a[:, :-1] ** 2).sum(axis=1)
        d2 = a @ columns
        if self.exclude_self:
            at = np.minimum(np.searchsorted(rows, own), len(rows) - 1)
            mine = np.flatnonzero(rows[at] == own)
            d2[mine, at[mine]] = np.inf
        margin = max(1e-12, 1e-15 * asked.shape[1]) * (less + size)
        most = np.minimum(self.limit[who], self.distance[who, -1]) ** 2 + margin - less
        if k == 1:  # most queries have found something nearer before
            least = d2.min(axis=1)
            hit = np.flatnonzero(least <= most)
            who, asked, d2 = who[hit], asked[hit], d2[hit]
            most = np.minimum(most, least + margin)[hit]
        near = d2 <= most[:, None]
        if self.exclude_self and np.isinf(most).any():
            near &= d2 < np.inf
        if k > 1 and d2.shape[1] > k and np.count_nonzero(near) > 4 * k * len(who):
            near &= d2 <= (np.partition(d2, k - 1, axis=1)[:, k - 1] + margin)[:, None]
        q, s = np.divmod(np.flatnonzero(near), len(rows))
        if len(q) == 0:
            return
        gap = self.points[rows[s]] - asked[q]
        d = np.sqrt((gap * gap).sum(axis=1))
        # these and what was found before, in order
        mark = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        those = who[q[mark]]
        line = np.concatenate([np.cumsum(np.append(0, q[1:] != q[:-1])), np.repeat(np.arange(len(those)), k)])
        place = np.concatenate([rows[s], self.place[those].ravel()])
        d = np.concatenate([d, self.distance[those].ravel()])
        sort = np.lexsort((self.order[place], d, line))
        rank = np.arange(len(line)) - np.searchsorted(line[sort], line[sort])
        first = sort[rank < k]
        self.distance[those], self.place[those] = d[first].reshape(-1, k), place[first].reshape(-1, k)

"""A table stored by position, and edits that move no rows.

The rows are written once, numbered and sorted by ``pos``, so a range of positions is a few row groups. What an edited table holds
is a list of pieces: ranges of positions in that table or in inserted ones, with the cells that were set. Selecting, dropping,
inserting and setting change the list alone, on the driver, without a job; ten edits cost one count of the source and not ten.
``rows()`` then reads the pieces: a row's new position follows from its old one and its piece.

Edits whose result is no short list, as dropping every third row, are carried out on the rows, which are then stored anew.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import long_array, resolve, search_bucket, to_col
from ..session import written
from . import edit
from .position import positional_with_count

MAX_PIECES = 10_000
# Ranges that are named one by one in the filter of a scan; beyond that the scan reads from the first to the last.
LISTED_RANGES = 50


class Piece(NamedTuple):
    """Consecutive rows of an edited table: which stored table, the positions there, and cells that were set (column, value)."""

    table: int
    rows: range
    cells: tuple[tuple[str, Any], ...] = ()


def _between(pieces: list[Piece], first: int, last: int) -> list[Piece]:
    """The pieces of the rows ``first`` to ``last - 1``."""
    out, at = [], 0
    for p in pieces:
        part = p.rows[max(0, first - at) : max(0, last - at)]
        if len(part):
            out.append(p._replace(rows=part))
        at += len(p.rows)
    return out


class StoredTable:
    """Rows by position, to be edited without moving them. Edits return another table; this one stays as it is."""

    def __init__(self, tables: list[DataFrame], pieces: list[Piece]):
        self.tables, self.pieces = tables, pieces
        self.n = sum(len(p.rows) for p in pieces)

    @classmethod
    def write(cls, df: DataFrame, row_key=None, pos: str = "pos") -> "StoredTable":
        """Stores ``df`` in the order of ``row_key`` (or of its own ``pos``): the only time that its keys are read."""
        table, n = _stored(df, row_key, pos)
        return cls([table], [Piece(0, range(n))] if n else [])

    @property
    def columns(self) -> list[str]:
        return [c for c in self.tables[0].columns if c != "pos"]

    def _with(self, pieces: list[Piece], more: list[DataFrame] | None = None) -> "StoredTable":
        out = StoredTable(self.tables + (more or []), pieces)
        return StoredTable.write(out.rows()) if len(pieces) > MAX_PIECES else out

    def select(self, rows) -> "StoredTable":
        """Rows by index, list (its order and repeats are kept) or slice."""
        if not isinstance(rows, slice):
            return self._with([p for r in self._numbers(rows) for p in _between(self.pieces, r, r + 1)])
        wanted = range(self.n)[rows]
        up = wanted if wanted.step > 0 else wanted[::-1]
        out, at = [], 0
        for p in self.pieces:
            first = -(-max(0, at - up.start) // up.step) if len(up) else 0  # the first wanted row in this piece or after it
            inside = [up[first] - at] if first < len(up) else []
            if inside and inside[0] < len(p.rows):
                out.append(p._replace(rows=p.rows[inside[0] : max(0, up[-1] + 1 - at) : up.step]))
            at += len(p.rows)
        return self._with(out if wanted.step > 0 else [p._replace(rows=p.rows[::-1]) for p in reversed(out)])

    def drop(self, rows) -> "StoredTable":
        """All but some rows."""
        ranges = self._ranges(rows)
        if ranges is None:
            return StoredTable.write(edit.drop_rows(self.rows(), rows)[0])
        out, at = [], 0
        for r in ranges:
            out += _between(self.pieces, at, r.start)
            at = r.stop
        return self._with(out + _between(self.pieces, at, self.n))

    def insert(self, rows: DataFrame, at: int = -1, row_key=None) -> "StoredTable":
        """Other rows before a position; -1 appends. Columns go by position and are cast."""
        if len(rows.columns) != len(self.columns):
            raise ValueError(f"new rows have {len(rows.columns)} columns, the table has {len(self.columns)}")
        start = self.n if at == -1 else at + self.n if at < 0 else at
        if not 0 <= start <= self.n:
            raise IndexError(f"row position {at} is outside 0..{self.n}")
        placed, _ = positional_with_count(rows, row_key, pos="pos")
        types = dict(self.tables[0].dtypes)
        table, m = _stored(placed.select(*[to_col(v).cast(types[c]).alias(c) for v, c in zip(rows.columns, self.columns)], "pos"), None, "pos")
        new = [Piece(len(self.tables), range(m))] if m else []
        return self._with(_between(self.pieces, 0, start) + new + _between(self.pieces, start, self.n), [table])

    def set(self, rows, columns, value) -> "StoredTable":
        """P10: one value, or one per column, in the cells of some rows."""
        names = resolve(self.tables[0].select(*[to_col(c) for c in self.columns]), columns)
        values = list(value) if isinstance(value, (list, tuple)) else [value] * len(names)
        if len(values) != len(names):
            raise ValueError(f"{len(values)} values for {len(names)} columns")
        ranges = self._ranges(rows)
        if ranges is None:
            return StoredTable.write(edit.set_cells(self.rows(), rows, names, values))
        out, at = [], 0
        for r in ranges:
            out += _between(self.pieces, at, r.start)
            out += [p._replace(cells=p.cells + tuple(zip(names, values))) for p in _between(self.pieces, r.start, r.stop)]
            at = r.stop
        return self._with(out + _between(self.pieces, at, self.n))

    def rows(self) -> DataFrame:
        """The rows with their ``pos``, from one scan of each stored table that still has some."""
        parts, at = [], 0
        placed: dict[int, list[tuple[Piece, int]]] = {}
        for p in self.pieces:
            placed.setdefault(p.table, []).append((p, at))
            at += len(p.rows)
        for t, pieces in sorted(placed.items()):
            parts.append(self._read(t, pieces))
        return reduce(DataFrame.unionByName, parts) if parts else self.tables[0].limit(0)

    def _read(self, t: int, pieces: list[tuple[Piece, int]]) -> DataFrame:
        pieces = sorted(pieces, key=lambda x: min(x[0].rows))
        low, high = [min(p.rows) for p, _ in pieces], [max(p.rows) for p, _ in pieces]
        pos = F.col("pos")
        if len(pieces) <= LISTED_RANGES:
            hull = reduce(lambda a, b: a | b, [pos.between(a, b) for a, b in zip(low, high)])
        else:
            hull = pos.between(low[0], max(high))
        df = self.tables[t].filter(hull)
        if all(a > b for a, b in zip(low[1:], high)):
            depth = len(pieces).bit_length()
            bounds = long_array(low + [2**62] * (2**depth - 1 - len(pieces)))
            df = search_bucket(df, pos, lambda i: F.get(bounds, i), depth, "__piece").withColumn("__piece", F.col("__piece") - 1)
        else:
            # pieces that share rows, as a list of rows that names some twice
            df = df.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(len(pieces) - 1))))
        of = lambda numbers: F.get(long_array(numbers), F.col("__piece"))
        steps = of([p.rows.step for p, _ in pieces])
        gap = pos - of([p.rows.start for p, _ in pieces])
        inside = pos.between(of(low), of(high)) & (gap % steps == 0)
        moved = (of([at for _, at in pieces]) + (gap / steps).cast("bigint")).alias("pos")
        return df.filter(inside).select(*[self._cell(c, [p for p, _ in pieces]) for c in self.columns], moved)

    def _cell(self, column: str, pieces: list[Piece]) -> Column:
        cell, kind = to_col(column), dict(self.tables[0].dtypes)[column]
        latest = [dict(p.cells).get(column, _UNSET) for p in pieces]
        values = []
        for v in latest:
            if v is not _UNSET and v not in values:
                values.append(v)
        if not values:
            return cell
        code = F.get(long_array([0 if v is _UNSET else values.index(v) + 1 for v in latest]), F.col("__piece"))
        for i, v in enumerate(values):
            cell = F.when(code == i + 1, F.lit(v).cast(kind)).otherwise(cell)
        return cell.alias(column)

    def _numbers(self, rows) -> list[int]:
        return edit._row_numbers(rows, self.n)

    def _ranges(self, rows) -> list[range] | None:
        """Ascending ranges of rows without gaps; None if there would be too many."""
        if isinstance(rows, slice):
            wanted = range(self.n)[rows]
            wanted = wanted if wanted.step > 0 else wanted[::-1]
            if wanted.step == 1 or len(wanted) <= 1:
                return [range(wanted[0], wanted[-1] + 1)] if len(wanted) else []
            if len(wanted) > MAX_PIECES // 2:
                return None
            return [range(r, r + 1) for r in wanted]
        return [range(r, r + 1) for r in sorted(set(self._numbers(rows)))]


_UNSET = object()


def _stored(df: DataFrame, row_key, pos: str) -> tuple[DataFrame, int]:
    placed, n = positional_with_count(df, row_key, pos=pos)
    return written(placed.withColumnRenamed(pos, "pos").repartitionByRange("pos").sortWithinPartitions("pos"), "by-position"), n

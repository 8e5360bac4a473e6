"""Exact quantiles with linear interpolation, without gathering a column in one task.

Spark's ``percentile`` keeps every distinct value of a group in one task, which is right only for a bounded group. So it
is used up to ``DIRECT_ROWS`` values. Beyond that a scan with approximate percentiles, whose error in rank is known, brackets
each wanted rank from both sides; a second scan counts what lies below and at the ends of each bracket, and fetches what lies
between if that is few, which it is for some ten million values. Otherwise the bracket is cut again in the same way: 10^12
values take six scans, whatever their distribution.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import present, to_col

DIRECT_ROWS = 100_000
FETCH_ROWS = 10_000
# One over the share of the values by which an approximate rank may be wrong.
ACCURACY = 10_000

# Fixed value: the largest finite double; infinities are searched for as if they were it.
LARGEST = 1.7976931348623157e308


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], direct_rows: int = DIRECT_ROWS, bounds: dict | None = None
) -> dict[str, list]:
    """Per column the quantiles of its non-missing values (None where there are none).

    ``bounds``: per column ``(count, min, max)``, where the caller has them already.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    values = df.select(*[present(c, dtypes[c]).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if bounds is None:
        row = values.agg(
            *[
                agg(f"v{i}").alias(f"{name}{i}")
                for i in range(len(cols))
                for name, agg in (("n", F.count), ("lo", F.min), ("hi", F.max))
            ]
        ).first()
        bounds = {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
    if max(n for n, _, _ in bounds.values()) <= direct_rows:
        row = values.agg(
            *[F.percentile(f"v{i}", F.array(*[F.lit(p) for p in probs])).alias(f"q{i}") for i in range(len(cols))]
        ).first()
        return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)) for i, c in enumerate(cols)}
    return _narrowed(values, cols, probs, bounds)


@dataclass
class _Search:
    """Ranks of one column in an open interval: the values before the interval, and those inside."""

    column: int
    ranks: tuple[int, ...]
    low: float = -math.inf
    high: float = math.inf
    before: int = 0
    inside: int = 0

    def value(self) -> Column:
        """The column's value where it lies in the interval."""
        v = F.col(f"v{self.column}")
        tests = [v > F.lit(self.low)] * (self.low > -math.inf) + [v < F.lit(self.high)] * (self.high < math.inf)
        return F.when(reduce(lambda a, b: a & b, tests), v) if tests else v


def _narrowed(values: DataFrame, cols: list[str], probs: list[float], bounds: dict) -> dict[str, list]:
    finite = values.select(
        *[F.when(to_col(v).isNotNull(), F.greatest(F.least(to_col(v), F.lit(LARGEST)), F.lit(-LARGEST))).alias(v) for v in values.columns]
    )
    searches = []
    for i, c in enumerate(cols):
        n = bounds[c][0]
        places = [p * (n - 1) for p in probs] if n else []
        searches += [_Search(i, tuple(sorted({math.floor(x), math.ceil(x)})), inside=n) for x in places]
    found: dict[tuple[int, int], float] = {}
    while searches:
        searches = _one_round(finite, searches, found)

    def value(i: int, rank: int) -> float:
        v = found[(i, rank)]
        return math.copysign(math.inf, v) if abs(v) >= LARGEST else v

    out = {}
    for i, c in enumerate(cols):
        n = bounds[c][0]
        out[c] = []
        for p in probs:
            if n == 0:
                out[c].append(None)
                continue
            place = p * (n - 1)
            low, high = value(i, math.floor(place)), value(i, math.ceil(place))
            part = place - math.floor(place)
            out[c].append(low if part == 0 or low == high else low * (1 - part) + high * part)
    return out


def _one_round(values: DataFrame, searches: list[_Search], found: dict[tuple[int, int], float]) -> list[_Search]:
    """Brackets each search's ranks by approximate percentiles, counts exactly, and returns the searches that go on.

    Searches in one interval of a column share a sketch. The ends of their brackets cut the interval into cells; each value is
    put into its cell once, and cells are counted.
    """
    intervals: dict[tuple[int, float, float], list[_Search]] = {}
    for s in searches:
        intervals.setdefault((s.column, s.low, s.high), []).append(s)
    sketches = []
    for group in intervals.values():
        places = []
        for s in group:
            slack = 2 * s.inside / ACCURACY + 1
            places += [(s.ranks[0] - s.before - slack) / s.inside, (s.ranks[-1] - s.before + 1 + slack) / s.inside]
        ends = F.array(*[F.lit(min(1.0, max(0.0, p))) for p in places])
        sketches.append(F.percentile_approx(group[0].value(), ends, F.lit(ACCURACY)))
    row = values.agg(*[b.alias(f"b{j}") for j, b in enumerate(sketches)]).first()

    cells = []
    for j, ((column, _, _), group) in enumerate(intervals.items()):
        few = 8 * group[0].inside / ACCURACY + 8 <= FETCH_ROWS
        cells.append(_Cells(j, group, sorted(set(row[f"b{j}"])), [tuple(row[f"b{j}"][2 * i : 2 * i + 2]) for i in range(len(group))] if few else []))
    used = sorted({c.searches[0].column for c in cells})
    found_here = values.select(*[f"v{i}" for i in used]).mapInArrow(_counted([c.plain(used) for c in cells]), "j int, cell int, n bigint, fetched array<double>")
    counted = found_here.groupBy("j", "cell").agg(F.sum("n").alias("n"), F.flatten(F.collect_list("fetched")).alias("fetched")).collect()

    left = []
    for c in cells:
        c.counts = {r["cell"]: r["n"] for r in counted if r["j"] == c.number}
        c.fetched = {r["cell"]: sorted(r["fetched"]) for r in counted if r["j"] == c.number}
        left += c.resolve(found)
    merged: dict[tuple, _Search] = {}
    for s in left:
        same = merged.setdefault((s.column, s.low, s.high), s)
        same.ranks = tuple(sorted({*same.ranks, *s.ranks}))
    # ranks far apart in one interval are bracketed each on its own
    return [
        _Search(s.column, (r,), s.low, s.high, s.before, s.inside) if s.ranks[-1] - s.ranks[0] > 1 else s
        for s in merged.values()
        for r in (s.ranks if s.ranks[-1] - s.ranks[0] > 1 else s.ranks[:1])
    ]


@dataclass
class _Cells:
    """An interval cut at ``cuts``: cell 2k lies below cut k, cell 2k + 1 is the cut itself. Inside ``brackets`` values are fetched."""

    number: int
    searches: list[_Search]
    cuts: list[float]
    brackets: list[tuple[float, float]]
    counts: dict[int, int] | None = None
    fetched: dict[int, list[float]] | None = None

    def plain(self, used: list[int]) -> tuple:
        s = self.searches[0]
        return self.number, used.index(s.column), s.low, s.high, self.cuts, self.brackets

    def resolve(self, found: dict[tuple[int, int], float]) -> list[_Search]:
        """Finds ranks at a cut or among fetched values; the others go on in their cell."""
        ends, running = [], 0
        for cell in range(2 * len(self.cuts) + 1):
            running += self.counts.get(cell, 0)
            ends.append(running)
        left = []
        for s in self.searches:
            for r in s.ranks:
                k = r - s.before
                cell = next(i for i, end in enumerate(ends) if k < end)
                first = ends[cell] - self.counts[cell]
                if cell % 2:
                    found[(s.column, r)] = self.cuts[cell // 2]
                elif len(self.fetched[cell]) == self.counts[cell]:
                    found[(s.column, r)] = self.fetched[cell][k - first]
                else:
                    low = self.cuts[cell // 2 - 1] if cell else s.low
                    high = self.cuts[cell // 2] if cell < 2 * len(self.cuts) else s.high
                    left.append(_Search(s.column, (r,), low, high, s.before + first, self.counts[cell]))
        return left


def _counted(cells: list[tuple]):
    """Per interval and cell the values of a task, and those that are fetched: at most about ``FETCH_ROWS`` a bracket in all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(2 * len(cuts) + 1, np.int64) for _, _, _, _, cuts, _ in cells]
        fetched: list[dict[int, list[np.ndarray]]] = [{} for _ in cells]
        for batch in batches:
            columns = [np.asarray(c.drop_null()) for c in batch.columns]
            for count, kept, (_, column, low, high, cuts, brackets) in zip(counts, fetched, cells):
                v = columns[column]
                if low > -math.inf or high < math.inf:
                    v = v[(v > low) & (v < high)]
                below = np.searchsorted(cuts, v)
                cell = below + np.searchsorted(cuts, v, "right")
                count += np.bincount(cell, minlength=len(count))
                inside = np.zeros(len(v), bool)
                for a, b in brackets:
                    inside |= (v > a) & (v < b)
                inside &= cell % 2 == 0
                for c in np.unique(cell[inside]).tolist():
                    kept.setdefault(c, []).append(v[inside & (cell == c)])
        rows = [(spec[0], c, n, np.concatenate(kept[c]).tolist() if c in kept else []) for spec, count, kept in zip(cells, counts, fetched) for c, n in enumerate(count.tolist()) if n]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], ["j", "cell", "n", "fetched"])

    return work

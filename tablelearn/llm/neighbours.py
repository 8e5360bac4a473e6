"""Approximate nearest neighbours: a neighbour graph by NN-descent, and greedy search over it.

Each round of NN-descent joins every vector's neighbours and reverse neighbours with their vectors and compares them with
each other: neighbours of neighbours are likely neighbours. What beats a vector's list so far is shuffled to it and merged.
Vectors travel with the components they came with and are compared in double precision, so near copies keep their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import removed, require, saved

NEIGHBOURS, PROJECTIONS, CHUNK = 48, 3, 256
MAX_ROUNDS, SETTLED = 6, 0.02
BEAM, MAX_HOPS = 24, 8
GROUP = 128
SEED = 11

GRAPH_SCHEMA = "node long, code binary, scale double, ids array<long>, sims array<double>, fresh array<boolean>"
_LIST = "node long, ids array<long>, sims array<double>"


def packed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each, so that no square overflows, and the factor that brings each to length one."""
    code = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return code, 1 / np.linalg.norm(code.astype(np.float64), axis=1)


def best(target: np.ndarray, other: np.ndarray, sim: np.ndarray, fresh: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` most similar others of each target, each once, by target and falling similarity; ties to the smaller."""
    if not len(target):
        return target, other, sim, fresh
    o = np.lexsort((fresh, other, target))
    target, other, sim, fresh = target[o], other[o], sim[o], fresh[o]
    once = np.ones(len(target), bool)
    once[1:] = (target[1:] != target[:-1]) | (other[1:] != other[:-1])
    target, other, sim, fresh = target[once], other[once], sim[once], fresh[once]
    o = np.lexsort((other, -sim, target))
    target, other, sim, fresh = target[o], other[o], sim[o], fresh[o]
    top = np.arange(len(target)) - np.searchsorted(target, target) < keep
    return target[top], other[top], sim[top], fresh[top]


def _lists(target: np.ndarray, *columns: tuple[np.ndarray, pa.DataType]) -> list[pa.Array]:
    """Columns sorted by target as one list per target, after the targets."""
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[first, len(target)].astype(np.int32))
    return [pa.array(target[first], pa.int64()), *[pa.ListArray.from_arrays(offsets, pa.array(c, t)) for c, t in columns]]


def _vectors(code: pa.Array, scale: pa.Array, kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(code.to_pylist()), kind).reshape(len(code), -1)
    return rows * np.asarray(scale, np.float64)[:, None]


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a sorted partition regrouped so that all rows with one value in the first column come together."""
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(0))
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (carry and np.asarray(carry[-1].column(0))[-1] != keys[-1]):
            yield pa.Table.from_batches([*carry, batch.slice(0, cut)]).combine_chunks().to_batches()[0] if carry else batch.slice(0, cut)
            carry = []
        carry.append(batch.slice(cut))
    if carry:
        yield pa.Table.from_batches(carry).combine_chunks().to_batches()[0]


def _local_join(keep: int, kind: str):
    """Compares the members of each node's neighbourhood: rows (u, v, fresh, limit, scale, code) sorted by u, then by the round's
    order. Of over ``GROUP`` members each group is compared whole, as those that aren't fresh may not have met before."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a neighbourhood cut by a batch's end is compared in two parts
            u, v = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if not len(u):
                continue
            fresh, limit = batch.column(2).to_numpy(zero_copy_only=False), np.asarray(batch.column(3))
            x = _vectors(batch.column(5), batch.column(4), kind)
            starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
            targets, others, sims = [], [], []
            for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(u)]):
                for b in range(a, z, GROUP):
                    e = min(z, b + GROUP)
                    new = fresh[b:e] | (z - a > GROUP)
                    if not new.any():
                        continue
                    s = x[b:e] @ x[b:e].T
                    ok = (s > limit[b:e, None]) & (new[:, None] | new[None]) & (v[b:e, None] != v[None, b:e])
                    i, j = np.nonzero(ok)
                    targets.append(v[b:e][i])
                    others.append(v[b:e][j])
                    sims.append(s[i, j])
            if targets:
                t, o, s, _ = best(*map(np.concatenate, (targets, others, sims)), np.zeros(sum(map(len, targets)), bool), keep)
                yield pa.RecordBatch.from_arrays(_lists(t, (o, pa.int64()), (s, pa.float64())), ["node", "ids", "sims"])

    return work


def _flat(batch: pa.RecordBatch, lists: int) -> tuple[np.ndarray, ...]:
    """Row numbers, ids and similarities of a batch's lists; null lists are empty."""
    ids, sims = batch.column(lists), batch.column(lists + 1)
    counts = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()]) if ids.null_count else np.diff(np.asarray(ids.offsets))
    return np.repeat(np.arange(batch.num_rows), counts), np.asarray(ids.flatten()), np.asarray(sims.flatten())


def _merge(keep: int):
    """One list per node from its row and what was proposed to it: rows (node, code, scale, ids, sims) sorted by node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_keys(batches):
            node = np.asarray(batch.column(0))
            row, ids, sims = _flat(batch, 3)
            own = np.flatnonzero(np.asarray(batch.column(1).is_valid()))
            proposed = ~np.isin(row, own)
            t, o, s, f = best(node[row], ids, sims, proposed, keep)
            own_nodes = node[own]
            low, high = np.searchsorted(t, own_nodes), np.searchsorted(t, own_nodes, "right")
            take = np.concatenate([np.arange(a, z) for a, z in zip(low, high)]) if len(own) else np.zeros(0, np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(high - low)].astype(np.int32))
            rest = batch.take(pa.array(own))
            columns = [pa.ListArray.from_arrays(offsets, pa.array(c[take], k)) for c, k in ((o, pa.int64()), (s, pa.float64()), (f, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*rest.columns[:3], *columns], ["node", "code", "scale", "ids", "sims", "fresh"])

    return work


def _merged(rows: DataFrame, keep: int) -> DataFrame:
    ordered = rows.select("node", "code", "scale", "ids", "sims").repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(_merge(keep), GRAPH_SCHEMA)


def _as_rows(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("scale"), "ids", "sims")


def _first_lists(nodes: DataFrame, turn: int, keep: int, kind: str) -> DataFrame:
    """Neighbours within chunks of nodes that are neighbours in the order of a random projection's signs.

    Near copies have all signs in common; these are in the order of one more projection, another one each turn.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1), batch.column(2), kind) if batch.num_rows else np.zeros((0, 1))
            planes = np.random.default_rng(SEED + turn).standard_normal((x.shape[1], 33))
            at = x @ planes
            place = (at[:, :32] > 0) @ (1 << np.arange(31, -1, -1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64()), pa.array(at[:, 32])], ["node", "code", "scale", "place", "along"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column(0))
            if len(node) < 2:
                continue
            x = _vectors(batch.column(1), batch.column(2), kind)
            for a in range(0, len(node), CHUNK):
                ids, part = node[a : a + CHUNK], x[a : a + CHUNK]
                s = part @ part.T
                t = np.repeat(ids, len(ids))
                o = np.tile(ids, len(ids))
                other = t != o
                t, o, s, _ = best(t[other], o[other], s.ravel()[other], np.zeros(other.sum(), bool), keep)
                if len(t):
                    yield pa.RecordBatch.from_arrays(_lists(t, (o, pa.int64()), (s, pa.float64())), ["node", "ids", "sims"])

    placed = nodes.mapInArrow(keyed, "node long, code binary, scale double, place long, along double")
    order = ["place", "along", "node"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, _LIST)


def neighbour_graph(nodes: DataFrame, keep: int = NEIGHBOURS, kind: str = "f4") -> DataFrame:
    """NN-descent over ``node``, ``code`` (components of numpy's type ``kind``), ``scale``: each node's ``keep`` most similar
    others, as found.

    Rounds end when under ``SETTLED`` of the entries are new. Those that have one node as their neighbour are compared in groups
    of ``GROUP`` where they are very many, other groups each round, so the work is linear in the lists' entries.
    """
    spark = nodes.sparkSession
    rows = nodes.select("node", "code", "scale", F.expr("cast(array() as array<long>)").alias("ids"), F.expr("cast(array() as array<double>)").alias("sims"))
    for turn in range(PROJECTIONS):
        rows = rows.unionByName(_as_rows(_first_lists(nodes, turn, keep, kind)))
    graph = saved(_merged(rows, keep), "graph")
    for turn in range(MAX_ROUNDS):
        edges = graph.select("node", F.inline(F.arrays_zip("ids", "fresh")))
        both = edges.select(F.col("node").alias("u"), F.col("ids").alias("v"), "fresh").unionByName(
            edges.select(F.col("ids").alias("u"), F.col("node").alias("v"), "fresh")
        )
        limit = F.when(F.size("ids") < keep, F.lit(-2.0)).otherwise(F.element_at("sims", -1))
        members = graph.select(F.col("node").alias("v"), limit.alias("limit"), "scale", "code")
        joined = both.join(members, "v").select("u", "v", "fresh", "limit", "scale", "code")
        proposals = joined.repartition("u").sortWithinPartitions("u", F.xxhash64("v", F.lit(turn)), "v").mapInArrow(_local_join(keep, kind), _LIST)
        after = saved(_merged(graph.select("node", "code", "scale", "ids", "sims").unionByName(_as_rows(proposals)), keep), "graph")
        removed(spark, graph)
        graph = after
        entries, new = graph.agg(F.sum(F.size("ids")), F.sum(F.size(F.filter("fresh", lambda f: f)))).first()
        if not entries or new < SETTLED * entries:
            break
    return graph


def greedy_search(graph: DataFrame, starts: DataFrame, beam: int = BEAM, kind: str = "f4") -> DataFrame:
    """``query``, ``ids``: the most similar nodes found for each node in ``starts`` (column ``query``), best first, itself excluded.

    Every hop looks at the neighbours of all not yet visited nodes among a query's best ``beam``; a query is done when none is
    left among them.
    """
    own = starts.join(graph, F.col("query") == F.col("node"))
    state = saved(
        own.select("query", "code", "scale", F.slice("ids", 1, beam).alias("ids"), F.slice("sims", 1, beam).alias("sims")).withColumn(
            "fresh", F.transform("ids", lambda _: F.lit(True))
        ),
        "search",
    )
    vectors = graph.select(F.col("node").alias("other"), F.col("code").alias("other_code"), F.col("scale").alias("other_scale"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows (query, code, scale, ids, sims, other, other_code, other_scale) sorted by query: its state, then what it met
        for batch in _whole_keys(batches):
            query = np.asarray(batch.column(0))
            own = np.flatnonzero(np.asarray(batch.column(1).is_valid()))
            met = np.flatnonzero(np.asarray(batch.column(5).is_valid()))
            mine = batch.take(pa.array(own))
            row, ids, sims = _flat(mine, 3)
            q = np.asarray(mine.column(0))
            t, o, s, f = q[row], ids, sims, np.zeros(len(row), bool)
            if len(met):
                other = batch.take(pa.array(met))
                x, y = _vectors(mine.column(1), mine.column(2), kind), _vectors(other.column(6), other.column(7), kind)
                of = np.searchsorted(q, query[met])
                found = np.einsum("ij,ij->i", x[of], y)
                t, o = np.r_[t, query[met]], np.r_[o, np.asarray(other.column(5))]
                s, f = np.r_[s, found], np.r_[f, np.ones(len(met), bool)]
            t, o, s, f = best(t, o, s, f, beam)
            low, high = np.searchsorted(t, q), np.searchsorted(t, q, "right")
            offsets = pa.array(np.r_[0, np.cumsum(high - low)].astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, pa.array(c, k)) for c, k in ((o, pa.int64()), (s, pa.float64()), (f, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*mine.columns[:3], *columns], ["query", "code", "scale", "ids", "sims", "fresh"])

    for _ in range(MAX_HOPS):
        seen = state.select("query", F.explode("ids").alias("other"))
        visit = state.select("query", F.inline(F.arrays_zip("ids", "fresh"))).where("fresh").select("query", F.col("ids").alias("node"))
        reached = visit.join(graph.select("node", F.col("ids").alias("next")), "node").select("query", F.explode("next").alias("other"))
        reached = reached.where("query <> other").distinct().join(seen, ["query", "other"], "left_anti")
        met = reached.join(vectors, "other")
        rows = state.select("query", "code", "scale", "ids", "sims").unionByName(met, allowMissingColumns=True)
        after = saved(rows.repartition("query").sortWithinPartitions("query", F.col("code").isNull()).mapInArrow(step, GRAPH_SCHEMA.replace("node", "query")), "search")
        removed(state.sparkSession, state)
        state = after
        if not state.where(F.exists("fresh", lambda f: f)).take(1):
            break
    return state.select("query", "ids")


def _in_range(vector: str) -> Column:
    """The vector as doubles, times the power of two that brings its largest component near one: no square overflows or vanishes,
    and no digit is lost, so cosines are those of the vector itself."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    exponent = F.floor(F.log2(largest)).cast("int")
    half = F.floor(exponent / 2).cast("int")  # in two steps, each a power that doubles can hold
    return F.transform(vector, lambda x: x.cast("double") * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows, by cosine, found for the rows of ``vectors`` whose keys are in ``queries`` (column ``key``).

    Returns query_id, rank (from 1), ``key`` and score (the exact cosine, in double precision), nearest first, ties to the
    smaller key; a row is never its own neighbour; with fewer other rows, all of them.

    Equal vectors are one node of the graph. Of the rows behind a node the k+1 smallest keys are kept beside it, which is all
    that a query can return of them; so a vector that a third of all rows share costs no more than any other.

    ``MAX_ROUNDS``, ``MAX_HOPS``, ``BEAM`` and ``NEIGHBOURS`` bound the search, which is why some neighbours may be missed.
    Rows take no part whose key is null or whose vector is null, empty, zero, or holds null or non-finite components.
    Repeated rows (equal key and vector) count once. Vectors of different lengths fail the job. Empty table: no rows. Other
    columns are not read.
    """
    require(vectors, key, embedding)
    require(queries, key)
    spark = vectors.sparkSession
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    )
    rows = saved(rows.distinct(), "vectors")
    if rows.select(F.size("vector")).distinct().limit(2).count() > 1:
        raise ValueError("vectors of different lengths")
    classes = saved(rows.groupBy("vector").agg(F.min("id").alias("node")), "vector-classes")
    members = saved(
        rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("at") <= k + 1).join(classes, "vector").select("node", "id"),
        "vector-members",
    )

    kind = "f4" if vectors.schema[embedding].dataType.elementType == T.FloatType() else "f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, scale = packed(np.asarray(batch.column(1).flatten(), kind).reshape(batch.num_rows, -1))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale)], ["node", "code", "scale"])

    nodes = saved(classes.select("node", "vector").mapInArrow(pack, "node long, code binary, scale double"), "nodes")
    graph = neighbour_graph(nodes, kind=kind)

    asked = rows.join(queries.select(F.col(key).cast("long").alias("id")).distinct(), "id")
    asked = saved(asked.join(classes, "vector").select(F.col("id").alias("query_id"), "node", "vector"), "queries")
    found = greedy_search(graph, asked.select(F.col("node").alias("query")).distinct(), kind=kind)
    candidates = found.select("query", F.explode(F.concat("ids", F.array("query"))).alias("node"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = (
        asked.select("query_id", F.col("node").alias("query"), _in_range("vector").alias("a"))
        .join(candidates, "query")
        .join(classes.select("node", _in_range("vector").alias("b")), "node")
        .select("query_id", "node", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / (norm("a") * norm("b")))).alias("score"))
    )
    expanded = scored.join(members, "node").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        expanded.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
    )

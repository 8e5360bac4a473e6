"""Exact Gini decision tree, grown level by level.

A level is one job for all its open nodes. Rows become a histogram of classes per (node, feature, value), the only
step that touches them. Running class counts over the sorted values then score every split ``x < v``. They are
built in two parts, inside value ranges and across them, so that no task takes all the values of a feature
(a table small enough for one task skips that).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, constant_array, double_array, feature, long_array, search_bucket, to_col
from ..operators.quantile import exact_quantiles
from ..session import dropped, written

ROWS_PER_RANGE = 250_000
MAX_RANGE_DEPTH = 16
MAX_OPEN_NODES = 50_000
# Gini values are compared after rounding, so that splits equal but for the order of summation tie.
GINI_DIGITS = 12


def impurity(counts: Sequence[Column], total: Column) -> Column:
    """1 - sum of squared shares, 0 for no rows."""
    squares = reduce(lambda a, b: a + b, [c.cast("double") * c for c in counts])
    return F.when(total > 0, 1.0 - squares / (total.cast("double") * total)).otherwise(0.0)


def gini_of_split(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """The impurities of both sides, weighted by their rows."""
    n_left = reduce(lambda a, b: a + b, left)
    n_right = reduce(lambda a, b: a + b, right)
    n = (n_left + n_right).cast("double")
    return impurity(left, n_left) * n_left / n + impurity(right, n_right) * n_right / n


def range_depth(rows: int) -> int:
    """How often the values of a feature are to be halved so that a task gets no more than it can sort."""
    depth = 0
    while depth < MAX_RANGE_DEPTH and rows / 2**depth > ROWS_PER_RANGE:
        depth += 1
    return depth


def value_ranges(df: DataFrame, d: int, depth: int) -> list[list[float]]:
    """Per feature ``2**depth - 1`` ascending bounds of about equally many rows, from one aggregate."""
    if depth == 0:
        return [[] for _ in range(d)]
    probs = double_array([i / 2**depth for i in range(1, 2**depth)])
    row = df.agg(*[F.percentile_approx(f"x{j}", probs, F.lit(2 ** (depth + 3))).alias(f"b{j}") for j in range(d)]).first()
    return [list(row[f"b{j}"]) for j in range(d)]


def class_histogram(rows: DataFrame, d: int, classes: int) -> DataFrame:
    """``(node, f, v, c0..)``: rows per class for every value of every feature. ``rows`` has ``node``, ``y`` and ``x0..``."""
    values = F.array(*[F.struct(F.lit(j).alias("f"), F.col(f"x{j}").alias("v")) for j in range(d)])
    return (
        rows.select("node", "y", F.inline(values))
        .groupBy("node", "f", "v")
        .agg(*[F.sum((F.col("y") == k).cast("bigint")).alias(f"c{k}") for k in range(classes)])
    )


def split_scores(histogram: DataFrame, classes: int, bounds: list[list[float]]) -> DataFrame:
    """Every candidate split: ``(node, f, rng, v, gini, l0.., t0..)``, class counts left of ``v`` and in the node.

    The smallest value of a feature splits nothing off, so its gini is the node's own impurity.
    """
    ks = range(classes)
    width = len(bounds[0])
    if width == 0:
        whole = Window.partitionBy("node", "f")
        below = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        scored = histogram.select(
            "node", "f", F.lit(0).alias("rng"), "v",
            *[F.coalesce(F.sum(f"c{k}").over(below), F.lit(0)).alias(f"l{k}") for k in ks],
            *[F.sum(f"c{k}").over(whole).alias(f"t{k}") for k in ks],
        )
    else:
        flat = double_array([b for bs in bounds for b in bs])
        depth = (width + 1).bit_length() - 1
        ranged = search_bucket(histogram, F.col("v"), lambda i: F.get(flat, F.col("f") * width + i), depth, "rng")
        per_range = ranged.groupBy("node", "f", "rng").agg(*[F.sum(f"c{k}").alias(f"r{k}") for k in ks])
        feature_rows = Window.partitionBy("node", "f")  # as many rows as there are ranges
        before = feature_rows.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_range.select(
            "node", "f", "rng",
            *[F.coalesce(F.sum(f"r{k}").over(before), F.lit(0)).alias(f"o{k}") for k in ks],
            *[F.sum(f"r{k}").over(feature_rows).alias(f"t{k}") for k in ks],
        )
        inside = Window.partitionBy("node", "f", "rng").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        scored = (
            ranged.select("node", "f", "rng", "v", *[F.coalesce(F.sum(f"c{k}").over(inside), F.lit(0)).alias(f"i{k}") for k in ks])
            .join(offsets, ["node", "f", "rng"])
            .select("node", "f", "rng", "v", *[(F.col(f"i{k}") + F.col(f"o{k}")).alias(f"l{k}") for k in ks], *[f"t{k}" for k in ks])
        )
    left = [F.col(f"l{k}") for k in ks]
    right = [F.col(f"t{k}") - F.col(f"l{k}") for k in ks]
    return scored.withColumn("gini", gini_of_split(left, right))


def best_splits(scores: DataFrame, classes: int) -> DataFrame:
    """Per node the split of least gini; on ties the first feature, then the smallest value."""
    order = F.struct(
        F.round("gini", GINI_DIGITS).alias("g"), "f", "v", "gini",
        F.array(*[F.col(f"l{k}") for k in range(classes)]).alias("left"),
        F.array(*[F.col(f"t{k}") for k in range(classes)]).alias("total"),
    )
    # the candidates already lie sorted by range, so the first step neither shuffles nor sorts them
    per_range = scores.groupBy("node", "f", "rng").agg(F.min(order).alias("best"))
    return per_range.groupBy("node").agg(F.min("best").alias("best")).select("node", "best.*")


def binned(rows: DataFrame, d: int, bins: int) -> DataFrame:
    """``rows`` with every input replaced by the lower end of its bin: the greatest of ``bins`` exact quantiles that isn't above it.

    A split at the lower end of a bin parts the bins as it parts the values themselves.
    """
    quantiles = exact_quantiles(rows, [f"x{j}" for j in range(d)], [i / bins for i in range(bins)])
    for j in range(d):
        ends = sorted(set(quantiles[f"x{j}"]))
        depth = len(ends).bit_length()
        padded = double_array(ends + [math.inf] * (2**depth - 1 - len(ends)))
        rows = search_bucket(rows, F.col(f"x{j}"), lambda i, padded=padded: F.get(padded, i), depth, "__bin")
        # the least value is an end; infinity as a value lies in the bin of the last one
        rows = rows.withColumn(f"x{j}", F.get(padded, F.least(F.col("__bin"), F.lit(len(ends))) - 1)).drop("__bin")
    return rows


def _is_smaller(nodes: list[dict[str, Any]], i: int) -> bool:
    parent = nodes[nodes[i]["parent"]]
    return parent["left_smaller"] == (i == parent["left"])


def _with_siblings(histogram: DataFrame, above: DataFrame, nodes: list[dict[str, Any]], open_nodes: list[int], classes: int) -> DataFrame:
    """The histogram of the counted nodes, and of their siblings: what their parents have besides."""
    larger = {nodes[i]["parent"]: i for i in open_nodes if not _is_smaller(nodes, i)}
    smaller = {i: larger[nodes[i]["parent"]] for i in open_nodes if _is_smaller(nodes, i)}
    counts = [f"c{k}" for k in range(classes)]
    sibling = long_array([smaller.get(i, -1) for i in range(len(nodes))])
    child = long_array([larger.get(i, -1) for i in range(len(nodes))])
    taken = histogram.select(F.get(sibling, F.col("node")).cast("int").alias("node"), "f", "v", *[(-F.col(c)).alias(c) for c in counts])
    whole = above.select(F.get(child, F.col("node")).cast("int").alias("node"), "f", "v", *counts).filter("node >= 0")
    rest = whole.unionByName(taken).groupBy("node", "f", "v").agg(*[F.sum(c).alias(c) for c in counts])
    return histogram.unionByName(rest.filter(" + ".join(counts) + " > 0"))


def training_rows(df: DataFrame, input_cols: list[str], target: str, max_classes: int, *more: Column) -> tuple[DataFrame, list]:
    """``y`` as class number, ``x0..`` and further columns; the sorted classes."""
    found = df.select(to_col(target).alias("y")).filter("y IS NOT NULL").distinct().limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    if not found:
        raise ValueError("no rows to train on")
    classes = sorted(r["y"] for r in found)
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), to_col(target)) - 1
    rows = df.filter(to_col(target).isNotNull()).select(
        number.cast("int").alias("y"), *[feature(c).alias(f"x{i}") for i, c in enumerate(input_cols)], *more
    )
    return rows, classes


def descend(df: DataFrame, cols: list[Column], nodes: list[dict[str, Any]], out: str, root: Column | None = None) -> DataFrame:
    """``out`` = the number of the leaf a row ends in, from the first node or the one that ``root`` numbers.

    The tree lies in constant arrays. One projection per level follows a branch, which stays in generated code
    for trees of any size.
    """
    levels = max(n["depth"] for n in nodes) - 1
    leaf = [n["feature"] is None for n in nodes]
    own = range(len(nodes))
    which = long_array([0 if l else n["feature"] for l, n in zip(leaf, nodes)])
    bound = double_array([0.0 if l else n["threshold"] for l, n in zip(leaf, nodes)])
    left = long_array([i if l else n["left"] for i, l, n in zip(own, leaf, nodes)])
    right = long_array([i if l else n["right"] for i, l, n in zip(own, leaf, nodes)])
    df = df.withColumn("__x", F.array(*cols)).withColumn(out, F.lit(0) if root is None else root)
    for _ in range(levels):
        at = F.col(out)
        x = F.get(F.col("__x"), F.get(which, at).cast("int"))
        df = df.withColumn(out, F.when(x < F.get(bound, at), F.get(left, at)).otherwise(F.get(right, at)).cast("int"))
    return df.drop("__x")


class DecisionTreeClassifier(TableEstimator):
    """A node stays a leaf when no split lowers its gini, a child would have fewer than ``min_samples`` rows,
    or its depth (the root's is 1) exceeds ``max_depth``. Siblings that predict one and the same class collapse.
    Inputs must have no missing values.

    By default every value of an input is a candidate. With ``max_bins`` only so many are, at exact quantiles of the input: a node's
    histogram then has no more than ``max_bins`` lines an input, and of two siblings only the smaller one is counted, as the other
    is their parent less that one."""

    def __init__(self, input_cols, target_cols, max_depth: int = 3, min_samples: int = 5, max_classes: int = 100, max_bins: int | None = None):
        super().__init__()
        if max_bins is not None and max_bins < 2:
            raise ValueError("there are at least 2 bins")
        self.max_bins = max_bins
        self.input_cols = as_list(input_cols)
        self.target_cols = as_list(target_cols)
        if len(self.target_cols) != 1:
            raise ValueError("a tree takes one target")
        self.max_depth = max_depth
        self.min_samples = min_samples
        self.max_classes = max_classes

    def _fit(self, dataset: DataFrame) -> "DecisionTreeModel":
        d = len(self.input_cols)
        rows, classes = training_rows(dataset, self.input_cols, self.target_cols[0], self.max_classes)
        rows = binned(rows, d, self.max_bins) if self.max_bins else rows
        cached = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            nodes = self._grow(cached.withColumn("run", F.lit(0)), d, len(classes))
        finally:
            cached.unpersist()
        return self._model(classes, nodes)

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "DecisionTreeModel"]:
        """One tree per fold, all grown together: a level is one job, with a histogram per (tree, node), that a row enters once
        for every fold but its own. The trees are those of a training by fold."""
        if self.max_bins:  # each fold's bins are those of its own training rows
            return super().fit_folds(df, fold_col, folds)
        d = len(self.input_cols)
        known = df.filter(to_col(fold_col).isNotNull())
        rows, classes = training_rows(known, self.input_cols, self.target_cols[0], self.max_classes, to_col(fold_col).alias("fold"))
        cached = rows.persist(StorageLevel.MEMORY_AND_DISK)
        others = F.filter(F.array(*[F.when(F.col("fold") != i, F.lit(j)) for j, i in enumerate(folds)]), lambda j: j.isNotNull())
        try:
            nodes = self._grow(cached.withColumn("run", F.explode(others)).drop("fold"), d, len(classes), len(folds))
        finally:
            cached.unpersist()
        return {i: self._model(classes, _one_tree(nodes, j)) for j, i in enumerate(folds)}

    def _model(self, classes: list, nodes: list[dict[str, Any]]) -> "DecisionTreeModel":
        params = {
            "input_cols": self.input_cols,
            "target_cols": self.target_cols,
            "max_depth": self.max_depth,
            "min_samples": self.min_samples,
        }
        return DecisionTreeModel(params, {"classes": classes, "nodes": _collapsed(nodes)})

    def _grow(self, rows: DataFrame, d: int, classes: int, trees: int = 1) -> list[dict[str, Any]]:
        """The nodes of all trees, the roots first; ``run`` says which tree a row is for."""
        size = 0 if self.max_bins else rows.count()
        bounds = above = None
        nodes = [{"parent": None, "depth": 1, "feature": None} for _ in range(trees)]
        open_nodes, depth = list(range(trees)), 1
        while open_nodes:
            if len(open_nodes) > MAX_OPEN_NODES:
                raise ValueError(f"more than {MAX_OPEN_NODES} nodes on a level; lower max_depth or raise min_samples")
            placed = descend(rows, [F.col(f"x{i}") for i in range(d)], nodes, "node", F.col("run"))
            if depth > 1:
                # of siblings with bins only the smaller one's rows are counted
                counted = {i for i in open_nodes if not self.max_bins or _is_smaller(nodes, i)}
                placed = placed.filter(F.get(long_array([1 if i in counted else 0 for i in range(len(nodes))]), F.col("node")) == 1)
            histogram = class_histogram(placed, d, classes)
            large = False
            if self.max_bins:
                # a line per node, input and bin; kept for the level below
                level = written(histogram if above is None else _with_siblings(histogram, above, nodes, open_nodes, classes), "tree-level")
                if above is not None:
                    dropped(above)
                histogram = above = level
            elif range_depth(size) > 0:
                # many rows may still have few values; the way by ranges reads the histogram twice
                histogram = histogram.persist(StorageLevel.MEMORY_AND_DISK)
                large = range_depth(histogram.count()) > 0
                if large and bounds is None:
                    bounds = value_ranges(rows, d, range_depth(size))
            found = best_splits(split_scores(histogram, classes, bounds if large else [[]] * d), classes).collect()
            if not self.max_bins:
                histogram.unpersist()
            following = []
            for r in sorted(found, key=lambda r: r["node"]):
                node = nodes[r["node"]]
                left, total = list(r["left"]), list(r["total"])
                n, n_left = sum(total), sum(left)
                node.update(
                    samples=n, counts=total, gini=r["gini"],
                    impurity=1 - sum((c / n) ** 2 for c in total), label=max(range(classes), key=lambda k: (total[k], -k)),
                )
                no_split = n_left == 0 or n_left < self.min_samples or n - n_left < self.min_samples
                if no_split or depth > self.max_depth:
                    continue
                node.update(feature=r["f"], threshold=r["v"], left=len(nodes), right=len(nodes) + 1, left_smaller=2 * n_left <= n)
                following += [len(nodes), len(nodes) + 1]
                nodes += [{"parent": r["node"], "depth": depth + 1, "feature": None} for _ in range(2)]
            open_nodes, depth = following, depth + 1
        if above is not None:
            dropped(above)
        return nodes


def _one_tree(nodes: list[dict[str, Any]], root: int) -> list[dict[str, Any]]:
    """The nodes of one of several trees, numbered anew in the same order."""
    number = {root: 0}
    for i, node in enumerate(nodes):  # children come after their parent
        if i in number and node["feature"] is not None:
            number[node["left"]] = number[node["right"]] = -1
    number = {i: at for at, i in enumerate(sorted(number))}
    return [{k: number[v] if k in ("left", "right") or (k == "parent" and v is not None) else v for k, v in nodes[i].items()} for i in number]


def _collapsed(nodes: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Turns inner nodes whose leaves all predict one class into leaves, and renumbers level by level."""
    labels: dict[int, set] = {}
    for i in reversed(range(len(nodes))):  # children come after their parent
        node = nodes[i]
        if node["feature"] is None:
            labels[i] = {node["label"]}
            continue
        labels[i] = labels[node["left"]] | labels[node["right"]]
        if len(labels[i]) == 1:
            node["feature"] = None
    kept, new_number = [], {}
    for i, node in enumerate(nodes):
        parent = node["parent"]
        if parent is None or (parent in new_number and nodes[parent]["feature"] is not None):
            new_number[i] = len(kept)
            kept.append(i)
    out = []
    for i in kept:
        node = dict(nodes[i])
        node["parent"] = None if node["parent"] is None else new_number[node["parent"]]
        node.pop("left_smaller", None)
        if node["feature"] is None:
            for name in ("threshold", "left", "right"):
                node.pop(name, None)
        else:
            node["left"], node["right"] = new_number[node["left"]], new_number[node["right"]]
        out.append(node)
    return out


class DecisionTreeModel(TableModel):
    def with_leaf(self, df: DataFrame) -> DataFrame:
        return descend(df, [feature(c) for c in self.input_cols], self.state["nodes"], "leaf")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """C5."""
        labels = constant_array([self.state["classes"][n["label"]] for n in self.state["nodes"]])
        return self.with_leaf(dataset).withColumn("prediction", F.get(labels, F.col("leaf"))).drop("leaf")

    def rules(self, spark) -> DataFrame:
        """The fitted nodes as a table."""
        rows = [
            (
                i, n["parent"], n["depth"], None if n["feature"] is None else self.input_cols[n["feature"]],
                n.get("threshold"), float(n["gini"]), int(n["samples"]), self.state["classes"][n["label"]],
            )
            for i, n in enumerate(self.state["nodes"])
        ]
        label_type = "string" if isinstance(self.state["classes"][0], str) else ("double" if isinstance(self.state["classes"][0], float) else "bigint")
        return spark.createDataFrame(
            rows,
            "node int, parent int, depth int, feature string, threshold double, fit_gini double, fit_samples bigint, "
            f"label {label_type}",
        )

    def report(self, df: DataFrame) -> DataFrame:
        """Every node with the rows of ``df`` that pass it, their impurity and how many the label gets right."""
        nodes = self.state["nodes"]
        paths = []
        for i in range(len(nodes)):
            path, at = [], i
            while at is not None:
                path.append(at)
                at = nodes[at]["parent"]
            paths.append(",".join(map(str, path)))
        target = to_col(self.target_cols[0])
        # few rows from here on: leaves times classes
        mix = self.with_leaf(df).groupBy("leaf", target.alias("y")).agg(F.count(F.lit(1)).alias("n"))
        path = F.split(F.get(constant_array(paths), F.col("leaf")), ",").cast("array<int>")
        per_node = mix.select(F.explode(path).alias("node"), "y", "n").groupBy("node", "y").agg(F.sum("n").alias("n"))
        rules = F.broadcast(self.rules(df.sparkSession))
        seen = per_node.join(rules.select("node", "label"), "node").groupBy("node").agg(
            F.sum("n").alias("samples"),
            (1 - F.sum(F.col("n").cast("double") * F.col("n")) / F.pow(F.sum("n"), 2)).alias("impurity"),
            F.sum(F.when(F.col("y") == F.col("label"), F.col("n")).otherwise(0)).alias("correct"),
        )
        return rules.join(seen, "node", "left").na.fill(0, ["samples", "correct"])

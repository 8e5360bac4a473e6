"""Training layout: roles, batches, epochs, shuffles, splits and folds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_list, resolve, to_col
from .position import numbered_within, positional_with_count, rank_groups, shuffle_hash


def assign_roles(df: DataFrame, target) -> tuple[list[str], list[str]]:
    """L1: ``(input columns, target columns)``; whatever is not a target is an input."""
    targets = resolve(df, target)
    return [c for c in df.columns if c not in targets], targets


def data_block(df: DataFrame, target=None) -> DataFrame:
    """L2: the inputs as DOUBLE; all columns when no target is set."""
    inputs = assign_roles(df, target)[0] if target is not None else df.columns
    return df.select(*[to_col(c).cast("double").alias(c) for c in inputs])


def target_block(df: DataFrame, target=None) -> DataFrame:
    """L2: the targets as DOUBLE; a table without columns when no target is set."""
    targets = assign_roles(df, target)[1] if target is not None else []
    return df.select(*[to_col(c).cast("double").alias(c) for c in targets])


def steps_per_epoch(n: int, batch_size: int, drop_remainder: bool = False) -> int:
    return n // batch_size if drop_remainder else math.ceil(n / batch_size)


def _check_batch(batch_size) -> None:
    if not isinstance(batch_size, int) or isinstance(batch_size, bool) or batch_size < 1:
        raise ValueError("batch_size must be a positive integer")


def batch(df: DataFrame, batch_size: int = 32, drop_remainder: bool = False, row_key=None, pos: str = "pos") -> DataFrame:
    """L3: ``batch_id`` and ``batch_pos`` by position; a short last batch is kept unless dropped."""
    _check_batch(batch_size)
    placed, n = positional_with_count(df, row_key, pos=pos)
    return _batched(placed, n, batch_size, drop_remainder, pos)


def _batched(placed: DataFrame, n: int, batch_size: int, drop_remainder: bool, pos: str) -> DataFrame:
    out = placed.withColumn("batch_id", F.floor(F.col(pos) / batch_size)).withColumn(
        "batch_pos", F.pmod(F.col(pos), F.lit(batch_size)).cast("int")
    )
    return out.filter(F.col("batch_id") < n // batch_size) if drop_remainder else out


def repeat(df: DataFrame, times: int) -> DataFrame:
    """L4: every row ``times`` times, told apart by ``epoch``."""
    if not isinstance(times, int) or isinstance(times, bool) or times < 1:
        raise ValueError("times must be a positive integer; an endless repeat has no table")
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("epoch"))


def box_shuffle(
    df: DataFrame, row_key, box: int = 1000, seed: int = 42, pos: str = "pos", order_key=None
) -> DataFrame:
    """Permute rows inside consecutive boxes of ``box`` positions. With an ``epoch`` column each epoch has
    its own permutation. A box of n rows or more shuffles the whole table (L6)."""
    if not isinstance(box, int) or isinstance(box, bool) or box < 1:
        raise ValueError("box must be a positive integer")
    keys = as_list(row_key)
    by_epoch = "epoch" in df.columns
    base = df if pos in df.columns and order_key is None else positional_with_count(df, order_key or keys, pos=pos)[0]
    middle = [F.col("epoch").cast("string")] if by_epoch else []
    boxed = base.withColumn("__box", F.floor(F.col(pos) / box)).withColumn(
        "__hash", shuffle_hash(seed, keys, *middle)
    )
    group = ["epoch", "__box"] if by_epoch else ["__box"]
    ranked = numbered_within(boxed, group, "__hash", keys, box, "__rank")
    return ranked.withColumn(pos, F.col("__box") * box + F.col("__rank")).drop("__box", "__hash", "__rank")


def full_shuffle(df: DataFrame, row_key, seed: int = 42, pos: str = "pos") -> DataFrame:
    """``pos`` in the order of ``md5(seed:key)``."""
    return positional_with_count(df, row_key, seed, pos)[0]


def epoch_plan(
    df: DataFrame,
    row_key,
    epochs: int = 1,
    batch_size: int = 32,
    box: int | None = None,
    seed: int = 42,
    drop_remainder: bool = False,
    pos: str = "pos",
) -> DataFrame:
    """``epoch, batch_id, batch_pos`` for repeated, box-shuffled, batched passes; consumed by grouping."""
    _check_batch(batch_size)
    placed, n = positional_with_count(df, row_key, pos=pos)
    passes = repeat(placed, epochs)
    if box is not None:
        passes = box_shuffle(passes, row_key, box, seed, pos)
    return _batched(passes, n, batch_size, drop_remainder, pos)


def train_test_split(
    df: DataFrame, row_key, ratio: float = 0.8, shuffle: bool = True, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The first ``floor(ratio * n)`` rows of the (shuffled) order, and the rest; sizes are exact.

    Both parts are filters on the key: no row is shuffled.
    """
    if not 0.0 < ratio < 1.0:
        raise ValueError("ratio lies between 0 and 1")
    marked, _ = rank_groups(df, row_key, seed if shuffle else None, lambda n: [math.floor(ratio * n)], "__part")
    return marked.filter("__part = 0").drop("__part"), marked.filter("__part = 1").drop("__part")


def cross_val_folds(
    df: DataFrame,
    row_key,
    folds: int = 3,
    shuffle: bool = True,
    seed: int = 42,
    drop_remainder: bool = False,
    balanced: bool = False,
) -> DataFrame:
    """``fold_id`` by position, folds of ``n // folds`` rows; what remains is one more, short fold unless
    dropped. When n is small the full folds can outnumber ``folds``. ``balanced`` makes exactly ``folds`` folds
    that differ by at most one row."""
    if not isinstance(folds, int) or folds < 2:
        raise ValueError("there are at least 2 folds")
    full = 0

    def starts(n: int):
        nonlocal full
        if n <= folds:
            raise ValueError(f"{folds} folds for {n} rows")
        if balanced:
            return [math.ceil(i * n / folds) for i in range(1, folds)]
        size = n // folds
        full = n // size
        return range(size, n, size)

    out, _ = rank_groups(df, row_key, seed if shuffle else None, starts, "fold_id")
    return out.filter(F.col("fold_id") < full) if drop_remainder and not balanced else out

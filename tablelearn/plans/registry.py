"""Registry of queries ``(spark, folder) -> DataFrame`` and of the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for queries that write and read back."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded, with no negative zero: what two engines can agree on."""
    c = F.col(value) if isinstance(value, str) else value
    return F.round(c.cast("double"), digits) + 0.0


# The row position of a seeded shuffle and of the key's own order, as SQL.
def shuffled_pos(key: str, seed: int = 42) -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key}) - 1"


def natural_pos(key: str) -> str:
    return f"row_number() OVER (ORDER BY {key}) - 1"

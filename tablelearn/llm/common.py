"""What several operators share: written tables, hidden column names, and slices of Arrow batches."""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 2 * 2**20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table that ``saved`` wrote and that nothing reads any more."""
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns {missing} are not in the table")


def hidden(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns under names that clash with none."""
    return [df["`" + c.replace("`", "``") + "`"].alias(f"__kept_{i}") for i, c in enumerate(columns)]


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def lengths_of(column: pa.Array) -> list[int]:
    """The bytes of each text; null has none."""
    return pc.binary_length(column).fill_null(0).to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Rows as lists of Python values, one at a time: for rows that are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [c[i].as_py() for c in batch.columns]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit`` at most; a longer row is a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def per_slice(
    batches: Iterator[pa.RecordBatch], work: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch | None], text: int = 1, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Runs ``work`` on slices of about ``limit`` bytes of each batch; ``text`` is the position of its text column."""
    for batch in batches:
        for i, j in slices(lengths_of(batch.column(text)), limit):
            part = batch.slice(i, j - i)
            out = work(part, texts_of(part.column(text)))
            if out is not None and out.num_rows:
                yield out


class Memo(dict):
    """A bounded memo of ``make``: two generations of ``limit`` entries, so that what is used often stays."""

    def __init__(self, make: Callable[[str], bytes], limit: int = 250_000, longest: int = 64) -> None:
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def _worker_state() -> dict:
    """What a Python worker keeps between its tasks."""
    module = sys.modules.setdefault("_tablelearn_worker", types.ModuleType("_tablelearn_worker"))
    return module.__dict__.setdefault("kept", {})


def kept_by_worker(kind: type, spec: str) -> object:
    """``kind(spec)``, made once per Python worker: later tasks of the same worker find it with its memo."""
    state = _worker_state()
    name = f"{kind.__name__}-{hash(spec)}"
    if name not in state:
        state.clear()
        state[name] = kind(spec)
    return state[name]


def lean_worker() -> None:
    """Gives back what an encoder in an earlier job has kept in this worker; called by work that needs none."""
    state = _worker_state()
    if state:
        state.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()

"""Contiguous shards of nearly equal bytes, from prefix sums of document sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import require, saved


def byte_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """Puts every document into one of ``shards`` contiguous ranges of ``key`` with nearly equal bytes.

    Returns one row per input row: ``key``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``shard`` and
    ``slot`` (gapless from 0 in each shard). A document lies in the shard that holds its middle byte: the shards' sizes
    differ from the target by half a document at each end. Where a document is longer than a target, shards may be empty.

    Only narrow rows (key, size, checksum) are shuffled, once, by ranges of the key. Each range is written with its
    number, so no retry can deal rows anew; totals per range give the ranges' offsets, and running sums stay inside a
    range. A source or text that holds a third of all rows doesn't matter, as only the key deals out rows; rows that share
    one key share a range.

    Null text: size 1, checksum 0. Null keys come first. Rows with equal keys: by checksum and size, so repeated rows
    may change places only with their equals. Empty table: no rows. Other columns are not read.
    """
    require(docs, key, text)
    rows = docs.select(
        F.col(key).alias("__key"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = saved(rows.repartitionByRange("__key").withColumn("__range", F.spark_partition_id()), "shard-sizes")

    # one row per range; their number is that of the shuffle's partitions
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("__range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    everything = Window.partitionBy()
    offsets = totals.select(
        "__range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_offset"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row_offset"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("__range").orderBy(F.col("__key").asc_nulls_first(), "text_crc32", "size")
    running = placed.select(
        "*",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("__upto"),
        F.row_number().over(inside).alias("__row"),
    ).join(offsets, "__range")
    middle = F.col("byte_offset") + F.col("__upto") - F.col("size") + F.expr("size div 2")
    numbered = running.select(
        "__key",
        "size",
        "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / F.col("all_bytes"))).cast("int").alias("shard"),
        (F.col("row_offset") + F.col("__row") - 1).alias("__index"),
    )
    firsts = numbered.groupBy("shard").agg(F.min("__index").alias("__first"))
    return numbered.join(F.broadcast(firsts), "shard").select(
        F.col("__key").alias(key), "size", "text_crc32", "shard", (F.col("__index") - F.col("__first")).alias("slot")
    )

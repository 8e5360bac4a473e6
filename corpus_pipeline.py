"""A training corpus from ``documents``: language, near duplicates, repeated passages, contamination, tokens.

Each stage takes (spark, docs, folder), works on all that the one before kept, and is written before the next one reads it.
A document is a row; rows that share a doc_id but not a text are different documents, and a row without doc_id counts as
the one with the least. Null text counts as empty. Columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablelearn.llm import bpe, decontaminate, language, repeats, simhash
from tablelearn.llm.common import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key that tells apart texts of one doc_id and sorts by doc_id."""
    return docs.select(*COLUMNS, F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("__doc"))


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents in which no language can be told: null, empty, or without a letter. All others stay as they are.

    That also holds where the network knows no language, as no row that it may learn from has one (``lang`` is null in all of
    them): documents with a letter stay. The network's prediction drops none.
    """
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.fit_network(language.training_windows(docs)), keep=True, letter="__letter")
    return found.where("__letter").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the least doc_id, once; documents without words are one group."""
    keyed = _keyed(docs)
    groups = simhash.near_duplicates(keyed, key="__doc")
    first = groups.where(F.col("component_id").eqNullSafe(F.col("__doc"))).select("__doc").distinct()
    once = Window.partitionBy("__doc").orderBy("n_chars", "source", "lang")
    kept = keyed.join(first, "__doc", "left_semi")
    return kept.withColumn("__copy", F.row_number().over(once)).where("__copy = 1").select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes out of each text what a document with a lesser doc_id has too, in strings of 50 bytes; ``n_chars`` follows the text.

    All documents stay; one that is made up of such passages is left without text.
    """
    cut = repeats.remove_repeats(docs.select(*COLUMNS), keep=True)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents of which at least one word in twenty lies in a passage of a benchmark item."""
    keyed = _keyed(docs)
    found = decontaminate.find_passages(keyed, spark.read.parquet(f"{folder}/benchmark.parquet"), key="__doc")
    return keyed.join(found.where("contaminated").select("__doc").distinct(), "__doc", "left_anti").select(*COLUMNS)


def encode_and_decode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs, path, decoded=True).select("doc_id", "n_tokens", "ids", "text")


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", remove_repeated_passages),
    ("benchmark contamination", drop_contaminated),
    ("tokens", encode_and_decode),
]

#: SQL has no XXH64, no trained network and no byte-pair merges; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)

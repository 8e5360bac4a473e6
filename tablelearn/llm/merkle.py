"""A Merkle manifest of a table: a leaf per row, a tree per group, and a tree over the groups' roots.

Where a leaf stands in its group is found without sorting rows. The keys of a group are a bitmap, kept as its words of 64
keys that aren't empty; words are merged from all tasks by bitwise or, and a directory holds how many rows lie before each.
A row's rank is its word's entry plus the bits below its own. Leaves then go into slot arrays of ``BLOCK`` places, keyed by
group and block; an array is reduced seven levels at a time, and its root is a slot of the next round's arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.position import positional
from .common import require, saved

RUN, STEPS = 3, 7
BLOCK = RUN**STEPS


def field(value: Column) -> Column:
    """How one value enters a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    """The digest (lowercase hex SHA-256) of a row's values in their order."""
    return _digest([field(v) for v in values])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, run: F.sha2(F.concat(run["left"], node, run["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf's level to the root's, left to right."""
    return _digest([F.concat_ws("", F.transform(proof, lambda run: F.concat(run["left"], run["right"])))])


def manifest(docs: DataFrame, key: str, group: str, fields: Sequence[str], claimed: Column | None = None) -> DataFrame:
    """One row per input row: ``key``, ``leaf``, ``claimed``, ``position`` in its group, ``subroot``, ``root`` and ``proof``.

    A leaf is the digest of ``fields``; ``claimed`` is a leaf to be held against the root (``fold``), or null. In a group,
    leaves ascend by ``key``, an integer; every ``RUN`` consecutive nodes become their digest, the last run's fewer ones too,
    until one is left: the subroot, and a lone leaf's own digest where it is alone. Subroots in bytewise order of their group,
    null first, become the root in the same way. ``proof`` has for each level the digests ``left`` and ``right`` of the
    node, concatenated.

    Rows are shuffled three times, as keys and digests without text. No group is in one task: bitmaps are dealt by ranges of
    (group, key), slot arrays hold ``BLOCK`` leaves, and the directory's offsets come from totals per range. Rows that share
    group and key go by leaf, and are numbered by the leaf's first digits and by the part of the table that they came from;
    null keys come first and are numbered that way only. Repeated rows take places in any order, as their leaves are equal.
    Null or empty text is as any value. Empty table: no rows. Columns beyond those named are not read.
    """
    require(docs, key, group, *fields)
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))
    leaves = saved(
        docs.select(
            F.col(key).cast("long").alias("key"),
            tree.alias("tree"),
            leaf_of([F.col(f) for f in fields]).alias("leaf"),
            (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
            F.spark_partition_id().alias("part"),
        ),
        "merkle-leaves",
    )
    words = _directory(leaves)
    sizes = words.groupBy("tree").agg(F.sum("rows").alias("size"))
    nodes = _ranked(leaves, words).withColumnRenamed("leaf", "digest")
    rounds, subroots = _reduced(nodes, sizes, ["key", "claimed"])

    tops = positional(subroots.select("tree", "digest"), ["tree"], pos="position").withColumnsRenamed({"tree": "group"})
    tops = tops.withColumn("tree", F.lit(""))
    top_rounds, top = _reduced(tops, tops.groupBy("tree").agg(F.count("*").alias("size")), ["group"])
    root = top.select("digest").first()
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = top.select("tree", "position", nothing.alias("proof"))
    for blocks in reversed(top_rounds):
        above = _with_proofs(blocks, above)
    above = above.select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("position"), "proof", F.col("digest").alias("subroot"))
    for blocks in reversed(rounds):
        above = _with_proofs(blocks, above)
    return above.select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "claimed", "position", "subroot", F.lit(root and root.digest).cast("string").alias("root"), "proof"
    )


def _digest(parts: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _word(key: Column) -> list[Column]:
    """The bitmap word that holds a key, and the key's bit in it."""
    return [F.shiftright(key, 6).alias("word"), key.bitwiseAND(F.lit(63)).cast("int").alias("bit")]


def _directory(leaves: DataFrame) -> DataFrame:
    """Each group's bitmap words (tree, word, bits) with the rows in them, those before them, and the keys that come again.

    The rows without key are word null. Words are merged before and after the shuffle, and dealt by ranges of (tree, word).
    """
    keys = leaves.groupBy("tree", "key").agg(F.count("*").alias("m"))
    words = keys.select("tree", "m", *_word(F.col("key"))).groupBy("tree", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"),
        F.sum("m").alias("rows"),
        # at most 64 entries
        F.collect_list(F.when(F.col("m") > 1, F.struct("bit", (F.col("m") - 1).alias("more")))).alias("repeats"),
    )
    dealt = saved(words.repartitionByRange("tree", "word").withColumn("range", F.spark_partition_id()), "merkle-bitmaps")
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("tree", "range").agg(F.sum("rows").alias("n"))
    offsets = totals.select("tree", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("tree", "range").orderBy(F.col("word").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    running = dealt.withColumn("upto", F.sum("rows").over(inside)).join(offsets, ["tree", "range"])
    return running.select("tree", "word", "bits", "rows", "repeats", (F.col("offset") + F.col("upto") - F.col("rows")).alias("before"))


def _ranked(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """Leaves with their ``position`` in their group."""
    keyed = leaves.where("key IS NOT NULL").select("*", *_word(F.col("key"))).join(words, ["tree", "word"])
    below = F.aggregate(F.filter("repeats", lambda r: r["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda n, r: n + r["more"])
    rank = F.col("before") + F.expr("bit_count(bits & ~shiftleft(-1L, bit))") + below
    columns = ["tree", "key", "leaf", "claimed", "part"]
    ranked = keyed.select(*columns, rank.alias("position"), F.exists("repeats", lambda r: r["bit"] == F.col("bit")).alias("again"))
    lone = ranked.where("NOT again").select("tree", "position", "key", "leaf", "claimed")
    unkeyed = leaves.where("key IS NULL").select(*columns, F.lit(0).cast("long").alias("position"))
    return lone.unionByName(_numbered(ranked.where("again").drop("again").unionByName(unkeyed)))


def _numbered(tied: DataFrame) -> DataFrame:
    """Rows that share group and key, numbered by leaf: an offset per digits, one per leaf and part, and a number in these."""
    same = ["tree", "key", "digits"]
    cut = tied.withColumn("digits", F.substring("leaf", 1, 3))
    counts = cut.groupBy(*same, "leaf", "part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*same).orderBy("leaf", "part").rowsBetween(Window.unboundedPreceding, -1))
    by_digits = Window.partitionBy("tree", "key").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy(*same).agg(F.sum("n").alias("n")).select(*same, F.coalesce(F.sum("n").over(by_digits), F.lit(0)).alias("start"))
    offsets = counts.select(*same, "leaf", "part", F.coalesce(upto, F.lit(0)).alias("inner"))
    for table in (starts, offsets):
        on = [F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in table.columns[:-1]]
        cut = cut.alias("t").join(table.alias("o"), on).select("t.*", f"o.{table.columns[-1]}")
    number = F.row_number().over(Window.partitionBy(*same, "leaf", "part").orderBy("position")) - 1
    return cut.select("tree", (F.col("position") + F.col("start") + F.col("inner") + number).alias("position"), "key", "leaf", "claimed")


def _reduced(nodes: DataFrame, sizes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of every round, and each tree's last node. ``payload`` stays with the nodes of the first round."""
    largest = sizes.agg(F.max("size")).first()[0] or 0
    rounds = []
    while not rounds or largest > 1:
        place = F.struct("position", "digest", *payload)
        blocks = nodes.groupBy("tree", F.expr(f"position div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(place)).alias("slots"))
        rounds.append(saved(blocks.join(sizes, "tree"), "merkle-slots"))
        last = F.element_at("levels", -1)
        nodes = rounds[-1].withColumn("levels", _levels()).select("tree", F.col("block").alias("position"), F.element_at(last, 1).alias("digest"))
        sizes = sizes.select("tree", F.ceil(F.col("size") / BLOCK).alias("size"))
        largest, payload = -(-largest // BLOCK), []
    return rounds, nodes


def _steps() -> Column:
    """Levels to go in one block: until one node is left, ``STEPS`` at most."""
    return sum((F.when(F.col("size") > RUN**k, 1).otherwise(0) for k in range(STEPS)), F.lit(0))


def _levels() -> Column:
    """A block's nodes of all levels, its slots first."""

    def parents(nodes: Column) -> Column:
        runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / RUN).cast("int"))
        return F.transform(runs, lambda i: F.sha2(F.concat_ws("", F.slice(nodes, i * RUN + 1, RUN)).cast("binary"), 256))

    return F.aggregate(
        F.array_repeat(F.lit(0), _steps()),
        F.array(F.transform("slots", lambda s: s["digest"])),
        lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))),
    )


def _with_proofs(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of a round's blocks, each with its siblings up to the root; further columns of ``above`` are handed down."""

    def siblings(slot: Column) -> Column:
        def run(_: Column, k: Column) -> Column:
            nodes, place = F.element_at("levels", k + 1), F.floor(slot / F.pow(F.lit(RUN), k)).cast("int")
            inside = place % RUN
            left = F.slice(nodes, place - inside + 1, inside)
            return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", F.slice(nodes, place + 2, RUN - 1 - inside)).alias("right"))

        return F.transform(F.array_repeat(F.lit(0), _steps()), run)

    found = blocks.join(above.withColumnRenamed("position", "block"), ["tree", "block"]).withColumn("levels", _levels())
    names = blocks.schema["slots"].dataType.elementType.names
    rows = F.transform("slots", lambda s, i: F.struct(*[s[c].alias(c) for c in names], F.concat(siblings(i), F.col("proof")).alias("proof")))
    others = [c for c in above.columns if c not in {"tree", "position", "proof", *names}]
    return found.select("tree", *others, F.inline(rows))

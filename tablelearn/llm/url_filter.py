"""URL rules by a cascade of Bloom filters: exact membership over the corpus's own keys, without joins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import require, saved

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits a key and hashes of the first level and of all others. The first lets one key in some two million through that isn't
#: listed, so the second, which holds these, stays small however many keys the corpus has.
FIRST, LATER = (32, 16), (10, 4)
MAX_LEVELS = 64
#: A level's words travel in the plan, so the size of every level is checked before it is built.
MAX_FILTER_BYTES = 256 * 2**20


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(key: Column, bits: int, seed: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, and the seed and number of its hashes."""

    words: tuple[int, ...]
    seed: int
    hashes: int

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        tests = [
            F.bit_get(F.get(words, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1
            for bit in _bits(key, 64 * len(self.words), self.seed, self.hashes)
        ]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def filter_bytes(keys: int, bits: int) -> int:
    return 8 * max(1, math.ceil(keys * bits / 64))


def _level(keys: DataFrame, count: int, seed: int) -> Level:
    bits, hashes = LATER if seed else FIRST
    size = filter_bytes(count, bits) // 8
    if 8 * size > MAX_FILTER_BYTES:
        raise ValueError(f"a filter of {count} keys takes {8 * size} bytes, more than {MAX_FILTER_BYTES}")
    bit = F.explode(F.array(*_bits(F.col("key"), 64 * size, seed, hashes)))
    words = (
        keys.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("value"))
        .collect()  # size words at most
    )
    found = {r.word: r.value for r in words}
    return Level(tuple(found.get(i, 0) for i in range(size)), seed, hashes)


@dataclass(frozen=True)
class Cascade:
    """Levels that encode, in turn, listed keys and the other kind's keys that the level before lets through."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed. The first level that refuses it decides; the last one is never wrong."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels), 0, -1):
            out = F.when(~self.levels[n - 1].holds(key), F.lit(n % 2 == 0)).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Filters that tell the keys of ``listed`` from all other keys of ``universe`` without error (both: column ``key``).

    The universe is scanned once: only its keys that pass the first filter and aren't listed go on, and each further
    level holds a small part of the level two before it.
    """
    encoded = saved(listed.select("key").where("key is not null").distinct(), "url-listed")
    count, levels, others = encoded.count(), [], None
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade doesn't end; are there keys with equal hashes under every seed?")
        level = _level(encoded, count, len(levels))
        levels.append(level)
        if others is None:
            passing = universe.where(level.holds(F.col("key"))).select("key").distinct().join(encoded, "key", "left_anti")
        else:
            passing = others.where(level.holds(F.col("key")))
        others, encoded = encoded, saved(passing, "url-passing")
        count = encoded.count()
    return Cascade(tuple(levels))


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys of all rules that could fit, longest first: the host's last n labels with the path's first m characters."""
    parts = F.split(host, "\\.")
    hosts = F.transform(
        F.filter(F.array(*map(F.lit, labels)), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    paths = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda m: m <= F.length(path)), lambda m: F.substring(path, F.lit(1), m))
    keys = F.flatten(
        F.transform(
            hosts,
            lambda h: F.transform(
                paths,
                lambda p: F.struct((-F.length(h) - F.length(p)).alias("short"), (-F.length(h)).alias("short_host"), F.concat(h, p).alias("key")),
            ),
        )
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """The verdict of the longest rule that fits each url.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits its host and all subdomains, if the url's
    path starts with the rule's. Longest: most characters in host and path together, then in the host. A rule listed with
    both verdicts blocks. Returns ``key``, host, path, rule (host and path; null where none fits) and verdict
    (``default`` where none fits), one row per input row; no row is shuffled.

    The universe of the cascades is every key that any of these urls could be listed under, so membership is exact for
    all of them. There is one cascade per verdict, up to ``MAX_FILTER_BYTES`` a level (some 64 million rules), beyond which
    the job fails.

    Null url, or one without ``://``: host and path are empty, no rule fits. Rules with a null host or path never fit.
    Repeated rows are judged each. Empty tables: no rows, or all rows with ``default``. Other columns are not read.
    """
    require(pages, key, url)
    require(rules, "host", "path", "verdict")
    rules = rules.where("host is not null and path is not null").select(
        F.concat("host", "path").alias("key"), F.size(F.split("host", "\\.")).alias("labels"), F.length("path").alias("length"), "verdict"
    )
    shape = rules.agg(
        F.collect_set("labels").alias("labels"),  # as many as there are lengths of rules
        F.collect_set("length").alias("lengths"),
        F.count("*").alias("n"),
    ).first()
    rows = pages.select(F.col(key).alias("__key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    columns = [F.col("__key").alias(key), "host", "path", "rule"]
    if shape.n == 0:
        return rows.withColumn("rule", F.lit(None).cast("string")).select(*columns, F.lit(default).alias("verdict"))
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), sorted(shape.labels), sorted(shape.lengths)))
    universe = keyed.select(F.explode("keys").alias("key"))
    block = build_cascade(rules.where("verdict = 'block'"), universe)
    allow = build_cascade(rules.where("verdict = 'allow'"), universe)
    judged = F.transform("keys", lambda k: F.struct(k.alias("key"), block.holds(k).alias("block"), allow.holds(k).alias("allow")))
    first = F.get(F.filter(judged, lambda k: k["block"] | k["allow"]), F.lit(0))
    return (
        keyed.withColumn("first", first)
        .withColumn("rule", F.col("first.key"))
        .select(
            *columns,
            F.when(F.col("first").isNull(), F.lit(default)).when(F.col("first.block"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        )
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")

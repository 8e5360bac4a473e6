from zlib import crc32

from llm_data import ODD, SF, docs_of

from tablelearn.llm import sharding
from tablelearn.llm.queries import QUERIES


def brute(data, shards=16):
    data = [(k, (t or "").encode()) for k, t in data]
    data.sort(key=lambda r: (r[0] is not None, r[0] or 0, crc32(r[1]), len(r[1])))
    total, before, out, slots = sum(len(t) + 1 for _, t in data), 0, [], {}
    for k, t in data:
        size = len(t) + 1
        middle = before + size // 2
        shard = min(shards - 1, middle * shards // total)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((k, size, crc32(t), shard, slots[shard]))
        before += size
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, documents):
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in QUERIES["op10_sharding"](spark, SF).collect()]
    assert sorted(got, key=repr) == brute([(k, t) for k, t, _ in documents])


def test_odd_rows(spark):
    docs = docs_of(spark, [(k, t, 0, 0) for k, t in ODD], "doc_id long, text string, size long, shard int")
    for shards in (1, 3, 50):
        got = [tuple(r) for r in sharding.byte_shards(docs, shards=shards).collect()]
        assert sorted(got, key=repr) == brute(ODD, shards)


def test_empty_table(spark):
    assert sharding.byte_shards(docs_of(spark, [])).collect() == []


def test_shards_are_contiguous_and_nearly_equal(spark, documents):
    rows = sorted(tuple(r) for r in sharding.byte_shards(docs_of(spark, [(k, t) for k, t, _ in documents])).select("doc_id", "size", "shard").collect())
    assert [s for *_, s in rows] == sorted(s for *_, s in rows)
    target, longest = sum(n for _, n, _ in rows) / 16, max(n for _, n, _ in rows)
    for shard in range(16):
        assert abs(sum(n for _, n, s in rows if s == shard) - target) <= longest + 1

import xxhash
from llm_data import ODD, SF, docs_of

from tablelearn.llm import simhash
from tablelearn.llm.queries import QUERIES


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (key, fingerprint). The least key reachable of each row, None counting as least."""
    order = lambda k: (k is not None, k or 0)
    label = [k for k, _ in prints]
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 3 and order(label[j]) < order(label[i]):
                    label[i], changed = label[j], True
    return label


def check(spark, data, out):
    prints = [(k, brute_fingerprint(t)) for k, t in data]
    with_key = [(k, p) for k, p in prints if k is not None]
    least = dict(zip([p for _, p in with_key], brute_components(with_key)))
    want = sorted(((k, f"{p:016x}", least.get(p)) for k, p in prints), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=repr) == want


def test_query_against_brute_force(spark, documents):
    check(spark, [(k, t) for k, t, _ in documents], QUERIES["op1_simhash_near_dedup"](spark, SF))


def test_odd_rows(spark):
    docs = docs_of(spark, [(k, t, 1, 2) for k, t in ODD], "doc_id long, text string, fp long, n_links long")
    check(spark, ODD, simhash.near_duplicates(docs))


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).collect() == []


def test_every_link_is_found_in_short_and_long_lists(spark, monkeypatch):
    import random

    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base[:8]:  # many fingerprints that share most of their bytes
        for _ in range(60):
            x = b
            for bit in rnd.sample(range(64), rnd.randint(0, 4)):
                x ^= 1 << bit
            prints.add(x)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = sorted((a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    for limit in (0, 7, 10_000):
        monkeypatch.setattr(simhash, "LONG_LIST", limit)
        got = [(r.x, r.y) for r in simhash.links(table).collect()]
        assert len(got) == len(set(got)) and sorted(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert {n for n, r in got.items() if r == 0} >= set(range(1, 51))
    assert {got[100 + i] for i in range(1, 40)} == {100} and got[201] == 200

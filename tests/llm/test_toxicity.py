import random
from zlib import crc32

import duckdb
import numpy as np
import pytest
from llm_data import ODD, docs_of

from tablelearn.llm import toxicity as tox
from tablelearn.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"
INSULTS = {"idiot": 4.0, "idiot$": 4.0, "clow": 3.0, "clowd$": 0.0}


def clauses(text, weights=INSULTS):
    return tox.Grammar().clauses(tox.Lexicon(weights).events(text)[0])


def test_the_grammar_scores_clauses_in_their_context():
    assert clauses("An idiot, that clown.") == [4.0, 3.0]
    assert clauses("a clowd of words") == []
    assert clauses("you idiot") == [4.0 * tox.TARGETED]
    assert clauses("he is not an idiot") == [4.0 * tox.NEGATED]
    assert clauses("not so. an idiot") == [4.0]
    assert clauses("not one two three four idiot") == [4.0]
    assert clauses("he said that idiot won. idiot") == [4.0 * tox.REPORTED, 4.0]
    assert clauses('"what an idiot" he wrote. an idiot') == [4.0 * tox.REPORTED, 4.0]
    assert clauses("she called you no idiot") == [4.0 * tox.REPORTED * tox.NEGATED * tox.TARGETED]
    assert clauses("i will kill you") == [tox.THREAT_WEIGHT] == clauses("you, you i kill")
    assert clauses("kill the lights") == [] == clauses("i will not kill you") == clauses("he said: kill you")


def plainly(events):
    """The same by counters, one word after the other."""
    out, clause = [], 0.0
    negated = seen = waits = 0
    told = quoted = False
    words = {place: (s, w) for place, s, w in events}
    for place in range(max(words, default=-1) + 1):
        s, w = words.get(place, (tox.PLAIN, 0.0))
        speech = told or quoted
        if s == tox.INSULT:
            clause += w * (tox.NEGATED if negated else 1) * (tox.REPORTED if speech else 1) * (tox.TARGETED if seen else 1)
        threat = s == tox.THREAT and not negated and not speech
        if (threat and seen) or (s == tox.TARGET and waits):
            clause += tox.THREAT_WEIGHT
        near = seen
        negated, seen, waits = max(negated - 1, 0), max(seen - 1, 0), max(waits - 1, 0)
        if s == tox.NEGATION:
            negated = tox.REACH
        if s == tox.TARGET:
            seen, waits = tox.REACH, 0
        if threat and not near:
            waits = tox.REACH
        if s == tox.REPORT and not quoted:
            told = True
        if s == tox.QUOTE:
            told, quoted = False, not quoted
        if s == tox.STOP:
            told = False
        if s in (tox.BREAK, tox.STOP):
            negated = seen = waits = 0
        if s >= tox.BREAK and clause:
            out.append(clause)
            clause = 0.0
    return out + [clause] * (clause != 0)


def test_the_composed_machine_against_counters():
    rng, grammar = random.Random(3), tox.Grammar()
    for _ in range(2000):
        events, place = [], 0
        for _ in range(rng.randrange(12)):
            place += rng.choice([1, 1, 1, 2, 3, 7])
            symbol = rng.choice([tox.INSULT, tox.THREAT, tox.TARGET, tox.NEGATION, tox.REPORT, tox.QUOTE, tox.BREAK, tox.STOP])
            events.append((place, symbol, 1.0 if symbol == tox.INSULT else 0.0))
        assert grammar.clauses(events) == pytest.approx(plainly(events)), events


def test_stems_are_drawn_towards_shorter_ones():
    counts = {"bad": [2, 1, 50, 9, 0, 0, 0, 0], "bad$": [40, 9, 0, 0, 0, 0, 0, 0], "badly": [0, 0, 1, 1, 0, 0, 0, 0]}
    counts = {s: [c * (1 if i % 2 else tox.UNIT) for i, c in enumerate(cells)] for s, cells in counts.items()}
    weights = tox.weights_of(counts, [10**7, 99, 10**7, 99, 0, 0, 0, 0], (0, 1))
    assert weights["badly"] > weights["bad"] > 2 > 0 > weights["bad$"]
    lexicon = tox.Lexicon(weights)
    assert lexicon.weight("bad") == weights["bad$"] and lexicon.weight("badxyz") == weights["bad"] and lexicon.weight("ba") == 0


def test_query_on_rows_held_out(spark):
    rows = QUERIES["op12_toxicity"](spark, LARGER).collect()
    marks = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGER}/labels.parquet'").fetchall())
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{LARGER}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(marks[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marks]
    toxic, clean = [p for m, p in held if m], [p for m, p in held if not m]
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.01


def synthetic(n, seed=0):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30)]
        bad = i % 3 == 0
        if bad:
            words[3] = words[9] = rng.choice(["vilest", "vilely", "vileness"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    return rows, marks


def test_odd_rows_and_copies_of_one_text(spark):
    rows, marks = synthetic(300)
    # a third of all rows is one clean text, labelled many times; some keys are labelled both ways, null or otherwise
    rows += [(1000 + i, "vilest alpha") for i in range(150)]
    marks += [(1000 + i, 0) for i in range(150)] + [(None, 1), (1, 1), (1, 0), (2, None), (4, 7)]
    docs = spark.createDataFrame([(k, t, 0.5, 1) for k, t in rows + ODD], "doc_id long, text string, score double, toxic int")
    model = tox.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = tox.score(docs, model).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((k for k, _ in rows + ODD), key=repr)
    by_key = {r.doc_id: r.predicted for r in got}
    assert np.mean([by_key[i] == (i % 3 == 0) for i in range(20, 300)]) > 0.95
    odd = docs_of(spark, ODD)
    assert {r.predicted for r in tox.score(odd, model).collect()} == {0}


@pytest.mark.parametrize("marks,want", [([], 0), ([(i, 0) for i in range(9)], 0), ([(i, 1) for i in range(9)], 1), ([(i, None) for i in range(9)], 0)])
def test_labels_of_one_class_or_none(spark, marks, want):
    docs = docs_of(spark, [(i, f"word{i} idiot") for i in range(9)] + [(9, None)])
    model = tox.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert {r.predicted for r in tox.score(docs, model).collect()} == {want}
    assert tox.score(docs_of(spark, []), model).collect() == []
    assert tox.fit(docs_of(spark, []), spark.createDataFrame(marks, "doc_id long, toxic int")).weights == {}

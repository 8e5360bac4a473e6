"""Toxicity of whole texts by a weighted finite-state grammar over clauses.

A lexical transducer reads words by their letters and writes what they are: an insult with its weight, a threat, a target, a
negation, a verb of reported speech, a quote mark or the end of a clause. Which words and stems insult is learned from labelled
texts. Three small transducers over these symbols are composed into one machine: a negation takes most of the weight of insults
after it, reported speech takes some, a target nearby adds to it, and a threat counts only with a target. The weights that the
machine lets through are added up by clause, and a text is scored from its clauses.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.position import lowest_hashes
from .common import Memo, lean_worker, per_slice, require, saved

PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, BREAK, STOP = range(9)
SYMBOLS = 9
#: The words of the grammar's closed classes.
CLOSED = {
    TARGET: "you your yours yourself u du dich dir dein deine euch ihr tu toi ton vous tú ti tus usted vosotros",
    THREAT: "kill hurt stab shoot strangle punch burn destroy töten umbringen erschießen verprügeln tuer frapper étrangler matar golpear",
    NEGATION: "not no never nobody isn aren wasn weren nicht kein keine nie niemals pas jamais aucun nunca jamás",
    REPORT: "said says say told wrote writes called calls quoted claimed reported sagte schrieb nannte berichtete dit écrit appelé déclaré dijo escribió llamó",
}
MARKS = {**dict.fromkeys(",;:()[]|—–", BREAK), **dict.fromkeys(".!?…", STOP), **dict.fromkeys("\"“”„«»", QUOTE)}
#: How many words a negation or a target reaches, and what becomes of an insult's weight.
REACH, NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 4, 0.25, 0.5, 1.25, 3.0
#: Letters of a stem; documents of each class that are learned from; stems and words that are kept; least documents and log odds of one.
STEM, SAMPLE_DOCS, LEXICON, LEAST_DOCS, LEAST_WEIGHT = (2, 9), 10_000, 50_000, 3, 2.0
#: A text's words count ``UNIT`` each; beyond so many words, as much as these together, so that no long text outweighs the rest.
UNIT, LONG = 1000, 1000
THRESHOLD = 0.7
_WORD_OR_MARK = re.compile(r"[^\W\d_]+|[" + re.escape("".join(MARKS)) + "]")
_WORD = re.compile(r"[^\W\d_]+")


class Transducer:
    """States and arcs: (state, symbol) -> (state, symbol written, factor on its weight). Arcs that aren't given keep the symbol
    and go where ``default`` says."""

    def __init__(self, states: int, default: Callable[[int, int], int]) -> None:
        self.states = states
        self.arcs = {(s, a): (default(s, a), a, 1.0) for s in range(states) for a in range(SYMBOLS)}

    def arc(self, state: int, symbol: int, to: int, writes: int | None = None, factor: float = 1.0) -> None:
        self.arcs[state, symbol] = (to, symbol if writes is None else writes, factor)

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes, the other one reads."""
        out = Transducer(self.states * other.states, lambda s, a: s)
        for (s, a), (to, symbol, factor) in self.arcs.items():
            for t in range(other.states):
                to_other, written, more = other.arcs[t, symbol]
                out.arcs[s * other.states + t, a] = (to * other.states + to_other, written, factor * more)
        return out


def negation() -> Transducer:
    """A negation takes most of the weight of insults and threats within ``REACH`` words, in its clause."""
    t = Transducer(REACH + 1, lambda s, a: 0 if a in (BREAK, STOP) else REACH if a == NEGATION else max(s - 1, 0))
    for s in range(1, REACH + 1):
        t.arc(s, INSULT, s - 1, factor=NEGATED)
        t.arc(s, THREAT, s - 1, PLAIN)
    return t


def reported_speech() -> Transducer:
    """After a verb of speech, to the end of the sentence, and between quote marks, others speak."""
    plain, told, quoted = 0, 1, 2
    t = Transducer(3, lambda s, a: plain if a == STOP and s == told else s)
    t.arc(plain, REPORT, told)
    for s in (plain, told):
        t.arc(s, QUOTE, quoted)
    t.arc(quoted, QUOTE, plain)
    for s in (told, quoted):
        t.arc(s, INSULT, s, factor=REPORTED)
        t.arc(s, THREAT, s, PLAIN)
    return t


def target() -> Transducer:
    """Adds to insults near a target; a threat counts once a target stands within ``REACH`` words of it, before or after."""
    # 0: nothing; 1..REACH: a target was seen; REACH+1..2*REACH: a threat waits for one
    step = lambda s, a: 0 if a in (BREAK, STOP) else s - 1 if s not in (0, REACH + 1) else 0
    t = Transducer(2 * REACH + 1, step)
    for s in range(2 * REACH + 1):
        seen, waits = 0 < s <= REACH, s > REACH
        t.arc(s, TARGET, REACH, THREAT if waits else TARGET)
        t.arc(s, THREAT, step(s, PLAIN) if seen else 2 * REACH, THREAT if seen else PLAIN)
        if seen:
            t.arc(s, INSULT, step(s, PLAIN), factor=TARGETED)
    return t


class Grammar:
    """The composed machine as tables; runs of plain words are taken in one step."""

    def __init__(self) -> None:
        machine = negation().then(reported_speech()).then(target())
        cells = [[machine.arcs[s, a] for a in range(SYMBOLS)] for s in range(machine.states)]
        self.next = [[c[0] for c in row] for row in cells]
        # the factor on an insult's own weight, or the weight of a threat
        self.passed = [[f if w == INSULT else 0.0 for _, w, f in row] for row in cells]
        self.threat = [[THREAT_WEIGHT * f if w == THREAT else 0.0 for _, w, f in row] for row in cells]
        self.idle = [list(range(machine.states))]
        for _ in range(REACH + 1):
            self.idle.append([self.next[s][PLAIN] for s in self.idle[-1]])

    def clauses(self, events: list[tuple[int, int, float]]) -> list[float]:
        """What each matched clause weighs; ``events`` are (word's place, symbol, weight), plain words left out."""
        out, state, at, clause = [], 0, -1, 0.0
        last = len(self.idle) - 1
        for place, symbol, weight in events:
            gap = place - at - 1
            if gap > 0:
                state = self.idle[gap if gap < last else last][state]
            at = place
            clause += self.passed[state][symbol] * weight + self.threat[state][symbol]
            state = self.next[state][symbol]
            if symbol >= BREAK and clause:
                out.append(clause)
                clause = 0.0
        if clause:
            out.append(clause)
        return out


class Lexicon:
    """The lexical transducer: the symbol of each word, insults by the longest known stem or whole word (which ends in ``$``)."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.closed = {w: s for s, words in CLOSED.items() for w in words.split()}
        self.memo = Memo(self.read, 300_000)

    def weight(self, word: str) -> float:
        whole = self.weights.get(word + "$")
        if whole is not None:
            return whole
        for k in range(min(len(word), STEM[1]), STEM[0] - 1, -1):
            found = self.weights.get(word[:k])
            if found is not None:
                return found
        return 0.0

    def read(self, chunk: str) -> tuple[tuple[int, float], ...]:
        """The symbols of a run without white space; none where it is one plain word."""
        out = []
        for piece in _WORD_OR_MARK.findall(chunk.lower()):
            weight = 0.0 if piece in MARKS else self.weight(piece)
            symbol = MARKS.get(piece) or (INSULT if weight >= LEAST_WEIGHT else self.closed.get(piece, PLAIN))
            out.append((symbol, weight))
        return tuple(out) if any(s != PLAIN for s, _ in out) else ()

    def events(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """(place, symbol, weight) of all that isn't plain, and the number of words."""
        chunks = text.split()
        return [(i, s, w) for i, found in enumerate(map(self.memo.__getitem__, chunks)) if found for s, w in found], len(chunks)


FEATURES = 7


def features(lexicon: Lexicon, grammar: Grammar, text: str) -> list[float]:
    """What a score is made from; texts without a matched clause are all alike, however long."""
    events, words = lexicon.events(text)
    found = grammar.clauses(events)
    if not found:
        return [1.0] + [0.0] * (FEATURES - 1)
    total = sum(found)
    return [1.0, math.log1p(total), 10 * total / (words + 10), math.log1p(len(found)), max(found), math.log1p(words), math.log1p(total) * math.log1p(words) / 5]


@dataclass
class Model:
    """Stems and words with their weights, and how clauses make a score."""

    weights: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    slopes: np.ndarray

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        z = ((np.array(rows).reshape(-1, FEATURES) - self.mean) / self.scale) @ self.slopes
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def held_out(key: str) -> Column:
    """Rows that nothing is learned from; null keys are held out too."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def stems(word: str) -> Iterator[str]:
    for k in range(STEM[0], min(len(word), STEM[1]) + 1):
        yield word[:k]
    yield word + "$"


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[DataFrame, dict[int, float]]:
    """Distinct labelled texts (``toxic``, ``text``, ``fold``) that may be learned from, and how many rows one of a class stands for.

    At most ``SAMPLE_DOCS`` keys of each class, those of least hash; a key with both labels counts as 1, others than 0 and 1 as none.
    """
    require(docs, key, text)
    require(labels, key, label)
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = []
    for toxic, n in sorted(counts.items()):
        of_class = known.where(F.col("toxic") == toxic)
        picked += [(r.key, toxic) for r in lowest_hashes(of_class, F.md5(F.col("key").cast("string").cast("binary")), ["key"], SAMPLE_DOCS, n)]
    kind = known.schema["key"].dataType.simpleString()
    ids = F.broadcast(docs.sparkSession.createDataFrame(picked, f"key {kind}, toxic int"))  # 2 * SAMPLE_DOCS rows at most
    whole = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(ids, "key")
    # a text that comes again, be it by the million, is learned once: copies collapse before the shuffle
    once = whole.groupBy(F.xxhash64("text").alias("hash"), "toxic").agg(F.first("text").alias("text"))
    sample = saved(once.select("toxic", "text", F.pmod("hash", F.lit(2)).cast("int").alias("fold")), "toxicity-sample")
    return sample, {c: n / min(n, SAMPLE_DOCS) for c, n in counts.items()}


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, words in units and documents by fold and class); the empty stem counts all words."""
    lean_worker()

    def flush(counts: dict[str, list[int]]) -> pa.RecordBatch:
        cells = np.array(list(counts.values()), np.int64).reshape(-1, 8)
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *[pa.array(c) for c in cells.T]], ["stem", *_CELLS])

    counts: dict[str, list[int]] = defaultdict(lambda: [0] * 8)
    for batch in batches:
        for toxic, text, fold in zip(*(c.to_pylist() for c in batch.columns)):
            words = Counter(_WORD.findall(text.lower()))
            total = sum(words.values())
            each = UNIT if total <= LONG else max(1, UNIT * LONG // total)
            of_text = Counter({"": total * each})
            for w, n in words.items():
                for s in stems(w):
                    of_text[s] += n * each
            at = 2 * (2 * fold + toxic)
            for s, n in of_text.items():
                cell = counts[s]
                cell[at] += n
                cell[at + 1] += 1
            if len(counts) > 200_000:
                yield flush(counts)
                counts.clear()
    yield flush(counts)


_CELLS = [f"{what}{fold}{toxic}" for fold in (0, 1) for toxic in (0, 1) for what in ("words", "docs")]


def _stem_counts(sample: DataFrame) -> tuple[dict[str, list[int]], list[int]]:
    """Counts of stems that mark toxic texts, and of longer ones that may not; and those of all words."""
    schema = "stem string, " + ", ".join(f"{c} long" for c in _CELLS)
    counts = sample.select("toxic", "text", "fold").mapInArrow(_count_stems, schema).groupBy("stem").agg(*[F.sum(c).alias(c) for c in _CELLS])
    counts = saved(counts.where(f"stem = '' OR {' + '.join(c for c in _CELLS if c.startswith('docs'))} >= {LEAST_DOCS}"), "toxicity-stems")
    first = counts.where("stem = ''").first()
    if first is None:
        return {}, [0] * 8
    every = [first[c] for c in _CELLS]
    clean, toxic = every[0] + every[4], every[2] + every[6]
    odds = (F.expr("words01 + words11") + UNIT / 2) / max(toxic, 1) / ((F.expr("words00 + words10") + UNIT / 2) / max(clean, 1))
    marking = counts.where(f"stem != '' AND docs01 + docs11 >= {LEAST_DOCS}").where(F.log(odds) >= LEAST_WEIGHT)
    best = saved(marking.orderBy(F.desc(F.log(odds) * F.expr("docs01 + docs11")), "stem").limit(LEXICON), "toxicity-marks")
    # a longer stem or whole word takes the place of a shorter one, whatever it says itself
    shorter = F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[1])), lambda k: F.substring(F.col("stem"), F.lit(1), k))
    below = counts.where(F.length("stem") > STEM[0]).withColumn("above", F.explode(F.array_distinct(shorter))).where("above != stem")
    under = below.join(F.broadcast(best.select(F.col("stem").alias("above"))), "above", "left_semi").select("stem", *_CELLS).distinct()
    under = under.orderBy(F.desc(F.expr(" + ".join(c for c in _CELLS if c.startswith("docs")))), "stem").limit(LEXICON)
    found = {r.stem: [r[c] for c in _CELLS] for table in (best, under) for r in table.collect()}
    return found, every


def weights_of(counts: dict[str, list[int]], every: list[int], folds: tuple[int, ...]) -> dict[str, float]:
    """The log odds of each stem over those of any word, each drawn towards the longest stem within it."""

    def both(cells: list[int]) -> tuple[int, int, int]:
        return sum(cells[4 * f] for f in folds), sum(cells[4 * f + 2] for f in folds), sum(cells[4 * f + 1] + cells[4 * f + 3] for f in folds)

    clean, toxic, _ = both(every)
    if not clean or not toxic:
        return {}
    share, base = {"": toxic / (clean + toxic)}, math.log(toxic / clean)
    for stem in sorted(counts, key=len):
        c, t, docs = both(counts[stem])
        above = next(share[stem[:k]] for k in range(len(stem) - 1, -1, -1) if stem[:k] in share)
        if docs:
            share[stem] = (t + 2 * UNIT * above) / (c + t + 2 * UNIT)
    return {s: math.log((p + 1e-6) / (1 - p + 1e-6)) - base for s, p in share.items() if s}


def _logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mass = mass / mass.sum()
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    mean[0], scale[0] = 0, 1
    z, slopes = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ slopes, -700, 700)))
        slope = z.T @ (mass * (p - y)) + ridge * slopes
        slopes = slopes - np.linalg.solve((z * (mass * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(slopes)), slope)
    return mean, scale, slopes


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learns the insults and the score from rows of ``docs`` that ``labels`` marks 0 or 1 and that aren't held out.

    Stems are weighed on one half of the sample for the score of the other half, then on both. Without rows of both classes
    nothing is learned, and every text scores 0 (1 where all rows are toxic).
    """
    sample, stands_for = labelled_sample(docs, labels, key, text, label)
    counts, every = _stem_counts(sample)
    by_fold = [Lexicon(weights_of(counts, every, (1 - f,))) for f in (0, 1)]
    spec = sample.sparkSession.sparkContext.broadcast([x.weights for x in by_fold])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons, grammar = [Lexicon(w) for w in spec.value], Grammar()
        for batch in batches:
            toxic, texts, fold = (c.to_pylist() for c in batch.columns)
            rows = [features(lexicons[f], grammar, t) for t, f in zip(texts, fold)]
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    # 2 * SAMPLE_DOCS short rows at most
    found = sample.select("toxic", "text", "fold").mapInArrow(work, "toxic int, x array<double>").collect()
    y = np.array([r.toxic for r in found], float)
    if len(set(y.tolist())) < 2:
        slopes = np.zeros(FEATURES)
        slopes[0] = 700.0 if len(y) and y[0] else -700.0
        return Model({}, np.zeros(FEATURES), np.ones(FEATURES), slopes)
    order = sorted(range(len(found)), key=lambda i: (found[i].toxic, found[i].x))  # sums in one order at every run
    x, y = np.array([found[i].x for i in order]), y[order]
    mass = np.where(y == 1, stands_for[1], stands_for[0])
    return Model({s: round(w, 6) for s, w in weights_of(counts, every, (0, 1)).items()}, *_logistic(x, y, mass))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on) of every row; nothing is shuffled.

    Null and empty texts score as texts without clauses do. Texts of any length are read whole; the work is linear. Repeated rows
    and null keys stay. Other columns are not read.
    """
    require(docs, key, text)
    # plain values: a task needs no copy of this package to read them
    spec = docs.sparkSession.sparkContext.broadcast((model.weights, model.mean, model.scale, model.slopes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        model = Model(*spec.value)
        lexicon, grammar = Lexicon(model.weights), Grammar()

        def one(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            scores = model.scores([features(lexicon, grammar, t.decode()) for t in texts])
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], ["__key", "score", "predicted"])

        yield from per_slice(batches, one)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(work, f"__key {kind}, score double, predicted int").withColumnRenamed("__key", key)

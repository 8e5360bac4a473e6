"""Language identification by a small byte convolutional network, trained in numpy.

Text is cut into windows of a fixed number of bytes. Bytes are embedded, filters of several widths run over them, each
filter's largest response in the window is kept (max pooling), and a linear layer with softmax gives the languages'
probabilities. A text's probabilities are the mean of its windows', weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import hidden, lean_worker, per_slice, require

WINDOW, EMBED, FILTERS, WIDTHS = 256, 8, 16, (2, 3, 4)
#: The bound of the training sample: documents per language, and windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS, MAX_LANGUAGES = 500, 2, 500
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 7
UNKNOWN = "und"
_CHUNK = 48
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class ByteCnn:
    """The network's weights."""

    languages: tuple[str, ...]
    embed: np.ndarray  # 256 x EMBED
    filters: tuple[np.ndarray, ...]  # width * EMBED x FILTERS
    offsets: tuple[np.ndarray, ...]
    dense: np.ndarray
    dense_offset: np.ndarray

    def tables(self) -> tuple[list[np.ndarray], list[np.ndarray | None]]:
        """What each pair of neighbouring bytes (and a single last byte) adds to each filter's response."""
        heads, tails = [], []
        for width, w in zip(WIDTHS, self.filters):
            at = [self.embed @ w[k * EMBED : (k + 1) * EMBED] for k in range(width)]
            heads.append((at[0][:, None] + at[1][None]).reshape(1 << 16, -1))
            tails.append(None if width == 2 else at[2] if width == 3 else (at[2][:, None] + at[3][None]).reshape(1 << 16, -1))
        return heads, tails


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` bytes, the last one filled up with zeros."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scorer:
    """Applies a network to windows through its tables."""

    def __init__(self, net: ByteCnn) -> None:
        self.net = net
        self.heads, self.tails = net.tables()

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """The probabilities of each window."""
        pooled = np.empty((len(rows), FILTERS * len(WIDTHS)), np.float32)
        for i in range(0, len(rows), _CHUNK):
            part = rows[i : i + _CHUNK].astype(np.int32)
            pairs = part[:, :-1] << 8 | part[:, 1:]
            for k, width in enumerate(WIDTHS):
                if width == 2:
                    out = self.heads[k].take(pairs, axis=0)
                elif width == 3:
                    out = self.heads[k].take(pairs[:, :-1], axis=0)
                    out += self.tails[k].take(part[:, 2:], axis=0)
                else:
                    out = self.heads[k].take(pairs[:, :-2], axis=0)
                    out += self.tails[k].take(pairs[:, 2:], axis=0)
                best = out.max(axis=1) + self.net.offsets[k]
                pooled[i : i + _CHUNK, k * FILTERS : (k + 1) * FILTERS] = np.maximum(best, 0)
        return _softmax(pooled @ self.net.dense + self.net.dense_offset)

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """The probabilities of each text: its windows' mean, weighted by their bytes."""
        rows = [windows_of(t) for t in texts]
        counts = np.array([len(r) for r in rows])
        weight = np.full(counts.sum(), float(WINDOW))
        weight[np.cumsum(counts) - 1] = [max(1, len(t) - (n - 1) * WINDOW) for t, n in zip(texts, counts)]
        p = self.windows(np.concatenate(rows)) * weight[:, None]
        first = np.cumsum(counts) - counts
        return np.add.reduceat(p, first, axis=0) / np.add.reduceat(weight, first)[:, None]


def fit_network(samples: list[tuple[str, str]]) -> ByteCnn:
    """Trains a network on (language, text) samples by Adam on the cross-entropy; the order of samples doesn't matter."""
    samples = sorted(samples)
    languages = tuple(sorted({s[0] for s in samples}))
    if not languages:
        return ByteCnn((), np.zeros((256, EMBED)), (), (), np.zeros((0, 0)), np.zeros(0))
    raw = [t.encode()[:WINDOW] for _, t in samples]
    x = np.stack([windows_of(t)[0] for t in raw]).astype(np.int64)
    y = np.searchsorted(np.array(languages), [s[0] for s in samples])
    rng = np.random.default_rng(SEED)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    params = [normal(256, EMBED, scale=0.5)]
    params += [normal(w * EMBED, FILTERS, scale=(2 / (w * EMBED)) ** 0.5) for w in WIDTHS]
    params += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    width = FILTERS * len(WIDTHS)
    params += [normal(width, len(languages), scale=width**-0.5), np.zeros(len(languages), np.float32)]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n_w, step = len(WIDTHS), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            xb, yb = x[order[i : i + BATCH]], y[order[i : i + BATCH]]
            grads = [np.zeros_like(p) for p in params]
            emb, pooled, where = params[0][xb], [], []
            rows = np.arange(len(xb))[:, None]
            for k, w in enumerate(WIDTHS):
                spans = np.concatenate([emb[:, j : WINDOW - w + 1 + j] for j in range(w)], axis=2)
                out = spans @ params[1 + k]
                at = out.argmax(axis=1)
                pooled.append(np.maximum(np.take_along_axis(out, at[:, None], 1)[:, 0] + params[1 + n_w + k], 0))
                where.append(at)
            h = np.concatenate(pooled, axis=1)
            p = _softmax(h @ params[-2] + params[-1])
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            grads[-2], grads[-1] = h.T @ p, p.sum(axis=0)
            back = (p @ params[-2].T) * (h > 0)
            for k, w in enumerate(WIDTHS):
                g, at = back[:, k * FILTERS : (k + 1) * FILTERS], where[k]
                grads[1 + n_w + k] = g.sum(axis=0)
                for j in range(w):  # only the places that were kept pass a gradient
                    byte, part = xb[rows, at + j], slice(j * EMBED, (j + 1) * EMBED)
                    grads[1 + k][part] += np.einsum("bf,bfe->ef", g, params[0][byte])
                    np.add.at(grads[0], byte, g[:, :, None] * params[1 + k][part].T[None])
            step += 1
            rate = RATE * (1 - step / (EPOCHS * -(-len(x) // BATCH) + 1))
            for q, g, m, s in zip(params, grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(languages, params[0], tuple(params[1 : 1 + n_w]), tuple(params[1 + n_w : 1 + 2 * n_w]), params[-2], params[-1])


def held_out(key: str) -> Column:
    """Whether a row is kept from learning: the checksum of its key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """Windows of a bounded sample: ``SAMPLE_DOCS`` distinct texts of each language (all, if fewer), those of least hash.

    Held-out rows and null languages are never read for it. Places in the texts are drawn by hash as well. A text counts once
    for each language that it is marked with, however often it is there. Over ``MAX_LANGUAGES`` languages are an error.
    """
    rows = docs.where(~held_out(key) & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}")).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    few = rows.select("lang", "h").distinct().groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(few) > MAX_LANGUAGES:
        raise ValueError(f"column {lang} has over {MAX_LANGUAGES} values")
    if not few:
        return []
    share = F.coalesce(*[F.when(F.col("lang") == r.lang, int(1e6 * SAMPLE_DOCS / r["count"]) + 1) for r in few])
    # of copies one, before the shuffle; then those of least hash in each language
    some = rows.where(F.pmod("h", F.lit(1_000_000)) < share).groupBy("lang", "h").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1_000_000)), "h"))
    chosen = some.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS)
    starts = [1 + F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.lit(1), F.length("text") - WINDOW + 1)).cast("int") for i in range(SAMPLE_WINDOWS)]
    cut = chosen.select("lang", F.explode(F.array_distinct(F.array(*[F.substring("text", s, F.lit(WINDOW)) for s in starts]))).alias("text"))
    return [(r.lang, r.text) for r in cut.collect()]


def identify(docs: DataFrame, net: ByteCnn, key: str = "doc_id", text: str = "text", keep: bool = False, letter: str | None = None) -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (its probability) of every row, from its whole text; nothing is shuffled.

    With ``keep``, all columns of the table come along; own ones called ``lang_pred`` or ``score`` give way. ``letter`` names one
    more column: whether the text has a letter, whatever the network knows.

    A text that is null, has no letter, or meets a network without languages: ``und`` with score 0. Repeated rows get equal
    results. Ties go to the first language by name. Texts are scored in slices, so none needs more than its own bytes and
    its windows' pooled values. Without ``keep``, other columns are not read.
    """
    require(docs, key, text)
    given = ["lang_pred", "score", *([letter] if letter else [])]
    rest = [c for c in docs.columns if c not in given] if keep else [key]
    sent = rest if text in rest else [*rest, text]  # a text travels once
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        scorer = Scorer(net) if net.languages else None

        def one(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            has = [_LETTER.search(t.decode()) is not None for t in texts]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = [i for i, k in enumerate(has) if k and scorer is not None]
            if at:
                p = scorer.texts([texts[i] for i in at])
                for i, best, value in zip(at, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    lang[i], score[i] = net.languages[best], min(1.0, value)
            found = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(has, pa.bool_())][: len(given)]
            return pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *found], schema.names)

        yield from per_slice(batches, one, sent.index(text))

    rows = docs.select(*hidden(docs, sent))
    added = [T.StructField(c, t) for c, t in zip(given, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    schema = T.StructType([*[docs.schema[c] for c in rest], *added])
    return rows.mapInArrow(work, schema)

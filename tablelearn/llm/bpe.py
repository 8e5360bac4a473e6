"""Byte-level BPE: encoding by forced boundaries, and decoding.

Two bytes that are neighbours in no token of the vocabulary can never be merged over, nor can anything that holds both. Each
such pair in a text marks a certain cut: what lies between cuts is encoded on its own, and the ids are concatenated. Words that
come again are taken from a bounded memo.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from .common import Memo, kept_by_worker, per_slice, require

SHORT = 48
#: Entries of a generation of each memo: about 230 bytes an entry and two generations, so some 250 MB a worker at most.
AFTER_SPACE, PIECES = 450_000, 100_000
#: Fixed value: how the vocabulary's pre-tokenizer splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here, and in these blocks, all versions of Unicode agree about letters, numbers and spaces.
_COMMON = "\\x00-\\u0557\\u2010-\\u2027\\u4e00-\\u9fa5\\u3040-\\u3096\\uac00-\\ud7a3"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in vocabulary files: itself if printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """The merges of a vocabulary, and the byte pairs that none of its tokens holds."""

    def __init__(self, pairs: list[tuple[bytes, bytes]], ids: dict[bytes, int]) -> None:
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]
        self.single = [ids.get(bytes([b])) for b in range(256)]
        self.joined = bytearray(1 << 16)
        for token in ids:
            for a, b in zip(token, token[1:]):
                self.joined[a << 8 | b] = 1

    def encode(self, piece: bytes) -> bytes:
        """Little-endian 32-bit ids: every fragment between forced boundaries on its own, then concatenated."""
        out, start = array("I"), 0
        for i in range(1, len(piece)):
            if not self.joined[piece[i - 1] << 8 | piece[i]]:
                out.extend(self.fragment(piece[start:i]))
                start = i
        out.extend(self.fragment(piece[start:]))
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def fragment(self, fragment: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost first, until none is left."""
        parts = [self.single[b] for b in fragment]
        if len(parts) > SHORT:
            return self.long_fragment(parts)
        get, none = self.rank.get, len(self.merged)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i] = self.merged[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return parts

    def long_fragment(self, parts: list[int]) -> list[int]:
        """The same by a queue of pairs over a linked list: n log n."""
        n, gone = len(parts), -1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            r, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.merged[r], gone
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := self.rank.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(queue, (r, a, parts[a], parts[b]))
        return [p for p in parts if p != gone]


class TokenBytes:
    """The bytes of all tokens in one buffer, from which those of many ids are gathered at once."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.length = np.full(max(bytes_of, default=-1) + 1, -1, np.int64)
        self.first = np.zeros(len(self.length), np.int64)
        self.length[list(bytes_of)] = [len(t) for t in bytes_of.values()]
        self.first[list(bytes_of)] = np.cumsum([0, *map(len, bytes_of.values())])[:-1]
        self.buffer = np.frombuffer(b"".join(bytes_of.values()), np.uint8)

    def gather(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of ``ids`` in a row, and where each id's bytes begin, with the end of the last."""
        if len(ids) and (ids.max() >= len(self.length) or self.length[ids].min() < 0):
            raise KeyError("the vocabulary lacks some of the ids")
        lengths = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(ends[-1]) + np.repeat(self.first[ids] - ends[:-1], lengths)
        return self.buffer[places].tobytes(), ends


class Bpe:
    """A byte-level BPE vocabulary from its file; a Python worker makes it once."""

    def __init__(self, spec: str) -> None:
        j = json.loads(spec)
        model, byte_of = j["model"], {c: b for b, c in enumerate(byte_alphabet())}
        raw = lambda token: bytes(byte_of[c] for c in token)
        added = {a["content"]: a["id"] for a in j["added_tokens"]}
        if j.get("normalizer") or j["pre_tokenizer"]["type"] != "ByteLevel" or j["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level vocabulary")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in j["added_tokens"]):
            raise ValueError("added tokens that strip or need word edges are not supported")
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges([(raw(a), raw(b)) for a, b in pairs], ids)
        self.after_space, self.known = Memo(self.word, AFTER_SPACE), Memo(lambda piece: self.merges.encode(piece.encode()), PIECES)
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.added_at = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.table = TokenBytes({i: t for t, i in ids.items()} | {i: t.encode() for t, i in added.items()})
        self.split = regex.compile(SPLIT)
        self.lone, self.spaces = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"[^\S \n]")
        self.uncommon = regex.compile(f"[^{_COMMON}]")
        self.same_class: dict[str, bool] = {}
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def agreed(self, c: str) -> bool:
        """Whether both regex engines put the character into one class; they know different versions of Unicode."""
        if c not in self.same_class:
            ours = [len(self.split.findall(x + c)) for x in "a1!"]
            self.same_class[c] = ours == [len(self.library.pre_tokenize_str(x + c)) for x in "a1!"]
        return self.same_class[c]

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and not all(map(self.agreed, set(self.uncommon.findall(text)))):
            return [text[i:j] for _, (i, j) in self.library.pre_tokenize_str(text)]
        return self.split.findall(text)

    def chunk(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def word(self, word: str) -> bytes:
        """What follows a lone space, with it. Most are letters, or letters and one mark, and need no search."""
        if word.isascii() or not self.uncommon.search(word):
            if word.isalpha():
                return self.merges.encode((" " + word).encode())
            if word[:-1].isalpha() and not word[-1].isalnum() and not word[-1].isspace():
                return self.after_space[word[:-1]] + self.known[word[-1]]
        return self.chunk(" " + word)

    def ragged(self, text: str) -> bool:
        """Whether some space lies at an end or beside other white space, where it may not begin a piece."""
        if text[:1] == " " or text[-1:] == " " or self.spaces.search(text):
            return True
        return "  " in text or " \n" in text or "\n " in text

    def encode(self, text: str) -> bytes:
        out = []
        for part in self.added_at.split(text) if self.added_at else [text]:
            if part in self.added:
                out.append(self.added[part])
            elif self.ragged(part):
                first, *rest = self.lone.split(part)
                out += [self.chunk(first), *map(self.after_space.__getitem__, rest)]
            else:
                # between two characters that are no white space, a space always begins a piece
                first, *rest = part.split(" ")
                out += [self.chunk(first), *map(self.after_space.__getitem__, rest)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, packed: list[bytes]) -> list[str]:
        """The text of each list of ids."""
        raw, ends = self.table.gather(np.frombuffer(b"".join(packed), "<u4"))
        cuts = ends[np.cumsum([0] + [len(x) // 4 for x in packed])].tolist()
        return [raw[i:j].decode("utf-8", "replace") for i, j in zip(cuts, cuts[1:])]


def _spec(path: str) -> str:
    spec = open(path, encoding="utf-8").read()
    Tokenizer.from_str(spec)  # the file must be one that the library reads
    return spec


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key``, ``ids`` (binary, little-endian unsigned 32-bit integers) and ``n_tokens`` of every row; nothing is shuffled.

    With ``decoded``, ``text`` as well: what the ids decode to, found in the same pass.

    The ids are those of the ``tokenizers`` library for the vocabulary file at ``path`` (read on the driver), without special
    tokens added; strings of added tokens inside a text become those tokens, as there. Null or empty text: no ids. Texts of
    any length: the work is n log n in the longest fragment. Repeated rows are encoded each. Other columns are not read.
    """
    require(docs, key, text)
    spec = docs.sparkSession.sparkContext.broadcast(_spec(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = kept_by_worker(Bpe, spec.value)

        def one(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            ids = [bpe.encode(t.decode()) for t in texts]
            arrays = [part.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if decoded:
                arrays.append(pa.array(bpe.decode_all(ids), pa.string()))
            return pa.RecordBatch.from_arrays(arrays, ["__key", "ids", "n_tokens", "text"][: len(arrays)])

        yield from per_slice(batches, one)

    kind = docs.schema[key].dataType.simpleString()
    return docs.selectExpr(f"`{key}` AS __key", f"`{text}` AS __text").mapInArrow(work, f"__key {kind}, ids binary, n_tokens long" + ", text string" * decoded).withColumnRenamed("__key", key)


def decode(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and the decoded ``text`` of every row, added tokens included; bytes that are no UTF-8 are replaced.

    Null ids: empty text. An id that the vocabulary lacks fails the job.
    """
    require(tokens, key, ids)
    spec = tokens.sparkSession.sparkContext.broadcast(_spec(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = kept_by_worker(Bpe, spec.value)

        def one(part: pa.RecordBatch, packed: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bpe.decode_all(packed), pa.string())], ["__key", "ids", "text"])

        yield from per_slice(batches, one)

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.selectExpr(f"`{key}` AS __key", f"`{ids}` AS ids").mapInArrow(work, f"__key {kind}, ids binary, text string").withColumnRenamed("__key", key)

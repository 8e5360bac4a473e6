"""Records of many layouts into canonical turns, a reversible chat template, and its loss mask.

A record is one JSON object. Its schema fingerprint is a hash of its nested field paths, and the fingerprint alone selects
the declarative mapping that finds its turns. A further layout is a further ``Mapping``; no code changes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import require

START, END, TURN_END = "<|im_start|>", "<|im_end|>", "<|im_end|>\n"
TURNS_SCHEMA = "conv_id long, turn long, step long, role string, text string, layout string"
PIECES_SCHEMA = "conv_id long, turn long, step long, piece string, text_start int, text_end int, in_loss boolean, layout string"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``turns``: (role, path) pairs in order; a role that starts with ``$`` is itself a path. With ``each``, the pairs are
    read from every element of that list. ``optional`` paths may be absent. ``order`` is the path of the turn's number for
    layouts with one turn per record. ``renames``: names that the layout gives to roles, and theirs here; others stay as given.
    """

    name: str
    turns: tuple[tuple[str, str], ...]
    each: str | None = None
    order: str | None = None
    key: str = "conv_id"
    optional: tuple[str, ...] = ()
    renames: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        inner = [p for role, text in self.turns for p in (role[1:] if role.startswith("$") else None, text) if p]
        return [self.key, *([self.order] if self.order else []), *[f"{self.each}[].{p}" if self.each else p for p in inner]]

    def fingerprints(self) -> Iterator[int]:
        """Of every record shape that the mapping reads: with and without each optional path."""
        paths = self.paths()
        for bits in range(1 << len(self.optional)):
            left_out = {p for i, p in enumerate(self.optional) if bits >> i & 1}
            yield fingerprint([p for p in paths if p not in left_out])
        if self.each:
            yield fingerprint([self.key, f"{self.each}[]"])  # no element


MAPPINGS = (
    Mapping("turn", (("$role", "text"),), order="turn"),
    Mapping("prompt", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_system", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", (("system", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Mapping("messages", (("$role", "content"),), each="messages"),
    Mapping("conversations", (("$from", "value"),), each="conversations", renames=(("human", "user"), ("prompter", "user"), *((x, "assistant") for x in ("gpt", "bot", "model")))),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """The nested field paths of a JSON value: ``a.b`` for objects, ``a[]`` for lists; null is a leaf as any other."""
    if isinstance(value, dict):
        inner = [field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()]
        return set().union(*inner) if inner else {prefix + "{}"}
    if isinstance(value, list):
        inner = [field_paths(v, prefix + "[]") for v in value]
        return set().union(*inner) if inner else {prefix + "[]"}
    return {prefix}


def fingerprint(paths: Sequence[str]) -> int:
    """A 64-bit hash of the sorted field paths."""
    return int.from_bytes(hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).digest(), "big")


def _at(value: object, path: str) -> object:
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def _turns_of(record: dict, m: Mapping) -> Iterator[tuple[int | None, int, str, str]]:
    number = _at(record, m.order) if m.order else 0
    names = dict(m.renames)
    items = _at(record, m.each) or [] if m.each else [record]
    step = 0
    for item in items:
        for role, path in m.turns:
            if path in m.optional and path not in record:
                continue
            name = _plain(_at(item, role[1:])) if role.startswith("$") else role
            yield (number if isinstance(number, int) else None), step, names.get(name, name), _plain(_at(item, path))
            step += 1


def canonical_turns(records: DataFrame, record: str = "record", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """The turns of JSON records of mixed layouts: conv_id, turn, step (order within the record), role, text, layout.

    Row-local: nothing is shuffled. Null text: empty. Null or missing role: empty. Null turn: before all others. A record that is null, no JSON object, or
    of a fingerprint that no mapping has, gives one row with null role and text and the layout ``unknown`` and its key if it
    has one, so nothing goes unseen. Lists of mixed elements have the union of their paths. Repeated records give repeated
    turns. Other columns are not read.
    """
    require(records, record)
    known = {f: m for m in mappings for f in m.fingerprints()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(0).to_pylist():
                try:
                    value = json.loads(text) if text is not None else None
                except ValueError:
                    value = None
                m = known.get(fingerprint(list(field_paths(value)))) if isinstance(value, dict) else None
                if m is None:
                    key = value.get("conv_id") if isinstance(value, dict) else None
                    rows.append((key if isinstance(key, int) else None, None, None, None, None, "unknown"))
                    continue
                key = _at(value, m.key)
                rows += [(key if isinstance(key, int) else None, *t, m.name) for t in _turns_of(value, m)]
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "turn", "step", "role", "text", "layout"])

    return records.select(record).mapInArrow(work, TURNS_SCHEMA)


_OPENED, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: one backslash more between the two, which ``unescape`` takes away again."""
    return _OPENED.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def format_turns(turns: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """Each turn's piece of the formatted conversation, and where in it the text lies.

    A conversation's text is its pieces in order of turn and step, with nothing between; so a conversation of any length
    needs no single cell. A piece is ``<|im_start|>role\\n``, the escaped text, ``<|im_end|>\\n``. ``text_start`` and ``text_end``
    count code points; the text is trained on where ``in_loss``. Rows of unknown layout have no turn and are left out.
    """
    require(turns, "conv_id", "turn", "step", "role", "text", "layout")
    roles = frozenset(loss_roles)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, starts, ends, loss = [], [], [], []
            for role, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
                pieces.append(head + body + TURN_END)
                starts.append(len(head))
                ends.append(len(head) + len(body))
                loss.append(role in roles)
            arrays = [*batch.columns[:3], pa.array(pieces, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(loss, pa.bool_()), batch.column(5)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "step", "piece", "text_start", "text_end", "in_loss", "layout"])

    return turns.where("layout <> 'unknown'").select("conv_id", "turn", "step", "role", "text", "layout").mapInArrow(work, PIECES_SCHEMA)


def parse_piece(piece: str) -> tuple[str, str]:
    """The role and text of a formatted turn."""
    head, _, rest = piece.partition("\n")
    if not head.startswith(START) or not rest.endswith(TURN_END) or END in rest[: -len(TURN_END)]:
        raise ValueError("not one formatted turn")
    return unescape_role(head[len(START) :]), unescape(rest[: -len(TURN_END)])


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, parsed from its formatted pieces: turns, their digest, the text under the loss mask, all characters.

    A digest needs its conversation's turns in order. They are hashed as they stream by from a sorted partition, so no
    conversation, however long, is ever held whole. Turns that tie in turn and step go by piece. A null conv_id is a
    conversation of its own.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key: object = work  # no key equals it
        state: list = []

        def fresh() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def closed(key: object, s: list) -> tuple:
            return key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

        def out(done: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

        for batch in batches:
            done = []
            for key, piece, start, end, loss in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if open_key is work or key != open_key:
                    if open_key is not work:
                        done.append(closed(open_key, state))
                    open_key, state = key, fresh()
                role, text = parse_piece(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if loss:
                    trained = unescape(piece[start:end])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += len(piece)
            if done:
                yield out(done)
        if open_key is not work:
            yield out([closed(open_key, state)])

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "step", "piece")
    return ordered.select("conv_id", "piece", "text_start", "text_end", "in_loss").mapInArrow(work, DIGEST_SCHEMA)


def turn_records(conversations: DataFrame) -> DataFrame:
    """A table with one row per turn as JSON records of the layout ``turn``."""
    require(conversations, "conv_id", "turn", "role", "text")
    fields = F.struct("conv_id", "turn", "role", "text")
    return conversations.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))

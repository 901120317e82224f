"""Operator 2: chat formatting with schema fingerprints.

A record is JSON text of any known layout (prompt/completion, instruction,
message lists, one turn per row, ...). The set of its nested field paths is
hashed; each fingerprint is matched once to the most specific declarative
mapping whose paths it holds, and the mapping turns the record into canonical
(conversation, turn, role, text) rows.

The template writes every turn as ``### role:`` newline, text, ``</turn>``.
A backslash goes before each ``\\``, ``#`` and ``<`` of a text, and in a role
before ``:`` and line breaks too, so no text can look like a mark and
unescaping restores it exactly. The loss mask covers assistant texts.

Output is one segment per turn (conversation, position, segment, loss span);
a conversation is the concatenation of its segments, never built in one cell,
so a conversation of any length is read back as a stream.

Cases: null text and role count as empty; turns are ordered by turn number
(null first), then role, then text, so ties are stable; repeated rows are
repeated turns; an empty message list gives no turn; a record of no known
layout, or that is not JSON, gives one row with layout ``unmapped`` and its
text kept; unknown extra fields are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. ``turns`` are (role, path) for records
    that hold whole texts; ``each`` is (list path, role field, text field,
    role names) for message lists; ``row`` is (turn, role, text) for one turn
    per record. ``key`` is the path of the conversation id."""

    name: str
    needs: frozenset[str]
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    key: tuple[str, ...] = ("conv_id", "id")
    roles: dict[str, str] = field(default_factory=dict, hash=False, compare=False)


def _m(name: str, needs: str, **kw) -> Mapping:
    return Mapping(name, frozenset(needs.split()), **kw)


# The layouts in use and the role names they write.
SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
MAPPINGS = (
    _m("turn_rows", "turn role text", row=("turn", "role", "text"), roles=SPOKEN),
    _m("messages", "messages[].role messages[].content", each=("messages", "role", "content"), roles=SPOKEN),
    _m("from_value", "conversations[].from conversations[].value", each=("conversations", "from", "value"),
       roles=SPOKEN),
    _m("instruction", "instruction output", turns=(("user", "instruction"), ("assistant", "output"))),
    _m("instruction_input", "instruction input output",
       turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    _m("instruction_response", "instruction response", turns=(("user", "instruction"), ("assistant", "response"))),
    _m("prompt_completion", "prompt completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    _m("prompt_response", "prompt response", turns=(("user", "prompt"), ("assistant", "response"))),
    _m("system_prompt_response", "system prompt response",
       turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    _m("question_answer", "question answer", turns=(("user", "question"), ("assistant", "answer"))),
    _m("nested_data", "data.prompt data.response", turns=(("user", "data.prompt"), ("assistant", "data.response"))),
)
LISTS = {m.each[0]: m for m in MAPPINGS if m.each}


def paths(value, at: str = "") -> set[str]:
    """Leaf field paths of a JSON value; list elements share one ``[]`` path."""
    if isinstance(value, dict):
        return set().union(*[paths(v, f"{at}.{k}" if at else k) for k, v in value.items()]) if value else {at}
    if isinstance(value, list):
        return set().union(*[paths(v, at + "[]") for v in value]) if value else {at + "[]"}
    return {at}


def fingerprint(names: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(names)).encode()).hexdigest()


def choose(names: set[str]) -> Mapping | None:
    """The known mapping that needs most of these paths; ties by listing order."""
    fit = [m for m in MAPPINGS if m.needs <= names]
    fit += [m for path, m in LISTS.items() if path + "[]" in names]
    return max(fit, key=lambda m: len(m.needs), default=None)


def _get(record, path: str):
    for part in path.split("."):
        record = record.get(part) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def apply_mapping(m: Mapping, record: dict) -> list[tuple[int | None, str, str]]:
    """(turn, role, text) rows of one record."""
    role = lambda r: m.roles.get(_text(r), _text(r))
    if m.row:
        turn, r, t = (_get(record, p) for p in m.row)
        return [(None if turn is None else int(turn), role(r), _text(t))]
    if m.each:
        path, r, t = m.each
        found = [x for x in (_get(record, path) or []) if isinstance(x, dict)]
        return [(i, role(x.get(r)), _text(x.get(t))) for i, x in enumerate(found)]
    given = [(r, _get(record, p)) for r, p in m.turns]
    return [(i, r, _text(v)) for i, (r, v) in enumerate(given)]


def canonical(df: DataFrame, record_col: str = "record", id_col: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, layout, fingerprint) from JSON records. The
    conversation id is ``id_col``, else the record's own id field."""
    key = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    source = df.select(key.alias("id"), F.col(record_col).cast("string").alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[str, Mapping | None] = {}
        for b in batches:
            out: list[tuple] = []
            for i, raw in zip(b.column("id").to_pylist(), b.column("record")):
                raw = raw.as_py()
                mark = None
                try:
                    record = json.loads(raw) if raw is not None else None
                    m = None
                    if isinstance(record, dict):
                        names = paths(record)
                        mark = fingerprint(names)
                        if mark not in chosen:
                            if len(chosen) > 10_000:
                                chosen.clear()
                            chosen[mark] = choose(names)
                        m = chosen[mark]
                    turns = apply_mapping(m, record) if m else []
                    key = i
                    if m and key is None:
                        key = next((v for v in (_get(record, k) for k in m.key)
                                    if isinstance(v, int) and not isinstance(v, bool)), None)
                    for number in (key, *(turn for turn, _, _ in turns)):
                        if number is not None and not -2 ** 63 <= number < 2 ** 63:
                            raise OverflowError(number)
                # no JSON, a turn that is no number, a number beyond 64 bits, too deep a nesting
                except (ValueError, TypeError, OverflowError, RecursionError):
                    m = None
                if m is None:
                    out.append((i, None, "", raw or "", "unmapped", mark))
                    continue
                out += [(key, turn, role, text, m.name, mark) for turn, role, text in turns]
            cols = list(zip(*out)) if out else [()] * 6
            types = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, types)],
                ["conv_id", "turn", "role", "text", "layout", "fingerprint"])

    return source.mapInArrow(
        run, "conv_id long, turn long, role string, text string, layout string, fingerprint string")


def escape(c: Column, role: bool = False) -> Column:
    c = F.regexp_replace(c, r"([\\#<])", r"\\$1")
    return F.replace(F.replace(c, F.lit(":"), F.lit("\\:")), F.lit("\n"), F.lit("\\n")) if role else c


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted segment per turn, with the loss span inside it (code
    points from the segment's start; -1 where there is no loss)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, True), F.lit(":\n"))
    body = escape(text)
    loss = role == LOSS_ROLE
    return turns.select(
        "conv_id", "turn", F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.when(loss, F.length(head)).otherwise(F.lit(-1)).alias("loss_start"),
        F.when(loss, F.length(head) + F.length(body)).otherwise(F.lit(-1)).alias("loss_end"))


def unescape(s: str, role: bool = False) -> str:
    if role:
        return re.sub(r"(?s)\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s)
    return re.sub(r"(?s)\\(.)", r"\1", s)


TURN = re.compile(r"### ([^\\:\n]*(?:\\.[^\\:\n]*)*):\n([^\\#<]*(?:\\.[^\\#<]*)*)</turn>\n", re.S)


class Reader:
    """Reads one formatted conversation from a stream of pieces of any size."""

    def __init__(self):
        self.left = ""
        self.turns = self.chars = self.loss_chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str) -> None:
        self.chars += len(piece)
        data = self.left + piece
        at = 0
        while m := TURN.match(data, at):
            role, text = unescape(m[1], True), unescape(m[2])
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            at = m.end()
        self.left = data[at:]

    def mask(self, piece: str, start: int, end: int) -> None:
        """Adds the text under a loss span of the piece."""
        text = unescape(piece[start:end])
        self.loss_chars += len(text)
        self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self, conv_id) -> tuple:
        if self.left:
            raise ValueError(f"conversation {conv_id} ends inside a turn")
        return (conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted segments alone. Rows reach
    a task sorted, so it holds one turn and two running digests whatever the
    length of a conversation."""
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, reader = None, None
        for b in batches:
            out = []
            for conv, piece, start, end in zip(*[b.column(c).to_pylist() for c in
                                                 ("conv_id", "segment", "loss_start", "loss_end")]):
                if reader is None or conv != now:
                    if reader is not None:
                        out.append(reader.row(now))
                    now, reader = conv, Reader()
                reader.feed(piece)
                if start >= 0:
                    reader.mask(piece, start, end)
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(reader.row(now), types)], names)

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")

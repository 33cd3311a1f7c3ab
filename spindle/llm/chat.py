r"""Chat formatting with a grammar round trip.

Template, one segment per turn; a conversation is its segments in order:

    <s>[INST]role[/INST]text</s>

Control strings are ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``; a backslash makes
the next character literal.  Every turn is rendered plainly, parsed again and
compared with its source; on a difference its control strings are escaped, then its
backslashes as well, until the parser gives back the same role and text.  The parser
is a left-to-right scan without choices, and a segment ends in a control string, so
parsing a conversation is parsing its segments one after another.

The loss mask of a segment is the span of an assistant's (escaped) text.

Defined cases: null role or text is empty; a null ``conv_id`` is a conversation of
its own; turns with equal numbers are ordered by role, then text; null turn numbers
come first; repeated rows are repeated turns; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import body, order_key

OPEN, CLOSE, HEAD, TAIL = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = re.compile(r"</?s>|\[/?INST\]")
TOKEN = re.compile(r"\\(.)|(</?s>|\[/?INST\])", re.DOTALL)

SEGMENTS = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_start int, loss_end int"
DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
           "loss_sha256 string, formatted_chars bigint")


def escape(text: str, level: int) -> str:
    """0: plain; 1: a backslash before each control string; 2: backslashes are doubled as well."""
    if level == 2:
        text = text.replace("\\", "\\\\")
    return CONTROL.sub(lambda m: "\\" + m.group(), text) if level else text


def render(role: str, text: str, level: int) -> tuple[str, int, int]:
    """The segment, and the start and end of the text in it."""
    head = f"{OPEN}{HEAD}{escape(role, level)}{TAIL}"
    inner = escape(text, level)
    return f"{head}{inner}{CLOSE}", len(head), len(head) + len(inner)


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """Roles and texts of a formatted string; None if it does not follow the grammar."""
    turns: list[tuple[str, str]] = []
    want, fields, buffer, at = 0, [], [], 0
    order = (OPEN, HEAD, TAIL, CLOSE)
    for m in TOKEN.finditer(formatted):
        plain = formatted[at:m.start()]
        at = m.end()
        if plain or m.group(1) is not None:
            if want < 2:
                return None
            buffer.append(plain + (m.group(1) or ""))
        if m.group(2) is None:
            continue
        if m.group(2) != order[want]:
            return None
        if want >= 2:
            fields.append("".join(buffer))
        buffer = []
        want = (want + 1) % 4
        if want == 0:
            turns.append((fields[0], fields[1]))
            fields = []
    return turns if at == len(formatted) and want == 0 else None


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The least escaped segment that parses back to exactly this role and text."""
    for level in (0, 1, 2):
        segment = render(role, text, level)
        if parse(segment[0]) == [(role, text)]:
            return segment
    raise AssertionError("full escaping must round-trip")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())])
    for batch in batches:
        made = []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
            formatted, start, end = format_turn(role, text)
            made.append((formatted, start, end) if role == "assistant" else (formatted, 0, 0))
        columns = list(zip(*made, strict=True)) if made else [[], [], []]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *schema.names])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One formatted segment per turn, with the loss span in code points of the segment (empty: none).

    Segments stay rows, ordered by (turn, role, text) in their conversation, so a
    conversation of any length needs no single string.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        body("role").alias("role"), body("text").alias("text"))
    return turns.mapInArrow(_format, SEGMENTS)


class _Digest:
    """Running digests of one conversation, read back from its segments."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        turns = parse(formatted)
        if turns is None:
            raise ValueError(f"conversation {self.conv_id}: a formatted segment does not parse")
        for role, text in turns:
            self.turns += 1
            self.turn_hash.update(f"{role}\n{text}\n".encode())
        self.chars += len(formatted)
        if end > start:
            masked = re.sub(r"\\(.)", r"\1", formatted[start:end], flags=re.DOTALL)
            self.loss += len(masked)
            self.loss_hash.update(masked.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    now: _Digest | None = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]
        for conv_id, formatted, start, end in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv_id)
            now.add(formatted, start, end)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.row()])


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conversation: turns, hashes and lengths, parsed back from the formatted segments.

    Rows stream through sorted partitions in Arrow batches, so a task holds one batch
    and two hash states.  A SHA-256 over a conversation is sequential by definition.
    """
    ordered = (segments.repartition("conv_id")
               .sortWithinPartitions(*order_key("conv_id", "turn", "role", "text"))
               .select("conv_id", "formatted", "loss_start", "loss_end"))
    return ordered.mapInArrow(_digest, DIGESTS)

"""Chat formatting from an event log.

A conversation is kept as events: ``message`` opens a message, ``delta`` appends to it, ``edit``
replaces its text, ``regenerate`` discards it and opens it anew. An edit or regeneration voids
what later turns held before it, because they answered a text that is gone. Events lie together
by conversation and are sorted by turn and sequence, so that one streaming pass folds them: it
holds one message and one number, whatever the length of a conversation.

Rendering wraps each message in marks and escapes control strings inside texts: a backslash is put
between ``<`` and ``|``, behind the backslashes that are there already, which can be undone.

Defined cases: null text is empty; a null role is the empty role; a null kind is ``message``;
a null turn or sequence sorts first; rows that repeat are messages that repeat; rows of a null
conversation form one conversation with a null id; a delta, edit or regeneration without an open
message opens one; unknown kinds are an error; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "delta", "edit", "regenerate")

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_RENDERED = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on a line of its own, so its line breaks are written out."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render(role: str, text: str) -> tuple[str, int, int]:
    """One message with the span of its text."""
    head = f"{OPEN}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one rendered message."""
    found = _RENDERED.fullmatch(formatted)
    if not found:
        raise ValueError("not a rendered message")
    return unescape_role(found[1]), unescape(found[2])


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted ``conv_id, turn, seq, kind, role, text`` to final ``conv_id, turn, position, role, text``."""
    conv, turn, position = object(), object(), 0
    voided, here = None, None  # the latest rewrite of an earlier turn, and of this one
    role, parts = "", None

    def closed() -> Iterator[tuple]:
        nonlocal parts, position
        if parts is not None:
            yield conv, turn, position, role, "".join(parts)
            position, parts = position + 1, None

    def later(a, b):
        return b if a is None or (b is not None and b > a) else a

    for new_conv, new_turn, seq, kind, new_role, text in events:
        if new_conv != conv or new_turn != turn:
            yield from closed()
            if new_conv != conv:
                position, voided = 0, None
            else:
                voided = later(voided, here)
            conv, turn, here = new_conv, new_turn, None
        if voided is not None and (seq is None or seq < voided):
            continue
        if kind == "message":
            yield from closed()
            role, parts = new_role, [text]
            continue
        if parts is None:
            role, parts = new_role, []
        if kind == "delta":
            parts.append(text)
        elif kind in ("edit", "regenerate"):
            role, parts = new_role or role, [text]
            here = later(here, seq)
        else:
            raise ValueError(f"unknown kind of event: {kind}")
    yield from closed()


def _arranged(events: DataFrame) -> DataFrame:
    """Conversations whole in a partition, their events in order. Ties are broken by content."""
    plain = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.col("kind"), F.lit("message")).alias("kind"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions(*plain.columns)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


_MESSAGES = "conv_id long, turn long, position long, role string, formatted string, loss_start long, loss_end long"


def format_chat(events: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """Final messages, rendered, in order inside each partition.

    ``formatted`` of a conversation is the concatenation over ``position``. ``loss_start`` and
    ``loss_end`` are the span of the text inside ``formatted`` that is learned from, null else.
    """

    def run(batches):
        def rendered():
            for conv, turn, position, role, text in fold(_rows(batches)):
                formatted, start, end = render(role, text)
                span = (start, end) if role == learned_role else (None, None)
                yield conv, turn, position, role, formatted, *span

        yield from _batches(rendered(), _MESSAGES)

    return _arranged(events).mapInArrow(run, _MESSAGES)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(messages: DataFrame) -> DataFrame:
    """Digests of each conversation, taken from the rendered text alone.

    Goes over the rows as ``format_chat`` left them and holds two running digests, not a text.
    """

    def run(batches):
        def digests():
            conv, state = object(), None
            for new, formatted, start, end in _rows(batches):
                if new != conv:
                    if state:
                        yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                    conv, state = new, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learned = unescape(formatted[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            if state:
                yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        yield from _batches(digests(), _DIGESTS)

    return messages.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, _DIGESTS)


def _batches(rows: Iterator[tuple], schema: str, chunk: int = 1024) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in schema.split(", ")]
    types = [pa.int64() if field.endswith("long") else pa.string() for field in schema.split(", ")]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == chunk:
            yield _batch(held, names, types)
            held = []
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

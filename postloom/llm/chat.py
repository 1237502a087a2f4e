r"""Chat formatting from an event log.

A log row is (conv_id, turn, seq, kind, role, text). Rows are dealt by conversation and
sorted by turn and sequence; each task then reads its rows once, as a stream, and holds one
message at a time, so a conversation of any length needs no memory of its own. Kinds:

* `message` starts a message of its turn (also any kind not named here, and null);
* `delta` appends its text to the message that is open in its turn, or starts one;
* `edit` replaces that message's text, or starts one;
* `regenerate` empties the turn's open message and keeps its role, and takes back what
  later turns had been given before it (rows of a smaller seq).

A rendered turn is `### role: text</turn>` and a line break. Inside role and text a
backslash is put before each backslash, `#` and `</turn>`, in roles also before `:`, so
that the output can be read back. Loss falls on the assistants' texts as they stand in the
output; spans count code points of the conversation's whole output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_ESCAPED = re.compile(r"\\|#|<(?=/turn>)")
_ESCAPED_ROLE = re.compile(r"\\|#|:|<(?=/turn>)")
_MARKED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]+|\\.)*): ((?:[^\\<]+|\\.|<(?!/turn>))*)</turn>\n", re.S)

ROWS_OUT = 1000

FORMATTED = "conv_id LONG, position LONG, turn LONG, role STRING, formatted STRING, loss_start LONG, loss_end LONG"
DIGESTS = (
    "conv_id LONG, n_turns LONG, turns_sha256 STRING, loss_chars LONG, loss_sha256 STRING, formatted_chars LONG"
)


def escape(text: str, role: bool = False) -> str:
    return (_ESCAPED_ROLE if role else _ESCAPED).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text)


def parse(output: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of rendered turns."""
    at = 0
    while at < len(output):
        m = _TURN.match(output, at)
        if m is None:
            raise ValueError("not a rendered turn")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Messages (conv_id, turn, role, text) of sorted events (conv_id, turn, seq, kind, role, text)."""
    least = float("-inf")
    conv = turn = None
    begun = False
    back = here = least  # seq of the last regeneration in earlier turns, and in this one
    message: list | None = None  # role, pieces of text

    def done() -> list[tuple]:
        return [] if message is None else [(conv, turn, message[0], "".join(message[1]))]

    for conv_id, at, seq, kind, role, text in events:
        seq = least if seq is None else seq
        if not begun or conv_id != conv or at != turn:
            yield from done()
            message = None
            back = max(back, here) if begun and conv_id == conv else least
            begun, conv, turn, here = True, conv_id, at, least
        if seq < back:
            continue
        text = text or ""
        if kind == "regenerate":
            here = max(here, seq)
            message = [role if message is None else message[0], [text] if text else []]
        elif kind in ("delta", "edit") and message is not None:
            if kind == "edit":
                message[1] = []
            message[1].append(text)
        else:
            yield from done()
            message = [role, [text]]
    yield from done()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batches(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, ROWS_OUT)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], names)


def format_chats(events: DataFrame) -> DataFrame:
    """Rendered turns of every conversation, each conversation's rows together and in order.

    `events` has conv_id, turn, seq, kind, role, text; other columns are dropped. Returns
    conv_id, position (from 0), turn, role, formatted, loss_start and loss_end (null unless
    the role is assistant). Nulls: texts and roles count as empty; a null conv_id is a
    conversation of its own; a null turn or seq comes first. Equal turn and seq: by kind,
    role and text. Repeated `message` rows are messages each. An empty log gives no rows.

    A digest or fold over a conversation has to see it in order, so the largest one sets
    the length of its task; its memory stays one message.
    """
    names = ["conv_id", "turn", "seq", "kind", "role", "text"]
    log = events.select(*[events[c] for c in names])
    dealt = log.repartition("conv_id").sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            conv, position, at = None, 0, 0
            for conv_id, turn, role, text in fold(_rows(batches)):
                if position == 0 or conv_id != conv:
                    conv, position, at = conv_id, 0, 0
                role = role or ""
                head = f"### {escape(role, True)}: "
                body = escape(text)
                shown = f"{head}{body}</turn>\n"
                loss = (at + len(head), at + len(head) + len(body)) if role == "assistant" else (None, None)
                yield conv_id, position, turn, role, shown, *loss
                position, at = position + 1, at + len(shown)

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.large_string(), pa.large_string(), pa.int64(), pa.int64()]
        yield from _batches(out(), kinds, [f.split()[0] for f in FORMATTED.split(", ")])

    return dealt.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from the output of `format_chats` as it comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            begun, conv = False, None
            n = chars = size = 0
            turns = loss = hashlib.sha256()
            for conv_id, position, shown, start, end in _rows(batches):
                if not begun or position == 0:
                    if begun:
                        yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), size
                    begun, conv, n, chars, size = True, conv_id, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in parse(shown):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                if start is not None:
                    masked = unescape(shown[start - size : end - size])
                    loss.update(masked.encode("utf-8", "surrogatepass"))
                    chars += len(masked)
                size += len(shown)
            if begun:
                yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield from _batches(out(), kinds, [f.split()[0] for f in DIGESTS.split(", ")])

    columns = ["conv_id", "position", "formatted", "loss_start", "loss_end"]
    return formatted.select(*columns).mapInArrow(run, DIGESTS)


def turn_events(conversations: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as the log that wrote it."""
    c = conversations
    return c.select(
        c["conv_id"].cast("long").alias("conv_id"),
        c["turn"].cast("long").alias("turn"),
        c["turn"].cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        c["role"],
        c["text"],
    )

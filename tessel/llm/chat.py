"""Chat formatting with a grammar round trip.

A conversation is the concatenation of its turns, and a turn is

    <s> ROLE | LEVEL \\n TEXT </s> \\n              for the roles under the loss mask (assistants)
    <s> ROLE | LEVEL \\n [INST] TEXT [/INST] </s> \\n   for all others

without the blanks. A deterministic parser reads it back. A turn is first rendered with its text as it is (level 0); if the
parser does not return the very same turn, control strings inside the text are escaped (level 1), and again until it does.
Escaping puts a backslash behind the first character of a control string, or one more where there are some, and is undone
exactly. Roles are always escaped. As every turn ends at the first end marker the parser meets, a conversation parses as
its turns do.

Defined cases: null texts and roles are empty; rows of a conversation are ordered by turn (null first), then role, then
text, so that ties are settled by content; repeated rows are turns of their own; a null conversation id is a conversation;
a conversation of any length is streamed, holding one turn at a time; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
LOSS_ROLE = "assistant"
CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
ROLE_SPECIAL = re.compile(r"[\\|\n<\[]")
HEADER = re.compile(r"<s>((?:[^\\|\n<\[]|\\[0-9a-f]{2})*)\|([0-9]+)\n")
MAX_LEVEL = 8

PIECES = "conv_id long, turn_no long, formatted string, loss_start long, loss_chars long"


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> str:
    """The turn's string, escaped as little as a faithful reading allows."""
    name = ROLE_SPECIAL.sub(lambda m: f"\\{ord(m[0]):02x}", role)
    body = text
    for level in range(MAX_LEVEL):
        made = f"{START}{name}|{level}\n{body if role == LOSS_ROLE else OPEN + body + CLOSE}{END}\n"
        if list(parse(made)) == [(role, text)]:
            return made
        body = escape(body)
    raise ValueError("a turn could not be rendered reversibly")


def parse(formatted: str) -> Iterator[tuple[str, str] | None]:
    """Turns (role, text) of a formatted string; None, and nothing more, where it breaks the grammar."""
    for turn in spans(formatted):
        yield turn and (turn[0], turn[1])


def spans(formatted: str) -> Iterator[tuple[str, str, int, int] | None]:
    """As ``parse``, with the span of the (escaped) text."""
    at = 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        end = formatted.find(END, head.end()) if head else -1
        if head is None or end < 0 or formatted[end + len(END) : end + len(END) + 1] != "\n":
            yield None
            return
        a, b = head.end(), end
        role = re.sub(r"\\([0-9a-f]{2})", lambda m: chr(int(m[1], 16)), head[1])
        if role != LOSS_ROLE:
            if not (formatted.startswith(OPEN, a) and formatted.endswith(CLOSE, a, b) and b - a >= len(OPEN) + len(CLOSE)) or formatted.find(CLOSE, a) != b - len(CLOSE):
                yield None
                return
            a, b = a + len(OPEN), b - len(CLOSE)
        body = formatted[a:b]
        for _ in range(int(head[2])):
            body = unescape(body)
        yield role, body, a, b
        at = end + len(END) + 1


def formatted(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per turn, as in ``PIECES``, in order inside a partition, a conversation's rows together.

    The conversation's string is its pieces in the order of turn_no; loss_start counts code points from the conversation's
    start, and is null with loss_chars 0 where the turn is not under the mask.
    """
    rows = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, at = None, -1, 0
        for b in batches:
            out = []
            for conv_id, role_, value in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if number < 0 or conv_id != now:
                    now, number, at = conv_id, 0, 0
                piece = render(role_, value.as_py())
                (_, _, start, end), = spans(piece)
                masked = role_ == LOSS_ROLE
                out.append((conv_id, number, piece, at + start if masked else None, end - start if masked else 0))
                number, at = number + 1, at + len(piece)
            yield _batch(out, PIECES)

    return order.mapInArrow(work, PIECES)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted pieces alone (rows as ``formatted`` leaves them)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def closed() -> list[tuple]:
            return [] if state is None else [(state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])]

        for b in batches:
            out = []
            for conv_id, piece in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if state is None or state[0] != conv_id:
                    out += closed()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                string = piece.as_py()
                for role, text in parse(string):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        state[3] += len(text)
                        state[4].update(text.encode())
                state[5] += len(string)
            yield _batch(out, READ)
        yield _batch(closed(), READ)

    return pieces.select("conv_id", "formatted").mapInArrow(work, READ)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

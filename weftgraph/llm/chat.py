"""Chat formatting with a grammar round trip.

A conversation is rendered turn after turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. A deterministic
parser reads it back. What does not come back as it went in holds text that the grammar would take
for its own; it is escaped, and the turn is read again until it comes back unchanged.

Turns are rendered and checked where they lie. A turn that comes back alone also does so inside its
conversation, as no control text of the grammar is left in it and the marks cannot run together with
what stands before them. Reading back works on the conversation's turns in order, as a stream, so a
conversation of any length needs the memory of one batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SHUT = "<|im_end|>"
#: Turns of this role are learned from.
LEARNED = "assistant"

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED_MARK = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPE = {"\\": "\\\\", "\n": "\\n"}
_ROLE_SIGNS = re.compile(r"[\\\n]")
_ROLE_ESCAPED = re.compile(r"\\(.)")


class Malformed(ValueError):
    """Text that the grammar cannot read."""


def escape_text(text: str) -> str:
    """One more backslash into every ``<|``, ``<\\|``, ... ; ``unescape_text`` takes it out again."""
    return _MARK.sub(r"<\1\\|", text)


def unescape_text(text: str) -> str:
    return _ESCAPED_MARK.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape_text(_ROLE_SIGNS.sub(lambda m: _ROLE_ESCAPE[m.group()], role))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), unescape_text(role))


class Parser:
    """Reads rendered text in pieces of any size; ``feed`` gives the turns that are complete."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.rest += text
        at = 0
        while True:
            if not self.rest.startswith(OPEN, at):
                if OPEN.startswith(self.rest[at : at + len(OPEN)]):
                    break
                raise Malformed(f"a turn should open at {self.rest[at:at + 30]!r}")
            line = self.rest.find("\n", at)
            if line < 0:
                break
            shut = self.rest.find(SHUT, line + 1)
            if shut < 0 or len(self.rest) < shut + len(CLOSE):
                break
            if not self.rest.startswith(CLOSE, shut):
                raise Malformed("text after the end of a turn")
            body = self.rest[line + 1 : shut]
            if OPEN in body or OPEN in self.rest[at + len(OPEN) : line] or SHUT in self.rest[at:line]:
                raise Malformed("a turn inside a turn")
            yield unescape_role(self.rest[at + len(OPEN) : line]), unescape_text(body)
            at = shut + len(CLOSE)
        self.rest = self.rest[at:]

    def end(self) -> None:
        if self.rest:
            raise Malformed("the last turn is not complete")


def parse(text: str) -> list[tuple[str, str]]:
    parser = Parser()
    turns = list(parser.feed(text))
    parser.end()
    return turns


def reads_back(rendered: str, role: str, text: str) -> bool:
    try:
        return parse(rendered) == [(role, text)]
    except Malformed:
        return False


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends in it.

    Escapes are put in only where the plain form does not come back: first in the text, then in the role.
    """
    shown_role, shown_text = role, text
    for escape in ("", "text", "role", "both"):
        shown_text = escape_text(text) if escape in ("text", "both") else text
        shown_role = escape_role(role) if escape in ("role", "both") else role
        rendered = f"{OPEN}{shown_role}\n{shown_text}{CLOSE}"
        if reads_back(rendered, role, text):
            begin = len(OPEN) + len(shown_role) + 1
            return rendered, begin, begin + len(shown_text)
    raise Malformed("a turn that no escape brings back")


RENDERED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("formatted", T.StringType()),
        T.StructField("loss_begin", T.IntegerType()), T.StructField("loss_end", T.IntegerType()),
    ]
)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        done = [render(r, t) for r, t in zip(roles, texts)]
        learned = [r == LEARNED for r in roles]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array([d[0] for d in done], pa.string()),
                pa.array([d[1] if y else 0 for d, y in zip(done, learned)], pa.int32()),
                pa.array([d[2] if y else 0 for d, y in zip(done, learned)], pa.int32()),
            ],
            names=RENDERED.names,
        )


def format_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Each turn with ``formatted``, its part of the rendered conversation, and its loss mask.

    The formatted conversation is the turns' parts in order of ``turn`` (then role and text), joined by
    nothing. ``loss_begin:loss_end`` are the code points of the part that are learned from: the
    text of assistant turns. Null texts and roles are empty. Nothing is shuffled.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return turns.mapInArrow(_render, RENDERED)


READ = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


class _Conversation:
    """What is known of a conversation while its parts pass by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.parser = Parser()

    def add(self, formatted: str, begin: int, end: int) -> None:
        self.chars += len(formatted)
        learned = unescape_text(formatted[begin:end])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())
        for role, text in self.parser.feed(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())

    def row(self) -> tuple:
        self.parser.end()
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Conversation | None = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [dict(zip(READ.names, r)) for r in rows],
            schema=pa.schema(
                [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                 ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            ),
        )

    for batch in batches:
        done = []
        for conv, part, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            now.add(part, begin, end)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation (a null id is one too), parsed from the output of ``format_turns``.

    A digest runs over the turns in order, so a conversation is read by one task; it streams through
    in sorted batches and is never held as a whole.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(_read, READ)


def all_text(turns: Iterable[tuple[str, str]]) -> str:
    """A conversation as one string; for callers that hold it anyway."""
    return "".join(render(role, text)[0] for role, text in turns)

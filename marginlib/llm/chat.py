r"""Chat formatting with a compiled template.

Conversations are rows (conv_id, turn, role, text); each is rendered by a
template that marks turns.  Control strings inside roles and texts are escaped
reversibly: a backslash is doubled, and one is put behind the first
character of every control string, so that none is left in a text.

Rows of a conversation meet in one sorted stream of a task and are rendered as
they come: memory holds a turn, not a conversation.

Defined results: null roles and texts count as empty; turns are ordered by turn
(null first), then role and text, so ties have one order; repeated rows are
repeated turns; rows with a null conv_id form one conversation; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlib.llm.template import Piece, Template

START, TURN, END = "<|start|>", "<|turn|>", "<|end|>"
# Control strings of chat formats.
CONTROL = (START, TURN, END, "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

CHAT = (
    "{% for m in messages %}{{ start }}{{ m.role | escape }}{{ turn }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ end }}\n{% endfor %}"
)

_TO_ESCAPE = re.compile(r"(\\)|(?:" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL) + ")")


def escape(text: str) -> str:
    """``text`` without control strings: the first character of each, wherever
    it starts, is cut off from the rest."""
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[1] else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def compiled(source: str = CHAT) -> Template:
    return Template(source, {"escape": escape})


def _names(messages) -> dict:
    return {"messages": messages, "start": START, "turn": TURN, "end": END}


_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(TURN) + "(.*?)" + re.escape(END) + "\n", re.S)


class Reader:
    """Reads formatted text piece by piece and keeps counts and digests."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars, self.open = "", 0, 0, 0, ""
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: Piece) -> None:
        text, loss = piece
        self.chars += len(text)
        if loss:
            self._loss(text)
        self.rest += text
        if not self.rest.endswith(END + "\n"):
            return
        at = 0
        while m := _TURN.match(self.rest, at):
            self.turns += 1
            self.turns_sha.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            at = m.end()
        self.rest = self.rest[at:]

    def _loss(self, text: str) -> None:
        """Unescape what is under the mask; a backslash at the end waits for its character."""
        text = self.open + text
        slashes = len(text) - len(text.rstrip("\\"))
        self.open = "\\" if slashes % 2 else ""
        plain = unescape(text[:len(text) - slashes % 2])
        self.loss_chars += len(plain)
        self.loss_sha.update(plain.encode())

    def row(self) -> tuple:
        return (self.turns, self.turns_sha.hexdigest(), self.loss_chars, self.loss_sha.hexdigest(), self.chars)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, iterator of messages) of rows that are sorted by conversation."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        yield conv, ({"turn": t, "role": role or "", "text": text or ""} for _, t, role, text in group)


def _sorted(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _map(conversations: DataFrame, make, schema: str) -> DataFrame:
    """``make()`` gives a function from (conv_id, messages) to a row, for each task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        rows = (one(conv, messages) for conv, messages in _conversations(batches))
        while part := list(itertools.islice(rows, 100)):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), arrow, strict=True)],
                                  schema=arrow)

    return _sorted(conversations).mapInArrow(run, schema)


def format_conversations(conversations: DataFrame, source: str = CHAT) -> DataFrame:
    """(conv_id, formatted, loss): the text of each conversation and its spans
    under the loss mask, in code points."""
    def make():
        template = compiled(source)

        def one(conv, messages):
            text, spans = template.render(**_names(messages))
            return conv, text, [{"start": a, "end": b} for a, b in spans]
        return one

    return _map(conversations, make, "conv_id long, formatted string, loss array<struct<start:long,end:long>>")


def read_back(conversations: DataFrame, source: str = CHAT) -> DataFrame:
    """Counts and digests of each conversation, read from its formatted text."""
    def make():
        template = compiled(source)

        def one(conv, messages):
            reader = Reader()
            for piece in template.stream(**_names(messages)):
                reader.add(piece)
            return (conv, *reader.row())
        return one

    return _map(conversations, make, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The rows and one more conversation whose texts are control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(probe)

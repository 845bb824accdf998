"""Chat formatting: conversations through a compiled template, with generation spans, and read back.

Rows are brought together by conversation and sorted by turn; a task renders them as a stream and
emits a conversation in parts of some 64,000 characters, cut between turns, so that memory follows a
turn and not a conversation, however long.  (SHA-256 of a whole conversation is one chain: the parts
of one conversation are read in order, in one task, a part at a time.)

Order is by turn, nulls first; rows of one turn by role, then text.  Null roles and texts are empty.
Repeated rows are turns of their own.  Rows without conv_id make one conversation without one.  Other
columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.chat_template import Output, Template, Turn, compile_template
from starloom.llm.common import slices

PART_CHARS = 1 << 16
ROWS = 1024

#: The controls and the template of the registered query.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = """
{%- for m in messages -%}
<s>{{ m.role | escape }}[INST]
{%- if m.role == 'assistant' -%}
{% generation %}{{ m.text | escape }}{% endgeneration %}
{%- else -%}
{{ m.text | escape }}
{%- endif -%}
[/INST]</s>
{%- endfor -%}
"""


@dataclass
class Part:
    """Some turns of a formatted conversation; spans are places in ``text``."""

    conv_id: int | None
    part: int
    text: str
    spans: list[tuple[int, int]]
    last: bool = False


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in role and text, each conversation together and in order."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)


def rendered(template: Template, batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """Sorted rows as parts of formatted conversations."""
    nobody, held, conv, out, part = Turn("", ""), None, None, Output(), 0

    def finished() -> Part:
        held.last = True
        template.turn(held, out)
        template.after(nobody, out)
        return Part(conv, part, "".join(out.texts), out.spans, True)

    for conv_id, role, text in _rows(batches):
        if held and conv_id == conv:
            template.turn(held, out)
            if out.size >= PART_CHARS:
                yield Part(conv, part, "".join(out.texts), out.spans)
                out, part = Output(), part + 1
            held = Turn(role, text, held.index0 + 1)
            continue
        if held:
            yield finished()
        conv, out, part, held = conv_id, Output(), 0, Turn(role, text)
        template.before(nobody, out)
    if held:
        yield finished()


def format_conversations(conversations: DataFrame, source: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS, constants: dict | None = None) -> DataFrame:
    """conv_id, part, text, spans array<struct<start, end>>: formatted conversations, in parts, with what is generated.

    ``start`` and ``end`` count code points of the part.  Conversations of up to some 64,000 characters are one part.
    """
    compile_template(source, controls, constants)  # faults show here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for p in rendered(compile_template(source, controls, constants), batches):
            some.append((p.conv_id, p.part, p.text, [{"start": a, "end": b} for a, b in p.spans]))
            size += len(p.text)
            if len(some) >= ROWS or size >= 16 * PART_CHARS:
                yield _batch(some, FORMATTED)
                some, size = [], 0
        if some:
            yield _batch(some, FORMATTED)

    return turns_of(conversations).mapInArrow(run, "conv_id long, part int, text string, spans array<struct<start:long,end:long>>")


FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


@dataclass
class ReadBack:
    """What the parts of one conversation say, a part at a time."""

    template: Template
    n_turns: int = 0
    loss_chars: int = 0
    chars: int = 0
    turns: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    loss: "hashlib._Hash" = field(default_factory=hashlib.sha256)

    def take(self, text: str, spans: list[tuple[int, int]]) -> None:
        """Split a part at its control strings: <s> role [INST] text [/INST] </s>."""
        undo, at = self.template.escape.undo, 0
        for m in self.template.escape.find(text):
            piece = text[at : m.start()]
            if m[0] == "[INST]":
                self.n_turns += 1
                self.turns.update(f"{undo(piece)}\n".encode())
            elif m[0] == "[/INST]":
                self.turns.update(f"{undo(piece)}\n".encode())
            elif piece:
                raise ValueError(f"text between turns: {piece[:40]!r}")
            at = m.end()
        for start, end in spans:
            plain = undo(text[start:end])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.chars += len(text)

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted text and its spans.

    Each part is read as soon as it is rendered, in the same task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, some = compile_template(TEMPLATE, CONTROLS), []
        seen = ReadBack(template)
        for p in rendered(template, batches):
            seen.take(p.text, p.spans)
            if p.last:
                some.append(seen.row(p.conv_id))
                seen = ReadBack(template)
            if len(some) >= ROWS:
                yield _batch(some, DIGESTS)
                some = []
        if some:
            yield _batch(some, DIGESTS)

    return turns_of(conversations).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

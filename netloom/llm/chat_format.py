"""Conversations formatted by a compiled template, turn by turn, and read back from the formatted text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.templates import Template, unescape, unescape_name
from netloom.llm.words import small_batches

START, STOP = "<|im_start|>", "<|im_end|>"
# The assistant's texts are what is to be learned.
CHAT = (
    "{% for message in messages %}"
    + START + "{{ message.role | escape_name }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    + STOP + "\n{% endfor %}"
)


def format_turns(conversations: DataFrame, source: str = CHAT) -> DataFrame:
    """(conv_id, turn, formatted, generated) of every row of ``conversations`` (conv_id, turn, role, text).

    ``formatted`` is what the row adds to its conversation's text, which is their concatenation by turn; ``generated`` are the stretches
    [start, end) in it, in code points, that the template marks. Rows are rendered one by one, so a
    conversation of any length is spread over all tasks. Where the template asks for a turn's place, rows are numbered by
    (turn, role, text) first, null turns in front.

    A null role or text counts as empty. Repeated rows are turns of their own. A null conv_id is a conversation of its own. An empty table
    gives an empty result; other columns are not read.
    """
    small_batches(conversations.sparkSession, 1024)
    template = Template(source)
    if not template.per_turn:
        raise ValueError("the template must have one loop over the messages and not look at other turns")
    rows = conversations.select(
        column(conversations, "conv_id").alias("conv_id"), column(conversations, "turn").alias("turn"),
        whole_text(conversations, "role").alias("role"), whole_text(conversations, "text").alias("text"),
    )
    if template.placed:
        order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
        rows = rows.select(
            "*", (F.row_number().over(order) - 1).alias("n"), F.lead(F.lit(1)).over(order).isNull().alias("last")
        )
    else:
        rows = rows.select("*", F.lit(0).alias("n"), F.lit(False).alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(source)
        for batch in batches:
            role, text, n, last = (batch.column(c).to_pylist() for c in range(2, 6))
            out = [compiled.render_turn({"role": r, "text": t}, i, e) for r, t, i, e in zip(role, text, n, last)]
            marks = [[{"start": a, "end": b} for a, b in m] for _, m in out]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f for f, _ in out], pa.string()), pa.array(marks, kind)],
                names=["conv_id", "turn", "formatted", "generated"],
            )

    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("turn", rows.schema["turn"].dataType),
        T.StructField("formatted", T.StringType()),
        T.StructField("generated", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ])
    return rows.mapInArrow(run, schema)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a formatted text; the reverse of ``CHAT``."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("a turn is expected")
        line = formatted.index("\n", at)
        stop = formatted.index(STOP, line + 1)
        yield unescape_name(formatted[at + len(START) : line]), unescape(formatted[line + 1 : stop])
        at = stop + len(STOP) + 1


class _Digest:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.formatted, self.loss = 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, generated: list[dict]) -> None:
        self.formatted += len(formatted)
        for role, text in read_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for mark in generated:
            text = unescape(formatted[mark["start"] : mark["end"]])
            self.loss += len(text)
            self.learned.update(text.encode())


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of formatted ``turns``, read back from them.

    A digest runs over a conversation from its first turn to its last, so each conversation's turns pass one task in order; they pass it as
    a stream, and nothing but the running digests is held.
    """
    small_batches(turns.sparkSession, 1024)
    rows = turns.select("conv_id", "turn", "formatted", "generated")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for conv, formatted, generated in zip(ids, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest))
                    now, digest = conv, _Digest()
                digest.add(formatted, generated)
            if done:
                yield result(done, batch.schema.field(0).type)
            last_type = batch.schema.field(0).type
        if digest is not None:
            yield result([(now, digest)], last_type)

    def result(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], id_type), pa.array([d.turns for _, d in done], pa.int64()),
             pa.array([d.all.hexdigest() for _, d in done]), pa.array([d.loss for _, d in done], pa.int64()),
             pa.array([d.learned.hexdigest() for _, d in done]), pa.array([d.formatted for _, d in done], pa.int64())],
            names=names,
        )

    types = [kind, T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(run, schema)
    )

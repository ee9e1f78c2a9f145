"""Chat formatting: conversations through a compiled template, and back.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is spread over tasks; each message is
rendered where it lies, with its place in the whole conversation. The output is a table of segments: a conversation is
one, unless it crosses a border between ranges or grows beyond a size, and then it is several in a row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimill.llm.templates import FILTERS, Piece, Template, join
from kpimill.session import materialize, scratch_path

# No text holds a "<" or "[" after escaping, so control strings stand only where the template puts them.
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %} {% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<<SYS>>{{ m.role | escape_name }}\n{{ m.text | escape }}<</SYS>>{% endif %}"
    "{% endfor %}"
)
TURN = re.compile(r"\[INST\] ([^<\[]*) \[/INST\]| ([^<\[]*)</s>|<<SYS>>([^<\[\n]*)\n([^<\[]*)<</SYS>>")
SEGMENT_CHARS = 1 << 20
_BACK = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}


def escape(text: str | None) -> str:
    return (text or "").replace("\\", "\\\\").replace("<", "\\l").replace("[", "\\b")


def escape_name(text: str | None) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def chat_template(source: str = TEMPLATE) -> Template:
    return Template(source, {**FILTERS, "escape": escape, "escape_name": escape_name})


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a formatted conversation, unescaped."""
    at = 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        user, assistant, role, text = m.groups()
        if user is not None:
            yield "user", unescape(user)
        elif assistant is not None:
            yield "assistant", unescape(assistant)
        else:
            yield unescape(role), unescape(text)
        at = m.end()


def stage_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows in order, written: conv_id, role, text, part (the range), seq (place in it). Equal turns are ordered by a
    hash of role and text, nulls come first."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("role"), b.column("text"), pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64())], ["conv_id", "role", "text", "part", "seq"]
            )
            seq += n

    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.withColumn("tie", F.xxhash64("role", "text")).repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie", "role", "text").select(order)
    return materialize(dealt.mapInArrow(number, "conv_id long, role string, text string, part int, seq long"), "turns")


def format_conversations(
    df: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment_chars: int = SEGMENT_CHARS
) -> DataFrame:
    """Segments: conv_id, part, segment, whole (the conversation is this segment alone), formatted, loss (list of [start, end)
    of what the model wrote, in characters of the segment).

    The template must be a single loop over ``messages``; a message has ``role`` and ``text``. Null texts are empty, a null
    role is the empty one, rows with a null conversation id are one conversation; repeated rows are turns of their own; an
    empty table gives no rows; other columns are ignored.
    """
    staged = stage_turns(df, conv_col, turn_col, role_col, text_col)
    # conversations in several ranges: two for each border at most, so the driver may know them
    pieces = staged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    several = pieces.groupBy(F.col("conv_id").alias("conv")).agg(F.count("*").alias("parts")).filter("parts > 1")
    crossing: dict[int | None, list[tuple[int, int]]] = {}
    for r in pieces.join(several, F.col("conv_id").eqNullSafe(F.col("conv"))).select("conv_id", "part", "n").collect():
        crossing.setdefault(r["conv_id"], []).append((r["part"], r["n"]))
    before: dict[tuple[int | None, int], int] = {}
    total: dict[int | None, int] = {}
    for conv, found in crossing.items():
        for part, n in sorted(found):
            before[conv, part] = total.get(conv, 0)
            total[conv] = total.get(conv, 0) + n

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = chat_template(template).render_turn
        out: list[tuple] = []
        held: tuple | None = None  # a turn is rendered when the next one shows whether it is the last of its conversation
        pieces: list[Piece] = []
        index = segment = chars = 0

        def close(conv, part, ended) -> None:
            nonlocal pieces, segment, chars
            text, spans = join(pieces)
            out.append((conv, part, segment, ended and segment == 0 and conv not in total, text, [list(s) for s in spans]))
            pieces, chars, segment = [], 0, segment + 1

        def turn(here_ends: bool) -> None:
            nonlocal index, segment, chars
            conv, part, role, text = held
            last = here_ends and (conv not in total or index + 1 == total[conv])
            found = run({"role": role or "", "text": text or ""}, index, last)
            pieces.extend(found)
            chars += sum(len(p) for p, _ in found)
            index += 1
            if here_ends or chars >= segment_chars:
                close(conv, part, here_ends)

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "part", "segment", "whole", "formatted", "loss"])
            out.clear()
            return made

        for b in batches:
            for conv, part, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "role", "text"))):
                if held is None or held[:2] != (conv, part):
                    if held is not None:
                        turn(True)
                    index, segment = before.get((conv, part), 0), 0
                else:
                    turn(False)
                held = (conv, part, role, text)
            if out:
                yield batch()
        if held is not None:
            turn(True)
        if out:
            yield batch()

    dealt = staged.repartition("part").sortWithinPartitions("part", "seq")
    return dealt.mapInArrow(render, "conv_id long, part int, segment int, whole boolean, formatted string, loss array<array<long>>")


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _segment(formatted: str, loss: list[list[int]]) -> tuple[int, bytes, str]:
    """Turns, their bytes (role, newline, text, newline), and the unescaped text under the loss mask of one segment."""
    turns = list(read_turns(formatted))
    return len(turns), "".join(f"{r}\n{t}\n" for r, t in turns).encode(), "".join(unescape(formatted[a:b]) for a, b in loss)


def read_digests(segments: DataFrame) -> DataFrame:
    """Read formatted segments back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars per conversation.

    Whole conversations are digested where they lie. Of the others, the read-back bytes go in order, a segment at a time,
    through one task per conversation: a SHA-256 cannot be taken in parts.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, text, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                n, turns, marked = _segment(text, loss)
                out.append((conv, n, hashlib.sha256(turns).hexdigest(), len(marked), hashlib.sha256(marked.encode()).hexdigest(), len(text)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None

        def done() -> pa.RecordBatch:
            conv, n, turns, chars, marked, size = held
            row = [conv, n, turns.hexdigest(), chars, marked.hexdigest(), size]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for conv, text, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                if held is None or held[0] != conv:
                    if held is not None:
                        yield done()
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                n, turns, marked = _segment(text, loss)
                held[1] += n
                held[2].update(turns)
                held[3] += len(marked)
                held[4].update(marked.encode())
                held[5] += len(text)
        if held is not None:
            yield done()

    cut = segments.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return segments.filter("whole").mapInArrow(whole, DIGESTS).unionByName(cut.mapInArrow(parts, DIGESTS))


def round_trip(df: DataFrame, spark: SparkSession | None = None, path: str | None = None, **columns: str) -> DataFrame:
    """Format, write (in the shared folder, or at ``path``), read back and digest."""
    spark = spark or df.sparkSession
    path = path or scratch_path(spark, "formatted")
    format_conversations(df, **columns).write.parquet(path)
    return read_digests(spark.read.parquet(path))

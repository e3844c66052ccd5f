"""Chat formatting: black-box templates, the span of each turn, a loss mask.

A template is any function from a list of turns to a text. Nothing is assumed about it: the prefixes
of a conversation are rendered one after the other, and what a prefix adds to the one before is the
span of its last turn. A template that changes earlier output is found by the same comparison.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import table
from tallylake.llm.registry import query


class Turn(NamedTuple):
    role: str
    text: str


Template = Callable[[list[Turn]], str]

# --- the built-in template -----------------------------------------------------------------

OPEN, CLOSE, ESCAPE = "### ", " </turn>\n", "\\"
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"[\\:\n]")
_ROLE_ESCAPED = re.compile(r"\\([\\:\n])")
#: A turn as it stands in the output; escaped characters are passed over in pairs.
_TURN = re.compile(r"### ((?:[^\\:]|\\[\\:\n])*): ((?:[^\\<]|\\(?:\\|###|</turn>)|<(?!/turn>))*) </turn>\n", re.S)


def escaped(text: str) -> str:
    """``text`` with a backslash before each backslash and each control string."""
    return _CONTROL.sub(lambda m: ESCAPE + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def marked_turns(turns: list[Turn]) -> str:
    """``### role: text </turn>`` for each turn, control strings inside texts escaped."""
    return "".join(
        f"{OPEN}{_ROLE_CONTROL.sub(lambda m: ESCAPE + m[0], t.role)}: {escaped(t.text)}{CLOSE}" for t in turns
    )


def read_back(output: str) -> list[Turn]:
    """The turns of a text that ``marked_turns`` made; ValueError for any other text."""
    turns, at = [], 0
    while at < len(output):
        found = _TURN.match(output, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append(Turn(_ROLE_ESCAPED.sub(lambda m: m[1], found[1]), unescaped(found[2])))
        at = found.end()
    return turns


# --- spans by comparison ---------------------------------------------------------------------


class Span(NamedTuple):
    """Characters ``start:end`` of the output belong to the turn, ``text_start:text_end`` to its text."""

    turn: int
    role: str
    start: int
    end: int
    text_start: int
    text_end: int


class Formatted(NamedTuple):
    """``rewritten``: the first turn (from 0) whose rendering changed earlier output, or None.

    Spans are given up to that turn, as later ones have no fixed place.
    """

    text: str
    spans: list[Span]
    rewritten: int | None


#: Texts that no template is expected to treat differently; they differ in their first character.
_PROBES = ("A", "B")


def _probe(template: Template, before: list[Turn], role: str) -> tuple[int, int]:
    """Where a text of ``role`` begins behind ``before``, and how many characters stand around all texts."""
    one, two = (template([*before, Turn(role, p)]) for p in _PROBES)
    return len(os.path.commonprefix([one, two])), len(one) - len(_PROBES[0])


def format_incrementally(template: Template, turns: list[Turn], loss_roles: frozenset[str]) -> Formatted:
    """Render every prefix, compare it with the one before, and probe the text's place in turns under the loss."""
    before, spans, rewritten = template([]), [], None
    for i, turn in enumerate(turns):
        output = template(turns[: i + 1])
        if not output.startswith(before):
            rewritten = i
            break
        inside = (len(output), len(output))
        if turn.role in loss_roles:
            begin, around = _probe(template, turns[:i], turn.role)
            inside = (begin, begin + len(output) - around)
        spans.append(Span(i, turn.role, len(before), len(output), *inside))
        before = output
    return Formatted(before if rewritten is None else template(turns), spans, rewritten)


_SPAN = pa.struct([
    ("turn", pa.int32()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
    ("text_start", pa.int64()), ("text_end", pa.int64()),
])
_FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(_SPAN)), ("rewritten", pa.int32()),
])
_FORMATTED_DDL = (
    "conv_id long, text string, spans array<struct<turn:int,role:string,start:long,end:long,"
    "text_start:long,text_end:long>>, rewritten int"
)
#: Characters of output in one Arrow batch, about.
_BATCH_CHARS = 4_000_000


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """One conversation at a time from rows that are sorted by conversation."""
    turns: list[Turn] = []
    now: int | None = None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)
        for conv_id, role, text in rows:
            if turns and conv_id != now:
                yield now, turns
                turns = []
            now = conv_id
            turns.append(Turn(role or "", text or ""))
    if turns:
        yield now, turns


def format_conversations(
    conversations: DataFrame, template: Template = marked_turns, loss_roles: Iterable[str] = ("assistant",)
) -> DataFrame:
    """One row per conversation: conv_id, text, spans, rewritten.

    Input columns: conv_id, turn, role, text; others are ignored. Turns are taken in the order of turn
    (null first), then role, then text; repeated rows are turns of their own. A null role or text
    counts as empty; rows with a null conv_id are one conversation. An empty table gives no rows.
    Rows are dealt by conversation and sorted, and a task holds one conversation at a time; its
    output is one string, so a conversation has to fit into a worker in any case.
    """
    loss = frozenset(loss_roles)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for conv_id, turns in _conversations(batches):
            made = format_incrementally(template, turns, loss)
            rows.append({
                "conv_id": conv_id, "text": made.text, "spans": [s._asdict() for s in made.spans],
                "rewritten": made.rewritten,
            })
            size += len(made.text)
            if size >= _BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(rows, _FORMATTED)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _FORMATTED)

    own = conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, _FORMATTED_DDL)


# --- the query -------------------------------------------------------------------------------

_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewritten", pa.int32()),
])


def digests(formatted: DataFrame) -> DataFrame:
    """What the output itself says: its turns, and the text under the loss mask, both unescaped."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                turns = read_back(row["text"])
                loss = "".join(
                    unescaped(row["text"][s["text_start"] : s["text_end"]])
                    for s in row["spans"] if s["text_end"] > s["text_start"]
                )
                every = "".join(f"{t.role}\n{t.text}\n" for t in turns)
                rows.append({
                    "conv_id": row["conv_id"], "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(every.encode("utf-8", "surrogatepass")).hexdigest(),
                    "loss_chars": len(loss),
                    "loss_sha256": hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(),
                    "formatted_chars": len(row["text"]), "rewritten": row["rewritten"],
                })
            yield pa.RecordBatch.from_pylist(rows, _DIGEST)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewritten int",
    )


#: A conversation that tries to close its own turns and open others.
TRIAL = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@query("op1_chat_format")
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    trial = spark.createDataFrame(TRIAL, "conv_id long, turn long, role string, text string")
    return digests(format_conversations(given.unionByName(trial)))

"""Chat formatting by a template that is only ever called, with the span of every turn and text found from its output.

A template is a black box from turns to one string. Successive prefixes of a conversation are rendered
and consecutive outputs compared: what the longer one has more is the span of its last turn. Where
the longer output does not begin with the shorter, the template rewrites history, and the conversation is
marked so instead of getting wrong spans. Inside a turn's span, the text lies between what stays the same
whatever text the turn has.

Long conversations are rendered in segments: a segment's prefixes start with a few turns of context in place of
all earlier turns, after a test that the template gives the same output either way. So a task holds
one segment at a time, however many turns a conversation has, and the work grows with the turns.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm import storage

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]

#: Turns of a segment, and the turns before it that its prefixes start with.
SEGMENT, CONTEXT = 64, 8

#: A span counts code points of the segment's formatted text.
SPAN = "struct<role: string, start: long, end: long, text_start: long, text_end: long, loss: boolean>"
FORMATTED = f"segment int, last boolean, n_turns int, formatted string, spans array<{SPAN}>, rewrites boolean"

# The strings that mark turns
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN", "[/TURN]")


class InstTemplate:
    """User turns in ``[INST]``, system turns in ``[SYS]``, assistant turns in ``<s>`` … ``</s>``, any other role by name.

    A text may hold the marks itself. Each gets a backslash behind its first character, and so does each that has
    backslashes there already, so that no mark is left in a text and ``unescape`` gives back every text.
    """

    _marks = re.compile(r"([<\[])(\\*)(?=" + "|".join(sorted({re.escape(c[1:]) for c in CONTROL})) + ")")
    _escaped = re.compile(r"([<\[])\\(\\*)(?=" + "|".join(sorted({re.escape(c[1:]) for c in CONTROL})) + ")")
    _turn = re.compile(
        r"\[INST\] (.*?) \[/INST\]|\[SYS\] (.*?) \[/SYS\]|<s>(.*?)</s>|\[TURN ([^\]]*)\] (.*?) \[/TURN\]", re.DOTALL
    )

    @classmethod
    def escape(cls, text: str) -> str:
        return cls._marks.sub(r"\1\\\2", text)

    @classmethod
    def unescape(cls, text: str) -> str:
        return cls._escaped.sub(r"\1\2", text)

    @classmethod
    def _one(cls, role: str, text: str) -> str:
        body = cls.escape(text)
        if role == "user":
            return f"[INST] {body} [/INST]"
        if role == "system":
            return f"[SYS] {body} [/SYS]"
        if role == "assistant":
            return f"<s>{body}</s>"
        return f"[TURN {quote(role, safe=' ')}] {body} [/TURN]"

    def __call__(self, turns: Sequence[Turn]) -> str:
        return "".join(self._one(role, text) for role, text in turns)

    @classmethod
    def parse(cls, formatted: str) -> list[Turn]:
        """The turns of a formatted text, from its marks alone."""
        turns, at = [], 0
        while at < len(formatted):
            found = cls._turn.match(formatted, at)
            if not found:
                raise ValueError(f"no turn begins at character {at}")
            user, system, assistant, role, other = found.groups()
            name = "user" if user is not None else "system" if system is not None else "assistant"
            text = next(t for t in (user, system, assistant, other) if t is not None)
            turns.append((unquote(role) if role is not None else name, cls.unescape(text)))
            at = found.end()
        return turns


def _common(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    return len(os.path.commonprefix([a, b]))


@dataclass
class Segment:
    """What some consecutive turns of a conversation are formatted to."""

    formatted: str = ""
    spans: list[tuple[str, int, int, int, int]] = field(default_factory=list)
    rewrites: bool = False


class Spans:
    """Finds spans by rendering. Marks around a text are kept by role and neighbour, and tested at every use."""

    def __init__(self, render: Render, unescape: Callable[[str], str]):
        self.render, self.unescape = render, unescape
        self.marks: dict[tuple[str | None, str], tuple[int, int]] = {}

    def _text(self, before: list[Turn], turn: Turn, piece: str) -> tuple[int, int] | None:
        """Where the text begins and ends in its turn's ``piece``."""
        kind = (before[-1][0] if before else None, turn[0])
        for fresh in (False, True):
            if fresh or kind not in self.marks:
                start = self.render(before)
                a, b = (self.render([*before, (turn[0], probe)]) for probe in ("0", "1"))
                if not (a.startswith(start) and b.startswith(start)):
                    return None
                a, b = a[len(start) :], b[len(start) :]
                self.marks[kind] = _common(a, b), _common(a[::-1], b[::-1])
            head, tail = self.marks[kind]
            end = len(piece) - tail
            if head <= end and self.unescape(piece[head:end]) == turn[1]:
                return head, end
        return None

    def segment(self, before: list[Turn], turns: list[Turn]) -> Segment:
        """``turns`` formatted behind the context ``before``."""
        shown, last = list(before), self.render(before)
        out, size = Segment(), 0
        pieces = []
        for turn in turns:
            longer = self.render([*shown, turn])
            if not longer.startswith(last):
                return self.rewritten(before, turns)
            piece = longer[len(last) :]
            text = self._text(shown, turn, piece)
            if text is None:
                return self.rewritten(before, turns)
            out.spans.append((turn[0], size, size + len(piece), size + text[0], size + text[1]))
            pieces.append(piece)
            size += len(piece)
            shown.append(turn)
            last = longer
        out.formatted = "".join(pieces)
        return out

    def rewritten(self, before: list[Turn], turns: list[Turn]) -> Segment:
        """Turns of a template that changes what it gave before, or a text: the last output, without spans."""
        start, whole = self.render(before), self.render([*before, *turns])
        return Segment(whole[len(start) :] if whole.startswith(start) else whole, [], True)

    def local(self, turns: list[Turn], context: int) -> bool:
        """Whether the last turn comes out the same after ``context`` turns as after all."""
        def piece(before: list[Turn]) -> str | None:
            start, whole = self.render(before), self.render([*before, turns[-1]])
            return whole[len(start) :] if whole.startswith(start) else None

        return piece(turns[-1 - context : -1]) == piece(turns[:-1])


def _segments(spans: Spans, turns: Iterator[Turn], segment: int, context: int) -> Iterator[tuple[int, bool, int, Segment]]:
    """(number, whether it is the last, turns, segment) of one conversation. One that a template rewrites, or that needs all
    earlier turns to be rendered right, is one segment."""
    held: list[Turn] = []
    number, before = 0, []
    for turn in turns:
        held.append(turn)
        if len(held) <= segment:
            continue
        if number == 0 and not spans.local(held, context):
            held += list(turns)
            break
        done = spans.segment(before, held[:-1])
        if done.rewrites and number == 0:
            held += list(turns)
            break
        yield number, False, len(held) - 1, done
        number, before, held = number + 1, held[:-1][-context:], [turn]
    yield number, True, len(held), spans.segment(before, held)


def format_conversations(
    turns: DataFrame,
    template: Callable[[], InstTemplate] = InstTemplate,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: Sequence[str] = ("assistant",),
    segment: int = SEGMENT,
    context: int = CONTEXT,
) -> DataFrame:
    """(key, segment, last, n_turns, formatted, spans, rewrites): the conversations' formatted texts, and where each turn lies.

    Turns go by ``order``, nulls first; of equal ones by role and text, and repeated rows are turns each. A null role or
    text is empty; rows without a key are one conversation, whose key is null; other columns are not read. A
    conversation has a row per ``segment`` turns, in order; together they are its text. Spans name the turn's and
    its text's first and last place, and whether it bears loss: the turns of the roles ``trained``. A conversation that the
    template rewrites has ``rewrites`` in some row, the text as rendered in the end, and no spans there. An empty table gives no rows.
    """
    spark = turns.sparkSession
    storage.small_batches(spark)
    named = turns.select(
        turns[key].alias("key"),
        turns[order].alias("at"),
        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
    )
    dealt = named.repartition(F.col("key")).sortWithinPartitions("key", F.col("at").asc_nulls_first(), "role", "text")
    schema = f"`{key}` {dict(turns.dtypes)[key]}, {FORMATTED}"
    loss = set(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = template()
        spans = Spans(made, made.unescape)
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))))
        out, size = [], 0
        for own, group in _runs(rows):
            for number, last, n, done in _segments(spans, group, segment, context):
                found = [dict(zip(("role", "start", "end", "text_start", "text_end", "loss"), (*s, s[0] in loss))) for s in done.spans]
                out.append((own, number, last, n, done.formatted, found, done.rewrites))
                size += len(done.formatted)
                if size > 1 << 22:
                    yield _batch(out, arrow)
                    out, size = [], 0
        if out:
            yield _batch(out, arrow)

    arrow = _arrow(schema)
    return dealt.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, rest of each row) of runs of rows with one key."""
    for own, group in groupby(rows, key=lambda row: row[0]):
        yield own, (row[1:] for row in group)


def read_back(formatted: DataFrame, template: Callable[[], InstTemplate] = InstTemplate, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted conversations.

    The turns are read from the marks, the text that bears loss from the spans, unescaped. Conversations of one segment are
    read where they lie; the segments of others stream through a task in order, which holds only digests.
    Conversations that a template rewrites have no turns here.
    """
    alone = F.col("last") & (F.col("segment") == 0)
    dealt = formatted.where(~alone).repartition(F.col(key)).sortWithinPartitions(key, "segment")
    kind = dict(formatted.dtypes)[key]
    schema = f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = template()
        rows = (
            row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (key, "formatted", "spans", "rewrites")))
        )
        out = []
        for own, group in _runs(rows):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = size = 0
            for whole, spans, rewrites in group:
                size += len(whole)
                if rewrites:
                    continue
                for role, text in made.parse(whole):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for span in spans:
                    if span["loss"]:
                        text = made.unescape(whole[span["text_start"] : span["text_end"]])
                        loss.update(text.encode())
                        chars += len(text)
            out.append((own, n, turns.hexdigest(), chars, loss.hexdigest(), size))
            if len(out) == 10_000:
                yield _batch(out, arrow)
                out = []
        if out:
            yield _batch(out, arrow)

    arrow = _arrow(schema)
    return formatted.where(alone).mapInArrow(run, schema).unionByName(dealt.mapInArrow(run, schema))

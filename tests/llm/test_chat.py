from __future__ import annotations

import hashlib
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from tidemark.llm import chat

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this module

MARKS = st.text(alphabet="ab <>[]/\\sINSTYTURN\n", max_size=30) | st.sampled_from(["</s>[INST] ok [/INST]", "<\\s>", "[\\\\/INST]"])
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "a]b[c%", "[INST]"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, MARKS), max_size=8))
def test_template_is_reversible(turns):
    made = chat.InstTemplate()
    assert made.parse(made(turns)) == turns
    done = chat.Spans(made, made.unescape).segment([], turns)
    assert done.formatted == made(turns) and not done.rewrites
    for (role, text), (span_role, start, end, a, b) in zip(turns, done.spans, strict=True):
        assert span_role == role and start <= a <= b <= end
        assert made.unescape(done.formatted[a:b]) == text
        assert made.parse(done.formatted[start:end]) == [(role, text)]


def brute(rows):
    """Digests per conversation, straight from the rows."""
    found = {}
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, _, role, text in rows:
        found.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(len(t) for r, t in turns if r == "assistant"),
            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(),
            len(chat.InstTemplate()(turns)),
        )
        for conv, turns in found.items()
    }


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (2, 3, None, "no role"),
        (2, None, "assistant", "first by its null turn"),
        (2, 3, "assistant", "tie"),
        (2, 3, "assistant", "tie"),
        (None, 0, "user", "no id"),
        (None, 1, "assistant", "日本 👩‍👩‍👧 \x00 " * 3),
        (3, 0, "assistant", ""),
        (4, 0, "tool]", "x" * 200_000),
        (4, 1, "assistant", "[\\INST] and <\\\\/s>" * 500),
    ] + [(5, i, ("user", "assistant", "system")[i % 3], f"turn {i} </s>") for i in range(500)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, segment int, key string")
    formatted = chat.format_conversations(frame)
    found = {r[0]: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    assert found == brute(rows)
    assert formatted.where("conv_id = 5").count() == -(-500 // chat.SEGMENT)
    assert chat.format_conversations(frame.limit(0)).count() == 0


class Growing(chat.InstTemplate):
    """Numbers its turns: no turn can be rendered without all before it."""

    def __call__(self, turns):
        return "".join(f"<{i}>{t}" for i, (_, t) in enumerate(turns))


class Forgetful(chat.InstTemplate):
    """Shows what the assistant said in its last turn alone."""

    def __call__(self, turns):
        last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
        return "".join(f"<{r}>{t if r != 'assistant' or i == last else ''}|" for i, (r, t) in enumerate(turns))


class Trimming(chat.InstTemplate):
    """Trims texts, so that they cannot be read back."""

    def __call__(self, turns):
        return "".join(f"<{r}>{t.strip()}|" for r, t in turns)


class Footed(chat.InstTemplate):
    """Ends with what each further turn takes away."""

    def __call__(self, turns):
        return "".join(f"<{r}>{t}|" for r, t in turns) + "THE END"


def test_long_conversations_of_a_template_that_needs_all_turns(spark):
    frame = spark.createDataFrame([(1, i, "user", f"t{i}") for i in range(200)], "conv_id long, turn long, role string, text string")
    rows = chat.format_conversations(frame, Growing).collect()
    assert len(rows) == 1 and rows[0].formatted == "".join(f"<{i}>t{i}" for i in range(200))
    assert [rows[0].formatted[s.text_start : s.text_end] for s in rows[0].spans] == [f"t{i}" for i in range(200)]


@pytest.mark.parametrize("template, told", [(Forgetful, True), (Footed, True), (Trimming, True), (chat.InstTemplate, False)])
@pytest.mark.parametrize("repeats", [1, 60])
def test_rewriting_is_detected(spark, template, told, repeats):
    turns = [("user", "a"), ("assistant", " b "), ("user", "c"), ("assistant", "d")] * repeats
    frame = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    rows = chat.format_conversations(frame, template).collect()
    assert any(r.rewrites for r in rows) is told
    assert all(not r.spans for r in rows if r.rewrites)

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallylake.llm.chat import Turn, digests, escaped, format_conversations, format_incrementally, marked_turns, op1_chat_format, read_back, unescaped

SF = "/root/testdata/sf0.001"
PARTS = st.lists(st.sampled_from(["\\", "#", "##", "###", "<", "</turn>", " </turn>\n", "### user: ", "a", ":", "\n", " ", "é"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.builds(Turn, PARTS, PARTS), max_size=5))
def test_every_text_is_read_back(turns):
    assert read_back(marked_turns(turns)) == turns
    for turn in turns:
        assert unescaped(escaped(turn.text)) == turn.text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.builds(Turn, st.sampled_from(["user", "assistant"]), PARTS), min_size=1, max_size=5))
def test_spans_by_comparison(turns):
    made = format_incrementally(marked_turns, turns, frozenset(["assistant"]))
    assert made.rewritten is None and made.text == marked_turns(turns)
    assert [s.start for s in made.spans] == [0, *(s.end for s in made.spans[:-1])] and made.spans[-1].end == len(made.text)
    for span, turn in zip(made.spans, turns):
        inside = made.text[span.text_start : span.text_end]
        assert unescaped(inside) == (turn.text if turn.role == "assistant" else "")


def test_a_template_that_rewrites_history_is_found():
    def last_thought_only(turns):
        return "".join(f"[{t.role}]{t.text if i + 1 == len(turns) else t.text.partition('!')[0]}" for i, t in enumerate(turns))

    turns = [Turn("user", "a"), Turn("assistant", "thought!b"), Turn("user", "c")]
    made = format_incrementally(last_thought_only, turns, frozenset(["assistant"]))
    assert made.rewritten == 2 and [s.turn for s in made.spans] == [0, 1] and made.text == "[user]a[assistant]thought[user]c"
    assert format_incrementally(marked_turns, [], frozenset()).text == ""


def test_text_is_not_taken_back():
    with pytest.raises(ValueError):
        read_back("### user: a </turn>\nrest")


def test_the_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    by: dict = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: r for r in op1_chat_format(spark, SF).collect()}
    assert got.keys() == by.keys()
    for conv_id, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        every = "".join(f"{role}\n{t}\n" for role, t in turns)
        row = got[conv_id]
        assert (row.n_turns, row.loss_chars, row.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.turns_sha256 == hashlib.sha256(every.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", "b", "x"), (1, 0, None, None, "x"), (1, 1, "assistant", "b", "x"), (None, None, "user", "", "x"), (2, None, "user", "z" * 300_000, "x"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans string")
    got = {r.conv_id: r for r in digests(format_conversations(given)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (3, 2), None: (1, 0), 2: (1, 0)}
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert digests(format_conversations(given.limit(0))).count() == 0

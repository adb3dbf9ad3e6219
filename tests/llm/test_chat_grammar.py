import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm.chat_grammar import GrammarError, escape, format_conversations, parse, render, round_trip, unescape

PIECES = st.sampled_from(["<", "[", "\\", "/", "s>", "SYS>>", "INST]", "ROLE]", "SAY]", " ", "\n", "é", "</s>", "[INST]", "<<SYS>>", "[/ROLE]"])
TEXTS = st.lists(PIECES, max_size=12).map("".join)
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), TEXTS)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=5))
def test_any_conversation_survives(turns):
    assert [t[:2] for t in parse("".join(render(r, t) for r, t in turns))] == turns


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text


def test_plain_text_is_not_escaped_and_bad_text_fails():
    assert render("user", "a [b] \\ <c>") == "[INST] a [b] \\ <c> [/INST]"
    assert render("assistant", "x </s>") == "<s> x <\\/s> </s>"
    for bad in ("text", "[INST] a", "[INST] a </s>", "<s> a [/INST]", "[INST] a [/INST] ", "[INST]a [/INST]"):
        with pytest.raises(GrammarError):
            parse(bad)


def test_round_trip_equals_brute_force(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "é <s>x"), (1, 1, "assistant", "é <s>x"), (1, None, "system", None), (2, 0, None, ""),
            (None, 3, "tool", "[INST]"), (4, 2, "assistant", None), (4, 1, "user", "x" * 100_000)] + [(5, k, ("user", "assistant")[k % 2], f"t{k} \\[INST]") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as at", "'x' as out")
    assert format_conversations(df, part_chars=5000).groupBy("conv_id").count().filter("conv_id = 5").first()["count"] > 10
    got = {r["conv_id"]: r for r in round_trip(df).collect()}
    assert set(got) == {1, 2, 4, 5, None}
    for conv, r in got.items():
        own = sorted(((t, a or "", b or "") for c, t, a, b in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        whole = "".join(f"{a}\n{b}\n" for _, a, b in own)
        loss = "".join(b for _, a, b in own if a == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(render(a, b)) for _, a, b in own)


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm.chat import Broken, escape, format_conversations, parse, read_back, render_turn, unescape

DDL = "conv_id long, turn long, role string, text string, page int, loss string"
BITS = st.lists(st.sampled_from(["\\", "</turn>", "### User:", "### Assistant: ", "### -:", "### =61:", "<", "\n", "a", " ", "#", "é"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", None, "Odd Röle", "", "-"]), BITS.map("".join)), max_size=4))
def test_whatever_is_rendered_is_read_back(turns):
    assert [t[:2] for t in parse("".join(render_turn(r, t) for r, t in turns))] == turns


@settings(max_examples=200, deadline=None)
@given(BITS.map("".join))
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text


def test_plain_texts_stay_as_they_are():
    assert render_turn("user", "a \\ b") == "### User: a \\ b</turn>\n"


@pytest.mark.parametrize("text", ["x", "### User: a", "### User: a</turn>", "### User: ### User: a</turn>\n", "### =zz: a</turn>\n"])
def test_other_texts_are_refused(text):
    with pytest.raises(Broken):
        parse(text)


def test_slashes_take_linear_time():
    assert parse(render_turn("user", "\\" * 1_000_000))[0][1] == "\\" * 1_000_000


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: ((t[0] is not None, t[0] or 0), (t[1] is not None, t[1] or ""), t[2]))
        said = "".join(t for _, r, t in turns if r == "assistant")
        out.append((
            conv, len(turns), hashlib.sha256("".join(f"{r or ''}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
            len(said), hashlib.sha256(said.encode()).hexdigest(), sum(len(render_turn(r, t)) for _, r, t in turns),
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("page_chars", [1 << 20, 40])
def test_conversations(spark, page_chars):
    rows = [
        (1, 1, "assistant", "</turn> é"), (1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"),
        (2, 0, "assistant", ""), (2, 0, "assistant", "### User: \\"), (None, 0, "user", "n"), (None, 1, "user", "m"),
        *[(3, i, "assistant" if i % 2 else "user", f"turn {i} \\### User:") for i in range(300)], (4, 0, "user", "y" * 100000),
    ]
    turns = spark.createDataFrame([(*r, 1, "z") for r in rows], DDL)
    formatted = format_conversations(turns, page_chars)
    assert formatted.columns == ["conv_id", "page", "text", "loss"]
    assert sorted(map(tuple, read_back(formatted).collect()), key=str) == expected(rows)
    if page_chars == 40:
        assert formatted.where("conv_id = 3").count() > 100


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], DDL))).collect() == []

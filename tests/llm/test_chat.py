import hashlib
import random

import pytest

from starflow.llm import chat
from starflow.llm.chat import format_turns, parse, read_back, render, unescape

COLUMNS = "conv_id long, turn long, role string, text string, formatted string"
PARTS = [*chat.CONTROL, "\\", "<", "[", " ", "a", "</s", "INST]", ">", "\n", "é"]


def test_any_turn_parses_back():
    rng = random.Random(0)
    for _ in range(5000):
        role = rng.choice(["user", "assistant", "system", "tool", "", rng.choice(PARTS) * 2, None])
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 7)))
        formatted, start, end = render(role, text)
        assert unescape(formatted[start:end]) == text
        both = list(parse(formatted + render("user", text)[0]))
        assert [t[:2] for t in both] == [(role or "", text), ("user", text)]


def test_escapes_only_where_needed():
    assert render("user", "a \\n b")[0] == "[INST] a \\n b [/INST]"
    assert render("user", "a</s>b")[0] == "[INST] a\\</s>b [/INST]"
    assert render("user", "\\[ [INST]")[0] == "[INST] \\\\[ \\[INST] [/INST]"


@pytest.mark.parametrize("bad", ["x", "[INST] a", "[INST]a [/INST]", "[INST] [/INST]", "<s> a </s> ",
                                 "[INST] <s> [/INST]", "</s>", "<<ROLE>> a <</ROLE>>"])
def test_parser_is_strict(bad):
    with pytest.raises(ValueError):
        list(parse(bad))


def digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_odd_rows(spark):
    data = [(1, 1, "assistant", "yes </s>", "x"), (1, 0, "user", "[INST]", "x"), (1, 1, "assistant", "yes </s>", "x"),
            (2, None, None, None, None), (2, 0, "tool", "", "x"), (None, 0, "user", "w" * 200_000, "x")]
    made = format_turns(spark.createDataFrame(data, COLUMNS))
    assert made.columns == ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"]
    got = {r["conv_id"]: tuple(r)[1:5] for r in read_back(made).collect()}
    assert got[1] == digest([("user", "[INST]"), ("assistant", "yes </s>"), ("assistant", "yes </s>")])
    assert got[2] == digest([(None, None), ("tool", "")])
    assert got[None] == digest([("user", "w" * 200_000)])
    assert read_back(format_turns(spark.createDataFrame([], COLUMNS))).count() == 0


def test_conversation_longer_than_a_batch(spark):
    data = [(5, i, "assistant" if i % 2 else "user", f"t{i} <s>", None) for i in range(5000)]
    got = read_back(format_turns(spark.createDataFrame(data, COLUMNS).repartition(7))).collect()
    assert tuple(got[0])[1:5] == digest([(r[2], r[3]) for r in data])

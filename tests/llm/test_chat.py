"""Chat formatting: exact round trips."""

import hashlib
import random

import pytest

from loomframe.llm.chat import INSTRUCT, ChatTemplate, RoleForm, format_chats, read_chats
from loomframe.llm.queries.chats import TRAP

PIECES = ["<", "s", ">", "/", "\\", ".", "[", "INST", "]", *INSTRUCT.controls, "\n", " ", "é"]


def test_escapes_are_reversible_and_leave_no_control_string():
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choices(PIECES, k=draw.randint(0, 14)))
        role = draw.choice(["user", "assistant", "system", "tool<|text|>", ""])
        escaped = INSTRUCT.escape(text)
        assert not any(c in escaped for c in INSTRUCT.controls) and INSTRUCT.unescape(escaped) == text
        whole = "".join(t for t, _ in INSTRUCT.segments(role, text, True) + INSTRUCT.segments("assistant", text, False))
        assert INSTRUCT.read(whole) == ([(role, text, role == "assistant"), ("assistant", text, True)], "")
        assert INSTRUCT.read(whole[:-1])[0] == [(role, text, role == "assistant")]


def test_template_without_start_and_bad_controls():
    t = ChatTemplate("", {"user": RoleForm("<u>", "</u>")}, RoleForm("<r>{role}:", "</r>"), {"": ("user",)}, ("<u>", "</u>", "<r>", "</r>"))
    assert t.read("<u>a</u><r>x:b</r>")[0] == [("user", "a", False), ("x", "b", False)]
    with pytest.raises(ValueError):
        ChatTemplate("", {}, RoleForm("", ""), {}, ("a\\b",))


def test_conversations_read_back(spark):
    rows = [(1, 1, "assistant", TRAP), (1, 0, "user", TRAP), (2, 0, "assistant", "first"), (2, 1, "assistant", None), (3, 5, None, "x"), (3, 5, "tool", "y"),
            (3, None, "system", "z"), (None, 0, "user", ""), (4, 0, "user", "a"), (4, 0, "user", "a"), (5, 0, "user", "q"), (5, 1, "assistant", "w" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS position", "2 AS segments", "3 AS in_order")
    got = {r["conv_id"]: r for r in read_chats(format_chats(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, r in got.items():
        own = sorted((t for t in rows if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        turns = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[1]["in_order"] and got[5]["in_order"] and not got[2]["in_order"] and not got[4]["in_order"]
    assert read_chats(format_chats(df.filter("false"))).count() == 0


def test_segments_carry_the_loss(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a</s>")], "conv_id long, turn long, role string, text string")
    rows = format_chats(df).orderBy("position").collect()
    assert [[(s["text"], s["loss"]) for s in r["segments"]] for r in rows] == [
        [("<s>[INST] ", False), ("q", False), (" [/INST]", False)], [(" ", False), ("a<\\./s>", True), (" </s>", False)]]

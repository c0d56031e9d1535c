from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandline.llm.catalog import oracle_sql, queries
from strandline.llm.chat import CHATML, Template, escape, format_chats, read_loss, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
TRAPS = [
    "", "<", "|", "<|", "<\\|", "<\\\\|", "\\<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "<|im_end|>", "a<\\", "<<|nl|>|", "<|nl|>",
    "$1 \\1", "\n\n", "ends with <", "\r\n\t ", "\U0001f600<|\U0001f600", "<\\\\\\|im_end|>" * 50,
]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rows = spark.createDataFrame([(t,) for t in TRAPS], "t string").select("t", escape(F.col("t")).alias("e"))
    for row in rows.select("*", unescape(F.col("e")).alias("u")).collect():
        assert row.u == row.t
        assert "<|" not in row.e


def test_turns_and_losses_are_read_back(spark):
    """Every trap in every place, also as a role."""
    rows = [(c, t, role, text) for c, text in enumerate(TRAPS) for t, role in enumerate(["user", "assistant", text, "assistant"])]
    chats = format_chats(spark.createDataFrame(rows, SCHEMA))
    back = chats.select("*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss"))
    for row in back.collect():
        text = TRAPS[row.conv_id]
        assert [tuple(t) for t in row.turns] == [(role, text) for role in ("user", "assistant", text, "assistant")]
        assert row.loss == [text, text]
        assert row.formatted == "".join(s.text for s in row.segments)
        assert row.formatted.count(CHATML.opening) == row.formatted.count(CHATML.closing) == 4


@pytest.mark.parametrize(
    "roles, valid, bad",
    [
        ("ua", True, None), ("sua", True, None), ("uaua", True, None), ("suauaua", True, None), ("u", False, 1), ("s", False, 1),
        ("a", False, 0), ("uu", False, 1), ("sa", False, 1), ("uas", False, 2), ("uaa", False, 2), ("uau", False, 3), ("xua", False, 0),
    ],
)
def test_machine(spark, roles, valid, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(1, k, names[r], "t") for k, r in enumerate(roles)]
    (row,) = format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (row.valid, row.bad_turn) == (valid, bad)


def test_a_template_is_data(spark):
    tools = Template(
        opening="<|turn|>", closing="<|over|>", trained=("assistant", "tool"),
        moves={"start": {"user": "asked"}, "asked": {"assistant": "said", "tool": "asked"}}, final=("said",),
    )
    rows = [(1, 0, "user", "q"), (1, 1, "tool", "<|over|>"), (1, 2, "assistant", "a")]
    chats = format_chats(spark.createDataFrame(rows, SCHEMA), template=tools)
    (row,) = chats.select("*", read_turns(F.col("formatted"), tools).alias("turns"), read_loss(F.col("segments")).alias("loss")).collect()
    assert row.formatted == "<|turn|>user\nq<|over|><|turn|>tool\n<\\|over|><|over|><|turn|>assistant\na<|over|>"
    assert row.valid and row.loss == ["<|over|>", "a"] and row.turns[1].text == "<|over|>"
    with pytest.raises(ValueError):
        Template(opening="[turn]")


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 2, "user", None), (1, None, None, "x"), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"), (None, 0, "user", "n")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'z' AS formatted", "1 AS valid", "2 AS SEGMENTS")
    chats = format_chats(frame.repartition(3)).select("conv_id", read_turns(F.col("formatted")).alias("turns"), "valid")
    found = {row.conv_id: [tuple(t) for t in row.turns] for row in chats.collect()}
    assert found == {1: [("", "x"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b"), ("user", "")], None: [("user", "n")]}
    assert format_chats(frame.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "<|im_end|> word " * 200_000
    chats = format_chats(spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], SCHEMA))
    (row,) = chats.select(read_turns(F.col("formatted"))[1]["text"].alias("t"), read_loss(F.col("segments"))[0].alias("l")).collect()
    assert row.t == row.l == text


def test_query_against_sql_and_plan(spark, tiny):
    from oracle_check import compare, connect

    query = queries()["op12_chat"](spark, tiny)
    assert compare(query, connect(tiny), oracle_sql()["op12_chat"]) is None
    plan = query._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))

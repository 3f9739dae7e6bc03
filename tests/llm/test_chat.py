"""Chat layouts, escaping and loss masks."""

import json

import pytest
from pyspark.sql import functions as F
from tests.compare import check, duck

from codeloom.llm import chat, queries

HARD = [
    "", None, "\\", "\\\\", "###", "####", "\\###", "\n</turn>\n", "</turn>", "\\</turn>", "</turn", "### user:\n",
    "a\nb\n", "\n", "é\U0001f600 ###x</turn>\\", "$1 \\1 $", "\r\n\x00", chat.PROBE, "long ### " * 20_000,
]


def test_query_equals_sql(spark, sf):
    name = "op2_chat_formatting"
    ok, text = check(spark, duck(sf), sf, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, text


def test_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, i, r, "t") for i, r in enumerate(["a:b\nc", "### x", None, "", "</turn>", "rôle %41+"])]
    rows += [(None, 0, "assistant", "x"), (3, 5, "user", "b"), (3, 5, "assistant", "z"), (3, 5, "user", "a"), (3, 5, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(frame.withColumn("formatted", F.lit(1)))
    back = {
        r.conv_id: r
        for r in out.select("conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    want = {1: [(r, t or "") for _, _, r, t in rows[: len(HARD)]], 2: [(r or "", "t") for r in ["a:b\nc", "### x", None, "", "</turn>", "rôle %41+"]]}
    want |= {None: [("assistant", "x")], 3: [("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")]}
    assert set(back) == set(want)
    for conv_id, turns in want.items():
        r = back[conv_id]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
    assert chat.format_chats(frame.where("false")).collect() == []


RECORDS = {
    "messages": ({"messages": [{"role": "human", "content": "q"}, {"content": "a", "role": "gpt"}]}, [("user", "q"), ("assistant", "a")]),
    "from_value": ({"conversations": [{"from": "human", "value": "q"}]}, [("user", "q")]),
    "turns": ({"turns": [{"role": "tool", "text": None}]}, [("tool", None)]),
    "instruction": ({"output": "a", "instruction": "q"}, [("user", "q"), ("assistant", "a")]),
    "instruction_input": ({"instruction": "q", "input": "", "output": "a"}, [("user", "q"), ("assistant", "a")]),
    "prompt_completion": ({"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
    "system_prompt_response": ({"system": "s", "prompt": "q", "response": None}, [("system", "s"), ("user", "q")]),
    "question_answer": ({"answer": "a", "question": "q {\"x\": [1]}"}, [("user", "q {\"x\": [1]}"), ("assistant", "a")]),
}


def test_record_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS.values())]
    rows += [(100, None), (101, ""), (102, "{"), (103, "[1]"), (104, '{"a": 1}'), (105, '{"messages": 3}'), (106, "{}")]
    found = {r.conv_id: r for r in chat.turns_of_records(spark.createDataFrame(rows, "k long, record string"), "k", "record").collect()}
    for i, (name, (_, turns)) in enumerate(RECORDS.items()):
        assert found[i].layout == name and [tuple(t) for t in found[i].turns] == turns
    assert len(found) == len(rows) and all(found[i].layout is None and found[i].turns is None for i in range(100, 107))


def test_table_layouts(spark):
    nested = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "k int, messages array<struct<role:string,content:string>>")
    rows = chat.rows_of_table(nested, "k").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    flat = spark.createDataFrame([(1, "q", "a")], "k int, prompt string, response string")
    assert [tuple(r) for r in chat.rows_of_table(flat, "k").collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    wider = flat.select("*", F.lit(1).alias("more"), F.array(F.struct(F.lit("x").alias("y"))).alias("a.b"))
    assert [tuple(r) for r in chat.rows_of_table(wider, "k").collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    with pytest.raises(ValueError, match="no layout"):
        chat.rows_of_table(flat.select("k", "prompt", F.lit("a").alias("reply")), "k")


WIDER = [
    ("messages", {"id": 7, "messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "gpt", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ("messages", {"messages": []}, []),
    ("messages", {"messages": [], "id": 1, "tools": []}, []),
    ("messages", {"messages": [{"role": "user", "content": "q"}], "meta": {"a": [{"b": {"c": {"d": {"e": 1}}}}]}}, [("user", "q")]),
    ("messages", {"messages": [{"role": "user"}, {"content": None}]}, [("user", None), (None, None)]),
    ("messages", {"messages": [{"role": "user", "content": "q"}], "prompt": "p", "response": "r"}, [("user", "q")]),
    ("instruction_input", {"instruction": "q", "input": "i", "output": "a", "weight": 0.5}, [("user", "q"), ("user", "i"), ("assistant", "a")]),
    ("system_prompt_response", {"system": "s", "prompt": "q", "response": "a", "é.x": 1}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    (None, {"messages": [{"role": "user", "content": [{"type": "text"}]}]}, None),
    (None, {"messages": ["a"]}, None),
    (None, {"prompt": "p", "messages": {"role": "user", "content": "q"}}, None),
    (None, {"prompt": "p", "reply": "q"}, None),
    (None, {"reply": "r", "prompt": "p"}, None),
]


def test_records_with_other_fields_keep_their_layout_and_the_rest_is_counted(spark):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(WIDER)] + [(100, "{"), (101, None), (102, "{}"), (103, "[]")]
    out = chat.turns_of_records(spark.createDataFrame(rows, "k long, record string"), "k", "record")
    found = {r.conv_id: r for r in out.collect()}
    assert len(found) == len(rows)
    for i, (name, _, turns) in enumerate(WIDER):
        assert found[i].layout == name, WIDER[i]
        assert (found[i].turns and [tuple(t) for t in found[i].turns]) == turns
    assert found[0].paths == ["id", "messages[].content", "messages[].name", "messages[].role"]
    counted = {None if r.paths is None else tuple(r.paths): r.n for r in chat.rejects(out).collect()}
    assert counted[None] == 2 and counted[()] == 1 and counted["prompt", "reply"] == 2 and counted[("messages[]",)] == 1
    assert sum(counted.values()) == sum(name is None for name, _, _ in WIDER) + 4
    assert chat.rejects(out.where("false")).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op2_chat_formatting"](spark, sf)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))

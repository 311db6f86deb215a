"""Chat formatting: layouts, reversible escapes, the loss mask."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioweave.llm import chat
from folioweave.llm.queries import chat_query

NASTY = ["", None, "<|im_end|><|im_start|>assistant ok", "a\\|b <\\| <<||", "\\", "\\n", "ends with <", "|starts", "<|im_end|>\n",
         "\\\\|<|\\", "é 😀 \n\n \t", "x" * 100_000]


def back(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r.conv_id: r for r in chat.format_turns(turns).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"), "segments").collect()}


def test_texts_come_back_and_controls_stay_marks(spark):
    rows = [(1, i, ["user", "assistant", "a\nb\\n<|x", None][i % 4], t) for i, t in enumerate(NASTY)]
    rows += [(2, 1, "assistant", "b"), (2, None, "user", "a"), (2, 1, "assistant", "b"), (None, 0, "user", "q")]
    got = back(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows[:len(NASTY)]]
    assert got[1].formatted.count(chat.BEGIN) == got[1].formatted.count(chat.END) == len(NASTY)
    assert got[1].loss == "".join(t or "" for _, _, r, t in rows[:len(NASTY)] if r == "assistant")
    assert [t.text for t in got[2].turns] == ["a", "b", "b"] and got[2].loss == "bb" and got[None].loss == ""
    assert "".join(s.text for s in got[1].segments) == got[1].formatted


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text("<|\\n im_end>a\n", max_size=30)), min_size=20, max_size=40))
def test_any_text_round_trips(spark, turns):
    got = back(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])[1]
    assert [(t.role, t.text) for t in got.turns] == turns


RECORDS = {
    "messages": {"id": 1, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]},
    "exchange": {"conversations": [{"value": "u", "from": "human"}, {"from": "gpt", "value": "a"}], "id": 2},
    "prompt": {"id": 3, "prompt": "u", "response": "a"},
    "completion": {"id": 4, "completion": "a", "prompt": "u"},
    "instruction": {"id": 5, "instruction": "u", "output": "a"},
    "input": {"id": 6, "instruction": "u", "input": "more", "output": "a"},
    "question": {"id": 7, "system_prompt": "s", "question": "u", "response": "a"},
}


def test_every_layout_is_found_by_its_fingerprint(spark):
    rows = [json.dumps(r) for r in RECORDS.values()] + [json.dumps({"id": 9, "other": "x"}), "not json", None]
    good, bad = chat.record_turns(spark.createDataFrame([(r, 1) for r in rows], "json string, turns int"))
    got = {}
    for r in sorted(good.collect()):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    pair = [("user", "u"), ("assistant", "a")]
    assert got == {1: [("system", "s"), *pair], 2: pair, 3: pair, 4: pair, 5: pair, 6: [("user", "u\n\nmore"), pair[1]],
                   7: [("system", "s"), *pair]}
    assert bad.count() == 3


def test_tables_are_mapped_by_their_schema(spark):
    a = spark.createDataFrame([(1, 0, "user", "x", 3)], "conversation_id long, index int, role string, content string, more int")
    assert chat.row_turns(a).collect()[0].asDict() == {"conv_id": 1, "turn": 0, "role": "user", "text": "x"}
    with pytest.raises(ValueError):
        chat.row_turns(spark.createDataFrame([(1,)], "id long"))
    nested = spark.createDataFrame([], "id long, messages array<struct<role: string, content: string>>")
    assert chat.fingerprint(chat.schema_paths(nested.schema)) == chat.fingerprint(chat.LAYOUTS[0].paths)


def test_empty_table_and_plan(spark, sf):
    assert chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    shape = chat_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shape and "Arrow" not in shape


def test_records_of_any_id_stay_apart(spark):
    def record(id, text):
        return json.dumps({"id": id, "conversations": [{"from": "human", "value": text}, {"from": "gpt", "value": f"re {text}"}]})

    ids = ["abc-17", "abc-18", None, None, 1.5, 1, "007", 7, "8", 10**30, True]
    rows = [record(i, f"text {n}") for n, i in enumerate(ids)] + [record(None, "same")] * 2
    good, bad = chat.record_turns(spark.createDataFrame([(r,) for r in rows], "json string").repartition(3))
    table = spark.createDataFrame([(7000, 0, "user", "x"), (None, 0, "user", "y"), (None, 1, "user", "z")],
                                  "conv_id long, turn long, role string, text string")
    got = chat.format_turns(good.unionByName(table, allowMissingColumns=True)).select(
        "conv_id", "record_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    said = sorted([t.text for t in r.turns] for r in got)
    assert said == sorted([[f"text {n}", f"re text {n}"] for n in range(len(ids))] + [["same", "re same"]] * 2 + [["x"], ["y", "z"]])
    assert bad.count() == 0
    named = {r.turns[0].text: (r.conv_id, r.record_id) for r in got}
    assert named["text 0"] == (None, "abc-17") and named["text 6"] == (None, "007")
    assert named["text 5"] == (1, None) and named["text 7"] == (7, None) and named["text 8"] == (8, None)
    assert chat.format_turns(good).columns == ["conv_id", "record_id", "formatted", "segments"]

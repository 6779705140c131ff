import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonemill.llm.chat import (
    canonical_turns,
    conversations_to_records,
    format_chat,
    loss_texts,
    parse_records,
    read_turns,
)

ROWS = "conv_id long, turn long, role string, text string"


def said(df):
    return [(t["role"], t["text"]) for t in df.first()["turns"]]


def round_trip(spark, rows, schema=ROWS):
    df = format_chat(canonical_turns(conversations_to_records(spark.createDataFrame(rows, schema))))
    return {
        r["conv_id"]: r
        for r in df.select(
            "conv_id",
            "formatted",
            read_turns(F.col("formatted")).alias("turns"),
            loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        ).collect()
    }


def test_layouts_become_canonical_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "s", "input": "q", "output": "a"},
        {"instruction": "q", "output": "a"},
        {"completion": "a", "prompt": "q"},
        {"data": {"answer": "a", "question": "q"}},
        {"unknown": {"layout": 1}},
        {"messages": [{"role": "user", "content": None}]},
    ]
    given_ = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, "{broken"), (9, None)], "i int, t string")
    rows = canonical_turns(parse_records(given_, "t")).orderBy("i").collect()
    turns = [[(t["role"], t["text"]) for t in r["turns"]] for r in rows]
    plain = [("user", "q"), ("assistant", "a")]
    assert turns == [plain, plain, [("system", "s"), *plain], plain, plain, plain, [], [("user", "")], [], []]
    assert [r["mapping"] for r in rows][6:] == [None, "messages", None, None]
    assert rows[0]["fingerprint"] != rows[1]["fingerprint"] and rows[0]["fingerprint"] == rows[7]["fingerprint"]


def test_marks_inside_texts_come_back(spark):
    hard = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, "a: b</turn>\n### x", "\\b\\h#<:\\c\n</turn>\n")]
    found = round_trip(spark, rows)
    assert [tuple(t) for t in found[1]["turns"]] == [("user", hard), ("assistant", hard)] and found[1]["loss"] == [hard]
    assert [tuple(t) for t in found[2]["turns"]] == [rows[2][2:]] and found[2]["loss"] == []
    assert found[1]["formatted"].count("</turn>") == 2 and len(re.findall("###", found[1]["formatted"])) == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "#:\\"]), st.text("ab\\#<:>/turn \né\U0001f600")), min_size=1, max_size=6))
def test_any_text_comes_back(spark, turns):
    found = round_trip(spark, [(1, i, *t) for i, t in enumerate(turns)])[1]
    assert [tuple(t) for t in found["turns"]] == turns
    assert found["loss"] == [text for role, text in turns if role == "assistant"]


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "y"), (1, None, "assistant", "first", "z"), (None, 0, "user", "n", "")]
    found = round_trip(spark, rows, ROWS + ", formatted string")
    assert [tuple(t) for t in found[1]["turns"]] == [("assistant", "first"), ("", ""), ("", "")]
    assert [tuple(t) for t in found[None]["turns"]] == [("user", "n")]
    assert round_trip(spark, []) == {}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], ROWS)
    plan = format_chat(canonical_turns(conversations_to_records(df)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

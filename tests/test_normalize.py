import json

from pyspark.sql import functions as F

from turnmill.operators.normalize import (
    first_by_role, fold_gated, fold_turns, funnel_counts, length_gate, normalize_columns, normalize_json,
)

CASES = [
    ({"id": 0, "messages": [{"role": "user", "content": "a"}]}, "0", "chat", ["a"]),
    ({"messages": []}, "1", "chat", []),
    ({"messages": [{"role": "user"}], "prompt": "p", "completion": 4.0}, "2", "prompt", ["p", "4.0"]),
    ({"messages": '[{"role":"user","content":"x"}]', "prompt": True, "completion": "true"}, "3", "prompt", ["True", "true"]),
    ({"id": "", "doc_id": "d", "prompt": None, "completion": "c", "text": "t"}, "d", None, None),
    ({"id": None, "instruction": "i", "input": "", "output": "o"}, "5", "instruction", ["i", "o"]),
    ({"instruction": "i", "input": "x", "output": 12345678901234567890}, "6", "instruction", ["i\n\nx", "12345678901234567890"]),
    ({"instruction": "i", "input": 0, "output": False}, "7", "instruction", ["i", "False"]),
    ({"Context": "c", "Response": "r", "response": "no"}, "8", "qa", ["c", "r"]),
    ({"question": "q", "text": "t"}, "9", "text", ["t"]),
    ({"query": "q", "output_text": [1, 2], "text": "t"}, "10", "qa", ["q", "[1,2]"]),
    ({"other": 1}, "11", None, None),
    ([1, 2], "12", None, None),
    ({"text": "😀"}, "13", "text", ["😀"]),
]


def test_layouts(spark):
    rows = [(json.dumps(c[0]), i) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "raw string, _ordinal long")
    got = {r["_ordinal"]: r for r in normalize_json(df).collect()}
    for i, (_, key, shape, contents) in enumerate(CASES):
        found = got[i]["messages"] and [m["content"] for m in got[i]["messages"]]
        assert (got[i]["id"], got[i]["shape"], found if shape else None) == (key, shape, contents), i


def test_columns(spark):
    df = spark.createDataFrame([("q1", "a1", 0)], "question string, answer string, _ordinal long")
    row = normalize_columns(df).first()
    assert (row["id"], row["shape"], [tuple(m) for m in row["messages"]]) == (
        "0", "qa", [("user", "q1"), ("assistant", "a1")]
    )


def test_gate_bounds_and_alarm(spark):
    rows = [(n, "x" * n) for n in (39, 40, 32768, 32769)]
    df = spark.createDataFrame(rows, "_ordinal long, text string")
    routed = length_gate(normalize_columns(df))
    assert {r["n_chars"]: r["route"] for r in routed.collect()} == {
        39: "short", 40: "kept", 32768: "kept", 32769: "long"
    }
    none = length_gate(normalize_columns(df.select("_ordinal", F.col("text").alias("other"))))
    row = funnel_counts(none).first()
    assert (row["total"], row["dropped_schema"], row["high_schema_drop"]) == (4, 4, True)


def test_large_conversations_keep_their_turns(spark):
    rows = [(1, t, "user", "y" * 200) for t in range(300)] + [(2, 1, "user", "b"), (2, 0, "system", "a")]
    rows += [(None, t, "user", "z" * 60) for t in range(12)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in fold_turns(df).collect()}
    assert len(got[1]["messages"]) == 300 and got[1]["n_chars"] == 60_000
    assert [m["content"] for m in got[2]["messages"]] == ["a", "b"] and len(got[None]["messages"]) == 12
    gated = {r["conv_id"]: r for r in fold_gated(df, min_chars=2, max_chars=719).collect()}
    assert {k: (r["route"], r["n_turns"]) for k, r in gated.items()} == {1: ("long", 300), 2: ("kept", 2), None: ("long", 12)}
    assert gated[1]["messages"] is None and len(gated[2]["messages"]) == 2
    firsts = {r["conv_id"]: (r["u"], r["s"]) for r in first_by_role(df, {"user": "u", "system": "s"}).collect()}
    assert firsts == {1: ("y" * 200, None), 2: ("b", "a"), None: ("z" * 60, None)}

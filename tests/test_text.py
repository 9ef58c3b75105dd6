import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from turnmill.functions import chat, pii, text as tx
from turnmill.functions.parsing import clean_variants, parse_scores, parse_verdict


def test_round_half_even_is_python_round(spark):
    rng = random.Random(1)
    values = [2.675, 0.0005, 0.0625, 1.0005, -2.675, -0.5, 0.5, 1.5, 2.5, 0.0, 85.05, 1 / 3]
    values += [rng.uniform(-1000, 1000) for _ in range(2000)]
    values += [k / 1000 + 0.0005 for k in range(2000)] + [k / 16 for k in range(500)]
    for digits in (1, 3, 4):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = [r[0] for r in df.select(tx.round_half_even(F.col("x"), digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_strip_is_python_strip(spark):
    cases = ["  a b\t\x1c", "　 x\x85", "", " \n ", "plain"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    assert [r[0] for r in df.select(tx.strip(F.col("x"))).collect()] == [c.strip() for c in cases]


def python_scrub(text):
    for label, pattern in pii.SCRUB_PATTERNS:
        text = re.sub(pattern, f"[{label}_REDACTED]", text)
    for pattern in pii.NAME_PATTERNS:
        text = re.sub(pattern, "[NAME_REDACTED]", text)
    return text


def test_scrub_golden(spark):
    cases = [
        "mail a.b+c@ex-ample.co.uk now", "call +1 (743) 555-3824 or 743.555.3824x", "123-45-6789",
        "4785380592391139", "1234 5678 9012 3456 789", "10.0.0.255 and 1.2.3", "see https://a.b/c?d=\"e\"",
        "Dear Anna, Mr. John Smith and Dr  Who", "éDr. Foo", "Hello anna", "ｈttp http://é.x/ü",
        "١٢٣-٤٥-٦٧٨٩", "a@b.c x@y.zz", "",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r[0] for r in df.select(pii.scrub(F.col("x"))).collect()]
    assert got == [python_scrub(c) for c in cases]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZé1234567890 -.@+()/:ht \n", max_size=60), min_size=1, max_size=30))
def test_scrub_property(spark, cases):
    df = spark.createDataFrame([(c,) for c in cases], "x string").repartition(3)
    got = {r[0]: r[1] for r in df.select("x", pii.scrub(F.col("x"))).collect()}
    assert got == {c: python_scrub(c) for c in cases}


def test_redact(spark):
    cases = {
        "card 4785380592391139 ok": "card [CREDIT_CARD] ok",
        "ssn 123-45-6789, MRN: 0012345": "ssn [SSN], [MRN]",
        "DOB 1980-01-02 at 12 Long Oak Street": "[DATE_OF_BIRTH] at [ADDRESS]",
        "Account number: AB-12345 from 10.1.2.3": "[ACCOUNT] from [IP]",
        "+1 (743) 555-3824 a@b.co https://x.y": "[PHONE] [EMAIL] [URL]",
        "  ": "  ",
    }
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    assert [r[0] for r in df.select(pii.redact(F.col("x"))).collect()] == list(cases.values())
    turns = spark.createDataFrame([([("system", "a@b.co"), ("user", "a@b.co"), ("tool", "a@b.co")],)], "m array<struct<role:string,content:string>>")
    out = turns.select(pii.redact_messages(F.col("m"))).first()[0]
    assert [t["content"] for t in out] == ["a@b.co", "[EMAIL]", "a@b.co"]


def test_parse_scores_edges(spark):
    cases = [
        ('{"overall": 4}', 4, False), ('ok {"overall": "4"} bye', 4, False), ('{"overall": 4.7}', 4, False),
        ('{"overall": -1.5}', -1, False), ('{"overall": 9}', 9, False), ('{"clarity": 1}', 3, False),
        ('{"overall": "high"}', 3, True), ('{"overall": null}', 3, True), ('[{"overall": 5}]', 3, True),
        ("", 3, True), ('{"overall": 2, "x": {"y": 1}} and } more', 3, True), ('x {"overall": 2, "x": {"y": 1}} y', 2, False),
        ('{"overall": 1}{"overall": 5}', 3, True), ('{"overall": 5} trailing', 5, False), (None, 3, False),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, response string")
    got = {r["i"]: r["_quality"] for r in parse_scores(df).collect()}
    assert [(got[i]["overall"], got[i]["parse_failed"]) for i in range(len(cases))] == [c[1:] for c in cases]


def test_parse_verdict_edges(spark):
    cases = [
        ('{"winner": "A", "reason": "r"}', "a", "r"), ('so {"winner": "b"} ok', "b", ""),
        ('{"winner": null}', "tie", ""), ("TIE", "tie", "unparseable"),
        ('x {"winner": "A", "n": {"k": 1}} y', "tie", "unparseable"), ('{"winner": "A", "n": {"k": 1}}', "a", ""),
        ('["A"]', "tie", "unparseable"), ("", "tie", "unparseable"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, response string")
    got = {r["i"]: (r["verdict"], r["judge_reason"]) for r in parse_verdict(df).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1:] for c in cases]


def test_long_runs_do_not_exhaust_the_stack(spark):
    long = ["-" * 100_000, "1) " * 50_000 + "x", "4 " * 300_000, "a@" * 300_000, "1.2." * 200_000, "Dr " * 200_000, "{" * 300_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(long)], "id long, response string")
    got = [r["v"] for r in df.orderBy("id").select(clean_variants(F.col("response"), 2).alias("v")).collect()]
    assert got[0] == [] and got[1] == ["x"]
    assert df.select(pii.scrub(F.col("response")), pii.redact(F.col("response"))).collect()
    assert parse_scores(df).count() == parse_verdict(df).count() == len(long)


def test_clean_variants(spark):
    raw = "1. one\n\n 2) - two \r\n...\n- 3 \n   four\n5"
    df = spark.createDataFrame([(raw,)], "x string")
    assert df.select(clean_variants(F.col("x"), 5)).first()[0] == ["one", "two", "four"]
    assert df.select(clean_variants(F.col("x"), 1)).first()[0] == ["one"]


def test_chat_views(spark):
    df = spark.createDataFrame(
        [([("user", " hi "), ("assistant", "yo"), ("user", "x")],)], "m array<struct<role:string,content:string>>"
    )
    m = F.col("m")
    row = df.select(
        chat.render_chat(m, chat.LLAMA3), chat.render_prompt(m), chat.review_text(m), chat.row_text(m),
        chat.first_content(m, "assistant"), chat.first_content(m, "system"),
    ).first()
    assert row[0] == (
        "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\nyo<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nx<|eot_id|>"
    )
    assert row[1] == "<|im_start|>user\n hi <|im_end|>\n<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\n"
    assert row[2] == "[USER]\n hi \n\n[ASSISTANT]\nyo\n\n[USER]\nx"
    assert row[3] == " hi  \n yo \n x" and row[4] == "yo" and row[5] is None
    with_system = chat.ChatTemplate("<{role}>", "</>", default_system="S")
    assert df.select(chat.render_chat(m, with_system)).first()[0].startswith("<system>S</>")


def test_field_template_is_single_pass(spark):
    df = spark.createDataFrame([("{b}", None, 3)], "a string, b string, n int")
    cols = {c: F.col(c) for c in df.columns}
    assert df.select(chat.field_template("{a}|{b}|{n}|{zz}{ a }", cols)).first()[0] == "{b}||3|{ a }"


def test_rules_that_need_a_digit_wait_for_one(spark):
    texts = [
        "no digits, Mr Foo Bar at http://x.example and a@b.example", "MRN: A1234 born on 1/2/1990 Account No. 12345",
        "4111 1111 1111 1111 or 123-45-6789", "12 Oak Street at 10.0.0.1 or 555-123-4567", "٣٣٣٣ ٤٤٤٤ ٥٥٥٥ ٦٦٦٦", "", None,
    ]
    numbered = [p for _, p in pii.REDACT_RULES[pii._NUMBERED]]
    assert len(numbered) == 8 and all(r"\d" in p for p in numbered)
    rules = [(p, f"[{tag}]") for tag, p in pii.REDACT_RULES]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(pii.redact(F.col("t")).alias("a"), pii._replace_all(F.col("t"), rules, pii._REDACT_NEEDS).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    assert got[0]["a"] == "no digits, [NAME] at [URL] and [EMAIL]"

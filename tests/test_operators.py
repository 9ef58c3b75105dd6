import random

import pytest
from pyspark.sql import functions as F

from turnmill.functions.chat import row_text
from turnmill.operators import augment, judge, packing, perf, quality, sampling, scoring
from turnmill.operators.model_apply import apply_model, redact_with_model
from turnmill.operators.ordering import kth_key, running_sum, seeded_key
from turnmill.operators.skew import skew_join


def ids(spark, n):
    return spark.range(n).withColumn("text", F.repeat(F.lit("x"), (F.col("id") * 37 % 900 + 1).cast("int")))


@pytest.mark.parametrize("small", [1, 50, 100_000])
def test_kth_key(spark, small):
    df = ids(spark, 1000).withColumn("k", seeded_key(1, F.col("id")))
    keys = sorted((r["k"], r["id"]) for r in df.collect())
    for k in (1, 7, 500, 1000):
        assert kth_key(df, "k", "id", k, small) == keys[k - 1]
    assert kth_key(df, "k", "id", 0) is None


def test_kth_key_with_equal_keys(spark):
    df = spark.range(300).withColumn("k", F.lit(5).cast("long"))
    assert kth_key(df, "k", "id", 120, 10) == (5, 119)


@pytest.mark.parametrize("n,ratio", [(1, 0.05), (10, 0.05), (999, 0.1), (40, 0.99)])
def test_split_is_exact_disjoint_and_stable(spark, n, ratio):
    df = ids(spark, n)
    got = {r["id"]: r["split"] for r in sampling.train_eval_split(df.repartition(7), ratio).collect()}
    again = {r["id"]: r["split"] for r in sampling.train_eval_split(df.coalesce(1), ratio).collect()}
    assert got == again and len(got) == n
    assert sum(s == "eval" for s in got.values()) == max(1, int(n * ratio))


def test_sample_by_cut_equals_top_k(spark, monkeypatch):
    df = ids(spark, 500)
    top = {r["id"] for r in sampling.seeded_sample(df, 60).collect()}
    monkeypatch.setattr(sampling, "_TOP_K", 10)
    assert {r["id"] for r in sampling.seeded_sample(df, 60).collect()} == top
    assert sampling.seeded_sample(df, 9999).count() == 500


@pytest.mark.parametrize("partitions", ["1", "4", "40"])
def test_packs(spark, ws, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = packing.pack_sequences(ids(spark, 400), ws, max_tokens=64).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    packs, tokens = {}, {}
    for r in rows:
        packs[r["pack"]] = packs.get(r["pack"], 0) + r["n_tokens"]
        tokens[r["id"]] = tokens.get(r["id"], 0) + r["n_tokens"]
    assert tokens == {i: -(-(i * 37 % 900 + 1) // 4) for i in range(400)}
    assert sorted(packs) == list(range(len(packs))) and all(n == 64 for p, n in packs.items() if p < len(packs) - 1)
    # A row's fragments follow each other from its first token on.
    by_row = {}
    for r in sorted(rows, key=lambda r: r["pack"]):
        assert r["from_token"] == by_row.get(r["id"], 0)
        by_row[r["id"]] = r["from_token"] + r["n_tokens"]


@pytest.mark.parametrize("partitions", ["1", "5", "64"])
def test_running_sums_are_those_of_one_scan(spark, ws, partitions):
    rng = random.Random(3)
    rows = [(i, rng.randrange(0, 1 << 40), "x") for i in range(500)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "k long, w long, _n string").repartition(7)
        got = {r["k"]: (r["upto"], r["_n"]) for r in running_sum(df, ["k"], "w", "upto", ws).collect()}
        assert running_sum(df.limit(0), ["k"], "w", "upto", ws).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    total = 0
    for k, w, _ in sorted(rows):
        total += w
        assert got[k] == (total, "x")


def reference_percentile(values, q):
    ordered = sorted(values)
    return ordered[min(int(q * len(ordered)), len(ordered) - 1)]


def test_percentiles_are_exact(spark):
    rng = random.Random(4)
    rows = [("tiny", float(v)) for v in range(1, 11)] + [("one", 3.5)]
    rows += [("big", rng.lognormvariate(3, 2)) for _ in range(30_000)]
    rows += [("ties", 7.0) for _ in range(20_000)] + [("ties", rng.random() * 14) for _ in range(9_000)]
    rows += [("nulls", None), ("nulls", 1.0)]
    df = spark.createDataFrame(rows, "model string, v double").repartition(6)
    qs = (0.0, 0.5, 0.95, 0.99, 1.0)
    got = {(r["model"], r["q"]): r["value"] for r in perf.latency_percentiles(df, ["model"], "v", qs).collect()}
    for model in ("tiny", "one", "big", "ties", "nulls"):
        values = [v for m, v in rows if m == model and v is not None]
        for q in qs:
            assert got[model, q] == reference_percentile(values, q), (model, q)
    assert got["tiny", 0.5] == 6.0


def test_request_summary_skips_errors(spark):
    rows = [("m", 10.0, 100.0, 5, None), ("m", None, 300.0, 0, None), ("m", 1.0, 9.0, 9, "HTTP 500"), ("bad", 1.0, 1.0, 1, "x")]
    log = spark.createDataFrame(rows, "model string, ttft_ms double, total_ms double, output_tokens long, error string")
    r = perf.request_summary(log).collect()
    assert len(r) == 1
    assert (r[0]["requests"], r[0]["latency_mean"], r[0]["throughput_mean"], r[0]["ttft_p50"], r[0]["latency_p99"]) == (
        2, 200.0, 50.0, 10.0, 300.0
    )


def test_cost_example(spark):
    speed = spark.createDataFrame([("m", 85.0)], "model string, tok_per_s double")
    rows = perf.cost_comparison(speed).collect()
    assert rows[0]["provider"] == "anthropic_sonnet_4.6" and rows[0]["self_hosted_per_1m"] == 0.1634
    assert [r["provider"] for r in rows][-2:] == ["together_llama_8b", "fireworks_llama_8b"]
    zero = spark.createDataFrame([("m", 0.0)], "model string, tok_per_s double")
    with pytest.raises(Exception, match="throughput must be positive"):
        perf.cost_comparison(zero).collect()


def test_win_rates_on_nothing(spark):
    row = judge.win_rates(spark.createDataFrame([], "judge_winner string")).first()
    assert row["total"] == 0 and row["finetune_win_rate"] is None and row["interpretation"] is None


def test_unblind_maps_letters_back(spark):
    pairs = spark.createDataFrame([(i, "p", "base", "fine") for i in range(40)], "id long, prompt string, base_output string, finetune_output string")
    blind = judge.blind_pairs(pairs)
    answers = blind.select("id", F.lit('{"winner": "A"}').alias("response"))
    out = judge.unblind(blind, answers).collect()
    assert {(r["swapped"], r["judge_winner"]) for r in out} == {(True, "finetune"), (False, "base")}
    assert not judge.blind_pairs(pairs, swap=0).filter("swapped").count()
    with pytest.raises(ValueError, match="not unique"):
        judge.assert_unique(pairs.unionByName(pairs), "id")


def test_quality_defaults_and_histogram(spark):
    rows = spark.createDataFrame([(str(i),) for i in range(4)], "id string")
    answers = spark.createDataFrame(
        [("0", '{"overall": 9}', None), ("1", '{"overall": 0}', None), ("2", None, "timeout")],
        "id string, response string, error string",
    )
    scored = quality.attach_scores(rows, answers)
    got = {r["id"]: (r["_quality"]["overall"], r["_quality"]["error"], r["route"]) for r in quality.quality_filter(scored).collect()}
    assert got == {"0": (9, None, "kept"), "1": (0, None, "rejected"), "2": (3, "timeout", "kept"), "3": (3, "no response", "kept")}
    bins = {r["score"]: r["rows"] for r in quality.score_histogram(scored).collect()}
    assert bins == {1: 1, 2: 0, 3: 2, 4: 0, 5: 1}


def test_augment(spark):
    schema = "id string, messages array<struct<role:string,content:string>>, text string"
    rows = spark.createDataFrame(
        [("a", [("system", "s"), ("user", "u"), ("user", "v")], "old"), ("b", [("system", "s")], "old"), ("c", [("user", "u")], "old")],
        schema,
    )
    answers = spark.createDataFrame([("a", "1. x\n2. y\n3. z"), ("b", "never")], "id string, response string")
    out = augment.augment_rows(rows, answers)
    got = {r["id"]: (r["t"], r["_aug_source"], r["text"]) for r in out.withColumn("t", row_text(F.col("messages"))).collect()}
    assert got == {
        "a": ("s \n u \n v", None, "old"), "b": ("s", None, "old"), "c": ("u", None, "old"),
        "a_aug0": ("s \n x \n v", "a", None), "a_aug1": ("s \n y \n v", "a", None),
    }
    assert tuple(augment.augment_stats(out, 2).first()) == (3, 5, 2)


def test_scores_skip_and_default(spark):
    rows = [("e", "exact_match", " A ", "a", None), ("e", "exact_match", "b", "a", None), ("e", "exact_match", "b", "", None),
            ("s", "substring", "xx Ab yy", "aB", None), ("g", "llm_judge", "x", "y", " 1."), ("u", "odd", "a", "a", None), ("n", "substring", "a", None, None)]
    df = spark.createDataFrame(rows, "name string, metric_type string, generated string, expected string, grade string")
    scored = scoring.scored_rows(df, grade="grade")
    specs = df.select("name", "metric_type").distinct()
    got = {r["name"]: (r["samples"], r["score"]) for r in scoring.benchmark_scores(specs, scored).collect()}
    assert got == {"e": (2, 0.5), "s": (1, 1.0), "g": (1, 1.0), "u": (1, 0.0), "n": (0, 0.0)}


def test_tag_domain(spark):
    cases = {"Acme-LAW": "legal", "medlaw": "legal", "clinicx": None, "fintech": "finance", "devs": "code", "CSx": "voice"}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert {r[0]: r[1] for r in df.select("s", scoring.tag_domain(F.col("s"))).collect()} == cases


def test_skew_join_equals_join(spark):
    big = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = sorted(tuple(r) for r in skew_join(big, small, "k", "id", limit=30).select("id", "k", "v").collect())
    assert got == sorted(tuple(r) for r in big.join(small, "k").select("id", "k", "v").collect())


def test_model_errors_and_quarantine(spark, ws):
    schema = "id string, messages array<struct<role:string,content:string>>, text string"
    rows = spark.createDataFrame(
        [("a", [("user", "keep me"), ("system", "raw")], "t"), ("b", [("user", "fail")], "t"), ("c", [("user", "  ")], "t"), ("d", [], "t")],
        schema,
    )

    def model(text):
        if text == "fail":
            raise ValueError("down")
        return text.upper()

    done, bad = redact_with_model(rows, model, ws, backoff=0.0)
    got = {r["id"]: ([m["content"] for m in r["messages"]], r["text"]) for r in done.collect()}
    assert got == {"a": (["KEEP ME", "raw"], None), "c": (["  "], None), "d": ([], None)}
    assert [r["id"] for r in bad.collect()] == ["b"]
    calls = apply_model(spark.createDataFrame([("x", "fail")], "id string, t string"), model, "t", backoff=0.0).first()
    assert (calls["response"], calls["error"], calls["attempts"]) == (None, "down", 3)


def test_replaced_content_is_not_joined(spark, monkeypatch):
    turns = [("system", "be brief"), ("user", "a long question"), ("user", "more")]
    rows = spark.createDataFrame([("1", turns)], "id string, messages array<struct<role:string,content:string>>")
    said = spark.createDataFrame([("1", "1. other\n2. third")], "id string, response string")
    joined, plain = [], type(rows).join
    monkeypatch.setattr(type(rows), "join", lambda self, *a, **k: (joined.append(self), plain(self, *a, **k))[1])
    out = {r["id"]: [m["content"] for m in r["messages"]] for r in augment.augment_rows(rows, said).collect()}
    assert out == {
        "1": ["be brief", "a long question", "more"], "1_aug0": ["be brief", "other", "more"], "1_aug1": ["be brief", "third", "more"],
    }
    assert [m["content"] for m in joined[0].first()["messages"]] == ["be brief", None, "more"]

"""Stored sketches against the sorted values they stand for."""

import datetime as dt
import random

from pyspark.sql import functions as F

from turnmill.operators.sketches import rank_error, sketch_log, sketch_percentiles, true_ranks, within_bound


def log(spark, n=30_000):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        value = None if i % 50 == 0 else float("nan") if i % 51 == 0 else rng.lognormvariate(5, 2) if i % 3 else 7.0
        rows.append(("abc"[i // 9 % 3], dt.datetime(2024, 1, 1 + i % 9, 12), value, None))
    return spark.createDataFrame(rows, "model string, ts timestamp, ms double, ttft double")


def test_answers_lie_within_the_bound(spark, ws):
    rows = ws.table(log(spark), "log")
    stored = ws.table(sketch_log(rows, ["model"], ["ms", "ttft"], "ts", 256), "sketches")
    assert stored.count() == 27
    answers = sketch_percentiles(stored, ["model"], {"ms": (0.01, 0.5, 0.95, 0.99, 1.0), "ttft": (0.5,)}, size=256)
    got = answers.collect()
    assert len(got) == 15 and {r["name"] for r in got} == {"ms"}
    held = {}
    for r in rows.filter("ms is not null and not isnan(ms)").collect():
        held.setdefault(r["model"], []).append(r["ms"])
    for r in got:
        values = held[r["model"]]
        assert r["n"] == len(values) and r["rank_error"] == rank_error(256)
        # Twice the bound of 99 % confidence.
        assert sum(v < r["value"] for v in values) / len(values) <= r["q"] + 2 * rank_error(256)
        assert sum(v <= r["value"] for v in values) / len(values) >= r["q"] - 2 * rank_error(256)
    audit = true_ranks(rows, answers, ["model"], "ms").withColumn("rank_error", F.col("rank_error") * 2).withColumn("ok", within_bound())
    assert audit.count() == 15 and audit.filter("not ok").count() == 0


def test_days_and_coarser_groups_need_no_log(spark, ws):
    rows = ws.table(log(spark, 900), "log")
    stored = ws.table(sketch_log(rows, ["model"], ["ms"], "ts"), "sketches")
    # So few values are held exactly.
    first = sketch_percentiles(stored, [], {"ms": (0.5,)}, F.col("day") <= "2024-01-03").first()
    values = sorted(r["ms"] for r in rows.filter("ts < '2024-01-04' and ms is not null and not isnan(ms)").collect())
    assert first["n"] == len(values) and abs(values.index(first["value"]) - len(values) // 2) <= values.count(first["value"]) + 1
    assert sketch_percentiles(stored, ["model"], {"ms": (0.5,)}, F.lit(False)).count() == 0


def test_a_larger_sketch_is_closer():
    assert rank_error(2048) < 0.0025 < rank_error(200) < 0.02

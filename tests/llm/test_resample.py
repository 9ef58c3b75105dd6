"""Resampling against a plain restatement of its definition."""

import hashlib
import math
import random
import re
import zlib

import pytest

from turnmill.llm.resample import Features, blocks, resample


def plain(docs, target, words=1, buckets=10_000, share=10, least=20, seed=2024):
    """(doc_id, n_features, weight, score) of each document, and the drawn ones in order."""

    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, words + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    rows = [(i, *features(x)) for i, x in docs]
    for _, _, f in rows:
        for b in f:
            s[b] += 1
    for x in target:
        for b in features(x)[1]:
            t[b] += 1
    big_s, big_t = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in range(buckets)]
    out = []
    for i, n, f in rows:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    return [(r[0], *r[2:]) for r in out], [r[0] for r in able[: len(able) * share // 100]]


def corpus(n=120):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("Alpha", "ß", "日本", "x9", "É") for b in range(60)]
    docs = [(i, "".join(rng.choice(words) + rng.choice([" ", ", ", "--", "\n", "\0"]) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return docs, [" ".join(rng.choice(words[:80]) for _ in range(40)) for _ in range(10)]


@pytest.mark.parametrize(("words", "share"), [(1, 10), (3, 35)])
def test_equals_the_definition(spark, frame, words, share):
    docs, target = corpus()
    got = resample(frame(docs), spark.createDataFrame([(t,) for t in target], "text string"), words=words, share=share).collect()
    rows, drawn = plain(docs, target, words, share=share)
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == sorted(rows)
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_nulls_repeats_ties_and_clashing_columns(spark, messy):
    got = resample(messy, spark.createDataFrame([("w1 w2", 1)], "text string, key int"), share=50)
    rows = got.collect()
    assert len(rows) == messy.count() and got.schema["rank"].dataType.simpleString() == "bigint"
    able = [r for r in rows if r["n_words"] >= 20]
    ranked = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(able) * 50 // 100 + 1))
    assert [r["score"] for r in ranked] == sorted((r["score"] for r in able), reverse=True)[: len(ranked)]
    empty = [r for r in rows if not r["n_features"]]
    assert empty and all(r["weight"] == 0 and r["rank"] is None for r in empty)
    again = resample(messy.repartition(7), spark.createDataFrame([("w1 w2",)], "text string"), share=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_empty_tables(spark, none, frame):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resample(none, target).collect() == []
    rows = resample(frame([(1, "a " * 40)]), target.limit(0), share=100).collect()
    assert [(r["n_features"], r["rank"]) for r in rows] == [(40, 1)]


def test_parts_of_a_text_hold_whole_words():
    text = ("Straße, 日本 x" + "y" * 900 + "  ") * 40
    parts = list(blocks(text.encode(), 512))
    assert "".join(parts) == text and len(parts) > 10
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    assert [w for p in parts for w in split(p)] == split(text)
    assert "".join(blocks(b"x" * 5000, 512)) == "x" * 5000


def test_runs_cross_the_parts_of_a_text(monkeypatch):
    import turnmill.llm.resample as module

    text = "a b, c d-e f " * 30
    whole = Features(1000, 3)(text)
    small = blocks.__defaults__
    monkeypatch.setattr(module.blocks, "__defaults__", (16,))
    cut = Features(1000, 3)(text)
    module.blocks.__defaults__ = small
    assert whole[0] == cut[0] and sorted(whole[1].tolist()) == sorted(cut[1].tolist())

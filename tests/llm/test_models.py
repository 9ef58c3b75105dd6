"""Classifiers and language identification: plain versions, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PIECES, prose
from turnmill.llm import langid, quality, toxicity
from turnmill.llm.labelled import fold, training_rows
from turnmill.llm.langid import identify_languages, training_texts
from turnmill.llm.quality import classify_quality
from turnmill.llm.toxicity import classify_toxicity

CLEAN = "the of and house river stone garden winter summer walking reading between under mountain letter morning paper".split()
BAD = ["bastrard", "morlock", "dunderpate"]


def toxic_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        w = prose(rng, rng.randrange(20, 60), CLEAN + [f"{a}{b}" for a in CLEAN[3:9] for b in CLEAN[9:]]).split()
        label = int(rng.random() < 0.3)
        if label:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        rows.append((" ".join(w), label))
    return rows


def plain_kernel(x, y):
    """Gapped subsequences of four letters that two strings share, ends included, each gap of one at most."""

    def vector(s):
        s = ["<", *s, ">"]
        out = {}
        for i in range(len(s)):
            for gaps in toxicity.GAPS:
                at, weight = [i], 1.0
                for g in gaps:
                    if g and at[-1] + 1 < len(s):
                        weight *= toxicity.LETTER_DECAY if s[at[-1] + 1].isalnum() else toxicity.SIGN_DECAY
                    at.append(at[-1] + 1 + g)
                if at[-1] < len(s) and all(s[j].isalnum() or s[j] in "<>" for j in at):
                    code = "".join(s[j] for j in at)
                    out[code] = out.get(code, 0) + weight
        return out

    a, b = vector(x), vector(y)
    return sum(v * b.get(c, 0) for c, v in a.items())


def test_kernel_matches_plain_sums():
    strings = ["idiot", "i.d.i.o.t", "idioot", "stationary", "x1y2z3", "ab"]
    rows, _ = toxicity.features(strings)
    own = [max(1.0, plain_kernel(s, s)) for s in strings]
    for i, x in enumerate(strings):
        for j, y in enumerate(strings):
            if len({*x}) == len(x) and len({*y}) == len(y):  # no subsequence occurs twice
                assert rows[i] @ rows[j] == pytest.approx(plain_kernel(x, y) / np.sqrt(own[i] * own[j]), rel=1e-4)


def test_toxicity_on_held_out_texts_and_disguises():
    train, test = toxic_rows(1, 500), toxic_rows(2, 300)
    machine = toxicity.fit([t for t, _ in train], [y for _, y in train])
    said = machine.score(pa.array([t for t, _ in test])) >= 0.7
    truth = np.array([y for _, y in test]) == 1
    assert (said == truth).mean() >= 0.98
    disguised = machine.score(pa.array(["the b.a.s.t.r.a.r.d reading", "a m o r l o c k house", "the dunnderpate", "MORLOCK!"]))
    clean = machine.score(pa.array(["the reading", "a house", "the under", ""]))
    assert disguised.min() > clean.max()


def test_toxicity_rows(spark, messy, none):
    labels = spark.createDataFrame([(4, 1), (50, 0), (4, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    rows = classify_toxicity(messy, labels, fold(F.col("doc_id"), 3) == 1).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert {r["doc_id"]: r["held_out"] for r in rows if r["doc_id"] is not None} == {
        r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows if r["doc_id"] is not None
    }
    assert {r["score"] for r in classify_toxicity(messy, labels.limit(0), F.lit(False)).collect()} == {0.5}
    assert classify_toxicity(none, labels, F.lit(False)).count() == 0


def test_held_out_labels_stay_out(spark, frame):
    docs = frame([(i, f"text {i}") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = training_rows(docs, labels, "quality", fold(F.col("doc_id"), 5) == 0, 10).collect()
    assert len(rows) == 20 and sorted(r["label"] for r in rows) == [0] * 10 + [1] * 10
    assert all(zlib.crc32(r["text"][5:].encode()) % 5 for r in rows)


def plain_ftrl(rows, size, alpha, beta, l1, l2):
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for x, y in rows:
        w = {i: weight(i) for i in x}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - y) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
            n[i] += g * g
    return [weight(i) for i in range(size)]


def test_ftrl_matches_plain_updates():
    rng = random.Random(3)
    rows = [({i: rng.random() for i in rng.sample(range(12), 4)}, rng.randrange(2)) for _ in range(200)]
    model = quality.Ftrl(12)
    for x, y in rows:
        model.update(np.array(list(x)), np.array(list(x.values())), y)
    assert model.weights() == pytest.approx(plain_ftrl(rows, 12, model.alpha, model.beta, model.l1, model.l2))


def test_quality_on_held_out_texts():
    rng = random.Random(4)

    def rows(n):
        out = []
        for _ in range(n):
            t, y = prose(rng, rng.randrange(15, 60)), int(rng.random() < 0.7)
            out.append((t if y else rng.choice([t.upper() + "!!", t.replace(" ", "%%% "), t.replace(" ", " | ")]), y))
        return out

    train, test = rows(600), rows(200)
    weights = quality.fit([t for t, _ in train], [y for _, y in train], 16, 30.0, 4)
    grams, first = quality.hashed_ngrams(pa.array([t for t, _ in test]), 16)
    score = [quality.sigmoid(30 * weights[grams[a:b]].sum() / (b - a) + weights[-1]) for a, b in zip(first[:-1], first[1:])]
    assert np.mean([(s >= 0.3) == y for s, (_, y) in zip(score, test)]) >= 0.97


def test_quality_rows(spark, messy, none):
    labels = spark.createDataFrame([(4, 1), (50, 0), (8, 1), (None, 1), (7, None)], "doc_id long, quality int")
    rows = classify_quality(messy, labels, fold(F.col("doc_id"), 5) == 0).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert {r["score"] for r in classify_quality(messy, labels.limit(0), F.lit(False)).collect()} == {0.5}
    assert classify_quality(none, labels, F.lit(False)).count() == 0


def sums_over_segmentations(word, vocabulary, chance):
    ids = {p: i for i, p in enumerate(vocabulary.pieces)}
    body = bytes([langid.MARK]) + word
    total = np.zeros(chance.shape[1])

    def cut(i, product):
        nonlocal total
        if i == len(body):
            total = total + product
        for k in range(1, min(vocabulary.longest, len(body) - i) + 1):
            p = body[i : i + k]
            piece = ids.get(p, len(vocabulary.pieces) + p[0] if k == 1 else None)
            if piece is not None:
                cut(i + k, product * chance[piece])

    cut(0, np.ones(chance.shape[1]))
    return np.log(total)


def test_forward_sums_all_segmentations():
    vocabulary = langid.Vocabulary(PIECES)
    counts = [dict(the=5, house=3, thing=2), dict(haus=4, ding=2, das=6)]
    from collections import Counter

    chance = langid.learn([Counter({w.encode(): n for w, n in c.items()}) for c in counts], vocabulary)
    assert chance.sum(0) == pytest.approx([1, 1])
    for w in ("the", "haus", "größe", "xq", "thinghaus"):
        assert langid.word_scores([w.encode()], vocabulary, chance)[0] == pytest.approx(sums_over_segmentations(w.encode(), vocabulary, chance), rel=1e-4)


def test_the_vocabulary_is_used_whole_and_long_words_are_cut_for_free():
    import sentencepiece

    vocabulary = langid.Vocabulary(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    assert len(vocabulary.pieces) == len({model.id_to_piece(i).lower().replace("▁", chr(langid.MARK)) for i in usual}) and vocabulary.longest > 16
    chance = np.random.default_rng(1).dirichlet(np.ones(vocabulary.size), 3).T
    rng = random.Random(2)
    for word in ("日本語の文章は空白なしで書かれる" * 2, "Straßenbahnhaltestellenverzeichnis" * 2, "=" * 90, "".join(rng.choice("aeint,.") for _ in range(90))):
        body = bytes([langid.MARK]) + word.encode()
        letters = langid.as_rows([body])
        whole = np.log(langid.forward(vocabulary.matches(letters), chance)[0, len(body)])
        parts = vocabulary.parts(body)
        assert b"".join(parts) == body and vocabulary.parts(body, block=16) == parts
        assert langid.word_scores([word.encode()], vocabulary, chance)[0] == pytest.approx(whole, rel=1e-4)
        assert langid.long_score(body, vocabulary, chance, block=32) == pytest.approx(whole, rel=1e-6)
    assert len(vocabulary.parts("日本語の文章".encode())) > 2


LANGS = {
    "en": "the house and a river with stones under this bridge where children were walking".split(),
    "de": "das haus und ein fluss mit steinen unter dieser brücke auf der kinder gingen".split(),
    "fr": "la maison et une rivière avec des pierres sous ce pont où les enfants marchaient".split(),
}


def test_language_of_held_out_texts(spark, messy, none):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(3, 40), LANGS[lang]), lang) for i in range(300) for lang in [rng.choice(list(LANGS))]]
    rows += [(900, None, "en"), (901, "123 …— 7", "en"), (902, "", "de"), (903, "Haus", None), (None, "the house", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in identify_languages(docs, PIECES, fold(F.col("doc_id"), 4) == 2, per_lang=60).collect()}
    tested = [(i, lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i]["held_out"] for i, _ in tested) and len(out) == len(rows)
    assert np.mean([out[i]["lang_pred"] == lang for i, lang in tested]) >= 0.95
    assert [out[i]["lang_pred"] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert identify_languages(messy, PIECES, F.lit(False)).count() == messy.count()
    assert {r["lang_pred"] for r in identify_languages(messy, PIECES, F.lit(True)).collect()} == {"und"}
    assert identify_languages(none, PIECES, F.lit(False)).count() == 0


def test_samples_hold_one_text_of_a_key_and_a_budget_of_bytes(spark, frame):
    rows = [(k, f"text {k} {i}") for k in (1, 2, 3) for i in range(500)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0)], "doc_id long, quality int")
    docs, none = frame(rows), F.lit(False)
    got = training_rows(docs, labels, "quality", none, 5).collect()
    # Key 3 has both labels and counts as 0.
    assert sorted((r["text"].split()[1], r["label"]) for r in got) == [("1", 1), ("2", 0), ("3", 0)]
    assert [r["text"] for r in training_rows(docs.repartition(5), labels, "quality", none, 5).collect()] == [r["text"] for r in got]
    assert training_rows(docs, labels, "quality", none, 5, most_bytes=3).collect() == []
    texts = training_texts(docs, none, 400, "doc_id", "text", "lang").collect()
    assert sorted(r["text"].split()[1] for r in texts) == ["1", "2", "3"] and {r["lang"] for r in texts} == {"en"}
    assert training_texts(docs, none, 400, "doc_id", "text", "lang", most_bytes=1).collect() == []

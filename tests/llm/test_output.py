"""Mixing, packing and the pipeline against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import BYTES, prose
from tests.llm.test_joins import plain_components
from tests.llm.test_single_pass import plain_rules
from turnmill.llm import tokens
from turnmill.llm.mixing import mix_documents, mix_plan
from turnmill.llm.packing import best_fit, matrix, pack_documents, positions, write_packed
from turnmill.llm.tokens import encoding

WORD = r"[^\x20\x09-\x0D]+"


def plain_targets(sizes, weights=(3, 1, 2)):
    """Deal out 150 % by weight; give the excess of full sources to the others until none is left."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), 1.5 * sum(sizes.values())
    while left > 1e-9 and len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        share, left = left / total, 0.0
        for s in names:
            if s not in full:
                target[s] += share * weight[s]
                if target[s] >= 2 * sizes[s]:
                    left += target[s] - 2 * sizes[s]
                    target[s] = 2.0 * sizes[s]
                    full.add(s)
    return target


def plain_copies(key, text, rate, nth=0):
    """Copies of a row that is the nth of those with its key, source and text."""
    digest = hashlib.md5(f"mix:{'' if key is None else key}:{hashlib.md5((text or '').encode()).hexdigest()}:{nth}".encode()).hexdigest()
    return int(rate) + (int(digest[:13], 16) / 2**52 < rate - int(rate))


def test_mix_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 60)), rng.choice(["a", "b", "B", "c", "d", "é", None, "d", "d"])) for i in range(400)]
    rows += [(900, None, "a"), (901, "", None), (902, "x", "only"), (None, "no key", "a"), (7, "again", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(WORD, t or ""))
    targets = plain_targets(sizes)
    got = mix_plan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] and int(rate) <= r["copies"] <= int(rate) + 1
    rates = {s: round(targets[s] / n, 12) if n else 0 for s, n in sizes.items()}
    wanted = sorted((str(i), len(re.findall(WORD, t or "")), plain_copies(i, t, rates[s])) for i, t, s in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in got) == wanted
    copies = Counter(r["doc_id"] for r in mix_documents(docs).collect())
    assert sum(copies.values()) == sum(r["copies"] for r in got)
    assert mix_documents(docs).schema == docs.schema


def test_mix_on_messy_rows(messy, none):
    assert mix_plan(messy).count() == messy.count() and mix_documents(messy).schema == messy.schema
    assert mix_documents(messy).count() == sum(r["copies"] for r in mix_plan(messy).collect())
    assert mix_plan(none).count() == mix_documents(none).count() == 0


def test_best_fit_matches_a_plain_search():
    rng = random.Random(1)
    for _ in range(150):
        most = rng.choice([1, 2, 7, 16, 64])
        lengths = sorted((rng.randint(1, most) for _ in range(rng.randrange(80))), reverse=True)
        free = []
        for n in lengths:
            fits = [f for f in free if f >= n]
            if fits:
                free[free.index(min(fits))] -= n
            else:
                free.append(most - n)
        rows = best_fit(lengths, most)
        assert sorted(sum(lengths[i] for i in r) for r in rows) == sorted(most - f for f in free)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))


def unpacked(rows, length):
    """Ids of each document, from its parts."""
    parts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == length and (ids[r["n_tokens"] :] == 50256).all() and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["position_resets"] == r["cu_seqlens"][:-1]
        for i, (doc, part) in enumerate(zip(r["doc_ids"], r["parts"])):
            parts[doc].setdefault(part, []).append(ids[r["cu_seqlens"][i] : r["cu_seqlens"][i + 1]].tolist())
    return parts


def test_packing_loses_no_token(spark, tmp_path, frame):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.choice([1, 5, 50, 400]))) for i in range(80)] + [(100, None), (101, ""), (102, "x" * 5000)]
    rows = pack_documents(frame(docs), BYTES, length=128, shard_bytes=20_000).collect()
    own, parts = encoding(BYTES), unpacked(rows, 128)
    assert len({r["shard"] for r in rows}) > 1
    for doc, text in docs:
        ids = [x for p in sorted(parts[doc]) for x in parts[doc][p][0]]
        assert ids == [*own.encode_ordinary(text or ""), 50256] and all(len(parts[doc][p]) == 1 for p in parts[doc])
    path = str(tmp_path / "packed")
    write_packed(pack_documents(frame(docs), BYTES, length=128, shard_bytes=20_000), path)
    one = [r for r in rows if r["shard"] == rows[0]["shard"]]
    again = spark.read.parquet(path).filter(f"shard = {rows[0]['shard']}").collect()
    assert (matrix(one, 128) == matrix(again, 128)).all()
    assert positions([0, 3, 5], 8).tolist() == [0, 1, 2, 0, 1, 0, 1, 2] and positions([0, 4], 4).tolist() == [0, 1, 2, 3]


def test_packing_repeated_keys_and_empty_input(messy, none):
    rows = pack_documents(messy, BYTES).collect()
    parts = unpacked(rows, 2048)
    assert len(parts[4][0]) == 4 and len(parts[None][0]) == 2
    assert pack_documents(none, BYTES).count() == 0


def plain_edit_free(items, text):
    return not any(re.sub(r"\s+", " ", i.lower()) in re.sub(r"\s+", " ", text.lower()) for i in items)


def test_pipeline_matches_brute_force(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(8)
    items = [prose(rng, 40) for _ in range(5)]
    docs = []
    for i in range(90):
        text = prose(rng, rng.randrange(60, 200))
        kind = rng.random()
        if kind < 0.15:
            text = prose(rng, 12) + (" same words again and again" * 30)
        elif kind < 0.35 and docs:
            w = rng.choice(docs)[1].split()
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind < 0.45:
            text = text + " " + rng.choice(items) + " " + prose(rng, 20)
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
    docs += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, "few words", "en", None, 9)]
    folder = tmp_path / "data"
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    left = [d for d in docs if plain_rules(d[1])[-1]]
    least = {key[0]: key[2] for key in plain_components([(d[0], d[1]) for d in left])}
    left = [d for d in left if least[d[0]] == d[0]]
    left = [d for d in left if plain_edit_free(items, d[1])]
    sizes = defaultdict(int)
    for d in left:
        sizes[d[3]] += len(d[1].split())
    targets = plain_targets(sizes)
    wanted = {d[0]: plain_copies(d[0], d[1], round(targets[d[3]] / sizes[d[3]], 12)) for d in left}
    rows = corpus_pipeline.run(spark, str(folder)).collect()
    parts, own = unpacked(rows, 2048), encoding(BYTES)
    assert {d: len(p[0]) for d, p in parts.items()} == {d: n for d, n in wanted.items() if n}
    texts = {d[0]: d[1] for d in docs}
    assert all(ids == [*own.encode_ordinary(texts[d]), 50256] for d, p in parts.items() for ids in p[0])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, spark.read.parquet(str(folder / "documents.parquet")).limit(0), str(folder)).count() == 0


def test_rows_without_a_key_draw_apart(spark):
    rng = random.Random(41)
    rows = [(None, " ".join(["w"] * rng.randint(1, 40)) + f" u{i}", None, f"s{i % 3}", i) for i in range(3000)]
    for docs in (rows, [(None, "a b c d", None, f"s{i % 3}", 1) for i in range(3000)]):
        frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
        got = mix_plan(frame).collect()
        assert len(got) == 3000
        taken, target = Counter(), {}
        for r in got:
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert r["taken"] <= 2 * r["size"]
        assert all(abs(taken[s] - t) <= 0.05 * t for s, t in target.items())
        assert mix_documents(frame).count() == sum(r["copies"] for r in got)
        assert sorted(map(str, mix_plan(frame.repartition(7)).collect())) == sorted(map(str, got))


@pytest.mark.parametrize("space", [" ", "\n", " \n", "\u3000", "\u2003 "])
def test_long_white_space_has_the_ids_of_the_whole(space, monkeypatch):
    encode = tokens.Encoder(BYTES)
    for n in (49, 50, 51, 52, 400):
        for text in (space * n, "a" + space * n, space * n + "b", f"a {space * n}b{space * n}\u00a0c {space * 3}d"):
            monkeypatch.setattr(tokens, "LONG_RUN", 50)
            ids, _ = encode(pa.array([text]))
            assert ids.tolist() == encode.encoding.encode_ordinary(text)
            encode._clear()


def test_a_text_of_millions_of_spaces_or_letters():
    encode = tokens.Encoder(BYTES)
    for text in (" " * 5_000_000, "\n" * 1_500_000 + "x", "x" * 2_000_000):
        ids, at = encode(pa.array([text, "end"]))
        assert "".join(encode.encoding.decode(ids[: at[1]].tolist())) == text

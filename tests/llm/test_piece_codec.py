"""The agenda and decoder against the library and a scan for the best pair."""

import hashlib
import random
import time

import numpy as np
import pytest

from turnmill.llm import piece_codec
from turnmill.llm.piece_codec import ID, Codec, encode_and_decode

from .conftest import PIECES


@pytest.fixture(scope="module")
def own():
    return Codec(PIECES)


def library(own, text):
    ids = own.library.encode(text, add_bos=True, add_eos=True)
    return np.array(ids, ID).tobytes(), own.library.decode(ids)


TEXTS = ["", " ", "  a  b ", "\n\t", "<s></s><unk> ⁇ ", "▁a▁ ▁", "naïve straße 日本語 😀​\0", "<0x41>", "aaaa" * 50, "x" * 3000, " " * 3000, "a " * 500]


def test_encodes_and_decodes_as_the_library(own):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice(" ▁ab\n\té日😀<s>0x​the ing") for _ in range(rng.randint(0, 90))) for _ in range(2000)]
    for text in texts:
        ids, decoded = library(own, text)
        assert own.encode(text) == ids and own.decode(ids) == decoded
        assert own.agrees(text, ids, decoded)
    assert not own.agrees("a b", library(own, "a c")[0], "a b") and not own.agrees("a b", library(own, "a b")[0], "a c")


def test_decodes_any_ids_as_the_library(own):
    rng = random.Random(8)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(300), 0, 1, 2]) for _ in range(rng.randint(0, 7))]
        assert own.decode(np.array(ids, ID).tobytes()) == own.library.decode(ids)


def test_the_agenda_takes_the_best_pair_first(own):
    def scan(text):
        s = list(text)
        while True:
            ranks = [own.rank.get(a + b, 1 << 30) for a, b in zip(s, s[1:], strict=False)]
            if not ranks or min(ranks) == 1 << 30:
                return s
            i = ranks.index(min(ranks))
            s[i : i + 2] = [s[i] + s[i + 1]]

    rng = random.Random(9)
    for n in (0, 1, 2, 20, 64, 65, 300):
        text = "".join(rng.choice("theingaa▁") for _ in range(n))
        assert own.merge(text) == scan(text)


def test_parts_of_long_texts_give_the_ids_of_the_whole(own, monkeypatch):
    monkeypatch.setattr(piece_codec, "BLOCK", 20)
    for text in [*TEXTS, "some words, and  more \n words ▁ here " * 40]:
        ids, decoded = library(own, text)
        assert own.encode(text) == ids and own.agrees(text, ids, decoded)


def test_many_cuts_get_the_ids_of_one(own, monkeypatch):
    rng = random.Random(10)
    cuts = ["▁" + "".join(rng.choice("theingaéß日😀\n.▁") for _ in range(rng.randint(0, 63))) for _ in range(2000)]
    ids = [own._ids(own.merge(c)) for c in cuts]
    assert own.merge_many(cuts) == ids
    monkeypatch.setattr(piece_codec, "BLOCK", 200)
    assert own.merge_many(cuts) == ids and own.merge_many([]) == []


def test_many_ids_are_decoded_apart(own):
    rng = random.Random(11)
    many = [[rng.choice([rng.randrange(32_000), rng.randrange(300), 0, 1, 2]) for _ in range(rng.randint(0, 7))] for _ in range(3000)]
    assert own.decode_many([np.array(x, ID).tobytes() for x in many]) == [own.library.decode(x) for x in many]
    assert own.decode_many([]) == []


def test_work_beside_the_library(own):
    """CPU time, as a share of the library's, on words that were not met before."""

    def seconds(work):
        spent = []
        for _ in range(5):
            own.known.clear()
            start = time.process_time()
            work()
            spent.append(time.process_time() - start)
        return min(spent)

    rng = random.Random(12)
    text = " ".join("".join(rng.choice(["the", "in", "er", "ou", "an", "de", "s", "y", ","]) for _ in range(rng.randint(2, 6))) for _ in range(40_000))
    ids = own.encode(text)
    theirs = own.library.encode(text)
    encoded = seconds(lambda: own.encode(text)) / seconds(lambda: own.library.encode(text))
    decoded = seconds(lambda: own.decode(ids)) / seconds(lambda: own.library.decode(theirs))
    assert encoded < 0.8 and decoded < 0.6, (encoded, decoded)


def test_rows(spark, messy, none, own):
    got = encode_and_decode(messy, PIECES).collect()
    rows = messy.select("doc_id", "text").collect()
    assert sorted((str(r["doc_id"]), hashlib.md5(r["ids"]).hexdigest(), r["decoded"]) for r in got) == sorted(
        (str(r["doc_id"]), hashlib.md5(library(own, r["text"] or "")[0]).hexdigest(), library(own, r["text"] or "")[1]) for r in rows
    )
    assert all(r["agrees"] for r in got)
    assert encode_and_decode(none, PIECES).collect() == []

import random
import re

import numpy as np
import pyarrow as pa

from turnmill.llm.text import pieces, rolled, sums, windows, words

WORD = r"[^\x20\x09-\x0D]+"


def test_words_and_windows_match_a_plain_scan():
    rng = random.Random(3)
    alphabet = ["a", "b", "é", "日", " ", "\n", "\t", "\x0b", " ", "\x1c"]
    texts = [None, "", " "] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)]
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    w = words(column)
    word = w.fingerprints()
    expected = [re.findall(WORD, t or "") for t in texts]
    assert [[w.word(j).decode() for j in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])] == expected
    flat = [x for t in expected for x in t]
    assert len(set(word.tolist())) == len(set(flat))
    seen = {}
    for x, h in zip(flat, word.tolist()):
        assert seen.setdefault(x, h) == h
    values, starts = windows(word, w.first, 3)
    spans = [tuple(t[i : i + 3]) for t in expected for i in range(len(t) - 2)]
    assert len(starts) == len(spans) and len(set(values.tolist())) == len(set(spans))


def test_fingerprints_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 3000).astype(np.uint8)
    starts = np.append(np.sort(rng.integers(0, 2900, 400)), 3000)
    ends = starts + np.append(rng.integers(0, 100, 400), 0)
    whole = rolled(values, starts, ends, 0xD1342543DE82EF95, np.arange(1, 257, dtype=np.uint64))
    for block in (1, 7, 500, 2999, 3000):
        assert (rolled(values, starts, ends, 0xD1342543DE82EF95, np.arange(1, 257, dtype=np.uint64), block) == whole).all()
    assert not len(rolled(values[:0], starts[:0], ends[:0], 3))


def test_lower_case_folds_ascii_only():
    w = words(pa.array(["ABC abc É é"]))
    h = w.fingerprints(lower=True)
    assert h[0] == h[1] and h[2] != h[3]


def test_pieces_cover_all_rows_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * n for n in (0, 5, 50, 3, 3, 0, 99, 1, 0)])], ["doc_id", "text"])
    cut = list(pieces(batch, most=10))
    assert [r for p in cut for r in p.column(0).to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= 10 for p in cut)
    assert not list(pieces(batch.slice(0, 0)))


def test_sums_of_empty_ranges():
    assert sums(np.array([1, 2, 3]), np.array([0, 0, 2, 3, 3])).tolist() == [0, 3, 3, 0]

"""Repetition rules and secret scans against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import BYTES, messy_rows
from turnmill.llm import repetition, secrets
from turnmill.llm.repetition import drop_repetitive, longest_repeats, repetition_rules
from turnmill.llm.secrets import find_secrets, looks_random, random_span
from turnmill.llm.tokens import Encoder, encoding

WORD = r"[^\x20\x09-\x0D]+"


def plain_rules(text, min_repeat=20, max_covered=0.15, max_repeat=60):
    text = text or ""
    w = re.findall(WORD, text)
    n = len(w)
    seen = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    five = {j for i in range(n - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    long = []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        long.append(best)
    cover = {j for i in range(n) if long[i] >= min_repeat for j in range(i, i + long[i])}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = n < 10 or 100 * len(five) > 20 * n
    kept = not failed and len(cover) <= max_covered * n and max(long, default=0) <= max_repeat
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(five), len(cover), max(long, default=0), failed, kept)


def rules_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    return [tuple(list(r.values())[1:]) for r in repetition.measure(batch, 20, 0.15, 60).to_pylist()]


def test_repetition_matches_brute_force():
    rng = random.Random(5)
    texts = [None, "", "\n\n", "a", "a " * 40, "x y\nx y\nx y\n z", "é é\té\x0bñ # <>|"]
    for _ in range(150):
        k = rng.choice([1, 2, 4, 30])
        texts.append("".join(rng.choice([f"w{rng.randrange(k)}", "é", "#"]) + rng.choice([" ", "\n", "\t"]) for _ in range(rng.randrange(70))))
    run = [f"v{i}" for i in range(90)]
    texts += [" ".join(run + [f"u{i}" for i in range(400)] + run[:n]) for n in (19, 20, 45, 60, 61)]
    assert rules_of(texts) == [plain_rules(t) for t in texts]


def test_longest_repeats_of_one_word_and_of_none():
    assert longest_repeats(np.array([7] * 6, np.uint64), np.array([0, 6])).tolist() == [5, 5, 4, 3, 2, 1]
    assert not len(longest_repeats(np.zeros(0, np.uint64), np.array([0, 0])))


def test_repetition_on_messy_rows(messy, none):
    rows = repetition_rules(messy).collect()
    short = [r for r in messy_rows() if len(r[1] or "") < 3000]
    got = Counter(tuple(r[1:]) for r in rows)
    assert len(rows) == len(messy_rows()) and all(got[plain_rules(r[1])] for r in short)
    kept = drop_repetitive(messy)
    assert kept.schema == messy.schema and kept.count() == sum(r["kept"] for r in rows)
    assert repetition_rules(none).count() == drop_repetitive(none).count() == 0


ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest())


def test_fixed_secret_forms_match_brute_force():
    rng = random.Random(8)
    parts = ["é", " ", "password", "PassWd", "secret", "ſecret", "toKen", "api_key", "apikey", "=", ":", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8I9", "abc123", "0123456789abcdef", "x.y/z", "\n"]
    texts = [None, ""] + ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    got = secrets.scan(batch, secrets.encoding(BYTES), 16, 2.3).to_pylist()
    assert [(r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got] == [plain_base(t) for t in texts]


@pytest.mark.parametrize(
    ("value", "random_string"),
    [
        ("ghp_16C7e42F292c6912E7710c838347Ae178B4a", True), ("wJalrXUtnFEMI7K7MDENGbPxRfiCYzEXAMPLEKEY", True),
        ("sk-proj-9xQ2mLpR7vT4kWnZ8bYc", True), ("AKIB447BD7EW7YT55JDR", True), ("da39a3ee5e6b4b0d3255bfef95601890afd80709", False),
        ("123e4567-e89b-12d3-a456-426614174000", False), ("some_long_snake_case_name_2", False), ("CamelCaseIdentifierName10", False),
        ("2024-01-01-12-30-45-99", False), ("sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", False), ("layer_12_weights_v2", False),
    ],
)
def test_token_efficiency_tells_random_strings(value, random_string):
    assert looks_random(value.encode(), secrets.encoding(BYTES), 2.3) is random_string


def test_secret_spans_are_code_points(frame):
    text = "é schön ghp_16C7e42F292c6912E7710c838347Ae178B4a ende password=hunter22 x"
    row = find_secrets(frame([(1, text), (2, None)]), BYTES).orderBy("doc_id").collect()
    spans = dict((k, text[int(a) : int(b)]) for k, a, b in (s.split(":") for s in row[0]["spans"].split(",")))
    assert spans == {"random": "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "assign": "password=hunter22"}
    assert row[1]["spans"] == "" and row[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_secrets_on_messy_rows(messy, none):
    assert find_secrets(messy, BYTES).count() == messy.count()
    assert find_secrets(none, BYTES).count() == 0


def test_token_ids_equal_whole_text_encoding():
    rng = random.Random(4)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "1", "%", " ", "　", "don't", "\x1c", "ß", "—", "日"]
    texts = [None, "", " ", "a ", "  b", "x　", "   c ", "     d"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(1500)]
    own, encode = encoding(BYTES), Encoder(BYTES)
    for _ in range(2):
        ids, at = encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == own.encode_ordinary(t or "")


@pytest.mark.parametrize("front", ["", "config/production/credentials/", "export_service_configuration_value=", "my_session_key="])
def test_random_strings_are_found_behind_names_and_paths(front):
    rng = random.Random(12)
    tokens = secrets.encoding(BYTES)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    found = 0
    for _ in range(300):
        value = "".join(rng.choice(letters) for _ in range(16))
        span = random_span((front + value).encode(), tokens, 16, 2.3)
        found += bool(span) and span[1] == len(front + value) and span[0] <= len(front) + 3
    assert found >= 285


def test_names_and_paths_are_no_random_strings():
    tokens = secrets.encoding(BYTES)
    for value in (
        "config/production/credentials/default", "getURLForHTTPRequest", "XMLHttpRequestUpload", "export_service_configuration_value=",
        "Donaudampfschifffahrtsgesellschaft", "2024-05-17/10_22_31", "application/vnd-openxmlformats-officedocument", "----------------",
        "AbstractSingletonProxyFactoryBean", "usr/local/share/python3/site-packages",
    ):
        assert random_span(value.encode(), tokens, 16, 2.3) is None

"""Toxicity: a subsequence string kernel, Nystrom landmarks and a linear support vector machine.

The strings are words; a run of single letters between spaces is one string. The kernel of two
strings sums, over the subsequences of four letters that they share, a decay for each character
left out in between: letters decay fast, other signs hardly, so "i.d.i.o.t" stays close to "idiot".
A string's two ends count as letters. Each gap is of one character at most. Subsequences are hashed
to 20 bits. Long strings are compared in windows of ``WINDOW`` starts.

Strings of labelled sentences are mapped to their kernels with landmark strings, whitened by the
landmarks' own kernel, and separated by a squared-hinge machine. Sentences of toxic documents are
only known to hold one toxic string somewhere, so the string taken for each is its best so far.
As the kernel is a product of explicit sums, the machine folds into one weight per
subsequence: scoring is exact, needs no kernel per landmark, and reads every character of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from turnmill.llm.labelled import sigmoid, training_rows
from turnmill.llm.text import maxima, pieces, words

#: Letters of a byte: a-z, digits, and a class for the low half of a continuation byte; 0 for signs.
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[48:58] = np.arange(27, 37)
SYMBOL[0x80:0xC0] = 37 + (np.arange(0x80, 0xC0) & 0x1F) % 25
OPEN, CLOSE, SIZE = 62, 63, 64
LETTER_DECAY, SIGN_DECAY, WINDOW, BITS = 0.4, 0.9, 12, 20
GAPS = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class Strings:
    """The strings of some texts: symbols, the string of each, and the strings of each text."""

    def __init__(self, column: pa.Array):
        w = words(column)
        # Single letters with one space between them are one string.
        single = w.ends - w.starts == 1
        joined = np.zeros(len(single), bool)
        if len(single) > 1:
            joined[1:] = single[1:] & single[:-1] & (w.starts[1:] - w.ends[:-1] == 1)
            joined[w.first[(w.first > 0) & (w.first < len(joined))]] = False
        heads = np.flatnonzero(~joined)
        self.starts = w.starts[heads]
        self.ends = w.ends[np.append(heads[1:], len(joined)) - 1] if len(heads) else w.ends[:0]
        self.first = np.searchsorted(self.starts, w.offsets)
        self.buf = w.buf
        # Bytes that begin a code point of several bytes carry nothing that the next does not tell.
        held = np.zeros(len(w.buf) + 1, np.int64)
        opened = np.zeros(len(w.buf) + 1, np.int64)
        np.add.at(opened, self.starts, 1)
        np.add.at(opened, self.ends, -1)
        inside = (np.cumsum(opened)[:-1] > 0) & (w.buf < 0xC0)
        held[1:] = np.cumsum(inside)
        # Each string begins and ends with a mark, a letter of its own.
        length = held[self.ends] - held[self.starts] + 2
        self.to = np.cumsum(length)
        self.at = self.to - length
        self.symbols = np.zeros(int(length.sum()), np.int64)
        body = np.ones(len(self.symbols), bool)
        body[self.at] = body[self.to - 1] = False
        self.symbols[body] = SYMBOL[w.buf[inside]]
        self.symbols[self.at], self.symbols[self.to - 1] = OPEN, CLOSE

    def text(self, i: int) -> str:
        return self.buf[self.starts[i] : self.ends[i]].tobytes().decode()


def subsequences(s: Strings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, hashed codes and decays of all subsequences of four letters within a string, by gaps."""
    x = s.symbols
    n = len(x)
    end = np.repeat(s.to, s.to - s.at)
    letter = x > 0
    decay = np.where(letter, LETTER_DECAY, SIGN_DECAY).astype(np.float32)
    low = x.astype(np.uint32)
    for gaps in GAPS:
        steps = np.cumsum([g + 1 for g in gaps])
        span = int(steps[-1])
        m = n - span
        if m <= 0:
            continue
        ok = letter[:m] & (np.arange(span, n) < end[:m])
        for step in steps:
            ok &= letter[step : step + m]
        at = np.flatnonzero(ok)
        code, before = low[at], 0
        weight = np.ones(len(at), np.float32)
        for step in steps.tolist():
            code = code * np.uint32(SIZE) + low[at + step]
            if step - before == 2:
                weight *= decay[at + step - 1]
            before = step
        yield at, (code * np.uint32(2654435761)) >> np.uint32(32 - BITS), weight


def string_scores(s: Strings, table: np.ndarray) -> np.ndarray:
    """For each string the best window: its subsequences' weights over the length of their vector."""
    n = len(s.symbols)
    gained, square = np.zeros(n), np.zeros(n)
    for at, code, weight in subsequences(s):
        gained[at] += table[code] * weight
        square[at] += weight * weight
    gain, length = np.append(0.0, np.cumsum(gained)), np.append(0.0, np.cumsum(square))
    upto = np.minimum(np.arange(n) + WINDOW, np.repeat(s.to, s.to - s.at))
    windows = _ratio(gain[upto] - gain[:-1], length[upto] - length[:-1])
    best = maxima(windows, np.append(s.at, n), 0.0)
    whole = _ratio(gain[s.to] - gain[s.at], length[s.to] - length[s.at])
    return np.where(s.to - s.at <= WINDOW, whole, best)


def _ratio(gain: np.ndarray, square: np.ndarray) -> np.ndarray:
    return gain / np.sqrt(np.maximum(square, 1.0))


def features(strings: list[str], codes: dict[int, int] | None = None) -> tuple[np.ndarray, dict[int, int]]:
    """Explicit subsequences of strings as unit rows of a matrix, over given ones or those that occur."""
    s = Strings(pa.array(strings, pa.string()))
    owner = np.searchsorted(s.first, np.repeat(np.arange(len(s.at)), s.to - s.at), "right") - 1
    found = list(subsequences(s))
    square = np.zeros(len(strings))
    for at, _, weight in found:
        square += np.bincount(owner[at], weight.astype(np.float64) ** 2, len(strings))
    if codes is None:
        codes = {int(c): i for i, c in enumerate(np.unique(np.concatenate([c for _, c, _ in found] or [np.zeros(0, int)])))}
    column = np.full(1 << BITS, -1)
    column[list(codes)] = list(codes.values())
    out = np.zeros((len(strings), len(codes)), np.float32)
    for at, code, weight in found:
        col = column[code]
        np.add.at(out, (owner[at][col >= 0], col[col >= 0]), weight[col >= 0])
    out /= np.sqrt(np.maximum(square, 1.0))[:, None].astype(np.float32)
    return out, codes


def _separate(z: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 15) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1))])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        live = y * (x @ w) < 1
        xs, c = x[live], cost[live]
        w = np.linalg.solve(np.diag(ridge) + (xs * c[:, None]).T @ xs, (xs * c[:, None]).T @ y[live])
    return w[:-1], float(w[-1])


class Machine:
    def __init__(self, table: np.ndarray, bias: float, slope: float, shift: float):
        self.table, self.bias, self.slope, self.shift = table, bias, slope, shift

    def decide(self, column: pa.Array) -> np.ndarray:
        """The best decision value among a text's strings."""
        s = Strings(column)
        return maxima(string_scores(s, self.table) + self.bias, s.first, self.bias)

    def score(self, column: pa.Array) -> np.ndarray:
        return sigmoid(self.slope * self.decide(column) + self.shift)


SENTENCE = re.compile(r"[.!?\n]+\s*")


def _sides(texts: list[str | None], labels: list[int]) -> tuple[list[list[str]], list[Counter]]:
    """The strings of each text of label 1, and for label 0 and 1 in how many contexts each string occurs.

    A context is the string before. Copies of a passage repeat its contexts, so they count once.
    """
    toxic: list[list[str]] = []
    seen: list[set[int]] = [set(), set()]
    often = [Counter(), Counter()]
    for text, label in zip(texts, labels, strict=True):
        s = Strings(pa.array(SENTENCE.split((text or "").lower()), pa.string()))
        strings = [s.text(i) for i in range(len(s.at))]
        for pair in zip(["", *strings], strings, strict=False):
            if (context := hash(pair)) not in seen[label]:
                seen[label].add(context)
                often[label][pair[1]] += 1
        if label and strings:
            toxic.append(strings)
    return toxic, often


def fit(texts: list[str | None], labels: list[int], landmarks: int = 160, cost: float = 8.0, rounds: int = 3, seed: int = 5) -> Machine:
    """Train on documents: strings of clean sentences against the strings that make others toxic.

    Strings that occur in several contexts, ten times as often under label 1, are toxic at once. A
    text of label 1 without any gives its best string, if the machine so far finds it toxic. A string
    weighs as often as it occurs, up to a limit.
    """
    toxic, (in_clean, in_toxic) = _sides(texts, labels)
    if not in_clean or not in_toxic:
        return Machine(np.zeros(1 << BITS, np.float32), 0.0, 0.0, 0.0)
    n1, n0 = sum(in_toxic.values()), sum(in_clean.values())

    def ratio(x: str) -> float:
        return in_toxic[x] / n1 / ((in_clean[x] + 0.5) / n0)

    bad = sorted((x for x, n in in_toxic.items() if n >= 3 and ratio(x) >= 10), key=lambda x: (-in_toxic[x], x))
    common = sorted((x for x in in_clean if ratio(x) < 2), key=lambda x: (-in_clean[x], x))
    chosen = bad[: landmarks * 3 // 4]
    chosen += [x for x in common if len(x) >= 3][: landmarks - len(chosen)]
    pool = sorted(x for x in in_clean if ratio(x) < 2)
    negatives = {pool[i] for i in np.random.default_rng(seed).permutation(len(pool))[:20000]} | set(common[:2000])
    positives, known = set(bad), set(bad)
    table, bias = np.zeros(1 << BITS, np.float32), 0.0
    for _ in range(rounds):
        rows = sorted(positives) + sorted(negatives)
        y = np.where(np.arange(len(rows)) < len(positives), 1.0, -1.0)
        if not positives:
            break
        mark, codes = features(chosen)
        values, vectors = np.linalg.eigh((mark @ mark.T).astype(np.float64))
        kept = values > 1e-4 * max(values.max(), 1e-9)
        whiten = vectors[:, kept] / np.sqrt(values[kept])
        z = np.vstack([features(rows[i : i + 500], codes)[0] @ mark.T for i in range(0, len(rows), 500)]) @ whiten
        often = np.array([min(40.0, in_toxic[x]) if x in positives else min(8.0, 1 + in_clean[x]) for x in rows])
        w, bias = _separate(z, y, cost * often)
        per_code = mark.T @ (whiten @ w)
        table = np.zeros(1 << BITS, np.float32)
        table[list(codes)] = per_code[list(codes.values())]
        for strings in toxic:
            if known.isdisjoint(strings):
                margin = string_scores(Strings(pa.array(strings, pa.string())), table)[: len(strings)] + bias
                if len(margin) == len(strings) and margin.max() > 0:
                    positives.add(strings[int(np.argmax(margin))])
        margin = string_scores(Strings(pa.array(pool, pa.string())), table)[: len(pool)]
        hard = [pool[i] for i in np.argsort(-margin)[:3000] if pool[i] not in positives]
        negatives |= set(hard)
        chosen = list(dict.fromkeys([*chosen, *hard[: landmarks // 2]]))
    machine = Machine(table, bias, 1.0, 0.0)
    margin = np.concatenate([machine.decide(pa.array([x or ""], pa.string())) for x in texts])
    machine.slope, machine.shift = _platt(margin, np.array(labels))
    return machine


def _platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, with smoothed targets."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(w[1])


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, left_out: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_label: int = 2000, landmarks: int = 160, threshold: float = 0.7,
) -> DataFrame:
    """Score of each document: the probability of label 1, and whether it reaches ``threshold``.

    ``left_out`` is a condition on the key that keeps labels out of the fit. At most ``per_label``
    labelled texts per label, of 64 MB together, are fitted, on the driver. Null and empty texts score as texts without
    any string; without labels of both kinds every score is 0.5. Each row of ``docs`` gives one row.
    """
    sample = training_rows(docs, labels, label, left_out, per_label, key, text).toPandas()
    machine = fit(sample["text"].tolist(), sample["label"].tolist(), landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                score = machine.score(piece.column(1))
                columns = [piece.column(0), piece.column(2), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), left_out.alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)

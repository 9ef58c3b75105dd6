"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Runs of letters and runs of signs are words of their own, so that decoration is seen apart from
what it decorates. Unigrams and bigrams are hashed to ``bits`` bits; a text's features are the
shares of its n-grams. The model is fitted on a bounded sample of labelled rows; scoring is a sparse
dot product per text in one map, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from turnmill.llm.labelled import sigmoid, training_rows
from turnmill.llm.text import SPACE, buffers, mix, pieces, rolled, sums

#: 0: white space, 1: signs, 2: letters and digits.
KIND = np.where(SPACE, 0, 1).astype(np.int8)
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 2
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def hashed_ngrams(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed unigrams and bigrams of each text, and where each text's begin.

    A bigram of a word with itself is one feature whatever the word.
    """
    buf, offsets = buffers(column)
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = KIND[buf]
    turn = np.ones(len(buf), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[offsets[offsets < len(buf)]] = True
    starts = np.flatnonzero(turn)
    ends = np.append(starts[1:], len(buf))
    full = kind[starts] > 0
    starts, ends = starts[full], ends[full]
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    one = rolled(buf, starts, ends, 0xD1342543DE82EF95, _TABLE)
    two = mix(one[:-1] * np.uint64(0xA3B195354A39B70D) + one[1:])
    two[one[:-1] == one[1:]] = np.uint64(1)
    # Interleaved: at 2 i the word i, at 2 i + 1 the bigram that begins with it.
    both = np.empty(2 * len(one), np.uint64)
    both[::2] = one
    both[1::2] = np.append(two, np.uint64(0))
    inside = np.ones(len(both), bool)
    inside[2 * first[1:][np.diff(first) > 0] - 1] = False
    at = np.concatenate(([0], np.cumsum(inside)))[2 * first]
    return (both[inside] >> np.uint64(64 - bits)).astype(np.int64), at


class Ftrl:
    """Logistic regression with per-coordinate FTRL-proximal updates."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def update(self, at: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (sigmoid(w @ values) - label) * values
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g


def fit(texts: list[str | None], labels: list[int], bits: int, scale: float, epochs: int) -> np.ndarray:
    """Weights of the hashed n-grams; the last is the bias."""
    model = Ftrl((1 << bits) + 1)
    rows = []
    for text in texts:
        grams, _ = hashed_ngrams(pa.array([text], pa.string()), bits)
        at, counts = np.unique(grams, return_counts=True)
        rows.append((np.append(at, 1 << bits), np.append(scale * counts / max(1, len(grams)), 1.0)))
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            model.update(*rows[i], labels[i])
    return model.weights().astype(np.float32)


def classify_quality(
    docs: DataFrame, labels: DataFrame, left_out: Column, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = 3000, bits: int = 18, scale: float = 30.0, epochs: int = 4, threshold: float = 0.3,
) -> DataFrame:
    """Score of each document: the probability of label 1, and whether it reaches ``threshold``.

    ``left_out`` is a condition on the key that keeps labels out of the fit. At most ``per_label``
    labelled texts per label, of 64 MB together, are fitted, on the driver. Null and empty texts get the score of the
    bias; without labels every score is 0.5. Each row of ``docs`` gives one row.
    """
    sample = training_rows(docs, labels, label, left_out, per_label, key, text).toPandas()
    weights = fit(sample["text"].tolist(), sample["label"].tolist(), bits, scale, epochs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                grams, first = hashed_ngrams(piece.column(1), bits)
                total = sums(weights[grams].astype(np.float64), first)
                score = sigmoid(scale * total / np.maximum(1, np.diff(first)) + float(weights[-1]))
                predicted = (score >= threshold).astype(np.int32)
                columns = [piece.column(0), piece.column(2), pa.array(score), pa.array(predicted)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), left_out.alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)

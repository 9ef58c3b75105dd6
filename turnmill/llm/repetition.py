"""Quality rules on repetition: word suffix arrays of whole texts, many texts at once.

The suffixes of each text's words are sorted by prefix doubling until no two are equal. The
longest common prefixes of neighbours give the LCP intervals, each a repeated substring that
cannot grow to the right. The union of the spans of repeats of ``min_repeat`` words or more, and
the longest repeat, are limited.

One map over the texts, without a shuffle; memory is that of one piece of texts or of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnmill.llm.text import LEAD, SPACE, Words, mix, pieces, rolled, sums, words

_BYTES = np.arange(1, 257, dtype=np.uint64)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def longest_repeats(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run from it that begins elsewhere in its text too.

    ``values`` stand for words, text i has those of ``first[i]:first[i + 1]``. A class is a run of
    neighbours in suffix order whose first ``step`` words are equal, and is named after its first
    place. Classes of one suffix are settled and take no part in later rounds.
    """
    n = len(values)
    longest = np.zeros(n, np.int64)
    if not n:
        return longest
    counts = np.diff(first)
    end = np.repeat(first[1:], counts)
    key = mix(values + np.repeat(np.arange(len(counts), dtype=np.uint64), counts) * np.uint64(0x9E3779B97F4A7C15))
    suffix = np.argsort(key)
    sorted_key = key[suffix]
    fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[suffix] = np.maximum.accumulate(np.where(fresh, place, 0))
    slots = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    pairs = np.flatnonzero(~fresh)  # each with the place before it
    rounds: list[tuple[np.ndarray, np.ndarray]] = []
    step = 1
    while len(slots):
        at = suffix[slots]
        rounds.append((at, rank[at]))
        on = at + step
        after = np.where(on < end[at], rank[np.minimum(on, n - 1)], -1)
        both = rank[at] * (n + 1) + after + 1
        by = np.argsort(both)
        at, both = at[by], both[by]
        suffix[slots] = at
        fresh = np.append(True, both[1:] != both[:-1])
        rank[at] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        step *= 2
    a, b, length = suffix[pairs - 1], suffix[pairs], np.zeros(len(pairs), np.int64)
    classes = np.full(n + 1, -1, np.int64)
    for at, of in reversed(rounds):
        step //= 2
        classes[at] = of
        x, y = np.minimum(a + length, n), np.minimum(b + length, n)
        same = (classes[x] == classes[y]) & (classes[x] >= 0) & (x < end[a]) & (y < end[b])
        length[same] += step
        classes[at] = -1
    np.maximum.at(longest, a, length)
    np.maximum.at(longest, b, length)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in the union of spans."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth[:-1]) > 0


def repeated_lines(w: Words) -> np.ndarray:
    """Per text, its lines that hold a word and equal an earlier line of it."""
    cut = np.flatnonzero(w.buf == 0x0A)
    starts = np.sort(np.concatenate((w.offsets[:-1], cut + 1)))
    # A text that ends in a line break, or is empty, gives an empty line, which holds no word.
    ends = np.sort(np.concatenate((cut, w.offsets[1:])))
    has_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    owner = np.searchsorted(w.offsets, starts, "right") - 1
    line = rolled(w.buf, starts, ends, 0xD1342543DE82EF95, _BYTES)
    _, seen = np.unique(mix(line + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner, minlength=w.texts) - np.bincount(owner[seen], minlength=w.texts)


def measure(batch: pa.RecordBatch, min_repeat: int, max_covered: float, max_repeat: int) -> pa.RecordBatch:
    w = words(batch.column(1))
    counts, n = w.counts, len(w.starts)
    longest = longest_repeats(w.fingerprints(), w.first)
    five = np.flatnonzero(longest >= 5)
    long = np.flatnonzero(longest >= min_repeat)
    n_repeat = sums(covered(five, np.full(len(five), 5), n), w.first)
    n_covered = sums(covered(long, longest[long], n), w.first)
    most = np.zeros(w.texts, np.int64)
    np.maximum.at(most, w.owner(), longest)
    base_failed = (counts < 10) | (100 * n_repeat > 20 * counts)
    fits = (n_covered <= max_covered * counts) & (most <= max_repeat)
    columns = (
        batch.column(0), counts, sums(LEAD[w.buf] & ~SPACE[w.buf], w.offsets), sums(SYMBOLS[w.buf], w.offsets),
        repeated_lines(w), n_repeat, n_covered, most, base_failed, ~base_failed & fits,
    )
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names)


def repetition_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_repeat: int = 20, max_covered: float = 0.15, max_repeat: int = 60
) -> DataFrame:
    """Counts and verdict for each row of ``docs``.

    ``kept`` is false for texts of fewer than ten words, with over 20 % of words in five-word
    windows that occur twice, with over ``max_covered`` of words in repeats of ``min_repeat`` words
    or more, or with a repeat of over ``max_repeat`` words. Null and empty texts have no words and
    are not kept. Each row is judged on its own, so repeated rows and null keys give as many rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield measure(piece, min_repeat, max_covered, max_repeat)

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def drop_repetitive(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_repeat: int = 20, max_covered: float = 0.15, max_repeat: int = 60
) -> DataFrame:
    """The rows of ``docs`` that ``repetition_rules`` keeps, unchanged."""
    columns = [docs.columns.index(key), docs.columns.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                judged = pa.RecordBatch.from_arrays([piece.column(i) for i in columns], ["doc_id", "text"])
                yield piece.filter(measure(judged, min_repeat, max_covered, max_repeat).column("kept"))

    return docs.mapInArrow(run, docs.schema)

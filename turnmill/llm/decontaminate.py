"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping passages. A passage of m bytes that occurs in a text with at
most k edits shares m - q + 1 - k q of its q-grams with it, all on diagonals at most 2 k apart. Three
filters follow each other: a text region must hold that many q-grams of the benchmark at all; of one
passage within two neighbouring bands of diagonals; and a banded alignment must need k edits at most.

A part of a longer item is found if it holds a whole passage. With passages of 128 bytes, one every 64,
that is sure for unedited parts of 191 bytes or more; parts of under 128 bytes are not found.

Benchmark and texts are compared in lower case with white space runs as one space. The benchmark goes
to the executors in blocks of bounded size, one map over the texts for each block, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.llm.text import LEAD, LOWER, SPACE, buffers, pieces

Q, BITS, SEGMENT = 8, 22, 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, item_id long, start long, end long, n_passages long, edits long"


def normal(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in lower case with runs of white space as one space; new offsets; where each byte was."""
    space = SPACE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[offsets < len(buf)]] = True
    at = np.flatnonzero(keep)
    out = np.where(space[at], np.uint8(0x20), LOWER[buf[at]])
    # Capitals of Latin-1, whose second byte is 0x20 below that of the small letter.
    latin = np.flatnonzero(out[:-1] == 0xC3) + 1
    capital = latin[(out[latin] >= 0x80) & (out[latin] <= 0x9E) & (out[latin] != 0x97)]
    out[capital] += 32
    return out, np.searchsorted(at, offsets), at


def grams(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one number; shorter by 7 than the bytes."""
    two = buf[:-1].astype(np.uint64) | (buf[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


@dataclass
class Index:
    """q-grams of passages: sorted distinct codes, and for each the passages and places that hold it."""

    passages: list[np.ndarray]
    items: np.ndarray
    edits: np.ndarray
    shared: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    passage: np.ndarray
    place: np.ndarray
    bitmap: np.ndarray

    @property
    def longest(self) -> int:
        return max(map(len, self.passages))


def build(items: list[tuple[int, str]], window: int, step: int, rate: float, least: int) -> Index | None:
    """Index of the passages of items; items of under ``least`` bytes have none."""
    passages, owner = [], []
    for item, text in items:
        raw = np.frombuffer((text or "").strip().encode(), np.uint8)
        body = normal(raw, np.array([0, len(raw)]))[0] if len(raw) else raw
        if len(body) < least:
            continue
        last = max(0, len(body) - window)
        for start in sorted({*range(0, last, step), last}):
            passages.append(body[start : start + window])
            owner.append(item)
    if not passages:
        return None
    m = np.array([len(p) for p in passages])
    # The lemma must leave at least a quarter of a passage's q-grams in common.
    edits = np.minimum(np.floor(rate * m), np.floor((m - Q + 1) * 0.75 / Q)).astype(np.int64)
    code = np.concatenate([grams(p) for p in passages])
    passage = np.repeat(np.arange(len(m)), m - Q + 1)
    place = np.concatenate([np.arange(x - Q + 1) for x in m])
    order = np.argsort(code, kind="stable")
    codes, first = np.unique(code[order], return_index=True)
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[(codes * _ODD) >> np.uint64(64 - BITS)] = True
    return Index(
        passages, np.array(owner, np.int64), edits, m - Q + 1 - edits * Q, codes, np.append(first, len(code)), passage[order], place[order], bitmap
    )


def candidates(buf: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Passages and the lowest diagonal of a pair of bands that shares enough q-grams with them."""
    none = np.zeros(0, np.int64)
    if len(buf) < Q:
        return none, none
    code = grams(buf)
    hit = index.bitmap[(code * _ODD) >> np.uint64(64 - BITS)]
    for back in range(1, Q):  # grams that reach into the next text
        over = offsets[1:-1] - back
        hit[over[(over >= 0) & (over < len(hit))]] = False
    # Regions as long as a passage with all its edits that hold enough q-grams of any passages.
    reach = int((np.array([len(p) for p in index.passages]) + index.edits).max())
    upto = np.append(0, np.cumsum(hit, dtype=np.int32))
    end = np.minimum(np.arange(len(hit)) + reach, len(hit))
    dense = np.flatnonzero(upto[end] - upto[:-1] >= index.shared.min())
    if not len(dense):
        return none, none
    depth = np.bincount(dense, minlength=len(hit) + 1) - np.bincount(end[dense], minlength=len(hit) + 1)
    at = np.flatnonzero(hit & (np.cumsum(depth[:-1]) > 0))
    entry = np.minimum(np.searchsorted(index.codes, code[at]), len(index.codes) - 1)
    true = index.codes[entry] == code[at]
    at, entry = at[true], entry[true]
    # Diagonals can lie before the first byte.
    low = index.longest
    keys, shared = _banded(at, entry, index, low)
    after = np.searchsorted(keys, keys + 1)
    both = shared + np.where((after < len(keys)) & (keys[np.minimum(after, len(keys) - 1)] == keys + 1), shared[np.minimum(after, len(keys) - 1)], 0)
    passage = keys >> 40
    full = both >= index.shared[passage]
    # A band whose lower neighbour is empty may make a pair with it; its own count covers that pair.
    passage, band = passage[full], keys[full] & ((1 << 40) - 1)
    return passage, band * (2 * index.edits[passage] + 1) - low


def _banded(at: np.ndarray, entry: np.ndarray, index: Index, low: int, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Shared q-grams by passage and band of diagonals, key = passage << 40 | band; some hits at a time."""
    count = index.first[entry + 1] - index.first[entry]
    upto = np.cumsum(count)
    found = []
    for first in range(0, int(upto[-1]) if len(upto) else 0, most):
        some = slice(*np.searchsorted(upto, [first, first + most], "right"))
        n, total = count[some], int(count[some].sum())
        nth = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(index.first[entry[some]], n)
        passage, diagonal = index.passage[nth], np.repeat(at[some], n) - index.place[nth]
        band = (diagonal + low) // (2 * index.edits[passage] + 1)
        found.append(np.unique((passage << 40) | band, return_counts=True))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)


def align(
    buf: np.ndarray, lo: np.ndarray, hi: np.ndarray, patterns: list[np.ndarray], diagonal: np.ndarray, edits: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits between each pattern and a part of buf[lo:hi] whose diagonals lie in its band.

    The band holds the two neighbouring bands of the filter and ``edits`` more on either side.
    Returns the edits and the part's start and end; ties go to the earliest end and start. All
    patterns advance together, one letter at a time.
    """
    n, length = len(patterns), np.array([len(p) for p in patterns])
    width = int((2 * (2 * edits + 1) + 2 * edits).max())
    first = diagonal - edits
    letters = np.zeros((n, int(length.max())), np.uint8)
    for row, p in zip(letters, patterns, strict=True):
        row[: len(p)] = p
    place = first[:, None] + np.arange(width + letters.shape[1])
    inside = (place >= lo[:, None]) & (place < hi[:, None])
    text = np.where(inside, buf[np.clip(place, 0, len(buf) - 1)], 0)
    big = 1 << 12
    lane = np.arange(width, dtype=np.int32)
    cost = np.repeat(lane[None, :], n, 0)  # edits times big, plus the lane of the start
    final = cost.copy()
    for i in range(letters.shape[1]):
        step = cost + np.int32(big) * (text[:, i : i + width] != letters[:, i : i + 1])
        np.minimum(step[:, :-1], cost[:, 1:] + big, out=step[:, :-1])
        step -= big * lane
        cost = np.minimum.accumulate(step, 1)
        cost += big * lane
        done = length == i + 1
        final[done] = cost[done]
    best = np.argmin(final // big, 1)
    value = final[np.arange(n), best]
    return value // big, np.maximum(lo, first + value % big), np.minimum(hi, first + best + length)


def search(column: pa.Array, index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """Hits (row, item, start, end, passages, edits) in code points of the texts themselves."""
    raw, raw_offsets = buffers(column)
    if not len(raw):
        return []
    buf, offsets, origin = normal(raw, raw_offsets)
    # Long texts go segment by segment; segments overlap by twice what a passage can span.
    overlap, parts = 2 * (index.longest + int(index.edits.max())) + Q, []
    for low in range(0, len(buf), SEGMENT):
        part = buf[low : low + SEGMENT + overlap]
        passage, diagonal = candidates(part, np.clip(offsets - low, 0, len(part)), index)
        parts.append((passage, diagonal + low))
    passage, diagonal = (np.concatenate(x) for x in zip(*parts, strict=True))
    found: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    m, edits = np.array([len(p) for p in index.passages])[passage], index.edits[passage]
    # A band near a border between texts may belong to either side.
    head = np.searchsorted(offsets, np.clip(diagonal + edits, 0, len(buf) - 1), "right") - 1
    tail = np.searchsorted(offsets, np.clip(diagonal + m, 0, len(buf) - 1), "right") - 1
    pick = np.concatenate((np.arange(len(passage)), np.flatnonzero(head != tail)))
    rows = np.concatenate((head, tail[head != tail]))
    for a in range(0, len(pick), 1024):
        some, row = pick[a : a + 1024], rows[a : a + 1024]
        patterns = [index.passages[p] for p in passage[some]]
        needed, start, end = align(buf, offsets[row], offsets[row + 1], patterns, diagonal[some], edits[some])
        for i in np.flatnonzero(needed <= edits[some]).tolist():
            at = int(passage[some[i]])
            found.setdefault((int(row[i]), int(index.items[at])), []).append((int(start[i]), int(end[i]), at, int(needed[i])))
    out = []
    for (row, item), hits in sorted(found.items()):
        points = np.append(0, np.cumsum(LEAD[raw[raw_offsets[row] : raw_offsets[row + 1]]]))
        start, end = min(h[0] for h in hits), max(h[1] for h in hits)
        a = int(origin[start]) - int(raw_offsets[row])
        b = int(origin[end - 1]) + 1 - int(raw_offsets[row])
        out.append((row, item, int(points[a]), int(points[b]), len({h[2] for h in hits}), min(h[3] for h in hits)))
    return out


def indexes(benchmark: DataFrame, key: str, text: str, block_bytes: int, **options) -> Iterator[Index]:
    """Indexes of blocks of the benchmark, each of about ``block_bytes`` of text."""
    total = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for i in range(blocks):
        rows = benchmark.filter(F.pmod(F.xxhash64(key, text), F.lit(blocks)) == i).select(key, text).distinct().collect()
        if index := build(sorted((r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None), **options):
            yield index


def _options(window: int, step: int, rate: float, least: int) -> dict:
    return {"window": window, "step": step, "rate": rate, "least": least}


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = 128, step: int = 64, rate: float = 0.08, least: int = 24, block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row for each text and benchmark item of which it holds a passage.

    ``start`` and ``end`` span the passages in code points, ``n_passages`` counts them, ``edits`` is the
    fewest that one needs. Passages are ``window`` bytes every ``step``, or the whole of a shorter item;
    up to ``rate`` of their bytes may be edited,
    fewer in short ones, where a quarter of the q-grams must be left in common. Items under ``least`` bytes, null items and null or
    empty texts match nothing. Rows that repeat a key give their hits each.
    """
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for index in indexes(benchmark, item, item_text, block_bytes, **_options(window, step, rate, least)):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    hits = search(piece.column(1), index)
                    columns = [pa.array([h[i] for h in hits], pa.int64()) for i in range(6)]
                    columns[0] = piece.column(0).take(columns[0])
                    yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])

        out = out.union(rows.mapInArrow(run, SCHEMA))
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = 128, step: int = 64, rate: float = 0.08, least: int = 24, block_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows of ``docs`` without a passage of the benchmark, unchanged."""
    column = docs.columns.index(text)
    schema = docs.schema
    for index in indexes(benchmark, item, item_text, block_bytes, **_options(window, step, rate, least)):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, text):
                    clean = np.ones(piece.num_rows, bool)
                    clean[[h[0] for h in search(piece.column(column), index)]] = False
                    yield piece.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs

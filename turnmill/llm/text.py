"""Whole texts as numpy arrays: words, fingerprints and windows of many documents at once.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts stay in the buffers in
which Arrow delivers them; all positions are byte offsets until a caller converts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80
#: ASCII letters in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least n of each."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        have = tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)), dtype=np.uint64) for b in (base, inverse))
        _POWERS[base] = have
    return have


def rolled(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, table: np.ndarray | None = None, block: int = (1 << 20) - 1
) -> np.ndarray:
    """A fingerprint of values[start:end] for each span, equal for equal contents.

    ``table`` gives what stands for each value. Starts ascend; long arrays go block by block, so that
    memory follows the block and the longest span.
    """
    out = np.empty(len(starts), np.uint64)
    for low in range(0, len(values) + 1, block) if len(values) > block else (0,):
        mine = slice(*np.searchsorted(starts, [low, low + block])) if len(values) > block else slice(None)
        a, b = starts[mine] - low, ends[mine] - low
        if not len(a):
            continue
        part = values[low : low + int(b.max())] if len(values) > block else values
        part = part if table is None else table[part]
        up, down = powers(len(part) + 1, base)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[mine] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _ODD)
    return out


@dataclass
class Words:
    """The words of some texts: spans in buf, and for text i the words first[i]:first[i + 1]."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts), self.counts)

    def fingerprints(self, lower: bool = False) -> np.ndarray:
        return rolled(self.buf, self.starts, self.ends, 0xD1342543DE82EF95, _RANDOM[LOWER] if lower else _RANDOM)

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words(column: pa.Array) -> Words:
    buf, offsets = buffers(column)
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, offsets, none, none, np.zeros(len(offsets), np.int64))
    inside = ~SPACE[buf]
    edge = offsets[(offsets > 0) & (offsets < len(buf))]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edge] |= inside[edge]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[edge - 1] |= inside[edge - 1]
    starts = np.flatnonzero(opens)
    return Words(buf, offsets, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def windows(values: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows of k values that lie in one text, and where they start."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(first[1:], np.diff(first))
    starts = np.flatnonzero(np.arange(n) + k <= last)
    return rolled(values, starts, starts + k, 0xA3B195354A39B70D), starts


def pieces(batch: pa.RecordBatch, text: str = "text", most: int = (1 << 19) - 1) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of text, at least one row each."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        to = min(max(to, row + 1), batch.num_rows)
        yield batch.slice(row, to - row)
        row = to


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of values[first[i]:first[i + 1]] for each i, 0 for empty ranges."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def maxima(values: np.ndarray, first: np.ndarray, empty: float) -> np.ndarray:
    """The largest of values[first[i]:first[i + 1]] for each i."""
    out = np.full(len(first) - 1, empty, np.float64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.maximum.reduceat(values, first[full])
    return out

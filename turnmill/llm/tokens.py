"""Token ids of whole texts under a public byte-pair vocabulary.

The vocabulary's pattern never joins a character other than white space to white space after it, so
a text may be cut there, and each cut piece is encoded by itself. Pieces met before come from a table
of fixed size; only new ones are encoded.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

from turnmill.llm.text import SPACE, buffers, rolled, words

#: Fixed pattern of the public vocabularies that cuts texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
PLACES, POOL, CACHED = 1 << 19, 1 << 22, 64
#: Runs of white space of so many characters or more are encoded by themselves: the pattern would try every end of them.
LONG_RUN = 10_000
_SPACES = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The byte-pair vocabulary in a tiktoken file of base64 pieces and ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def other_spaces(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that may hold white space beyond ASCII, which the cuts do not know."""
    first = (buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3)) | ((buf >= 0x1C) & (buf <= 0x1F))
    at = np.flatnonzero(first)
    after = buf[np.minimum(at + 1, len(buf) - 1)]
    lead = buf[at]
    likely = (lead < 0x20) | ((lead == 0xC2) & ((after == 0x85) | (after == 0xA0))) | ((lead == 0xE1) & (after == 0x9A))
    likely |= ((lead == 0xE2) & ((after == 0x80) | (after == 0x81))) | ((lead == 0xE3) & (after == 0x80))
    return np.unique(np.searchsorted(offsets, at[likely], "right") - 1)


class Encoder:
    """Encodes batches of texts; the table of pieces has the same size for any input."""

    def __init__(self, path: str):
        self.encoding = encoding(path)
        #: The same vocabulary, merging over any text as one piece.
        self.whole = encoding(path, r"(?s:.)+")
        self.type = np.uint16 if self.encoding.n_vocab < 1 << 16 else np.uint32
        self.bytes = np.array([len(self.encoding.decode_single_token_bytes(i)) for i in range(self.encoding.n_vocab)])
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(PLACES, np.uint64)
        self.at = np.zeros(PLACES, np.int64)
        self.count = np.zeros(PLACES, np.int64)
        self.pool = np.zeros(POOL, self.type)
        self.used = 0

    def _encode(self, body: bytes) -> np.ndarray:
        text = body.decode()
        if len(text) < LONG_RUN:
            return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(self.type)
        parts, at = [], 0
        for run in re.finditer(f"{_SPACES}{{{LONG_RUN},}}", text):
            # The last space before a word belongs to what follows; the rest of a run is one piece of the pattern.
            end = run.end() - (run.end() < len(text))
            parts += [self._encode_plain(text[at : run.start()]), self.whole.encode_to_numpy(text[run.start() : end], disallowed_special=())]
            at = end
        return np.concatenate([*parts, self._encode_plain(text[at:])]).astype(self.type)

    def _encode_plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def _encode_all(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces; for each the place of its first and how many it has.

        Pieces between white space and a word's end can follow each other in one text, whose ids are
        dealt out by the bytes that they stand for. Others are encoded one by one.
        """
        last = buf[ends - 1]
        # Nor may a piece end in white space beyond ASCII, or in what could be.
        two, three = buf[np.maximum(ends - 2, 0)], buf[np.maximum(ends - 3, 0)]
        joins = SPACE[buf[starts]] & (last > 0x20) & (two != 0xC2) & ((three < 0xE1) | (three > 0xE3))
        a, size = starts[joins], (ends - starts)[joins]
        upto = np.cumsum(size)
        body = buf[np.arange(size.sum()) + np.repeat(a - upto + size, size)].tobytes()
        ids = self._encode(body)
        dealt = np.searchsorted(np.cumsum(self.bytes[ids]), upto) + 1
        alone = [self._encode(buf[x:y].tobytes()) for x, y in zip(starts[~joins].tolist(), ends[~joins].tolist(), strict=True)]
        count = np.empty(len(starts), np.int64)
        count[joins] = np.diff(dealt, prepend=0)
        count[~joins] = [len(x) for x in alone]
        own = np.concatenate((ids, *alone)).astype(self.type)
        at = np.empty(len(starts), np.int64)
        at[joins] = dealt - count[joins]
        at[~joins] = len(ids) + np.cumsum(count[~joins]) - count[~joins]
        return own, np.stack([at, count])

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        buf, offsets = buffers(column)
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, self.type), np.zeros(n + 1, np.int64)
        w = words(column)
        # A piece is the white space before a word and the word; what follows the last word is one more.
        starts = np.append(w.starts, 0)[:-1]
        starts[1:] = w.ends[:-1]
        head = w.first[:-1][np.diff(w.first) > 0]
        starts[head] = offsets[:-1][np.diff(w.first) > 0]
        last = np.where(np.diff(w.first) > 0, w.ends[np.maximum(w.first[1:], 1) - 1] if len(w.ends) else 0, offsets[:-1])
        tail = np.flatnonzero(last < offsets[1:])
        order = np.argsort(np.concatenate((starts, last[tail])), kind="stable")
        starts, ends = np.concatenate((starts, last[tail]))[order], np.concatenate((w.ends, offsets[1:][tail]))[order]
        whole = other_spaces(buf, offsets)
        if len(whole):
            mine = np.searchsorted(offsets, starts, "right") - 1
            apart = ~np.isin(mine, whole)
            starts = np.concatenate((starts[apart], offsets[whole]))
            ends = np.concatenate((ends[apart], offsets[whole + 1]))
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
        return self._pieces(buf, starts, ends, offsets)

    def _pieces(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = rolled(buf, starts, ends, 0xD1342543DE82EF95, _TABLE) | np.uint64(1)
        slot = (key >> np.uint64(45)).astype(np.int64)
        known = (self.keys[slot] == key) & (ends - starts <= CACHED)
        at, count = self.at[slot], self.count[slot]
        fresh = np.flatnonzero(~known)
        pool, used = self.pool, self.used
        if len(fresh):
            new, pick, back = np.unique(key[fresh], return_index=True, return_inverse=True)
            own, (place, size) = self._encode_all(buf, starts[fresh[pick]], ends[fresh[pick]])
            place = place + used
            pool = np.concatenate((pool[:used], own))
            at[fresh], count[fresh] = place[back], size[back]
            if len(pool) <= POOL:
                self.pool[used : len(pool)] = pool[used:]
                self.used = len(pool)
                to = (new >> np.uint64(45)).astype(np.int64)
                self.keys[to], self.at[to], self.count[to] = new, place, size
            else:
                self._clear()
        total = np.append(0, np.cumsum(count))
        take = np.arange(total[-1]) + np.repeat(at - total[:-1], count)
        return pool[take], total[np.searchsorted(starts, offsets)]


_HELD: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary."""
    if path not in _HELD:
        _HELD.clear()
        _HELD[path] = Encoder(path)
    return _HELD[path]

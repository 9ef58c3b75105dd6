"""Encoding and decoding with merge-type sentencepiece vocabularies.

A text begins as its characters, spaces written as the space mark. An agenda holds the adjacent symbols whose
joined text is a piece, the best score first and the leftmost of equal scores; the pair at its head is joined
and its neighbours enter the agenda, until it is empty. Characters outside the vocabulary become byte pieces.

Pieces of the vocabulary never hold the space mark after another character (that is looked up, not assumed),
so a text is cut before each run of space marks, and the agenda of each cut is its own. Cuts met before are
kept in a table of bounded size. Every batch is checked against the sentencepiece library, text by text.

A null text counts as an empty one, which has only the begin and end ids. Repeated keys stay rows of their own;
columns other than key and text are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from turnmill.llm.text import pieces

#: Fixed mark that stands for a space in pieces.
MARK = "▁"
#: What an unknown piece is decoded to.
UNKNOWN = " ⁇ "
HELD, LONGEST_HELD, BLOCK = 1 << 20, 64, 1 << 20
#: Symbol of a place whose character another symbol has taken, and rank and place of what joins to no piece.
TAKEN, NEVER = np.int32(-(1 << 31)), np.int32((1 << 31) - 1)
ID = np.dtype("<u4")
ODD = np.uint64(0x9E3779B97F4A7C15)


class Codec:
    """A merge-type vocabulary: its pieces by text, its agenda and its decoder."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        #: Rank of each piece, 0 for the best score.
        usual = [i for i in range(n) if not special[i] and not sp.is_byte(i)]
        if any(sp.is_unused(i) for i in usual):
            raise ValueError(f"{path} has unused pieces, which merges would have to take apart again")
        scores = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in usual}, reverse=True))}
        self.rank = {names[i]: scores[sp.get_score(i)] for i in usual}
        self.ids = {names[i]: i for i in usual}
        of_byte = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.of_byte = [of_byte.get(b, sp.unk_id()) for b in range(256)] if of_byte else None
        self.unknown, self.begin, self.end = sp.unk_id(), sp.bos_id(), sp.eos_id()
        self.bytes = [
            b"" if sp.is_control(i) else UNKNOWN.encode() if sp.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i)
            else names[i].replace(MARK, " ").encode() for i in range(n)
        ]
        self.texts = pa.array(self.bytes, pa.large_binary())
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.is_control = np.array([sp.is_control(i) for i in range(n)])
        if sp.normalize("A  b\téﬁ ") != f"{MARK}A{MARK}{MARK}b\téﬁ{MARK}":
            raise ValueError(f"{path} changes texts before it encodes them")
        apart = not any(MARK in name.lstrip(MARK) for name in self.ids)
        #: A cut without the mark that it begins with.
        self.cut = re.compile(f"{MARK}({MARK}*[^{MARK}]+|{MARK}*)" if apart else f"{MARK}((?s:.*))")
        self.apart = apart
        self._pairs()
        self.known: dict[str, bytes] = {}

    def _pairs(self) -> None:
        """Every two symbols that join to a piece, in a table with open addresses; characters known to no piece get negative symbols."""
        chars = sorted({c for name in self.ids for c in name} - self.ids.keys())
        n = len(self.bytes)
        symbol = self.ids | {c: n + i for i, c in enumerate(chars)}
        self.span = n + len(chars)
        keys, ranks, joined = [], [], []
        for name, i in self.ids.items():
            for at in range(1, len(name)):
                left, right = symbol.get(name[:at]), symbol.get(name[at:])
                if left is not None and right is not None:
                    keys.append(left * self.span + right)
                    ranks.append(self.rank[name])
                    joined.append(i)
        # A key lies in the first free place after its own. At most a quarter of the places are in use; free ones hold -1.
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.pair = np.full(1 << bits, -1, np.int64)
        self.pair_rank, self.pair_joined = np.full((2, 1 << bits), -1, np.int32)
        key, rank, join = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(joined, np.int32)
        left, at = np.arange(len(key)), self._place(key)
        while len(left):
            free = np.flatnonzero(self.pair[at[left]] < 0)
            put = left[free[np.unique(at[left[free]], return_index=True)[1]]]
            self.pair[at[put]], self.pair_rank[at[put]], self.pair_joined[at[put]] = key[put], rank[put], join[put]
            left = left[self.pair[at[left]] != key[left]]
            at[left] = (at[left] + 1) & self.last
        self.symbol = -1 - np.arange(0x110000, dtype=np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i

    def _place(self, key: np.ndarray) -> np.ndarray:
        """Where the table is searched for a key first."""
        return ((key.view(np.uint64) * ODD) >> self.shift).view(np.int64)

    def _meet(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether two symbols join to a piece, its rank and its symbol."""
        key = left.astype(np.int64) * self.span + right
        key[(left < 0) | (right < 0)] = -2
        at = self._place(key)
        have = self.pair[at]
        other = np.flatnonzero((have != key) & (have >= 0))
        while len(other):
            at[other] = (at[other] + 1) & self.last
            have[other] = found = self.pair[at[other]]
            other = other[(found != key[other]) & (found >= 0)]
        return have == key, self.pair_rank[at], self.pair_joined[at]

    def merge_many(self, cuts: list[str]) -> list[bytes]:
        """Ids of many short cuts, those of like length together."""
        out: list[bytes] = [b""] * len(cuts)
        sizes = np.array([len(c) for c in cuts])
        for low, high in ((0, 8), (8, 16), (16, LONGEST_HELD)):
            alike = np.flatnonzero((sizes > low) & (sizes <= high)).tolist()
            most = max(1, BLOCK // high)
            for row in range(0, len(alike), most):
                mine = alike[row : row + most]
                for i, ids in zip(mine, self._merge_alike([cuts[i] for i in mine], sizes[mine]), strict=True):
                    out[i] = ids
        return out

    def _merge_alike(self, cuts: list[str], sizes: np.ndarray) -> list[bytes]:
        """Ids of cuts. Each column of a matrix is the agenda of one cut, and every round pops all their heads."""
        n, width = len(cuts), int(sizes.max())
        rows = np.full((n, width), TAKEN, np.int32)
        rows[np.arange(width) < sizes[:, None]] = self.symbol[np.frombuffer("".join(cuts).encode("utf-32-le"), "<u4")]
        # Place p of cut c is p * n + c; the place after all others stands before the first and after the last of each cut.
        none = width * n
        symbols = np.append(rows.T, TAKEN)
        place = np.arange(none + 1, dtype=np.int32)
        before, after = place - n, np.minimum(place + n, none)
        before[:n] = none
        # An agenda entry is the rank of a place's pair, then the place in the cut.
        agenda, joined = np.full(none + 1, NEVER), np.full(none + 1, -1, np.int32)

        def enter(at: np.ndarray, then: np.ndarray) -> None:
            hit, rank, join = self._meet(symbols[at], symbols[then])
            agenda[at] = np.where(hit, rank * LONGEST_HELD + at // n, NEVER)
            joined[at] = join

        enter(place[: none - n], place[n:none])
        heads = agenda[:none].reshape(width, n)
        while True:
            head = heads.min(0)
            left = np.flatnonzero(head < NEVER)
            if not len(left):
                break
            at = head[left] % LONGEST_HELD * n + left
            gone = after[at]
            # The pair at the head becomes one symbol, and its neighbours enter the agenda.
            symbols[at], symbols[gone], agenda[gone] = joined[at], TAKEN, NEVER
            leads, follows = before[at], after[gone]
            after[at], before[follows] = follows, at
            enter(np.concatenate([leads, at]), np.concatenate([at, follows]))
        rows = np.ascontiguousarray(symbols[:none].reshape(width, n).T)
        inside = rows != TAKEN
        if self.of_byte:
            plain = (rows < 0) & (rows >= -128)
            rows[plain] = np.array(self.of_byte[:128], np.int32)[-1 - rows[plain]]
        body = rows[inside].astype(ID).tobytes()
        ends = (np.cumsum(inside.sum(1)) * 4).tolist()
        out = [body[a:b] for a, b in pairwise([0, *ends])]
        # Other characters that are no pieces become several bytes.
        for i in np.flatnonzero((inside & ((rows < 0) | (rows >= len(self.bytes)))).any(1)).tolist():
            out[i] = self._ids(self.merge(cuts[i]))
        return out

    def merge(self, text: str) -> list[str]:
        """The pieces of a text whose spaces are marks."""
        rank, symbols = self.rank, list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            if (r := rank.get(symbols[i] + symbols[i + 1])) is not None:
                agenda.append((r, i, i + 1, len(symbols[i]) + len(symbols[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, ""
            follows = after[left] = after[right]
            if follows < n:
                before[follows] = left
                if (r := rank.get(a + b + symbols[follows])) is not None:
                    heapq.heappush(agenda, (r, left, follows, size + len(symbols[follows])))
            leads = before[left]
            if leads >= 0 and (r := rank.get(symbols[leads] + a + b)) is not None:
                heapq.heappush(agenda, (r, leads, left, size + len(symbols[leads])))
        return [s for s in symbols if s]

    def _ids(self, merged: list[str]) -> bytes:
        ids: list[int] = []
        for piece in merged:
            if (i := self.ids.get(piece)) is not None:
                ids.append(i)
            elif self.of_byte:
                ids += [self.of_byte[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return np.array(ids, ID).tobytes()

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Parts of about a million characters, each but the first beginning with a space after another character."""
        at = 0
        while at < len(text):
            to = at + BLOCK
            found = re.compile(f"(?<=[^ {MARK}])[ {MARK}]").search(text, to) if to < len(text) else None
            to = found.start() if found else len(text)
            yield at, to
            at = to

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts between the begin and end ids, as little-endian unsigned 32-bit integers."""
        begin, end = (np.array([i], ID).tobytes() for i in (self.begin, self.end))
        out, row, size = [], [], 0
        for i, text in enumerate(texts):
            out.append([begin])
            for a, b in self.spans(text):
                row.append((i, self._cuts(text[a:b] if a else " " + text[a:b])))
                size += len(row[-1][1])
                if size >= BLOCK // 4:
                    self._join(row, out)
                    size = 0
        self._join(row, out)
        return [b"".join([*parts, end]) for parts in out]

    def _cuts(self, part: str) -> list[str]:
        """The cuts of a text that begins with a space or mark, each without its first mark."""
        if self.apart and "  " not in part and MARK not in part:
            return part[1:].split(" ")
        return self.cut.findall(part.replace(" ", MARK))

    def _join(self, row: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        """Encode cut parts of texts: cuts not met before together, then each part from the table."""
        every = list(chain.from_iterable([cuts for _, cuts in row]))
        found = list(map(self.known.get, every))
        missing = [at for at, ids in enumerate(found) if ids is None]
        fresh = {every[at] for at in missing}
        short = [c for c in fresh if len(c) < LONGEST_HELD]
        made = dict(zip(short, self.merge_many([MARK + c for c in short]), strict=True))
        if len(self.known) + len(made) > HELD:
            self.known.clear()
        self.known |= made
        made |= {c: self._ids(self.merge(MARK + c)) for c in fresh if len(c) >= LONGEST_HELD}
        for at in missing:
            found[at] = made[every[at]]
        at = 0
        for i, cuts in row:
            out[i].append(b"".join(found[at : at + len(cuts)]))
            at += len(cuts)
        row.clear()

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        return self.decode_many([ids])[0]

    def decode_many(self, ids: list[bytes]) -> list[str]:
        """The texts of ids. Byte pieces that make no character become one replacement character each."""
        every = np.frombuffer(b"".join(ids), ID)
        first = np.cumsum([0, *[len(x) // 4 for x in ids]])
        taken = self.texts.take(pa.array(every))
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64, len(every) + 1)[first].tolist()
        body = memoryview(data or b"")
        # A control piece parts the byte pieces beside it.
        control = np.flatnonzero(self.is_control[every])
        owner = np.searchsorted(first, control, "right") - 1
        parted = set(owner[(control > first[owner]) & (control < first[owner + 1] - 1)].tolist())
        out = []
        for i, (a, b) in enumerate(pairwise(first.tolist())):
            try:
                text = self._decode_bytes(every[a:b]) if i in parted else str(body[ends[i] : ends[i + 1]], "utf-8")
            except UnicodeDecodeError:
                text = self._decode_bytes(every[a:b])
            # The first space mark stands for the start of the text, unless a byte or unknown piece comes first.
            head = next((x for x in every[a:b] if not self.is_control[x]), None)
            starts = head is not None and not self.is_byte[head] and int(head) != self.unknown
            out.append(text[1:] if starts and text.startswith(" ") else text)
        return out

    def _decode_bytes(self, at: np.ndarray) -> str:
        out, row = [], 0
        inside = self.is_byte[at]
        while row < len(at):
            to = row + 1
            while to < len(at) and inside[to] == inside[row]:
                to += 1
            body = b"".join(self.bytes[i] for i in at[row:to].tolist())
            out.append(_characters(body) if inside[row] else body.decode())
            row = to
        return "".join(out)

    def agrees(self, text: str, ids: bytes, decoded: str) -> bool:
        """Whether the library encodes and decodes alike, part by part of a long text."""
        sp = self.library
        parts = list(self.spans(text))
        # A later part's leading space is what the library puts before any text.
        own = [sp.encode(text[a + bool(a) : b], out_type="numpy") for a, b in parts]
        theirs = np.concatenate([np.array([self.begin], ID), *(x.view(ID) for x in own), np.array([self.end], ID)])
        said = " ".join(sp.decode(x) for x in own)
        return theirs.tobytes() == ids and said == decoded


def _characters(body: bytes) -> str:
    """UTF-8 bytes as text, one replacement character for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(body):
        for size in (1, 2, 3, 4):
            try:
                out.append(body[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_LOADED: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec of a vocabulary."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encode_and_decode(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, ids, decoded, agrees) of each whole text.

    ``ids`` are little-endian unsigned 32-bit integers with the begin and end ids, ``decoded`` is their text, and
    ``agrees`` says whether the sentencepiece library gives the same ids and text. ``vocabulary`` is a file that
    every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            for piece in pieces(batch, "body"):
                texts = [x or "" for x in piece.column(1).to_pylist()]
                ids = own.encode_many(texts)
                decoded = own.decode_many(ids)
                same = [own.agrees(*x) for x in zip(texts, ids, decoded, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string()), pa.array(same)], ["key", "ids", "decoded", "agrees"]
                )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids binary, decoded string, agrees boolean").withColumnRenamed("key", key)

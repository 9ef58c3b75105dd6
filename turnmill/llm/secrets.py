"""Secret scans: three fixed forms, and random strings told by a token-efficiency test.

Prose gives a public byte-pair vocabulary several characters a token, a random string about two.
Unbroken strings that yield few characters a token are reported, unless they are a known digest,
an identifier of words, a number, an address or a path; so are such parts of longer strings, behind a path or name.

One map over the texts, without a shuffle. All forms are searched as bytes; only texts in which
something is found have their positions counted in code points.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from turnmill.llm.text import LEAD, LOWER, buffers, pieces

#: Fixed patterns of the three forms and their least lengths.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")
#: What a value is looked for behind.
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Bytes that a random string may hold.
BODY = np.zeros(256, bool)
BODY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
HEXES = np.zeros(256, bool)
HEXES[list(b"0123456789abcdef")] = True
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(rb"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
HASH = re.compile(rb"(?:sha(?:1|224|256|384|512)|md5)-[A-Za-z0-9+/_-]+=*|[0-9A-Fa-f]+")
#: Words in one case or with capitals, each with a short number at most, held together by separators.
_SEGMENT = rb"(?:[A-Za-z]|[a-z]*(?:[A-Z][a-z]{2,})*|[A-Z]+)[0-9]{0,4}"
WORDS = re.compile(_SEGMENT + rb"(?:[+/_=-]" + _SEGMENT + rb")*")
NUMBER = re.compile(rb"[0-9+/_=-]+")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-pair vocabulary in a file of base64 pieces and ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=r"[^\r\n]+", mergeable_ranks=ranks, special_tokens={})


def runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true of at least so many bytes that lie in one text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = offsets[(offsets > 0) & (offsets < len(inside))]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edge] |= inside[edge]
    closes[:-1] &= ~inside[1:]
    closes[edge - 1] |= inside[edge - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def known(value: bytes) -> bool:
    """Whether a string is a digest, an identifier made of words, a number or a UUID."""
    if UUID.fullmatch(value) or NUMBER.fullmatch(value):
        return True
    if (m := HASH.fullmatch(value)) and (len(value) in DIGESTS or m.group().startswith((b"sha", b"md5"))):
        return True
    return bool(WORDS.fullmatch(value))


def looks_random(value: bytes, tokens: tiktoken.Encoding, most_ratio: float, block: int = 1024) -> bool:
    """Few characters a token, of a string that is not a known kind.

    Strings over ``block`` bytes are encoded block by block, as merging is slow on long strings.
    """
    if known(value):
        return False
    n = sum(len(tokens.encode_ordinary(value[i : i + block].decode("ascii"))) for i in range(0, len(value), block))
    return len(value) < most_ratio * n


#: What holds the parts of names and paths together.
JOINT = re.compile(rb"[+/_=-]")


def random_span(value: bytes, tokens: tiktoken.Encoding, least: int, most_ratio: float) -> tuple[int, int] | None:
    """Where a random string lies in an unbroken string, if it holds one.

    The whole is tested first; then what is left without the words at its front and end, as a name or path before
    a secret would hide it; then each part between joints, the longest first. Strings of a known kind are none.
    """
    if looks_random(value, tokens, most_ratio):
        return 0, len(value)
    if known(value):
        return None
    bounds = [-1, *[m.start() for m in JOINT.finditer(value)], len(value)]
    parts = [(a + 1, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a + 1]
    odd = [i for i, (a, b) in enumerate(parts) if not WORDS.fullmatch(value[a:b])]
    if not odd:
        return None
    spans = [(parts[odd[0]][0], len(value)), (parts[odd[0]][0], parts[odd[-1]][1])]
    spans += sorted((parts[i] for i in odd), key=lambda x: (x[0] - x[1], x[0]))
    for a, b in spans:
        if least <= b - a < len(value) and looks_random(value[a:b], tokens, most_ratio):
            return a, b
    return None


def fixed_forms(body: bytes) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the three forms in a text's bytes."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(body) if m.end(1) - m.start(1) >= LEAST["assign"]]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(body) if m.end() - m.start() >= LEAST[KINDS[kind]]]
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(batch: pa.RecordBatch, tokens: tiktoken.Encoding, least: int, most_ratio: float) -> pa.RecordBatch:
    buf, offsets = buffers(batch.column(1))
    n = batch.num_rows
    data, lower = buf.tobytes(), LOWER[buf].tobytes()
    hit = np.zeros(n, bool)
    for body, name in [(lower, x) for x in NAMES] + [(data, b"AKIA")]:
        at = body.find(name)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            hit[row] = True
            at = body.find(name, int(offsets[row + 1]))
    starts, _ = runs(HEXES[buf], offsets, LEAST["hex"])
    hit[np.searchsorted(offsets, starts, "right") - 1] = True
    found: dict[int, list[tuple[int, int, int]]] = {}
    for row in np.flatnonzero(hit).tolist():
        if spans := fixed_forms(data[offsets[row] : offsets[row + 1]]):
            found[row] = spans
    base = {row: list(spans) for row, spans in found.items()}
    starts, ends = runs(BODY[buf], offsets, least)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if not (span := random_span(data[start:end], tokens, least, most_ratio)):
            continue
        row = int(np.searchsorted(offsets, start, "right")) - 1
        a, b = start + span[0] - int(offsets[row]), start + span[1] - int(offsets[row])
        # A fixed form that overlaps reports the string already.
        if not any(x < b and a < y for x, _, y in base.get(row, ())):
            found.setdefault(row, []).append((a, 3, b))
    counts = np.zeros((4, n), np.int64)
    empty = hashlib.sha256(b"").hexdigest()
    digests, listed = [empty] * n, [""] * n
    for row, spans in found.items():
        points = np.concatenate(([0], np.cumsum(LEAD[buf[offsets[row] : offsets[row + 1]]])))
        spans = [(int(points[a]), k, int(points[b])) for a, k, b in spans]
        for _, k, _ in spans:
            counts[k, row] += 1
        digests[row] = hashlib.sha256(_listed([x for x in spans if x[1] < 3]).encode()).hexdigest()
        listed[row] = _listed(spans)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(listed, pa.string())], names)


def find_secrets(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", least: int = 16, most_ratio: float = 2.3
) -> DataFrame:
    """Secrets in each text: counts per kind, all spans, and a digest of those of the fixed forms.

    ``vocabulary`` is the path of a tiktoken file that every executor can read. Strings of
    ``least`` bytes or more with under ``most_ratio`` characters a token are random. Null and empty
    texts have no spans. Every row of ``docs`` gives one row, also with a null or repeated key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(vocabulary)
        for batch in batches:
            for piece in pieces(batch):
                yield scan(piece, tokens, least, most_ratio)

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, SCHEMA)

"""Importance resampling towards a target: the documents whose words look most like the target's.

Words come with their offsets from an untrained split of the ``tokenizers`` library over text in ASCII lower
case. A feature is a run of consecutive words, taken from a pair of offsets and joined by single spaces; it
counts in the bucket of its CRC-32. The gain of a bucket is the log of its share in the target over its share
in the documents, a document's weight is the mean gain of its features, and documents are drawn without
replacement by weight plus Gumbel noise that a hash of the key fixes.

Null texts count as empty and null keys as an empty text in the noise; documents without features weigh 0.
Repeated keys are documents of their own; equal scores go by key (null last), then by a hash of the text.
Without target texts, every bucket has the count 0 there. Other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, pre_tokenizers

from turnmill.llm.text import pieces
from turnmill.operators.ordering import block_positions
from turnmill.workspace import Workspace

#: Fixed pattern of words: ASCII letters and digits, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes that never belong to a word; texts are cut there.
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
BLOCK, HELD = 1 << 18, 1 << 19


@lru_cache(maxsize=1)
def splitter() -> pre_tokenizers.Split:
    """Keeps what the pattern matches and drops the rest."""
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def blocks(body: bytes, most: int = BLOCK) -> Iterator[str]:
    """A text of ASCII lower case in parts of about ``most`` bytes that no word crosses."""
    at = 0
    while at < len(body):
        to = at + most
        if to < len(body):
            ahead = _OUTSIDE[np.frombuffer(body, np.uint8, min(most, len(body) - to), to)]
            while not ahead.any() and to < len(body):
                to += most
                ahead = _OUTSIDE[np.frombuffer(body, np.uint8, min(most, len(body) - to), to)] if to < len(body) else ahead
            to = to + int(ahead.argmax()) if to < len(body) else len(body)
        yield body[at:to].decode()
        at = to


def windows_of(words: list[tuple[str, tuple[int, int]]], text: str, n: int) -> Iterator[str]:
    """Runs of n words, from the offsets of their first and last word.

    Where a single space parts all words of a run it is a slice of the text; else its words are joined.
    """
    for i in range(len(words) - n + 1):
        run = words[i : i + n]
        start, end = run[0][1][0], run[-1][1][1]
        width = sum(b - a for _, (a, b) in run) + n - 1
        body = text[start:end]
        yield body if end - start == width and body.count(" ") == n - 1 else " ".join(w for w, _ in run)


class Features:
    """The buckets of texts; features met before are kept in a table of bounded size."""

    def __init__(self, buckets: int, most: int):
        self.buckets, self.most, self.known = buckets, most, {}
        self.type = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def _bucket(self, feature: str) -> int:
        if len(self.known) >= HELD:
            self.known.clear()
        at = zlib.crc32(feature.encode()) % self.buckets
        if len(feature) <= 64:
            self.known[feature] = at
        return at

    def __call__(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words of a text, and the bucket of each feature."""
        split, get, bucket = splitter().pre_tokenize_str, self.known.get, self._bucket
        n_words, parts, before = 0, [], []
        for part in blocks(text.encode().lower()):
            words = split(part)
            n_words += len(words)
            found = [at if (at := get(w)) is not None else bucket(w) for w, _ in words]
            parts.append(np.array(found, self.type))
            if self.most > 1:
                # Runs that began in the part before: its last words, moved in front of this part.
                head = " ".join(w for w, _ in before) + " " if before else ""
                spans = [(w, (a + len(head), b + len(head))) for w, (a, b) in words]
                at, led = 0, []
                for w, _ in before:
                    led.append((w, (at, at + len(w))))
                    at += len(w) + 1
                joined, row = head + part, led + spans
                for n in range(2, self.most + 1):
                    runs = windows_of(row[max(0, len(led) - n + 1) :], joined, n)
                    parts.append(np.array([at if (at := get(r)) is not None else bucket(r) for r in runs], self.type))
                before = row[-(self.most - 1) :]
        return n_words, np.concatenate(parts) if parts else np.zeros(0, self.type)


def featurize(docs: DataFrame, key: str, text: str, buckets: int, most: int) -> DataFrame:
    """Rows (key, name, n_words, features): bucket numbers as little-endian integers, name a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets, most)
        for batch in batches:
            for piece in pieces(batch, "body"):
                got = [features(x or "") for x in piece.column(1).to_pylist()]
                counts, bodies = pa.array([n for n, _ in got], pa.int64()), pa.array([x.tobytes() for _, x in got], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), counts, bodies], ["key", "name", "n_words", "features"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("body"), F.xxhash64(docs[text]).alias("name"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, name long, n_words long, features binary")


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; one row per bucket reaches the driver."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column(0):
                total += np.bincount(np.frombuffer(body.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of each bucket's smoothed share in the target over that in the source, rounded down."""
    s, t, n = source.tolist(), target.tolist(), len(source)
    whole_s, whole_t = sum(s) + n, sum(t) + n
    return np.array([math.floor(1000 * math.log((b + 1) * whole_s / ((a + 1) * whole_t))) for a, b in zip(s, t, strict=True)], np.int64)


def weigh(features: DataFrame, table: np.ndarray) -> DataFrame:
    """Rows (key, name, n_words, n_features, weight): the floored mean gain of each document's features."""
    kind = np.dtype("<u2") if len(table) <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(body.as_buffer(), kind) for body in batch.column(3)]
            counts = np.array([len(x) for x in rows], np.int64)
            sums = np.array([int(table[x].sum()) for x in rows], np.int64)
            weight = np.where(counts > 0, sums // np.maximum(counts, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts), pa.array(weight)], ["key", "name", "n_words", "n_features", "weight"]
            )

    kind_of_key = features.schema["key"].dataType.simpleString()
    return features.mapInArrow(run, f"key {kind_of_key}, name long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    words: int = 1,
    buckets: int = 10_000,
    share: int = 10,
    least: int = 20,
    seed: int = 2024,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Score every document by its likeness to ``target`` and rank those drawn.

    Features are runs of 1 to ``words`` words; of the documents with ``least`` words or more, ``share`` percent
    are drawn, rounded down. Returns (key, n_words, n_features, weight, score, rank), rank null where not drawn.
    The driver holds one count per bucket and per distinct score; scores lie within some 60,000 values.
    """
    space = Workspace(docs.sparkSession)
    features = space.table(featurize(docs, key, text, buckets, words), "features")
    asked = featurize(target.select(target[target_text].alias("body")).withColumn("key", F.lit(0)), "key", "body", buckets, words)
    table = gains(histogram(features, buckets), histogram(asked, buckets))
    h = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256), F.lit(8)), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = space.table(weigh(features, table).withColumn("score", F.col("weight") + noise.cast("long")), "scored")

    able = F.col("n_words") >= least
    counts = sorted(((r["score"], r["n"]) for r in scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = sum(n for _, n in counts) * share // 100
    cut, reached = None, 0
    for cut, n in counts:
        reached += n
        if reached >= wanted:
            break
    near = F.lit(False) if not wanted else able & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), "name", "row"]
    first = scored.filter(near).withColumn("row", F.monotonically_increasing_id()).orderBy(*order)
    first = space.table(first.withColumn("seq", F.monotonically_increasing_id()), "ranked").withColumn("part", F.shiftright("seq", 33))
    first = block_positions(first, ["part"], {"seq": "position"})
    rank = F.when(F.col("position") < wanted, F.col("position") + 1)
    columns = [F.col("key").alias(key), "n_words", "n_features", "weight", "score"]
    rest = scored.filter(~near).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.select(*columns, rank.alias("rank")).unionByName(rest)

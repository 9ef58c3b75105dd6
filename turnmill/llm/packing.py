"""Token-id output: best-fit-decreasing packing of documents into rows of a fixed length.

Documents are encoded under a public vocabulary, closed with an end id, and cut into parts of at most
one row. Parts are dealt by hash over shards of bounded size; in each shard the longest part goes
first, into the fullest row that still has room, which a segment tree over free lengths finds.

The number of shards follows from the bytes of all texts and ``shard_bytes``, so a shard is one small
task at any input size, and neither a hot key nor a very long document fills one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.llm.text import pieces
from turnmill.llm.tokens import encoder

PARTS = "doc_id long, part int, ids binary, shard long"
ROWS = (
    "shard long, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, parts array<int>"
)


class FreeLengths:
    """Open rows by free length, in a segment tree whose nodes tell whether any row lies below."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.some = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.size
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return a row of the least free length that is enough: (free, row)."""
        node = least + self.size
        if not self.some[node]:
            # Up until a subtree on the right holds a row, then down its left edge.
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        free = node - self.size
        row = self.rows[free].pop()
        if not self.rows[free]:
            self.some[node] = 0
            while node > 1:
                node >>= 1
                if self.some[2 * node] or self.some[2 * node + 1]:
                    break
                self.some[node] = 0
        return free, row


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Rows of items, in the order in which they went in; lengths must not increase."""
    rows: list[list[int]] = []
    open_rows = FreeLengths(most)
    for item, n in enumerate(lengths):
        free, row = open_rows.take(n) or (most, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(item)
        if free > n:
            open_rows.add(free - n, row)
    return rows


def pack_shard(shard: pa.Table, length: int, pad: int, width: int) -> Iterator[dict]:
    """The rows of one shard. Its order does not depend on the order in which parts arrive."""
    parts = zip(shard["doc_id"].to_pylist(), shard["part"].to_pylist(), shard["ids"].to_pylist(), strict=True)
    items = sorted(parts, key=lambda x: (-len(x[2]), x[0] is None, x[0] or 0, x[1], x[2]))
    number = shard["shard"][0].as_py()
    filler = pad.to_bytes(width, "little")
    for i, row in enumerate(best_fit([len(x[2]) // width for x in items], length)):
        sizes = [len(items[j][2]) // width for j in row]
        ends = np.cumsum(sizes).tolist()
        yield {
            "shard": number, "row": i, "n_tokens": ends[-1],
            "ids": b"".join(items[j][2] for j in row) + filler * (length - ends[-1]),
            "cu_seqlens": [0, *ends], "position_resets": [0, *ends[:-1]],
            "doc_ids": [items[j][0] for j in row], "parts": [items[j][1] for j in row],
        }


def encode_parts(docs: DataFrame, vocabulary: str, shards: int, length: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, part, ids, shard): each text's ids and an end id, cut into parts of one row at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for piece in pieces(batch):
                ids, at = encode(piece.column(1))
                keys, out = piece.column(0).to_pylist(), []
                for i, k in enumerate(keys):
                    own = np.append(ids[at[i] : at[i + 1]], encode.type(end_id))
                    out += [(k, n, own[n * length : (n + 1) * length].tobytes()) for n in range(-(-len(own) // length))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())],
                    ["doc_id", "part", "ids"],
                )

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    # The text's own hash deals rows that repeat a key, and parts of one text, over all shards.
    spread = F.pmod(F.xxhash64("doc_id", "part", "ids"), F.lit(shards))
    return rows.mapInArrow(run, "doc_id long, part int, ids binary").withColumn("shard", spread)


def pack_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", length: int = 2048, end_id: int = 50256,
    pad_id: int = 50256, shard_bytes: int = 4 << 20,
) -> DataFrame:
    """Rows of ``length`` token ids: the packed id matrix of each shard, row by row.

    ``ids`` holds little-endian ids, two bytes each for vocabularies under 65,536 ids and four else,
    padded with ``pad_id`` beyond ``n_tokens``. ``cu_seqlens`` are the cumulative lengths of the row's
    segments, ``position_resets`` the places at which positions begin again at 0, ``doc_ids`` and
    ``parts`` tell whose ids they are. No id is lost: a document's parts in order are its ids and
    ``end_id``. Null and empty texts are an ``end_id`` alone. Rows that repeat a key are packed each.
    Reruns agree. Empty input gives no rows. ``write_packed`` keeps the result as files.
    """
    total = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    parts = encode_parts(docs, vocabulary, shards, length, end_id, key, text)

    def run(shard: pa.Table) -> pa.Table:
        width = encoder(vocabulary).type().itemsize
        rows = list(pack_shard(shard, length, pad_id, width))
        return pa.Table.from_pylist(rows, schema)

    ints = pa.list_(pa.int32())
    schema = pa.schema([
        ("shard", pa.int64()), ("row", pa.int32()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", ints),
        ("position_resets", ints), ("doc_ids", pa.list_(pa.int64())), ("parts", ints),
    ])
    # Tasks hold 64 shards at most, or fewer if the session deals out more partitions.
    spread = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // 64))
    return parts.repartition(spread, "shard").groupBy("shard").applyInArrow(run, ROWS)


def write_packed(packed: DataFrame, path: str) -> None:
    """One folder per shard; within it the rows of its matrix in order."""
    packed.sortWithinPartitions("shard", "row").write.partitionBy("shard").mode("errorifexists").parquet(path)


def matrix(rows: list, length: int, width: int = 2) -> np.ndarray:
    """The id matrix of a shard's rows."""
    body = b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["row"]))
    return np.frombuffer(body, f"<u{width}").reshape(-1, length)


def positions(cu_seqlens: list[int], length: int) -> np.ndarray:
    """Position of each id of a row in its segment; padding counts on from 0."""
    bounds = np.append(cu_seqlens, length) if cu_seqlens[-1] < length else np.array(cu_seqlens)
    return np.arange(length) - np.repeat(bounds[:-1], np.diff(bounds))

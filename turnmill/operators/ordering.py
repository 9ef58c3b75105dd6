"""Dense positions, exact k-th keys and seeded order without a global sort.

A window over the whole table would put it in one task. These helpers need only one
small count per block or per key range on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructType

from turnmill.workspace import Workspace

_IN_PARTITION = (1 << 33) - 1


def seeded_key(seed: int, id_col: Column) -> Column:
    """A 60-bit pseudo-random key of an id: the seed fixes the order of all rows."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), id_col.cast("string")))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("long")


def coin(seed: int, id_col: Column) -> Column:
    """A uniform number in [0, 1) per id, the same wherever the row is computed."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), id_col.cast("string")))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") / F.lit(4294967296.0)


def kth_key(df: DataFrame, key: str, tie: str, k: int, small: int = 100_000) -> tuple | None:
    """The k-th smallest ``(key, tie)`` of a table, for a 60-bit non-negative key.

    Narrows the key range 16 bits at a time: each pass collects at most 65,536
    counts, until the range holding the k-th row is small enough to sort.
    """
    if k <= 0:
        return None
    inside = df.select(key, tie)
    rank, shift = k, 60
    while True:
        shift = max(0, shift - 16)
        part = F.shiftright(key, shift)
        counts = sorted(inside.groupBy(part.alias("part")).count().collect())
        for prefix, n in counts:
            if rank <= n:
                break
            rank -= n
        else:
            return None
        inside = inside.filter(part == prefix)
        if n <= small or shift == 0:
            break
    row = (
        inside.orderBy(key, tie)
        .limit(rank)
        .agg(F.max(F.struct(key, tie)).alias("last"))
        .first()
    )
    return tuple(row["last"])


def at_or_before(key: str, tie: str, cut: tuple | None) -> Column:
    """Whether a row sorts at or before a cut returned by :func:`kth_key`."""
    if cut is None:
        return F.lit(False)
    return (F.col(key) < cut[0]) | ((F.col(key) == cut[0]) & (F.col(tie) <= F.lit(cut[1])))


def block_positions(df: DataFrame, block: list[str], seqs: dict[str, str]) -> DataFrame:
    """Turn per-task sequence numbers into dense 0-based positions.

    ``block`` columns name a contiguous piece of input that one task reads whole and
    sort in input order; ``seqs`` maps a ``monotonically_increasing_id`` column, null on
    rows it does not count, to the position column to add. Only one count per block
    is shuffled; its side of the join has one row per block.
    """
    aggs = []
    for seq in seqs:
        aggs += [F.count(seq).alias(f"n_{seq}"), F.min(seq).alias(f"min_{seq}")]
    blocks = df.groupBy(*block).agg(*aggs)
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.xxhash64(*block).alias("_block_key"),
        *[
            (F.coalesce(F.sum(f"n_{s}").over(before), F.lit(0)) - F.coalesce(f"min_{s}", F.lit(0)))
            .alias(f"off_{s}")
            for s in seqs
        ],
    )
    out = df.withColumn("_block_key", F.xxhash64(*block)).join(offsets, "_block_key")
    for seq, pos in seqs.items():
        out = out.withColumn(pos, F.col(seq) + F.col(f"off_{seq}"))
    return out.drop("_block_key", *[f"off_{s}" for s in seqs])


def dense_rank_of(ids: DataFrame, key: str, out: str, ws: Workspace) -> DataFrame:
    """0-based rank of each (unique) key, from a range-partitioned sort."""
    ranged = ws.table(
        ids.select(key).orderBy(key).withColumn("_seq", F.monotonically_increasing_id()), "ranked"
    )
    ranged = ranged.withColumn("_part", F.shiftright("_seq", 33))
    return block_positions(ranged, ["_part"], {"_seq": out}).drop("_seq", "_part")


def running_sum(df: DataFrame, order: list[str], weight: str, out: str, ws: Workspace) -> DataFrame:
    """Add ``out``, the sum of the non-negative long ``weight`` up to and with each row in the order of all rows.

    A weighted prefix sum in two passes: rows are sorted into ranges and summed up within each range as they are
    written; then each range gets the sum of all before it, from one row per range. ``order`` should be unique, or
    equal rows come in any order. Pass narrow rows.
    """

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            sums = np.cumsum(batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False)) + total
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.int64()), pa.array(np.full(len(sums), part, np.int64))], [*batch.schema.names, "_sum", "_range"]
            )

    schema = StructType([*df.schema.fields]).add("_sum", LongType()).add("_range", LongType())
    ranged = ws.table(df.orderBy(*order).mapInArrow(within, schema), "range-sums")
    ranges = ranged.groupBy("_range").agg(F.max("_sum").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(ranges), "_range").withColumn(out, F.col("_sum") + F.col("_before")).drop("_sum", "_range", "_before")

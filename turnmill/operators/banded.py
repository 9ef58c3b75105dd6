"""Approximate cosine joins for very many dense vectors: bands of hyperplane signs.

A random hyperplane gives two vectors at angle a the same sign with probability 1 - a / pi. The signs of a row,
cut into bands, are equi-join keys: rows that agree in all bits of some band are candidates, and every candidate is
verified exactly, so precision is 1 and only recall is approximate. Work grows with rows times bands, whatever the
threshold, where the exact index has to visit ever more cells as the threshold falls.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from turnmill.functions.vectors import flat_list, list_column
from turnmill.operators.similarity import PAIRS, DenseIndex, _part_of, _running
from turnmill.operators.skew import skew_join
from turnmill.workspace import Workspace

SKETCH_BITS = 64


def agreement(threshold: float) -> float:
    """Chance that one hyperplane leaves two vectors at this cosine on the same side."""
    return 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi


def plan_bands(n_rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands that reach ``recall`` at the threshold with the least work.

    A band costs one posting per row and the chance meetings of rows that have nothing in common.
    """
    p = agreement(threshold)

    def bands(bits: int) -> int:
        return max(1, math.ceil(math.log(1 - recall) / math.log1p(-(p**bits)))) if p**bits < 1 else 1

    def work(bits: int) -> float:
        return bands(bits) * n_rows * (1 + n_rows / 2 ** (bits + 1))

    bits = min(range(1, 41), key=work)
    return bits, bands(bits)


def sketch_distance(threshold: float) -> int:
    """Differing sketch bits that a pair at the threshold exceeds once in some 10,000 times (normal tail of 3.8)."""
    off = 1 - agreement(threshold)
    return min(SKETCH_BITS, math.ceil(SKETCH_BITS * off + 3.8 * math.sqrt(SKETCH_BITS * off * (1 - off)) + 0.5))


@dataclass
class BandedIndex:
    """Cosine over unit vectors (``ord, vec array<float>``) through bands; it stands in for ``DenseIndex``.

    A pair at the threshold is found with probability ``recall``, closer ones more surely. Hyperplanes come from
    ``seed``, so results do not depend on partitioning. A band value that over ``most`` rows or candidates share is
    not joined with itself: the rows of all such values go through the exact index together, where a large group of
    near copies is cut into blocks. Copies of a vector thus never meet in every band.
    """

    threshold: float
    dims: int
    bits: int
    bands: int
    most: int = 1_000
    seed: int = 42

    @classmethod
    def build(cls, vectors: DataFrame, threshold: float, n_rows: int, recall: float = 0.95, most: int = 1_000, seed: int = 42) -> BandedIndex:
        first = vectors.select(F.size("vec").alias("d")).limit(1).collect()
        return cls(threshold, first[0]["d"] if first else 0, *plan_bands(max(2, n_rows), threshold, recall), most, seed)

    def _planes(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.standard_normal((self.dims, self.bands * self.bits + SKETCH_BITS))

    def signatures(self, rows: DataFrame) -> DataFrame:
        """``ord, [until,] keys, sketch``: a number per band, and bits of planes that belong to no band."""
        planes, bits, bands = rows.sparkSession.sparkContext.broadcast(self._planes()), self.bits, self.bands
        bound = ["until"] if "until" in rows.columns else []

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = 1 << np.arange(bits, dtype=np.int64)
            for batch in batches:
                flat, lengths = flat_list(batch.column("vec"))
                side = flat.astype(np.float64).reshape(len(lengths), -1) @ planes.value >= 0
                keys = side[:, : bands * bits].reshape(len(lengths), bands, bits) @ weights
                sketch = np.packbits(side[:, bands * bits :], axis=1).view(np.int64).ravel()
                columns = [batch.column(c) for c in ("ord", *bound)]
                columns += [list_column(keys.ravel(), np.full(len(lengths), bands)), pa.array(sketch)]
                yield pa.RecordBatch.from_arrays(columns, ["ord", *bound, "keys", "sketch"])

        kinds = "ord long, " + "".join(f"{c} long, " for c in bound)
        return rows.select("ord", "vec", *bound).mapInArrow(sign, kinds + "keys array<long>, sketch long")

    @staticmethod
    def _postings(signed: DataFrame) -> DataFrame:
        rest = [c for c in signed.columns if c != "keys"]
        return signed.select(*rest, F.posexplode("keys").alias("band", "key"))

    def work_upto(self, rows: DataFrame, n_rows: int, cuts: list[int], ws: Workspace) -> list[float]:
        """Per cut: the meetings in bands of the rows up to it, per band; a group of near copies counts once."""
        part = _part_of(F.col("ord"), cuts)
        sizes = self._postings(self.signatures(rows)).groupBy("band", "key", part.alias("part")).agg(F.count("*").cast("double").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("band", "key").orderBy("part"))
        added = sizes.select("part", (upto**2 - (upto - F.col("n")) ** 2).alias("w")).groupBy("part")
        return [w / 2 / self.bands for w in _running(added.agg(F.sum("w").alias("w")), len(cuts))]

    def earlier_pairs(self, rows: DataFrame, reps: DataFrame, ws: Workspace) -> DataFrame:
        """``(ord, rep, sim)`` with ``sim >= threshold`` and rep before the row, at the index's recall.

        Optional column ``until`` on rows replaces ``ord`` as the bound on ``rep``.
        """
        if not self.dims:
            return rows.sparkSession.createDataFrame([], PAIRS)
        if "until" not in rows.columns:
            rows = rows.withColumn("until", F.col("ord"))
        mine, theirs = ws.table(self.signatures(rows), "signed"), ws.table(self.signatures(reps), "signed-reps")
        count = F.count("*").alias("n")
        shared = self._postings(mine).groupBy("band", "key").agg(count).join(
            self._postings(theirs).groupBy("band", "key").agg(count.alias("m")), ["band", "key"]
        )
        shared = ws.table(shared.withColumn("hot", (F.col("n") > self.most) | (F.col("m") > self.most)), "shared")
        # Values that rows and candidates share; more than ``most`` postings each, so there are few hot ones.
        usual, hot = shared.filter("not hot").select("band", "key"), shared.filter("hot").select("band", "key")
        near = F.bit_count(F.col("sketch").bitwiseXOR(F.col("rep_sketch"))) <= sketch_distance(self.threshold)
        right = self._postings(theirs.withColumnsRenamed({"ord": "rep", "sketch": "rep_sketch"})).join(usual, ["band", "key"])
        left = self._postings(mine).join(usual, ["band", "key"])
        met = left.join(right, ["band", "key"]).filter((F.col("rep") < F.col("until")) & (F.col("rep") != F.col("ord")) & near)
        pairs = self._verified(ws.table(met.select("ord", "rep").distinct(), "met"), rows, reps)
        if hot.isEmpty():
            return pairs
        crowd = ws.table(self._crowded(mine, hot).join(rows, "ord"), "crowd")
        crowd_reps = ws.table(self._crowded(theirs, hot).join(reps, "ord"), "crowd-reps")
        exact = DenseIndex.build(crowd_reps, self.threshold, crowd_reps.count())
        return pairs.unionByName(exact.earlier_pairs(crowd, crowd_reps, ws)).groupBy("ord", "rep").agg(F.max("sim").alias("sim"))

    def _crowded(self, signed: DataFrame, hot: DataFrame) -> DataFrame:
        """The rows with a band value that too many share. At most postings / ``most`` values are hot."""
        held = self._postings(signed).select("ord", F.struct("band", "key").alias("at"))
        return skew_join(held, hot.select(F.struct("band", "key").alias("at")), "at", "ord").select("ord").distinct()

    def _verified(self, pairs: DataFrame, rows: DataFrame, reps: DataFrame) -> DataFrame:
        theirs = reps.select(F.col("ord").alias("rep"), F.col("vec").alias("rep_vec"))
        both = skew_join(pairs, theirs, "rep", "ord").join(rows.select("ord", "vec"), "ord")

        def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                (a, n), (b, _) = (flat_list(batch.column(c)) for c in ("vec", "rep_vec"))
                a, b = (x.astype(np.float64).reshape(len(n), -1) for x in (a, b))
                sims = np.einsum("ij,ij->i", a, b)
                yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("rep"), pa.array(sims)], ["ord", "rep", "sim"])

        return both.mapInArrow(dots, PAIRS).filter(F.col("sim") >= self.threshold)


def cosine_pairs_banded(
    vectors: DataFrame, threshold: float, ws: Workspace, recall: float = 0.95, most: int = 1_000, seed: int = 42
) -> DataFrame:
    """Pairs ``ord > rep`` with cosine >= threshold over dense unit vectors, approximately.

    Every returned pair is exact; a pair at the threshold is returned with probability ``recall``, a closer one more
    surely. ``cosine_pairs`` returns all of them.
    """
    index = BandedIndex.build(vectors, threshold, vectors.count(), recall, most, seed)
    return index.earlier_pairs(vectors, vectors, ws)

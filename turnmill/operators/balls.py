"""A dense index of two levels of balls: vectors travel once per pair of blocks that can hold a partner.

Pivots sampled from the data form cells, and the sampled vectors of a cell are the centres of its balls. Every vector
belongs to the ball of the nearest centre of its nearest cell, or, if that is further away than the threshold's angle, to
the cell's rest, so that a stray vector makes no ball wide. Strays are sampled for more centres while that helps. Each
ball keeps its radius, the largest angle to its centre, and each cell that of its balls. Angles obey the triangle inequality, so two balls whose centres are further
apart than both radii and the threshold's angle hold no pair, and neither do two such cells.

Rows carry ids and ball numbers until they are packed, once, into blocks: one row with all ids and one matrix. Blocks lie
in a few sheaves by ball, and a block travels once to each pair of sheaves in which it has a partner; there a pair of blocks
is a few matrix products. With groups of a fixed size the blocks that a block meets do not grow in number with the corpus.
Where vectors have no structure all blocks meet, which is quadratic work, but a block still travels to as many places
as there are sheaves: 16 up to 2 million rows, then one for each 131,072 rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.functions.vectors import flat_list
from turnmill.operators.similarity import PAIRS, DenseIndex
from turnmill.workspace import Workspace

#: Rounding of angles between unit vectors of single precision.
_SLACK = 2e-3
#: Sheaves of blocks: so many at least, and rows in one at most (a few blocks more where balls are large).
SHEAVES, SHEAF_ROWS = 16, 131_072
BLOCK = "block long, ball int, ords binary, untils binary, vecs binary"


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


@dataclass
class BallIndex:
    """Cosine over unit vectors (``ord, vec array<float>``), exactly, with the interface of ``DenseIndex``.

    ``centres`` (balls, dims) are sorted by cell, and ``cells`` says where each cell's begin; the last ball of a cell is
    its rest, around the pivot. Their bytes are bounded by ``build``, since tasks receive them; balls of more than
    ``block_rows`` vectors are cut into blocks by hash.
    """

    threshold: float
    pivots: np.ndarray
    centres: np.ndarray
    cells: np.ndarray
    block_rows: int = 4096
    #: Block pairs of the last join, by what was pruned: for tests and reports.
    met: dict[str, int] = field(default_factory=dict)

    @classmethod
    def build(cls, vectors: DataFrame, threshold: float, n_rows: int, block_rows: int = 4096, most_bytes: int = 16 << 20) -> BallIndex:
        """Sample a centre for about every half block of rows, as many as ``most_bytes`` hold; the rows of least hash."""
        first = vectors.select(F.size("vec").alias("d")).limit(1).collect()
        dims = first[0]["d"] if first else 0
        if not dims:
            return cls(threshold, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(1, np.int64), block_rows)
        room = max(1, most_bytes // (8 * dims))
        sample = np.zeros((0, dims))
        stray, wanted, before = vectors, 2 * n_rows // block_rows + 1, n_rows
        for _ in range(5):
            picked = stray.select("vec", F.xxhash64("ord", F.lit(7)).alias("h")).orderBy("h").limit(int(min(wanted, room - len(sample)))).collect()
            new = np.array([r["vec"] for r in picked], np.float64).reshape(-1, dims)
            sample = np.unique(np.concatenate((sample, new)), axis=0)
            index = cls._over(sample, threshold, block_rows)
            stray = index.balls(vectors).filter("rest")
            left = stray.count()
            # No groups to find, or next to none left.
            if len(sample) >= room or left <= 0.01 * n_rows or left > 0.9 * before:
                break
            wanted, before = max(16, 4 * left // block_rows), left
        return index

    @classmethod
    def _over(cls, sample: np.ndarray, threshold: float, block_rows: int) -> BallIndex:
        sample = sample[np.random.default_rng(7).permutation(len(sample))]
        pivots = sample[: max(1, math.isqrt(len(sample)))]
        home = np.concatenate([(sample[i : i + 4096] @ pivots.T).argmax(1) for i in range(0, len(sample), 4096)])
        home = np.append(home, np.arange(len(pivots)))
        order = np.argsort(home, kind="stable")
        return cls(threshold, pivots, np.concatenate((sample, pivots))[order], np.searchsorted(home[order], np.arange(len(pivots) + 1)), block_rows)

    def work_upto(self, rows: DataFrame, n_rows: int, cuts: list[int], ws: Workspace) -> list[float]:
        """Per cut: pairs above the threshold up to it, extrapolated from a sample."""
        return DenseIndex(self.threshold, self.pivots, self.block_rows).work_upto(rows, n_rows, cuts, ws)

    def balls(self, rows: DataFrame) -> DataFrame:
        """Add ``ball``, ``angle`` (that to the ball's centre), and whether the ball is a cell's rest."""
        shared = rows.sparkSession.sparkContext.broadcast((self.pivots, self.centres, self.cells))
        extra = [c for c in ("until",) if c in rows.columns]
        reach = math.acos(max(-1.0, min(1.0, self.threshold)))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots, centres, cells = shared.value
            for batch in batches:
                x = _rows(batch.column("vec"))
                home = (x @ pivots.T).argmax(1)
                ball, best = np.zeros(len(x), np.int32), np.zeros(len(x))
                for cell in np.unique(home):
                    mine = np.flatnonzero(home == cell)
                    dots = x[mine] @ centres[cells[cell] : cells[cell + 1]].T
                    near = dots.argmax(1)
                    ball[mine], best[mine] = cells[cell] + near, dots[np.arange(len(mine)), near]
                angle = np.arccos(np.clip(best, -1, 1))
                rest = angle > reach
                ball[rest] = cells[home[rest] + 1] - 1
                angle[rest] = np.arccos(np.clip((x[rest] * pivots[home[rest]]).sum(1), -1, 1))
                columns = [batch.column(c) for c in ("ord", *extra, "vec")]
                columns += [pa.array(ball), pa.array(angle), pa.array(rest)]
                yield pa.RecordBatch.from_arrays(columns, ["ord", *extra, "vec", "ball", "angle", "rest"])

        kinds = "ord long, " + "".join(f"{c} long, " for c in extra) + "vec array<float>, ball int, angle double, rest boolean"
        return rows.select("ord", *extra, "vec").mapInArrow(place, kinds)

    def _packed(self, rows: DataFrame, ws: Workspace, name: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """Blocks of packed rows; and, by ball, how many blocks it has and its radius."""
        placed = ws.table(self.balls(rows), f"{name}-balls")
        sizes, radius = np.zeros(len(self.centres), np.int64), np.zeros(len(self.centres))
        # One row per ball reaches the driver, as many as there are centres.
        for r in placed.groupBy("ball").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect():
            sizes[r["ball"]], radius[r["ball"]] = -(-r["n"] // self.block_rows), r["radius"]
        cuts = placed.sparkSession.createDataFrame(
            [(int(b), int(sizes[b])) for b in np.flatnonzero(sizes)], "ball int, cuts int"
        )
        until = F.col("until") if "until" in placed.columns else F.col("ord")
        part = F.pmod(F.xxhash64("ord"), F.col("cuts")).cast("long")
        dealt = placed.join(F.broadcast(cuts), "ball").select(
            "ord", until.alias("until"), "vec", "ball", (F.col("ball").cast("long") * (1 << 31) + part).alias("block")
        )

        def pack(block: pa.Table) -> pa.Table:
            order = np.argsort(block.column("ord").to_numpy(), kind="stable")
            x = _rows(block.column("vec").combine_chunks())[order].astype(np.float32)
            row = {"block": [block.column("block")[0].as_py()], "ball": [block.column("ball")[0].as_py()]}
            row |= {f"{c}s": [block.column(c).to_numpy()[order].tobytes()] for c in ("ord", "until")} | {"vecs": [x.tobytes()]}
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds, strict=True)})

        return ws.table(dealt.groupBy("block").applyInArrow(pack, BLOCK), f"{name}-blocks"), sizes, radius

    def _near_balls(self, spark, mine: tuple[np.ndarray, np.ndarray], theirs: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        """Pairs ``(ball, near)`` of a ball with rows and one with candidates whose distance allows a pair.

        Cells are compared first; the balls of two near cells are compared in a task of their own.
        """
        shared = spark.sparkContext.broadcast((self.centres, self.cells, mine, theirs))
        reach = math.acos(max(-1.0, min(1.0, self.threshold))) + _SLACK
        cells = len(self.pivots)
        spread = []
        for sizes, radius in (mine, theirs):
            out = np.full(cells, -np.inf)
            for c in range(cells):
                own = slice(self.cells[c], self.cells[c + 1])
                if sizes[own].any():
                    far = angles(self.centres[own], self.pivots[c : c + 1])[:, 0] + radius[own]
                    out[c] = far[sizes[own] > 0].max()
            spread.append(out)
        near = angles(self.pivots, self.pivots) <= spread[0][:, None] + spread[1][None, :] + reach
        pairs = np.argwhere(near).tolist()
        self.met["cells"] = len(pairs)

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, at, (sizes, radius), (other_sizes, other_radius) = shared.value
            for batch in batches:
                left, right = [], []
                for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    x, y = (np.arange(at[c], at[c + 1])[s[at[c] : at[c + 1]] > 0] for c, s in ((a, sizes), (b, other_sizes)))
                    i, j = np.nonzero(angles(centres[x], centres[y]) <= radius[x][:, None] + other_radius[y][None] + reach)
                    left.append(x[i])
                    right.append(y[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x or [np.zeros(0, np.int64)]).astype(np.int32)) for x in (left, right)], ["ball", "near"]
                )

        frame = spark.createDataFrame(pairs, "a int, b int").repartition(max(1, min(len(pairs), 4 * spark.sparkContext.defaultParallelism)))
        return frame.mapInArrow(compare, "ball int, near int")

    def earlier_pairs(self, rows: DataFrame, reps: DataFrame, ws: Workspace) -> DataFrame:
        """All ``(ord, rep, sim)`` with ``sim >= threshold`` and rep before the row.

        Optional column ``until`` on rows replaces ``ord`` as the bound on ``rep``.
        """
        spark = rows.sparkSession
        if not len(self.centres):
            return spark.createDataFrame([], PAIRS)
        mine, *mine_balls = self._packed(rows, ws, "rows")
        theirs, *their_balls = (mine, *mine_balls) if rows is reps else self._packed(reps.select("ord", "vec"), ws, "reps")
        near = ws.table(self._near_balls(spark, tuple(mine_balls), tuple(their_balls)), "near-balls")
        left = near.join(mine.select("ball", "block"), "ball").select("near", "block")
        pairs = left.join(theirs.select(F.col("ball").alias("near"), F.col("block").alias("other")), "near").select("block", "other")
        pairs = ws.table(pairs, "block-pairs")
        self.met["blocks"] = pairs.count()
        # By ball, the sheaf of its blocks: near balls have near numbers. A ball with many blocks goes to several.
        pairs = pairs.join(_sheaves(spark, mine_balls[0], "block", self.block_rows), "block").join(_sheaves(spark, their_balls[0], "other", self.block_rows), "other")
        place = (F.col("block_sheaf").cast("long") * (1 << 31) + F.col("other_sheaf")).alias("place")
        partners = pairs.groupBy(place, "block").agg(F.collect_list("other").alias("others"))
        partners = ws.table(partners, "partners")
        self.met["sent"] = partners.count()
        left = partners.join(mine.drop("ball"), "block").select("place", F.lit(0).alias("side"), "block", "others", "ords", "untils", "vecs")
        none = F.lit(None)
        right = pairs.select(place, F.col("other").alias("block")).distinct().join(theirs.drop("ball"), "block").select(
            "place", F.lit(1).alias("side"), "block", none.cast("array<long>").alias("others"), "ords", none.cast("binary").alias("untils"), "vecs"
        )
        both = left.unionByName(right).repartition("place")
        both = both.sortWithinPartitions("place", "side", "block")
        t = self.threshold

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place, wanted = None, {}
            for batch in batches:
                for i in range(batch.num_rows):
                    if (at := batch.column("place")[i].as_py()) != place:
                        place, wanted = at, {}
                    get = lambda c: batch.column(c)[i].as_buffer()  # noqa: B023, E731
                    if not batch.column("side")[i].as_py():
                        # Copies: a view would keep its whole batch.
                        held = [np.frombuffer(get(c), k).copy() for c, k in (("ords", np.int64), ("untils", np.int64), ("vecs", np.float32))]
                        for other in batch.column("others")[i].as_py():
                            wanted.setdefault(other, []).append(held)
                        continue
                    b = np.frombuffer(get("ords"), np.int64)
                    y = np.frombuffer(get("vecs"), np.float32).reshape(len(b), -1).astype(np.float64)
                    for a, until, vecs in wanted.get(batch.column("block")[i].as_py(), ()):
                        x = vecs.reshape(len(a), -1)
                        for at in range(0, len(x), 512):
                            sims = x[at : at + 512].astype(np.float64) @ y.T
                            r, c = np.nonzero((sims >= t) & (b[None] < until[at : at + 512, None]) & (b[None] != a[at : at + 512, None]))
                            if len(r):
                                yield pa.RecordBatch.from_arrays([pa.array(a[at + r]), pa.array(b[c]), pa.array(sims[r, c])], ["ord", "rep", "sim"])

        return both.mapInArrow(products, PAIRS)


def _sheaves(spark, blocks_of: np.ndarray, name: str, block_rows: int = 4096) -> DataFrame:
    """``<name>, <name>_sheaf`` of all blocks, given their number by ball: about equal runs of blocks in order of balls."""
    total = int(blocks_of.sum())
    sheaves = max(SHEAVES, -(-total * block_rows // SHEAF_ROWS))
    ball = np.repeat(np.arange(len(blocks_of)), blocks_of)
    part = np.arange(total) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)
    table = pa.table({name: ball.astype(np.int64) * (1 << 31) + part, f"{name}_sheaf": (np.arange(total) * sheaves // max(1, total)).astype(np.int32)})
    return F.broadcast(spark.createDataFrame(table))


def _rows(column: pa.ListArray) -> np.ndarray:
    flat, lengths = flat_list(column)
    return flat.astype(np.float64).reshape(len(lengths), -1)

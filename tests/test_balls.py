"""The two-level dense index against brute force, and how its work grows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.operators.balls import BallIndex
from turnmill.operators.leaders import leader_clusters
from turnmill.operators.similarity import DenseIndex


def unit(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "ord long, vec array<float>").repartition(3)


def groups(n, size, dims=24, seed=1, spread=0.05):
    """Groups of near copies around unrelated centres."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // size, dims))
    return unit(np.repeat(centres, size, 0) + rng.normal(size=(n // size * size, dims)) * spread)


def brute(x, t, until=None):
    sims = x.astype(np.float64) @ x.astype(np.float64).T
    return {(i, j) for i, j in zip(*np.nonzero(sims >= t), strict=True) if i != j and j < (i if until is None else until[i])}


@pytest.mark.parametrize("t", [0.2, 0.6, 0.92])
@pytest.mark.parametrize("block_rows", [16, 4096])
def test_pairs_are_exact(spark, ws, t, block_rows):
    rng = np.random.default_rng(5)
    x = np.concatenate((groups(160, 8), unit(rng.normal(size=(90, 24))), np.tile(unit(rng.normal(size=(1, 24))), (60, 1))))
    x = x[rng.permutation(len(x))]
    rows = ws.table(frame(spark, x), "rows")
    index = BallIndex.build(rows, t, len(x), block_rows)
    got = {(r["ord"], r["rep"]) for r in index.earlier_pairs(rows, rows, ws).collect()}
    assert got == brute(x, t)


def test_bounds_and_other_candidates(spark, ws):
    x = groups(120, 6, spread=0.2)
    rows = ws.table(frame(spark, x), "rows")
    index = BallIndex.build(rows, 0.8, 120, 16)
    some = rows.filter("ord % 3 = 0").withColumn("until", F.col("ord") + 10)
    got = {(r["ord"], r["rep"]) for r in index.earlier_pairs(some, rows.filter("ord % 2 = 0"), ws).collect()}
    assert got == {(i, j) for i, j in brute(x, 0.8, np.arange(120) + 10) if i % 3 == 0 and j % 2 == 0}


def test_leaders_equal_those_of_the_dense_index(spark, ws):
    rows = ws.table(frame(spark, groups(200, 10, spread=0.15)), "rows")
    found = []
    for kind in (BallIndex, DenseIndex):
        got = leader_clusters(rows, kind.build(rows, 0.85, 200, 16), ws, work_per_row=1, min_work=50).collect()
        found.append(sorted((r["ord"], r["rep"], r["kept"]) for r in got))
    assert found[0] == found[1]


def test_block_pairs_grow_with_the_rows(spark, ws):
    met = []
    for n in (400, 1600):
        rows = ws.table(frame(spark, groups(n, 8, dims=48, spread=0.01)), "rows")
        index = BallIndex.build(rows, 0.97, n, 16)
        assert index.earlier_pairs(rows, rows, ws).count() == n // 8 * 28
        met.append(index.met["blocks"] / n)
    assert met[1] < 2 * met[0]


def test_no_and_few_vectors(spark, ws):
    empty = spark.createDataFrame([], "ord long, vec array<float>")
    assert BallIndex.build(empty, 0.9, 0).earlier_pairs(empty, empty, ws).count() == 0
    one = frame(spark, np.ones((1, 4), np.float32) / 2)
    assert BallIndex.build(one, 0.9, 1).earlier_pairs(one, one, ws).count() == 0


def test_a_block_travels_to_sheaves_not_to_blocks(spark, ws):
    """Without structure every block meets every other; what is shuffled grows with the rows all the same."""
    for n in (640, 2560):
        rng = np.random.default_rng(2)
        rows = ws.table(frame(spark, unit(rng.normal(size=(n, 8)))), "rows")
        index = BallIndex.build(rows, 0.2, n, 8)
        sims = brute(np.array([r["vec"] for r in rows.orderBy("ord").collect()], np.float32), 0.2)
        assert index.earlier_pairs(rows, rows, ws).count() == len(sims)
        assert index.met["blocks"] > 16 * 3 * n // 8 >= index.met["sent"]

"""Bands of hyperplane signs: recall, exactness, groups of copies, clustering."""

import math

import numpy as np
import pytest

from turnmill.operators.banded import BandedIndex, agreement, cosine_pairs_banded, plan_bands, sketch_distance
from turnmill.operators.leaders import leader_clusters
from turnmill.operators.similarity import cosine_pairs


def frame(spark, x, parts=3):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))], "ord long, vec array<float>").repartition(parts)


def planted(n=600, dims=32, seed=2):
    """Unrelated vectors, and one at a cosine of about 0.9 to 0.99 for every second of them."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    noise = rng.normal(size=(n // 2, dims)) * rng.uniform(0.1, 0.45, (n // 2, 1))
    return np.concatenate((x, x[: n // 2] + noise))


def pairs(df):
    return {(r["ord"], r["rep"]): r["sim"] for r in df.collect()}


@pytest.mark.parametrize(("threshold", "recall"), [(0.92, 0.95), (0.9, 0.99)])
def test_recall_and_exactness(spark, ws, threshold, recall):
    rows = ws.table(frame(spark, planted()), "rows")
    wanted, got = pairs(cosine_pairs(rows, threshold, ws)), pairs(cosine_pairs_banded(rows, threshold, ws, recall))
    assert len(wanted) > 100 and set(got) <= set(wanted)
    assert len(got) >= 0.9 * len(wanted)
    assert all(math.isclose(got[k], wanted[k], abs_tol=1e-9) for k in got)


def test_partitions_do_not_matter(spark, ws):
    rows = planted(200)
    assert pairs(cosine_pairs_banded(frame(spark, rows, 1), 0.9, ws)) == pairs(cosine_pairs_banded(frame(spark, rows, 5), 0.9, ws))


def test_a_third_of_near_copies_meets_in_blocks(spark, ws):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    x[::3] = x[0] + rng.normal(size=(100, 16)) * 0.02
    rows = ws.table(frame(spark, x), "rows")
    assert set(pairs(cosine_pairs_banded(rows, 0.92, ws, most=20))) == set(pairs(cosine_pairs(rows, 0.92, ws)))


def test_leader_clusters_over_bands(spark, ws):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 200)] + rng.normal(size=(200, 24)) * 0.03
    rows = ws.table(frame(spark, x), "rows")
    got = {r["ord"]: r["rep"] for r in leader_clusters(rows, BandedIndex.build(rows, 0.9, 200, 0.99), ws, work_per_row=1, min_work=50).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    leaders = []
    for i in range(len(u)):
        near = [(u[i] @ u[k], -k) for k in leaders if u[i] @ u[k] >= 0.9]
        if not near:
            leaders.append(i)
        assert got[i] == (-max(near)[1] if near else i)


def test_empty_and_single(spark, ws):
    empty = spark.createDataFrame([], "ord long, vec array<float>")
    assert cosine_pairs_banded(empty, 0.9, ws).count() == 0
    assert cosine_pairs_banded(frame(spark, np.ones((1, 4)), 1), 0.9, ws).count() == 0


def test_bands_reach_the_recall_asked_for():
    for n, t, r in ((1000, 0.92, 0.95), (10**9, 0.92, 0.95), (10**6, 0.5, 0.9)):
        bits, bands = plan_bands(n, t, r)
        assert 1 - (1 - agreement(t) ** bits) ** bands >= r
    assert plan_bands(10**9, 0.92, 0.95)[0] > plan_bands(1000, 0.92, 0.95)[0]
    assert 10 < sketch_distance(0.92) < 25 and sketch_distance(0.3) > 30

"""Indexes and clustering against brute force and a sequential scan."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnmill.functions.vectors import _by_row, l2_normalize, word_grams
from turnmill.operators.leaders import leader_clusters, with_cluster_ids
from turnmill.operators.semantic import dedup_stats, semantic_dedup
from turnmill.operators.similarity import DenseIndex, GramIndex, _descending, _finder, _row_order, _shared_entries
from turnmill.operators.skew import held_by, without
from turnmill.plans.enrich import long_report
from turnmill.streaming.store import RepresentativeStore


def texts(n=150, seed=3, hot=0.34):
    """Random texts, a third of them near copies of one text, plus exact copies."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocab) for _ in range(60)]
    out = []
    for _ in range(n):
        roll = rng.random()
        if roll < hot:
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"u{rng.randrange(10**6)}"
        elif roll < hot + 0.1 and out:
            words = rng.choice(out).split()
        else:
            words = [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
        out.append(" ".join(words))
    return out


def grams(text):
    words = text.lower().split()
    if len(words) == 1:
        return Counter(words)
    return Counter(zip(words, words[1:]))


def cosine(a, b):
    na, nb = (sum(v * v for v in x.values()) for x in (a, b))
    return sum(v * b[k] for k, v in a.items()) / math.sqrt(na * nb) if na and nb else 0.0


def scan(sims, n, t):
    """Sequential greedy clustering: (representative, similarity) per row."""
    leaders, out = [], []
    for i in range(n):
        best = max(leaders, key=lambda k: (sims(k, i), -k), default=None)
        if best is not None and sims(best, i) >= t:
            out.append((best, sims(best, i)))
        else:
            leaders.append(i)
            out.append((i, 1.0))
    return out


def expected_pairs(vecs, t):
    return {
        (j, i) for i in range(len(vecs)) for j in range(i + 1, len(vecs)) if cosine(vecs[i], vecs[j]) >= t
    }


@pytest.mark.parametrize("t", [0.3, 0.7, 0.92])
@pytest.mark.parametrize("known", [0, 5, 1000])
def test_gram_pairs_are_exact(spark, ws, t, known):
    docs = texts()
    df = spark.createDataFrame(list(enumerate(docs)), "ord long, text string")
    vectors = ws.table(word_grams(df.repartition(3), "ord", "text"), "v").filter("norm2 > 0")
    index = GramIndex.build(vectors, t, len(docs), keep=known) if known else GramIndex(t, vectors)
    index.rows_per_salt = 7
    rows = ws.table(index.rows(), "rows")
    got = {(r["ord"], r["rep"]) for r in index.earlier_pairs(rows, rows, ws).collect()}
    assert got == expected_pairs([grams(d) for d in docs], t)


def test_until_bounds_candidates(spark, ws):
    docs = ["a b c", "x y", "a b c", "a b c"]
    df = spark.createDataFrame(list(enumerate(docs)), "ord long, text string")
    vectors = ws.table(word_grams(df, "ord", "text"), "v")
    index = GramIndex(0.9, vectors)
    reps = ws.table(index.rows(), "rows")
    rows = reps.filter("ord = 0").withColumn("until", F.lit(3).cast("long"))
    pairs = index.earlier_pairs(rows, reps, ws).collect()
    assert {(r["ord"], r["rep"]) for r in pairs} == {(0, 2)}


@pytest.mark.parametrize("t", [-0.2, 0.3, 0.9])
def test_dense_pairs_are_exact(spark, ws, t):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 8))
    x = centers[rng.integers(0, 6, 200)] + 0.3 * rng.normal(size=(200, 8))
    x[7] = 0
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = (x / np.where(norm == 0, 1, norm)).astype(np.float32)
    df = ws.table(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "ord long, vec array<float>"), "x")
    index = DenseIndex.build(df, t, 64 * 49, block_rows=16)
    assert len(index.pivots) == 7
    got = {(r["ord"], r["rep"]) for r in index.earlier_pairs(df, df, ws).collect()}
    sims = x.astype(np.float64) @ x.T.astype(np.float64)
    assert got == {(j, i) for i in range(200) for j in range(i + 1, 200) if sims[i, j] >= t}


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"finish_below": 0},
        {"finish_below": 0, "min_work": 50, "work_per_row": 0},
        {"min_work": 300, "work_per_row": 0},
    ],
)
def test_leaders_match_a_sequential_scan(spark, ws, options):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(160, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    df = ws.table(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "ord long, vec array<float>").repartition(5), "x"
    )
    t = 0.75
    index = DenseIndex.build(df, t, 160, block_rows=64)
    got = with_cluster_ids(ws.table(leader_clusters(df, index, ws, **options), "a"), ws).collect()
    sims = x.astype(np.float64) @ x.T.astype(np.float64)
    want = scan(lambda a, b: sims[a, b], 160, t)
    assert {r["ord"]: r["rep"] for r in got} == {i: rep for i, (rep, _) in enumerate(want)}
    rank = {rep: k for k, rep in enumerate(sorted({rep for rep, _ in want}))}
    assert all(r["cluster_id"] == rank[r["rep"]] for r in got)


def test_chain_and_tie(spark, ws):
    """a~b~c with a!~c keeps a and c; a row between two leaders goes to the earlier."""
    rows = list(enumerate([[0.8, 0.6], [1.0, 0.0], [0.8, -0.6], [1.0, 0.0]]))
    df = ws.table(spark.createDataFrame(rows, "ord long, vec array<float>"), "x")
    out = leader_clusters(df, DenseIndex.build(df, 0.7, 4), ws).collect()
    assert {r["ord"]: (r["rep"], r["kept"]) for r in out} == {
        0: (0, True), 1: (0, False), 2: (2, True), 3: (0, False)
    }


@pytest.mark.parametrize("hot", [0.0, 0.34, 0.8])
@pytest.mark.parametrize("tight", [False, True])
def test_semantic_dedup_matches_a_scan(spark, ws, hot, tight, monkeypatch):
    if tight:
        plain = leader_clusters
        monkeypatch.setattr(
            "turnmill.operators.semantic.leader_clusters",
            lambda v, i, w: plain(v, i, w, work_per_row=0, min_work=2000, finish_below=0),
        )
    docs = texts(120, seed=9, hot=hot) + ["", "  ", ""]
    vecs = [grams(d) for d in docs]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string").repartition(3)
    clusters = ws.table(semantic_dedup(df, ws, threshold=0.9), "c")
    want = scan(lambda a, b: cosine(vecs[a], vecs[b]), len(docs), 0.9)
    got = {r["id"]: r for r in clusters.collect()}
    assert len(got) == len(docs)
    for i, (rep, sim) in enumerate(want):
        assert got[i]["rep_id"] == rep and abs(got[i]["similarity"] - sim) < 1e-9
        assert got[i]["state"] == ("kept" if rep == i else "dup")
    stats = dedup_stats(clusters, 0.9).first()
    assert stats["total"] == len(docs) and stats["kept"] + stats["duplicates"] == len(docs)


def test_empty_input(spark, ws):
    df = spark.createDataFrame([], "id long, text string")
    stats = dedup_stats(semantic_dedup(df, ws), 0.92)
    assert tuple(stats.first()) == (0, 0, 0, 0, 0.92)
    assert long_report("dedup", stats).count() == 5


def test_l2_normalize_keeps_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [list(r[0]) for r in df.select(l2_normalize(F.col("v"))).collect()]
    assert got == [[pytest.approx(0.6), pytest.approx(0.8)], [0.0, 0.0]]


def test_rows_that_share_little_are_not_compared(spark, ws):
    """Rare grams in common do not make long rows candidates, nor do rows of other sizes meet."""
    rng = random.Random(4)
    docs = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(300)) for _ in range(30)]
    docs = [d + " one rare passage here" for d in docs]
    docs.append(docs[0] + " now")
    df = spark.createDataFrame(list(enumerate(docs)), "ord long, text string")
    vectors = ws.table(word_grams(df, "ord", "text"), "v")
    alone = vectors.select(F.explode("grams").alias("g")).groupBy("g").count().filter("count = 1").collect()
    # The shared grams come first.
    index = GramIndex(0.92, vectors, np.array([r["g"] for r in alone], np.int64))
    rows = ws.table(index.rows(), "rows")
    assert index.meetings(rows, index.entries(rows), ws).count() == 1
    assert {(r["ord"], r["rep"]) for r in index.earlier_pairs(rows, rows, ws).collect()} == {(30, 0)}


def test_only_paired_rows_are_joined(spark):
    rows = spark.range(50_000)
    ids = spark.createDataFrame([(i,) for i in (3, 17, 49_999)], "rep long")
    left = {r["id"] for r in held_by(rows, "id", ids, 3).collect()}
    assert {3, 17, 49_999} <= left and len(left) < 50


def test_a_block_passes_in_small_batches(spark, ws, monkeypatch):
    monkeypatch.setattr("turnmill.operators.similarity._PAIRS_AT_ONCE", 100)
    x = np.ones((90, 4), np.float32) / 2
    df = ws.table(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "ord long, vec array<float>"), "x")
    pairs = DenseIndex.build(df, 0.9, 90).earlier_pairs(df, df, ws)
    assert pairs.count() == 90 * 89 // 2


def test_struck_rows_find_the_nearest_of_later_heads(spark, ws):
    """A row struck out by the first head may be nearer to a row that a later head keeps."""
    angle = np.radians([0, 5, 30, 22])
    x = np.stack((np.cos(angle), np.sin(angle)), 1).astype(np.float32)
    df = ws.table(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "ord long, vec array<float>"), "x")
    out = leader_clusters(df, DenseIndex.build(df, 0.9, 4), ws, min_work=0, work_per_row=0).collect()
    assert {r["ord"]: r["rep"] for r in out} == {0: 0, 1: 0, 2: 2, 3: 2}


def test_a_store_of_the_earlier_layout_is_refused(spark, ws):
    df = spark.createDataFrame([(0, "a b c")], "ord long, text string")
    vectors = ws.table(word_grams(df, "ord", "text"), "v")
    store = RepresentativeStore(spark, f"{ws.root}/store")
    assert store.index(vectors, 0.92, ws).n_rows == store.index(vectors, 0.92, ws).n_rows == 1
    spark.range(1).write.parquet(f"{store.path}/order")
    with pytest.raises(ValueError, match="earlier layout"):
        store.index(vectors, 0.92, ws)


@pytest.mark.parametrize("known", [0, 5, 1000])
def test_narrowed_rows_meet_alike(spark, ws, known):
    """Entries that no other row has leave, and all pairs stay."""
    rng = random.Random(8)
    docs = [f"{d} {' '.join(f'own{rng.randrange(10**9)}' for _ in range(3))}" for d in texts()]
    df = spark.createDataFrame(list(enumerate(docs)), "ord long, text string")
    vectors = ws.table(word_grams(df.repartition(3), "ord", "text"), "v")
    index = GramIndex.build(vectors, 0.7, len(docs), keep=known) if known else GramIndex(0.7, vectors)
    rows = ws.table(index.rows(), "rows")
    narrow, met = index.narrowed(rows, ws)
    assert met.count() == rows.count() and "grams" not in met.columns
    assert 4 * narrow.entries(met).count() < 3 * index.entries(rows).count()
    got = {(r["ord"], r["rep"]) for r in narrow.earlier_pairs(met, met, ws).collect()}
    assert got == expected_pairs([grams(d) for d in docs], 0.7)


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_shared_entries_over_batches(size):
    rng = np.random.default_rng(size)
    gram = np.sort(rng.integers(0, 25, 60))
    s2 = rng.random(60).astype(np.float32)
    order = np.lexsort((-s2, gram))
    gram, s2 = gram[order], s2[order]
    whole = pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.arange(60)), pa.array(s2), pa.array(s2)], ["gram", "ord", "s2", "w"])
    batches = [whole.slice(i, size) for i in range(0, 60, size)] + [whole.slice(60)]
    got = [o for b in _shared_entries(0.6)(batches) for o in b.column("ord").to_pylist()]
    assert got == [i for i, g in enumerate(gram) if (gram == g).sum() > 1 and s2[gram == g].max() >= np.float32(0.6)]


def test_orders_are_those_of_the_plain_sorts():
    rng = np.random.default_rng(1)
    row = np.sort(rng.integers(0, 9, 500))
    gram = rng.integers(-(2**63), 2**63 - 1, 500)
    starts = np.searchsorted(row, np.arange(9))
    # Grams of one row that differ in their lowest bit, and equal ones.
    gram[starts[3] : starts[3] + 4] = [6, 7, 6, -7]
    order = _by_row(row, gram)
    assert (order == np.lexsort((gram, row))).all()
    for at in (order, rng.permutation(500)):
        some, rank = gram[at], rng.integers(0, 4, 500).astype(np.int32)
        assert (_row_order(starts, row, rank, some) == np.lexsort((some, rank, row))).all()
    for most in (1, 50, 2**61):
        value = rng.integers(0, most, 500)
        assert (_descending(row, value) == value[np.lexsort((-value, row))]).all()
    known = np.unique(np.concatenate([gram[::3], np.arange(-40, 40)]))
    place = np.searchsorted(known, gram)
    want = np.where(known[np.minimum(place, len(known) - 1)] == gram, place + 1, 0)
    assert (_finder(known, np.arange(1, len(known) + 1, dtype=np.int32))(gram) == want).all()
    assert not _finder(known[:0], np.zeros(0, np.int32))(gram).any()


def test_only_what_may_be_gone_is_shuffled(spark, ws):
    rows = ws.table(spark.range(50_000).withColumn("text", F.concat(F.lit("t"), "id")), "rows")
    ids = ws.table(spark.createDataFrame([(i,) for i in (3, 17, 49_999, 70_000)], "ord long"), "ids")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = without(rows, "id", ids, 4)
        assert {r["id"] for r in left.collect()} == set(range(50_000)) - {3, 17, 49_999}
        sent = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The anti join stays above the filter by the bitmap.
    final = sent.split("== Initial Plan ==")[0]
    assert final.index("LeftAnti") < final.index("BroadcastHashJoin", final.index("LeftAnti"))
    assert without(rows, "id", ids, 0) is rows
    assert without(rows, "text", spark.createDataFrame([("t5",)], "x string"), 1).count() == 49_999

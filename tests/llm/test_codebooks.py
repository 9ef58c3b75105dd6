"""Codes by two trees against plain rounds of Lloyd."""

import numpy as np
import pytest

from turnmill.llm.codebooks import assign, books_digest, compress, gather, plant, with_label_error


def plain(values, books, rounds):
    """Codes and codebooks of (rows, parts, width) after some rounds."""
    for left in range(rounds, -1, -1):
        codes = ((values[:, :, None] - books[None]) ** 2).sum(3).argmin(2)
        if not left:
            return codes, books
        books = books.copy()
        for part in range(values.shape[1]):
            for entry in range(books.shape[1]):
                own = values[codes[:, part] == entry, part]
                if len(own):
                    books[part, entry] = own.sum(0) // len(own)


@pytest.mark.parametrize(("n", "entries", "width", "spread"), [(1, 1, 8, 9), (40, 16, 4, 3), (900, 16, 8, 4000), (777, 16, 1, 5), (500, 7, 3, 3)])
def test_trees_find_the_nearest_entries(n, entries, width, spread):
    rng = np.random.default_rng(n)
    values = rng.integers(-spread, spread, (n, 8, width))
    values[n // 2 :] += 3 * spread
    books = values[:entries].transpose(1, 0, 2).copy()
    forest = plant(values, leaf=8)
    for _ in range(4):
        codes = ((values[:, :, None] - books[None]) ** 2).sum(3).argmin(2)
        assert (assign(forest, books) == codes).all()
        sums, counts = gather(forest, books)
        for part in range(8):
            assert (counts[part] == np.bincount(codes[:, part], minlength=entries)).all()
            for entry in range(entries):
                assert (sums[part, entry] == values[codes[:, part] == entry, part].sum(0)).all()
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)


SCHEMA = "vec_id long, embedding array<float>, label int, key string, codes int"


def test_rows_nulls_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=16) / 3)], int(i % 3) if i % 7 else None, "k", i) for i in range(400)]
    odd = [(900, None, 1, "", 0), (901, [float("nan")] * 16, 1, "", 0), (902, [float("inf")] + [0.0] * 15, 1, "", 0)]
    odd += [(903, [None] + [0.5] * 15, 1, "", 0), (904, [], 1, "", 0), (905, [0.5] * 8, 1, "", 0)]
    kept = [*rows, rows[50], (None, [0.25] * 16, None, None, None)]
    got, books = compress(spark.createDataFrame([*kept, *odd], SCHEMA).repartition(5))
    values = np.floor(np.array([np.float32(r[1]) for r in kept]).astype(float) * 4096).astype(int).reshape(-1, 8, 2)
    codes, want = plain(values, values[:16].transpose(1, 0, 2).copy(), 6)
    assert (books == want).all()
    errors = ((values - want[np.arange(8)[None], codes]) ** 2).sum((1, 2))
    labels = {}
    for row, e in zip(kept, errors, strict=True):
        labels[row[2]] = labels.get(row[2], 0) + int(e)
    asked = sorted((str(r[0]), bytes(c.astype(np.uint8)), int(e), labels[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True))
    found = with_label_error(got).collect()
    assert sorted((str(r["vec_id"]), bytes(r["codes"]), r["error"], r["label_error"]) for r in found) == asked


def test_few_and_no_vectors(spark):
    got, books = compress(spark.createDataFrame([(1, [0.5] * 8, 1, "", 0), (2, [0.25] * 8, None, "", 0)], SCHEMA))
    assert books.shape == (8, 2, 1) and [(r["vec_id"], r["error"]) for r in got.orderBy("vec_id").collect()] == [(1, 0), (2, 0)]
    got, books = compress(spark.createDataFrame([], SCHEMA))
    assert with_label_error(got).collect() == [] and books_digest(books)
    got, _ = compress(spark.createDataFrame([(1, [0.5] * 9, 1, "", 0)], SCHEMA))
    assert got.collect() == []


def test_huge_components_are_held(spark):
    rows = [(i, [(-1.0) ** i * 3e38] * 8, 0, "", 0) for i in range(20)]
    got, books = compress(spark.createDataFrame(rows, SCHEMA))
    assert abs(books).max() == 1 << 27 and {r["error"] for r in got.collect()} == {0}

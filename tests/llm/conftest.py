import random

import public_tokenizers
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, node long, size string"

BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def prose(rng, n, words=None):
    words = words or [f"w{i}" for i in range(300)]
    return " ".join(rng.choice(words) for _ in range(n))


def messy_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, signs beyond ASCII."""
    rng = random.Random(1)
    base = prose(rng, 120)
    texts = [None, "", " \n\t ", "one", base, base, base.upper(), base + " more", prose(rng, 30_000), "x" * 200_000, "é ñ 日本語  ß—　z", "a " * 300]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), f"row{i}", i, "x") for i, t in enumerate(texts)]
    rows += [(4, base, "en", "s1", 5, None, None, None), (4, base, "en", "s1", 5, None, None, None), (4, prose(rng, 80), None, None, None, None, None, None)]
    rows += [(None, base, "de", None, 1, "r", 1, "y"), (None, None, None, None, None, None, None, None), (50, prose(rng, 90), None, "s0", 9, "", 0, "")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messy") / "documents.parquet")
    spark.createDataFrame(messy_rows(), SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (doc_id, text), the other columns filled."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    return make

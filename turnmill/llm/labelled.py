"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of a key's text modulo the number of folds; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def within_bytes(rows: DataFrame, most_bytes: int, *by: str) -> DataFrame:
    """Rows (text, ...) of a bounded table in the order of their hashes, as long as their texts fit into a budget per group."""
    upto = Window.partitionBy(*by).orderBy(F.xxhash64("text"), "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("upto", F.sum(F.octet_length("text")).over(upto)).filter(F.col("upto") <= most_bytes).drop("upto")


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, left_out: Column, per_label: int, key: str = "doc_id", text: str = "text",
    most_bytes: int = 64 << 20,
) -> DataFrame:
    """Rows (text, label) for fitting: for each label the ``per_label`` keys of least hash, one text of each.

    A sample of fixed size: only its keys, at most 2 * ``per_label``, are broadcast to the texts; of several texts
    with one key the one of least hash counts, and texts are left out once those of a label exceed ``most_bytes``.
    A key with labels 0 and 1 counts as 0; keys in the fold that is left out, null labels and null texts never enter.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~left_out).groupBy(key).agg(F.min(label).alias("label"))
    order = F.xxhash64(F.col(key).cast("string"))
    picked = [known.filter(F.col("label") == x).orderBy(order, key).limit(per_label) for x in (0, 1)]
    ids = picked[0].union(picked[1]).withColumnRenamed(key, "labelled_key")
    rows = docs.select(docs[key].alias("at"), docs[text].alias("text")).filter("text IS NOT NULL")
    texts = rows.join(F.broadcast(ids), rows["at"] == ids["labelled_key"]).groupBy("at", "label")
    one = texts.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return within_bytes(one, most_bytes, "label").select("text", "label").orderBy(F.xxhash64("text"), "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

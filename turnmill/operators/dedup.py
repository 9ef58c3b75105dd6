"""Exact duplicates by text hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def text_key(c: Column) -> Column:
    """32 bytes that stand for a text."""
    return F.unhex(F.sha2(c, 256))


def first_copies(df: DataFrame, key: str | Column, order: str) -> DataFrame:
    """Per distinct text key: first and last position, number of copies.

    Only a key and a number per row are aggregated, combined before the shuffle, so
    a text that fills a third of the table costs one row per task.
    """
    key = F.col(key) if isinstance(key, str) else key
    return df.groupBy(key.alias("text_hash")).agg(
        F.min(order).alias(order), F.max(order).alias("last_copy"), F.count("*").alias("n_copies")
    )


def exact_dedup(df: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of every distinct text, with its number of copies.

    Rows are found again through their unique ``order`` value rather than by hash: no
    join key here is ever hot.
    """
    firsts = first_copies(df, text_key(F.col(text)), order).select(order, "n_copies")
    return df.join(firsts, order)

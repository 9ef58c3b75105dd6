"""Seeded samples, exact splits, head rows, report samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.text import clip
from turnmill.operators.ordering import at_or_before, kth_key, seeded_key

# Seed, sample size, evaluation share, report limits.
SEED = 42
SAMPLE_ROWS = 20
EVAL_RATIO = 0.05
REPORT_ROWS = 8
PROMPT_CHARS = 500
OUTPUT_CHARS = 800

# Beyond this many rows a top-k no longer fits in one task.
_TOP_K = 10_000


def seeded_sample(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SEED, key: str = "id") -> DataFrame:
    """``min(n, rows)`` rows without replacement, the same for a seed on any cluster."""
    keyed = df.withColumn("_order", seeded_key(seed, F.col(key)))
    if n <= _TOP_K:
        return keyed.orderBy("_order", key).limit(n).drop("_order")
    cut = kth_key(keyed, "_order", key, n)
    whole = F.lit(True) if cut is None else at_or_before("_order", key, cut)
    return keyed.filter(whole).drop("_order")


def train_eval_split(
    df: DataFrame, ratio: float = EVAL_RATIO, seed: int = SEED, key: str = "id"
) -> DataFrame:
    """Add ``split``: exactly ``max(1, int(rows * ratio))`` rows are ``eval``.

    The cut key is found from counts per key range; the split itself is a filter, with
    no sort and no shuffle.
    """
    keyed = df.withColumn("_order", seeded_key(seed, F.col(key)))
    k = max(1, int(df.count() * ratio))
    cut = kth_key(keyed, "_order", key, k)
    return keyed.withColumn(
        "split", F.when(at_or_before("_order", key, cut), F.lit("eval")).otherwise(F.lit("train"))
    ).drop("_order")


def split_report(split: DataFrame, ratio: float = EVAL_RATIO, base_model: str | None = None) -> DataFrame:
    return split.agg(
        F.lit(base_model).cast("string").alias("base_model"),
        F.count("*").alias("total_rows"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "eval").alias("eval_rows"),
        F.lit(ratio).alias("eval_ratio"),
    )


def head_rows(
    df: DataFrame, n: int, order: str, usable: Column | None = None, filter_first: bool = True
) -> DataFrame:
    """The first ``n`` rows in input order that are usable.

    ``filter_first=False`` takes the first ``n`` rows and then drops unusable ones.
    """
    if usable is None:
        return df.orderBy(order).limit(n)
    if filter_first:
        return df.filter(usable).orderBy(order).limit(n)
    return df.orderBy(order).limit(n).filter(usable)


def report_samples(judged: DataFrame, order: str = "id", n: int = REPORT_ROWS) -> DataFrame:
    """The first judged rows with prompt and outputs cut to report length."""
    return judged.orderBy(order).limit(n).select(
        order,
        clip(F.col("prompt"), PROMPT_CHARS).alias("prompt"),
        clip(F.col("base_output"), OUTPUT_CHARS).alias("base_output"),
        clip(F.col("finetune_output"), OUTPUT_CHARS).alias("finetune_output"),
        "judge_winner",
        "judge_reason",
    )

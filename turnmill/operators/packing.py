"""Packing rendered rows into sequences of a fixed token length."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnmill.functions.text import approx_tokens
from turnmill.operators.ordering import running_sum, seeded_key
from turnmill.workspace import Workspace

# Fixed value: tokens per packed sequence.
MAX_TOKENS = 2048


def pack_sequences(
    df: DataFrame, ws: Workspace, key: str = "id", text: str = "text", max_tokens: int = MAX_TOKENS, seed: int = 42
) -> DataFrame:
    """Fragments ``pack, key, from_token, n_tokens``; every pack but the last holds exactly the maximum.

    Rows are laid end to end in a seeded order of their unique key and cut at pack borders, so a row may
    span packs. Their places come from a prefix sum over ranges of that order, in parallel at any size;
    only ids and lengths move, never texts.
    """
    lengths = df.select(
        key,
        approx_tokens(F.length(text)).cast("long").alias("n"),
        seeded_key(seed, F.col(key)).alias("_order"),
    ).filter(F.col("n") > 0)
    spans = running_sum(lengths, ["_order", key], "n", "stop", ws).withColumn("start", F.col("stop") - F.col("n"))
    first = F.floor(F.col("start") / F.lit(max_tokens))
    last = F.floor((F.col("stop") - 1) / F.lit(max_tokens))
    cut = spans.withColumn("pack", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start"), F.col("pack") * max_tokens)
    hi = F.least(F.col("stop"), (F.col("pack") + 1) * max_tokens)
    return cut.select("pack", key, (lo - F.col("start")).alias("from_token"), (hi - lo).alias("n_tokens"))

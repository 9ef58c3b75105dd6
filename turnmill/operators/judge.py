"""Pairing model outputs and reading blind pairwise judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.parsing import parse_verdict
from turnmill.functions.text import round_half_even, strip
from turnmill.operators.ordering import coin

# Win-rate bands.
IMPROVED = 0.6
COMPARABLE = 0.45


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fail the query if keys occur twice together; joins on them would multiply rows.

    The check is a count per key, combined before the shuffle.
    """
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if repeated:
        raise ValueError(f"{', '.join(keys)} not unique: {tuple(repeated[0])[:-1]!r}")
    return df


def _one_model(outputs: DataFrame, model: str, side: str, key: str) -> DataFrame:
    return outputs.filter(F.col("model") == model).select(
        key,
        strip(F.col("output")).alias(f"{side}_output"),
        F.col("tokens").alias(f"{side}_tokens"),
    )


def pair_outputs(
    prompts: DataFrame, outputs: DataFrame, base: str = "base", finetune: str = "finetune", key: str = "id"
) -> DataFrame:
    """Prompts with both models' outputs; a prompt missing either one is left out.

    Ids must be unique, and unique per model among the outputs; else the query fails.
    """
    assert_unique(prompts, key)
    outputs = assert_unique(outputs.filter(F.col("model").isin(base, finetune)), key, "model")
    b = _one_model(outputs, base, "base", key).filter(F.col("base_output").isNotNull())
    f = _one_model(outputs, finetune, "finetune", key).filter(F.col("finetune_output").isNotNull())
    return prompts.join(b, key).join(f, key)


def unpaired_rows(
    prompts: DataFrame, outputs: DataFrame, base: str = "base", finetune: str = "finetune", key: str = "id"
) -> DataFrame:
    """The prompts :func:`pair_outputs` leaves out."""
    done = outputs.filter(F.col("output").isNotNull())
    b = done.filter(F.col("model") == base).select(key)
    f = done.filter(F.col("model") == finetune).select(key)
    return prompts.join(b.join(f, key, "left_semi"), key, "left_anti")


def judge_prompt(prompt: Column, a: Column, b: Column) -> Column:
    """The blind comparison shown to the judge; the section headings are fixed values."""
    return F.concat(
        F.lit("USER PROMPT:\n"), prompt, F.lit("\n\nRESPONSE A:\n"), a, F.lit("\n\nRESPONSE B:\n"), b
    )


def blind_pairs(pairs: DataFrame, seed: int = 42, swap: float = 0.5, key: str = "id") -> DataFrame:
    """Order each pair by a seeded coin: adds ``swapped`` and ``judge_prompt``.

    A swapped pair shows the fine-tuned output as response A.
    """
    swapped = coin(seed, F.col(key)) < swap if swap > 0 else F.lit(False)
    out = pairs.withColumn("swapped", swapped)
    a = F.when(F.col("swapped"), F.col("finetune_output")).otherwise(F.col("base_output"))
    b = F.when(F.col("swapped"), F.col("base_output")).otherwise(F.col("finetune_output"))
    return out.withColumn("judge_prompt", judge_prompt(F.col("prompt"), a, b))


def unblind(blind: DataFrame, responses: DataFrame, key: str = "id") -> DataFrame:
    """Parse verdicts and map the letter back: adds ``judge_winner, judge_reason``.

    An answer other than A or B, or none at all, is a tie.
    """
    verdicts = parse_verdict(responses, "response").select(key, "verdict", "judge_reason")
    first_wins = F.when(F.col("swapped"), F.lit("finetune")).otherwise(F.lit("base"))
    second_wins = F.when(F.col("swapped"), F.lit("base")).otherwise(F.lit("finetune"))
    return (
        blind.join(verdicts, key, "left")
        .withColumn(
            "judge_winner",
            F.when(F.col("verdict") == "a", first_wins)
            .when(F.col("verdict") == "b", second_wins)
            .otherwise(F.lit("tie")),
        )
        .withColumn("judge_reason", F.coalesce("judge_reason", F.lit("no response")))
        .drop("verdict")
    )


def interpretation(rate: Column) -> Column:
    return (
        F.when(rate >= IMPROVED, F.lit("improved"))
        .when(rate >= COMPARABLE, F.lit("comparable"))
        .when(rate.isNotNull(), F.lit("worse"))
    )


def win_rates(judged: DataFrame) -> DataFrame:
    """Counts and rates (3 digits) per outcome; null rates when nothing was judged."""
    total = F.count("*")
    outcomes = [("finetune", "finetune_win"), ("base", "base_win"), ("tie", "tie")]
    counts = judged.agg(
        total.alias("total"),
        *[F.count_if(F.col("judge_winner") == w).alias(f"n_{w}") for w, _ in outcomes],
    )
    rate = {
        w: round_half_even(F.try_divide(F.col(f"n_{w}"), F.col("total")), 3) for w, _ in outcomes
    }
    return counts.select(
        "total",
        F.col("n_finetune").alias("finetune_wins"),
        F.col("n_base").alias("base_wins"),
        F.col("n_tie").alias("ties"),
        *[rate[w].alias(f"{name}_rate") for w, name in outcomes],
        interpretation(rate["finetune"]).alias("interpretation"),
    )

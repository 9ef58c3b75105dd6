"""Scoring generated answers against references, and benchmark result selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.text import fold_case, round_half_even, strip

# Domain tags and the keywords that select them, first match wins.
DOMAIN_RULES = [
    ("legal", ["legal", "cuad", "contract", "law", "attorney"]),
    ("medical", ["med", "health", "clinical", "patient", "counseling", "therapy", "psych"]),
    ("finance", ["finance", "fin", "bank", "trad", "fintech", "insurance"]),
    ("code", ["sql", "code", "spider", "sql-spider", "programming", "dev"]),
    ("voice", ["voice", "cs", "support", "bitext", "chat"]),
]


def tag_domain(slug: Column, rules: Sequence[tuple[str, Sequence[str]]] = DOMAIN_RULES) -> Column:
    """The first domain with a keyword inside the lower-cased slug, else null."""
    low = F.lower(slug)
    out = F.lit(None).cast("string")
    for domain, keywords in reversed(list(rules)):
        hit = F.lit(False)
        for word in keywords:
            hit = hit | F.contains(low, F.lit(word))
        out = F.when(hit, F.lit(domain)).otherwise(out)
    return out


def score_exact(generated: Column, expected: Column) -> Column:
    return (fold_case(generated) == fold_case(expected)).cast("double")


def score_substring(generated: Column, expected: Column) -> Column:
    return F.contains(fold_case(generated), fold_case(expected)).cast("double")


def score_graded(grade: Column) -> Column:
    """1 when the grader's answer starts with the digit 1."""
    return F.startswith(strip(grade), F.lit("1")).cast("double")


def scored_rows(
    df: DataFrame,
    metric: str = "metric_type",
    generated: str = "generated",
    expected: str = "expected",
    grade: str | None = None,
) -> DataFrame:
    """Add ``score`` by metric type; rows without reference or output are skipped.

    An unknown metric type scores 0.
    """
    usable = (F.coalesce(F.col(expected), F.lit("")) != "") & F.col(generated).isNotNull()
    graded = score_graded(F.col(grade)) if grade else F.lit(0.0)
    score = (
        F.when(F.col(metric) == "exact_match", score_exact(F.col(generated), F.col(expected)))
        .when(F.col(metric) == "substring", score_substring(F.col(generated), F.col(expected)))
        .when(F.col(metric) == "llm_judge", graded)
        .otherwise(F.lit(0.0))
    )
    return df.filter(usable).withColumn("score", F.coalesce(score, F.lit(0.0)))


def benchmark_scores(specs: DataFrame, scored: DataFrame, name: str = "name") -> DataFrame:
    """Samples and mean score (4 digits) per benchmark; 0 when nothing was scored."""
    means = scored.groupBy(name).agg(F.count("*").alias("samples"), F.avg("score").alias("_mean"))
    return specs.join(means, name, "left").select(
        name,
        "metric_type",
        F.coalesce("samples", F.lit(0)).alias("samples"),
        round_half_even(F.coalesce("_mean", F.lit(0.0)), 4).alias("score"),
    )


def pick_metric(results: DataFrame, known: DataFrame, task: str = "task") -> DataFrame:
    """The primary accuracy of each known task.

    ``results`` holds ``task, metrics array<struct<key,value>>`` in file order. Usable
    keys have a comma and ``acc`` before it; one with ``acc_norm`` is preferred.
    ``known`` (``task, display_name, ...``) is a small parameter table.
    """
    usable = F.filter(
        "metrics",
        lambda m: F.contains(m["key"], F.lit(","))
        & F.contains(F.substring_index(m["key"], ",", 1), F.lit("acc")),
    )
    normed = F.filter(usable, lambda m: F.contains(m["key"], F.lit("acc_norm")))
    # A preferred key with a null value falls back to the first usable key.
    picked = F.coalesce(
        F.try_element_at(normed, F.lit(1))["value"], F.try_element_at(usable, F.lit(1))["value"]
    )
    return results.join(known, task).select(
        task, *[c for c in known.columns if c != task], round_half_even(picked, 4).alias("score")
    )

"""Latency percentiles from stored sketches: per group and day, merged later without the log.

The exact percentiles of :mod:`turnmill.operators.perf` scan the log twice. Here one scan leaves a KLL sketch of each
column per group and day, some kilobytes each; any span of days, and any coarser grouping, is answered from those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Size of a sketch; the rank error falls almost as its inverse.
SIZE = 2048


def rank_error(size: int = SIZE) -> float:
    """Share of the values by which an answer's rank may be off, with 99 % confidence (published bound of KLL).

    Merging sketches of one size does not change it.
    """
    return 2.296 / size**0.9021


def sketch_log(log: DataFrame, group: Sequence[str], values: Sequence[str], at: str, size: int = SIZE) -> DataFrame:
    """One row per group and day: ``group..., day``, and for each column ``<name>_sketch`` and ``<name>_n``.

    Null and NaN values are left out; a day without values has an empty sketch. Append the rows of new days to a
    table: sketches are partial aggregates and are combined before they are shuffled.
    """
    held = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in values}
    aggs = [x for v, c in held.items() for x in (F.kll_sketch_agg_double(c, size).alias(f"{v}_sketch"), F.count(c).alias(f"{v}_n"))]
    return log.groupBy(*group, F.to_date(at).alias("day")).agg(*aggs)


def merged(stored: DataFrame, group: Sequence[str], values: Sequence[str], days: Column | None = None) -> DataFrame:
    """Sketches of all stored days, or of those that ``days`` selects, per group."""
    chosen = stored if days is None else stored.filter(days)
    aggs = [x for v in values for x in (F.kll_merge_agg_double(f"{v}_sketch").alias(f"{v}_sketch"), F.sum(f"{v}_n").alias(f"{v}_n"))]
    return chosen.groupBy(*group).agg(*aggs)


def sketch_percentiles(
    stored: DataFrame, group: Sequence[str], wanted: Mapping[str, Sequence[float]], days: Column | None = None, size: int = SIZE
) -> DataFrame:
    """Long form ``group..., name, q, n, value, rank_error`` from stored sketches; groups without values are left out.

    The true rank of ``value`` lies within ``rank_error * n`` of the one asked for. ``size`` is that of the sketches.
    """
    rows = merged(stored, group, list(wanted), days)
    answers = F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(float(q)).alias("q"), F.col(f"{name}_n").alias("n"),
            F.when(F.col(f"{name}_n") > 0, F.kll_sketch_get_quantile_double(f"{name}_sketch", F.lit(float(q)))).alias("value"),
        )
        for name, quantiles in wanted.items() for q in quantiles
    ])
    return rows.select(*group, F.explode(answers).alias("a")).select(*group, "a.*", F.lit(rank_error(size)).alias("rank_error")).filter("n > 0")


def true_ranks(log: DataFrame, answers: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Add the exact share of the log's values below each answer, and at or below it: an audit by one scan.

    ``answers`` holds one row per group and quantile; it is sent to the log by a join that may broadcast it.
    """
    marks = answers.filter(F.col("name") == name).groupBy(*group).agg(F.collect_list(F.struct("q", "value")).alias("_marks"))
    each = log.filter(F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))).join(marks, list(group))
    each = each.select(*group, F.col(name).cast("double").alias("_v"), F.explode("_marks").alias("_m"))
    counts = each.groupBy(*group, F.col("_m.q").alias("q")).agg(
        F.avg((F.col("_v") < F.col("_m.value")).cast("double")).alias("below"), F.avg((F.col("_v") <= F.col("_m.value")).cast("double")).alias("upto")
    )
    return answers.filter(F.col("name") == name).join(counts, [*group, "q"])


def within_bound() -> Column:
    """Whether an answer's true rank is as near as its stated bound, after :func:`true_ranks`."""
    return (F.col("below") <= F.col("q") + F.col("rank_error")) & (F.col("upto") >= F.col("q") - F.col("rank_error"))


"""Latency, throughput and cost from request logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.functions.text import round_half_even
from turnmill.workspace import Workspace

# Prices in $ per million tokens, and the hourly cost of own hardware.
PRICES = [
    ("openai_gpt-4o", 2.50, 10.00),
    ("openai_gpt-4o-mini", 0.15, 0.60),
    ("anthropic_sonnet_4.6", 3.00, 15.00),
    ("anthropic_haiku_4.5", 1.00, 5.00),
    ("together_llama_70b", 0.88, 0.88),
    ("together_llama_8b", 0.20, 0.20),
    ("fireworks_llama_70b", 0.90, 0.90),
    ("fireworks_llama_8b", 0.20, 0.20),
]
HOURLY_COST = 0.05
HEADLINE_PROVIDER = "openai_gpt-4o"

QUANTILES = (0.5, 0.95, 0.99)

BROADCAST_GROUPS = 100_000


def order_statistics(
    df: DataFrame, group: Sequence[str], wanted: Mapping[str, Sequence[float]], sums: Mapping[str, Column] | None = None,
    ws: Workspace | None = None, most: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Exact order statistics of several columns per group, in two scans; and plain aggregates.

    Returns the long form ``group..., name, q, n, value``, the value at index
    ``min(int(q*n), n-1)`` of each column's non-null values, and the table of groups with
    ``sums``. A window over a group would sort it in one task, so ranks are narrowed
    first: one aggregate holds a quantile sketch of every column with a guaranteed rank
    error, which gives a value range that must hold each answer; the second scan counts
    what lies below it and the distinct values inside. Where those are still over ``most``,
    the range is cut into equal parts and only the part with the answer is ranked.
    The query fails rather than answer if the guarantee were ever broken.
    """
    group, accuracy, slack = list(group), 10_000, 5e-4
    ws = ws or Workspace(df.sparkSession)
    aggs, targets = [], []
    for name, quantiles in wanted.items():
        v = F.col(name).cast("double")
        marks = sorted({min(1.0, max(0.0, q + d)) for q in quantiles for d in (-slack, slack)})
        at = {m: i for i, m in enumerate(marks)}
        n, sketch, lo, hi = (F.col(f"_{name}_{x}") for x in ("n", "marks", "lo", "hi"))
        aggs += [
            F.count(v).alias(f"_{name}_n"), F.percentile_approx(v, marks, accuracy).alias(f"_{name}_marks"),
            F.min(v).alias(f"_{name}_lo"), F.max(v).alias(f"_{name}_hi"),
        ]
        targets += [
            F.struct(
                F.lit(name).alias("name"), F.lit(float(q)).alias("q"), n.alias("n"),
                F.least(F.floor(n * F.lit(float(q))), n - 1).alias("idx"),
                F.when(n * F.lit(max(0.0, q - slack)) < 2, lo).otherwise(sketch[at[max(0.0, q - slack)]]).alias("lo"),
                F.when(n * F.lit(1 - min(1.0, q + slack)) < 2, hi).otherwise(sketch[at[min(1.0, q + slack)]]).alias("hi"),
            )
            for q in quantiles
        ]
    plain = [c.alias(name) for name, c in (sums or {}).items()]
    summed = df.groupBy(*group).agg(*aggs, *plain).withColumn("_wanted", F.array(*targets))
    # One row per group. Groups are models or request kinds, so this side is nearly always
    # small; it is broadcast only when its written size says so, because a shuffle on
    # the group would put a third of the log into one task.
    summed = ws.table(summed.select(*group, *[c for c in sums or {}], "_wanted"), "groups")
    asked = summed.select(*group, F.filter("_wanted", lambda w: w["n"] > 0).alias("_wanted"))
    if asked.count() <= BROADCAST_GROUPS:
        asked = F.broadcast(asked)
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in wanted])
    one = F.explode(F.filter(values, lambda x: x["v"].isNotNull())).alias("x")
    near = (
        df.select(*group, one)
        .join(asked, group)
        .select(*group, "x.v", F.explode(F.filter("_wanted", lambda w: (w["name"] == F.col("x.name")) & (F.col("x.v") <= w["hi"]))).alias("w"))
        # The null value stands for everything below the range and sorts first.
        .select(*group, "w.*", F.when(F.col("v") >= F.col("w.lo"), F.col("v")).alias("_v"))
        .groupBy(*group, "name", "q", "n", "idx", "lo", "hi", "_v")
        .agg(F.count("*").alias("_c"))
    )
    key = [*group, "name", "q"]
    near = ws.table(near, "near")
    if near.count() > most:
        near = _answer_part(near, key)
    upto = Window.partitionBy(*key).orderBy(F.col("_v").asc_nulls_first())
    ranked = near.withColumn("_upto", F.sum("_c").over(upto))
    reached = F.when(F.col("_upto") > F.col("idx"), F.struct("_upto", "_v"))
    hit = ranked.groupBy(*key, "n").agg(F.min(reached).alias("first"))
    answer = F.col("first._v")
    return hit.select(
        *key, "n",
        F.when(answer.isNotNull(), answer)
        .otherwise(F.raise_error(F.lit("quantile sketch out of bounds")).cast("double"))
        .alias("value"),
    ), summed.drop("_wanted")


def _answer_part(near: DataFrame, key: list[str], parts: int = 4096) -> DataFrame:
    """Of each target's counted values only the part of its range that holds the answer.

    The rows before that part are summed up in the null value.
    """
    share = (F.col("_v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    part = F.coalesce(F.least(F.floor(share * parts), F.lit(parts - 1)), F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(F.lit(0)))
    cut = near.withColumn("part", part)
    upto = Window.partitionBy(*key).orderBy("part")
    counts = cut.groupBy(*key, "idx", "part").agg(F.sum("_c").alias("_c")).withColumn("_upto", F.sum("_c").over(upto))
    holds = counts.filter("_upto > idx").groupBy(*key).agg(F.min("part").alias("holds"))
    return (
        cut.join(holds, key)
        .filter(F.col("part") <= F.col("holds"))
        .withColumn("_v", F.when(F.col("part") == F.col("holds"), F.col("_v")))
        .groupBy(*key, "n", "idx", "_v")
        .agg(F.sum("_c").alias("_c"))
    )


def latency_percentiles(
    df: DataFrame, group: Sequence[str], value: str, quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Exact order statistics of one column per group: long form ``group..., q, n, value``."""
    return order_statistics(df, group, {value: quantiles})[0].drop("name")


def _per_second() -> Column:
    return F.when(
        (F.col("output_tokens") > 0) & (F.col("total_ms") > 0),
        F.col("output_tokens") / (F.col("total_ms") / F.lit(1000.0)),
    )


def throughput_summary(log: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and best tokens per second of successful requests per group, in one scan."""
    return log.filter(F.col("error").isNull()).groupBy(*group).agg(
        round_half_even(F.avg(_per_second()), 1).alias("throughput_mean"),
        round_half_even(F.max(_per_second()), 1).alias("throughput_max"),
    )


def request_summary(log: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """Per group: latency, time to first token and throughput of successful requests.

    ``log`` has ``ttft_ms, total_ms, output_tokens, error``. Error rows and missing
    first-token times are excluded; throughput needs at least one token.
    """
    group = list(group)
    wanted = {"total_ms": QUANTILES, "ttft_ms": QUANTILES[:2]}
    long, sums = order_statistics(
        log.filter(F.col("error").isNull()), group, wanted,
        {
            "requests": F.count("total_ms"),
            "ttft_samples": F.count("ttft_ms"),
            "latency_mean": round_half_even(F.avg("total_ms"), 1),
            "ttft_mean": round_half_even(F.avg("ttft_ms"), 1),
            "throughput_mean": round_half_even(F.avg(_per_second()), 1),
            "throughput_max": round_half_even(F.max(_per_second()), 1),
        },
    )
    wide = [
        round_half_even(F.max(F.when((F.col("name") == name) & (F.col("q") == q), F.col("value"))), 1).alias(
            f"{title}_p{round(q * 100)}"
        )
        for name, title in (("total_ms", "latency"), ("ttft_ms", "ttft"))
        for q in wanted[name]
    ]
    return sums.join(long.groupBy(*group).agg(*wide), group, "left")


def batch_throughput(log: DataFrame, group: Sequence[str] = ("batch",)) -> DataFrame:
    """Tokens of successful requests over the wall time of each batch (0 without time)."""
    started, ended = (F.col(c).cast("timestamp") for c in ("started_at", "ended_at"))
    wall = F.unix_micros(F.max(ended)) - F.unix_micros(F.min(started))
    return (
        log.groupBy(*group)
        .agg(
            F.sum(F.when(F.col("error").isNull(), F.col("output_tokens")).otherwise(0)).alias("tokens"),
            (wall / F.lit(1e6)).alias("wall_s"),
        )
        .withColumn(
            "tok_per_s",
            round_half_even(
                F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.col("wall_s")), F.lit(0.0)), 1
            ),
        )
    )


def self_hosted_cost(tok_per_s: Column, hourly: float = HOURLY_COST) -> Column:
    """Dollars per million tokens; throughput must be positive."""
    positive = F.when(tok_per_s > 0, tok_per_s).otherwise(
        F.raise_error(F.lit("throughput must be positive")).cast("double")
    )
    return F.lit(hourly) / (F.lit(3600.0) * positive) * F.lit(1_000_000.0)


def cost_comparison(
    throughput: DataFrame,
    prices: Sequence[tuple[str, float, float]] = PRICES,
    tok_per_s: str = "tok_per_s",
    hourly: float = HOURLY_COST,
) -> DataFrame:
    """Every measurement against every provider's output price, dearest first.

    The price list travels as one literal array per measurement and is exploded.
    """
    price_list = F.array(
        *[
            F.struct(
                F.lit(i).alias("provider_ord"),
                F.lit(provider).alias("provider"),
                F.lit(per_input).alias("input_per_1m"),
                F.lit(per_output).alias("output_per_1m"),
            )
            for i, (provider, per_input, per_output) in enumerate(prices)
        ]
    )
    own = throughput.withColumn("_own", self_hosted_cost(F.col(tok_per_s), hourly))
    rest = [c for c in throughput.columns]
    return (
        own.select(*rest, "_own", F.explode(price_list).alias("p"))
        .select(
            *rest,
            round_half_even(F.col("_own"), 4).alias("self_hosted_per_1m"),
            "p.provider_ord", "p.provider", "p.input_per_1m", "p.output_per_1m",
            round_half_even(F.col("p.output_per_1m") / F.col("_own"), 1).alias("factor"),
        )
        .orderBy(*[c for c in rest if c != tok_per_s], F.desc("factor"), "provider_ord")
    )


def percent(rate: Column) -> Column:
    return round_half_even(rate * F.lit(100.0), 1)


def headline_metrics(
    summary: DataFrame, costs: DataFrame, rates: DataFrame, provider: str = HEADLINE_PROVIDER
) -> DataFrame:
    """The report's headline numbers in long form ``metric, value``.

    Each input is one small aggregate; a missing one gives null values.
    """
    def long(df: DataFrame, names: dict[str, Column]) -> DataFrame:
        one = df.agg(*[F.max(c).alias(n) for n, c in names.items()])
        pairs = F.array(
            *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
        )
        return one.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")

    chosen = F.col("provider") == provider
    return (
        long(
            summary,
            {
                "perf_throughput": F.col("throughput_mean"),
                "perf_ttft_p50": F.col("ttft_p50"),
                "perf_ttft_p95": F.col("ttft_p95"),
            },
        )
        .unionByName(long(rates, {"judge_finetune_pct": percent(F.col("finetune_win_rate"))}))
        .unionByName(
            long(
                costs,
                {
                    "self_hosted_cost": F.col("self_hosted_per_1m"),
                    "provider_cost": F.when(chosen, F.col("output_per_1m")),
                    "cost_savings_factor": F.when(chosen, F.col("factor")),
                },
            )
        )
    )

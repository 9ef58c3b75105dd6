"""Reading model answers: JSON scores, verdicts, numbered variants.

The helpers take column *names* and return DataFrames, so each answer is parsed once
into a variant column instead of once per extracted field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.json import is_single, single, wrapped
from turnmill.functions.text import strip

# The keys of a score answer.
_SCORES = ("clarity", "completeness", "naturalness", "correctness", "domain_fit")
_GREEDY_OBJECT = r"(?s)\{.*\}"
_SHORTEST_OBJECT = r"(?s)\{.*?\}"


def _with_object(df: DataFrame, raw: str, span: str, out: str) -> DataFrame:
    """Add the JSON object in an answer: the whole text, else its ``span`` match.

    Valid JSON that is not an object counts as unparseable.
    """
    text = strip(F.col(raw))
    inner = F.regexp_extract(text, span, 0)
    return (
        df.withColumn("_whole", wrapped(text))
        .withColumn("_inner", F.when(~is_single(F.col("_whole")), wrapped(inner)))
        .withColumn(
            out,
            F.when(~is_single(F.col("_whole")), single(F.col("_inner"))).when(
                F.startswith(text, F.lit("{")), single(F.col("_whole"))
            ),
        )
        .drop("_whole", "_inner")
    )


def _whole_number(obj: str, key: str) -> Column:
    """``int(x)`` of a number, boolean or numeric string; null for anything else."""
    value = F.try_variant_get(F.col(obj), f"$.{key}", "double")
    toward_zero = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    return toward_zero.try_cast("int")


def parse_scores(
    df: DataFrame, raw: str = "response", error: str | None = None, out: str = "_quality"
) -> DataFrame:
    """Turn a reviewer's answer into a score struct.

    A failed call, an unreadable answer or a non-numeric overall score gives the
    neutral overall score 3; the first two are flagged.
    """
    obj = "_score_obj"
    df = _with_object(df, raw, _GREEDY_OBJECT, obj)
    has_overall = F.try_variant_get(F.col(obj), "$.overall", "variant").isNotNull()
    overall = _whole_number(obj, "overall")
    err = F.col(error) if error else F.lit(None).cast("string")
    called = err.isNull() & F.col(raw).isNotNull()
    failed = called & (F.col(obj).isNull() | (has_overall & overall.isNull()))
    usable = called & ~failed
    fields = [F.when(usable, _whole_number(obj, k)).alias(k) for k in _SCORES]
    quality = F.struct(
        *fields,
        F.coalesce(F.when(usable, overall), F.lit(3)).alias("overall"),
        F.when(usable, F.try_variant_get(F.col(obj), "$.reason", "string")).alias("reason"),
        failed.alias("parse_failed"),
        F.when(failed, F.left(strip(F.col(raw)), F.lit(200))).alias("raw"),
        err.alias("error"),
    )
    return df.withColumn(out, quality).drop(obj)


def parse_verdict(df: DataFrame, raw: str = "response") -> DataFrame:
    """Add ``verdict`` (lower-case winner), ``judge_reason`` and ``unparsed``.

    The shortest ``{...}`` span is read, so an object with nested braces inside prose
    is unparseable and counts as a tie.
    """
    obj = "_verdict_obj"
    df = _with_object(df, raw, _SHORTEST_OBJECT, obj)
    found = F.col(obj).isNotNull()
    winner = F.lower(F.try_variant_get(F.col(obj), "$.winner", "string"))
    reason = F.try_variant_get(F.col(obj), "$.reason", "string")
    return (
        df.withColumn("verdict", F.coalesce(winner, F.lit("tie")))
        .withColumn(
            "judge_reason",
            F.when(found, F.coalesce(reason, F.lit(""))).otherwise(F.lit("unparseable")),
        )
        .withColumn("unparsed", F.when(~found, F.left(strip(F.col(raw)), F.lit(300))))
        .drop(obj)
    )


def clean_variants(raw: Column, n: int) -> Column:
    """The first ``n`` variants of a one-per-line answer, list markers removed.

    A marker is any leading run of digits, dots, closing brackets and dashes.
    """
    lines = F.split(raw, r"\r\n|[\r\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]")
    stripped = F.transform(lines, strip)
    bare = F.transform(
        stripped, lambda ln: F.regexp_replace(ln, r"(?U)^[\p{Nd}.)\-][\p{Nd}.)\-\s\x1c-\x1f]*", "")
    )
    return F.slice(F.filter(bare, lambda ln: ln != ""), 1, n)

"""Strict JSON parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Closes the wrapper array; only its presence matters.
_END = "turnmill:end"


def wrapped(c: Column) -> Column:
    """Parse ``[text, end mark]``.

    Spark's parser stops after the first value and ignores what follows it. Inside an
    array, trailing text is an error, and the end mark tells one value from several.
    """
    return F.try_parse_json(F.concat(F.lit("["), c, F.lit(f',"{_END}"]')))


def is_single(w: Column) -> Column:
    """Whether a :func:`wrapped` text was exactly one JSON value."""
    return F.coalesce(F.try_variant_get(w, "$[1]", "string") == _END, F.lit(False))


def single(w: Column) -> Column:
    """The value of a :func:`wrapped` text, null when it was not exactly one."""
    return F.when(is_single(w), F.try_variant_get(w, "$[0]", "variant"))

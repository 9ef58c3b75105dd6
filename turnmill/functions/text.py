"""Scalar text and number helpers, all plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from turnmill.schema import CHARS_PER_TOKEN

# The characters Python's str.strip() removes. Spark's one-argument
# trim only removes the space character.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def fold_case(c: Column) -> Column:
    """Stripped and lower-cased, the form match scores compare."""
    return F.lower(strip(c))


def blank(c: Column) -> Column:
    return strip(c) == ""


def approx_tokens(chars: Column) -> Column:
    """Token estimate of a character count, rounded up."""
    return F.ceil(chars / F.lit(CHARS_PER_TOKEN)).cast("long")


def clip(c: Column, n: int) -> Column:
    """First ``n`` characters, with an ellipsis when something was cut."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("…"))).otherwise(c)


def round_half_even(c: Column, digits: int) -> Column:
    """Round the *binary* value of a double, ties to even, like Python's ``round``.

    ``round`` and ``bround`` look at the shortest decimal form, so 2.675 becomes
    2.68; its binary value is below the tie and must become 2.67. The error of
    ``x * 10^digits`` is recovered exactly by splitting both factors in halves.
    """
    x = c.cast("double")
    k = float(10**digits)
    split = F.lit(134217729.0)  # 2^27 + 1
    k_hi = k * 134217729.0 - (k * 134217729.0 - k)
    k_lo = k - k_hi
    p = x * F.lit(k)
    x_hi = x * split - (x * split - x)
    x_lo = x - x_hi
    err = ((x_hi * k_hi - p) + x_hi * k_lo + x_lo * k_hi) + x_lo * k_lo
    base = F.floor(p).cast("double")
    over = p - base - F.lit(0.5)
    odd = F.pmod(base, F.lit(2.0)) == 1.0
    up = (over > 0) | ((over == 0) & ((err > 0) | ((err == 0) & odd)))
    # The exact product may lie just below a whole p.
    rounded = F.when(up, base + 1.0).otherwise(base)
    return rounded / F.lit(k)

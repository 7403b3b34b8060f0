"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2**27 + 1 cuts a double into two 26-bit halves


def round_half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` places by the exact binary value, true ties to even.

    Spark's ``round`` and ``bround`` decide by the shortest decimal text of a
    double, so 0.145 (stored a little below) would go up. The product with the
    scale is taken exactly, as a rounded part plus its error term. Meant for the
    few rows of a result table.
    """
    scale = F.lit(float(10**digits))

    def rounded(v: Column) -> Column:
        carry = v * F.lit(_SPLITTER)
        high = carry - (carry - v)
        scaled = v * scale
        error = (high * scale - scaled) + (v - high) * scale
        whole = F.floor(scaled)
        beyond_half = scaled - whole - F.lit(0.5)
        odd = F.pmod(whole, F.lit(2)) == 1
        up = (beyond_half > 0) | ((beyond_half == 0) & ((error > 0) | ((error == 0) & odd)))
        return (whole + F.when(up, 1).otherwise(0)) / scale

    # The one-element array names the value, so that its expression is not repeated.
    return F.get(F.transform(F.array(value.cast("double")), rounded), 0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio rounded to six places; zero when there is nothing to divide by."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.when(denominator != 0, round_half_even(ratio, 6)).otherwise(F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    """Share in percent rounded to two places; zero for an empty table."""
    share = F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0)
    return F.when(total != 0, round_half_even(share, 2)).otherwise(F.lit(0.0))

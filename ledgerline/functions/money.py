"""Exact money arithmetic.

Money stays ``DECIMAL`` through every sum; it is rounded HALF_UP and turned
into ``DOUBLE`` only at the output boundary. Averages and ratios are rounded
with integer arithmetic on the decimal operands (``div`` truncates an exact
quotient), so the result is the correctly rounded value of the exact rational
number, independent of how an engine implements decimal division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _div(a: Column, b: Column) -> Column:
    """SQL ``a div b``: exact quotient truncated toward zero, as BIGINT."""
    return F.call_function("div", a, b)


def revenue(price="price", quantity="quantity") -> Column:
    """Line revenue ``price * quantity``: DECIMAL(12,2) * INT -> DECIMAL(23,2)."""
    return _c(price) * _c(quantity)


def money_out(col, scale: int = 2) -> Column:
    """Round an exact money value HALF_UP and cast it to DOUBLE for output."""
    return F.round(_c(col), scale).cast("double")


def avg_money(total, count) -> Column:
    """``round(total / count, 2)`` HALF_UP, computed exactly, as DOUBLE.

    For non-negative totals: cents = (200 * total + count) div (2 * count),
    the floor of (100 * total / count + 1/2). NULL when count is 0 or NULL.
    """
    total, count = _c(total), _c(count)
    cents = _div(total * F.lit(200) + count, count * F.lit(2))
    return F.when(count > 0, cents.cast("double") / F.lit(100.0))


def half_up_ratio(numerator, denominator, scale: int = 6) -> Column:
    """``round(numerator / denominator, scale)`` HALF_UP (away from zero), exact.

    NULL when the denominator is 0 or NULL.
    """
    n, d = _c(numerator), _c(denominator)
    factor = 10**scale
    q = _div(F.abs(n) * F.lit(2 * factor) + F.abs(d), F.abs(d) * F.lit(2))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / F.lit(float(factor)))


def safe_growth(current, previous, scale: int = 6) -> Column:
    """DIVIDE(current - previous, previous, 0): growth ratio, 0 when no base."""
    prev = _c(previous)
    return F.coalesce(half_up_ratio(_c(current) - prev, prev, scale), F.lit(0.0))

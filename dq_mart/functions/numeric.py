"""Exact numeric helpers: percentages, money sums and averages, report text.

Results must not depend on summation order or on the engine, so counts stay
integral, money is summed as DECIMAL, and every rounding is an exact
integer formula (half away from zero, like SQL ``ROUND`` on NUMERIC).
Percentages are DOUBLE at the very end; money stays DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

MONEY = "decimal(18,2)"
#: Type of money sums: exact, and wide enough for any number of rows.
MONEY_SUM = "decimal(38,2)"


def idiv(a: Column, b: Column) -> Column:
    """Integer division (SQL ``div``), exact for BIGINT operands."""
    return F.call_function("div", a, b)


def pct_half_up(n: Column | str, d: Column | str, digits: int) -> Column:
    """``round(100 * n / d, digits)`` for counts n >= 0, d > 0, computed
    exactly in integers; null when d = 0 (the reference would raise)."""
    n = col_of(n).cast("bigint")
    d = col_of(d).cast("bigint")
    scale = 10 ** digits
    q = idiv(F.lit(2 * 100 * scale) * n + d, F.nullif(F.lit(2) * d, F.lit(0)))
    return q.cast("double") / F.lit(float(scale))


def money(c: Column | str) -> Column:
    """A money amount as DECIMAL(18,2), so sums are exact."""
    return col_of(c).cast(MONEY)


def sum_money(c: Column | str) -> Column:
    """Exact sum of money, DECIMAL to the end."""
    return F.sum(money(c)).cast(MONEY_SUM)


def avg_money_from(total: Column | str, n: Column | str) -> Column:
    """``round(total / n, 2)`` half away from zero, from an exact DECIMAL
    total and a row count; computed on whole cents, DECIMAL to the end (the
    sum in cents may exceed BIGINT, the average of money does not)."""
    wide = "decimal(38,0)"
    cents = (col_of(total).cast(MONEY_SUM) * F.lit(100)).cast(wide)
    n = col_of(n).cast("decimal(20,0)")
    two = F.lit(2).cast("decimal(1,0)")
    mag = idiv((two * F.abs(cents) + n).cast(wide), F.nullif(two * n, F.lit(0).cast("decimal(1,0)")))
    signed = F.when(cents < 0, -mag).otherwise(mag)
    return (signed.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY_SUM)


def report_number(c: Column | str) -> Column:
    """Text of a 2-decimal number as the reference's report prints a float:
    ``12.50`` -> ``12.5``, ``12.00`` -> ``12.0``, ``0.05`` -> ``0.05``."""
    s = col_of(c).cast(MONEY_SUM).cast("string")
    s = F.regexp_replace(s, r"0$", "")
    return F.regexp_replace(s, r"\.$", ".0")

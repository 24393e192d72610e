"""Ratios rounded like PostgreSQL NUMERIC (half away from zero, 1 decimal), exactly.

round(s*a/b, 1) for non-negative counts a, b equals floor((20*s*a + b) / (2*b)) / 10, which
is pure integer arithmetic: no decimal scale truncation, no binary-float boundary error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(num: Column, den: Column, scale: int = 100, zero_when_empty: bool = True) -> Column:
    """round(scale * num / den, 1) as DOUBLE for counts num, den >= 0.

    ``zero_when_empty``: 0 for a zero denominator (CASE ... ELSE 0); otherwise NULL
    (NULLIF on the denominator).
    """
    a = num.cast("long")
    b = den.cast("long")
    x = F.lit(20 * scale).cast("long") * a + b
    y = F.when(b > 0, F.lit(2).cast("long") * b)  # NULL instead of a zero divisor
    tenths = ((x - F.pmod(x, y)) / y).cast("long")  # exact integer quotient floor(x / y)
    value = tenths.cast("double") / F.lit(10.0)
    if zero_when_empty:
        return F.when(b > 0, value).otherwise(F.lit(0.0))
    return F.when(b != 0, value)


def ratio(num: Column, den: Column) -> Column:
    """round(num / den, 1) as DOUBLE, 0 when the denominator is 0."""
    return pct(num, den, scale=1)

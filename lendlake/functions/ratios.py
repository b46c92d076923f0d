"""Ratios and means.

Ratios and means are computed in DOUBLE from exact operands: money sums stay
decimal (exact, order independent) and only the final quotient is floating
point, so every engine and every partitioning gives the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """ROUND(100.0 * a / NULLIF(b, 0), digits) in DOUBLE; NULL when b is 0."""
    a = numerator.cast("double")
    b = F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * a / b, digits)


def exact_mean(c: Column) -> Column:
    """AVG(c) as an aggregate: exact SUM over COUNT of non-NULL values."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")


def money_sum(c: Column) -> Column:
    """SUM of a money column, widened so it cannot overflow at scale."""
    from lendlake.constants import MONEY_SUM

    return F.sum(c).cast(MONEY_SUM)

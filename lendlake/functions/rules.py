"""Ordered rule lists.

A rule list is a sequence of ``(condition, value)``. The result is the value
of the first rule whose condition is TRUE; a NULL condition is not TRUE, so it
falls through, exactly like a SQL ``CASE WHEN`` chain (N1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Fold ``[(cond, value)]`` into one ``CASE WHEN`` chain."""
    if not rules:
        return F.lit(default)
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def validity(failures: Sequence[Column]) -> Column:
    """FALSE when any failure condition is TRUE, in order; TRUE otherwise."""
    return first_match([(c, False) for c in failures], True)


def reason(rules: Sequence[tuple[Column, Column | str]]) -> Column:
    """Text of the first failing rule, NULL when none fails."""
    return first_match(rules, F.lit(None).cast("string"))


def not_in(c: Column, domain: Sequence[str]) -> Column:
    """Three-valued ``c NOT IN (...)``: NULL when c is NULL."""
    return ~c.isin(list(domain))

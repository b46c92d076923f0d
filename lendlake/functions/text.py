"""String helpers (H1-H7). All are built-in expressions, so they stay inside
whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendlake.constants import WHITESPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """TRIM that removes any white space at both ends, not only spaces."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_upper(c: Column | str) -> Column:
    """UPPER(TRIM(c))."""
    return F.upper(trim_ws(c))


def capitalize_first(c: Column | str) -> Column:
    """First character upper, all the rest lower: 'santa MARTA' -> 'Santa marta'.

    Deliberately not ``initcap`` (which would capitalise every word, N4).
    """
    t = trim_ws(c)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))


def blank_to_null(c: Column | str) -> Column:
    """NULLIF(TRIM(c), '')."""
    return F.nullif(trim_ws(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """c IS NULL OR TRIM(c) = ''."""
    return _col(c).isNull() | (trim_ws(c) == F.lit(""))


def text(c: Column | str) -> Column:
    """Value as text for messages; NULL stays NULL so concat propagates it."""
    return _col(c).cast("string")


def message(*parts: Column | str) -> Column:
    """NULL-propagating concatenation (H6): plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

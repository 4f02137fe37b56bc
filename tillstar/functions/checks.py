"""Building blocks of quality flags.  NULL in gives NULL out, unless noted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_present(column: str) -> Column:
    """Never NULL."""
    return F.col(column).isNotNull()


def is_positive_id(column: str) -> Column:
    """Never NULL: a missing id fails."""
    return is_present(column) & (F.col(column) > 0)


def is_one_of(column: str, options: Sequence[str]) -> Column:
    return F.col(column).isin(*options)


def matches(column: str, pattern: str) -> Column:
    """The pattern is found in the text."""
    return F.col(column).cast("string").rlike(pattern)


def matches_whole(column: str, pattern: str) -> Column:
    """The pattern, which carries its own anchors, extracts something."""
    return F.regexp_extract(column, pattern, 0) != ""


def rounds_to(left: Column, right: Column, digits: int = 2) -> Column:
    """Equal after rounding both sides half up."""
    return F.round(left, digits) == F.round(right, digits)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two digits; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * 100, 2)

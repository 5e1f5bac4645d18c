"""Row conditions shared by the checks and the one-pass summary."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.schemas import Minimum


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def any_null(columns: Iterable[str]) -> Column:
    return any_of(F.col(c).isNull() for c in columns)


def breaks_pattern(column: str, pattern: str) -> Column:
    """True for text that does not match; NULL, and so not flagged, for NULL."""
    return ~F.col(column).rlike(pattern)


def has_outer_spaces(column: str) -> Column:
    return F.col(column) != F.trim(column)


def is_below(minimum: Minimum) -> Column:
    """True outside the allowed range; NULL, and so not flagged, for NULL."""
    value = F.col(minimum.column)
    return value < minimum.value if minimum.inclusive else value <= minimum.value

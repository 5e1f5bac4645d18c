"""Business-day arithmetic in closed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day number of Monday 5 January 1970, counted from 1 January 1970.
_FIRST_MONDAY = 4


def _weekdays_up_to(day_number: Column) -> Column:
    """Weekdays from the first Monday up to and including a day: five per full week, plus the rest."""
    since_monday = day_number - _FIRST_MONDAY
    full_weeks = F.floor(since_monday / 7)
    into_week = F.pmod(since_monday, F.lit(7)) + 1
    return full_weeks * 5 + F.least(into_week, F.lit(5))


def business_days(start: str, end: str) -> Column:
    """Weekdays in the range with both ends counted, less one; NULL if a date is missing.

    Same weekday 0, Friday to Monday 1, Saturday to Sunday -1. Reversed dates
    count the same range, so they look like a normal gap; check the order apart.
    The cost does not depend on the length of the range, and no array is built.
    """
    first = F.unix_date(F.least(start, end))
    last = F.unix_date(F.greatest(start, end))
    gap = _weekdays_up_to(last) - _weekdays_up_to(first - 1) - 1
    both_known = F.col(start).isNotNull() & F.col(end).isNotNull()
    return F.when(both_known, gap.cast("int"))

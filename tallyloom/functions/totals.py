"""Sums and averages that can be built in two steps, before and after a join.

A line total is a double. Adding doubles in another order changes the last
digits, so a retried task could change a report. Amounts are therefore added as
whole millionths, in three long sums: units of 2^20, the units below, and the
millionths below a unit. Each grows by less than 2^20 a row, so none can overflow
before some nine trillion rows have been added, and the sums carry into each other
only once, in a decimal at the end. That costs about as much as a double sum and a
tenth of a decimal one. What an amount has beyond its whole millionths goes into a
fourth sum, of doubles, unless it is no more than the rounding of the amount
itself. Amounts of 10^9 or more, NaN and infinity go there whole, row by row. So
nothing is left out, and sums of amounts below 10^9 with six decimals or fewer do
not depend on the order of rows, however many there are.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_PER_UNIT = 1e6
# Bits of the lower limb of the units; the upper one has ten bits and the sign.
_LIMB = 20
# In millionths. Beyond this a double has too few digits left to round to one.
_EXACT_BELOW = 1e15
# Half a dozen roundings of a double, as a share of the amount.
_NOISE = 2.0**-50


def partial_sum(column: str) -> list[Column]:
    """First step: the parts of a sum, to be merged by ``merge_sum``."""
    amount = F.col(column)
    millionths = F.rint(amount * _PER_UNIT)
    exact = F.abs(millionths) < _EXACT_BELOW
    units = F.floor(millionths / _PER_UNIT)
    rest = (millionths - units.cast("double") * _PER_UNIT).cast("long")
    beyond = amount - millionths / _PER_UNIT
    noise = (F.abs(amount) >= 1 / _PER_UNIT) & (F.abs(beyond) <= F.abs(amount) * _NOISE)
    return [
        F.sum(F.when(exact, F.shiftright(units, _LIMB))).alias("_high"),
        F.sum(F.when(exact, units.bitwiseAND(F.lit((1 << _LIMB) - 1)))).alias("_low"),
        F.sum(F.when(exact, rest)).alias("_rest"),
        F.sum(F.when(~exact, amount).when(~noise, beyond)).alias("_beyond"),
        F.count(amount).alias("_amounts"),
    ]


def merge_sum() -> Column:
    """Second step: one double from the parts; NULL where no row had an amount."""
    limb = lambda name, weight: F.coalesce(F.sum(name), F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(weight))
    whole = limb("_high", 1 << _LIMB) + limb("_low", 1) + limb("_rest", "0.000001")
    total = whole.cast("double") + F.coalesce(F.sum("_beyond"), F.lit(0.0))
    return F.when(F.sum("_amounts") > 0, total)


def partial_mean(column: str) -> list[Column]:
    """First step: the parts of a mean of whole numbers, to be merged by ``merge_mean``."""
    return [F.sum(column).alias("_total"), F.count(column).alias("_values")]


def merge_mean() -> Column:
    """Second step: the mean from the parts; NULL where no row had a value."""
    return F.try_divide(F.sum("_total").cast("double"), F.sum("_values").cast("double"))

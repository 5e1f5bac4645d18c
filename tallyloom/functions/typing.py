"""Text to typed values. Bad text gives NULL whether ANSI mode is on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.schemas import DATE_PATTERN


def typed(column: str, spark_type: str) -> Column:
    """Cast text. Dates must have the full shape: a bare '2021-06' would cast to its first day."""
    text = F.col(column)
    if spark_type == "date":
        text = F.when(text.rlike(DATE_PATTERN), text)
    return text.try_cast(spark_type)


def lost_in_typing(column: str, spark_type: str) -> Column:
    """True for text that is there, has the right shape, and still does not cast."""
    text = F.col(column)
    present = text.rlike(DATE_PATTERN) if spark_type == "date" else text.isNotNull()
    return present & text.try_cast(spark_type).isNull()

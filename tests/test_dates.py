from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.dates import business_days

MONDAY = date(2021, 6, 7)


def gap(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a date, b date")
    return [r.gap for r in df.select("i", business_days("a", "b").alias("gap")).orderBy("i").collect()]


@pytest.mark.usefixtures("either_ansi")
def test_known_gaps(spark):
    friday, saturday, sunday = (MONDAY + timedelta(days=n) for n in (4, 5, 6))
    next_monday = MONDAY + timedelta(days=7)
    cases = {
        (MONDAY, MONDAY): 0,
        (friday, next_monday): 1,
        (saturday, next_monday): 0,
        (saturday, sunday): -1,
        (saturday, saturday): -1,
        (friday, saturday): 0,
        (next_monday, friday): 1,
        (MONDAY, next_monday): 5,
        (None, MONDAY): None,
        (MONDAY, None): None,
        (None, None): None,
    }
    assert gap(spark, cases) == list(cases.values())


def counted_day_by_day(a, b):
    first, last = min(a, b), max(a, b)
    days = (first + timedelta(days=n) for n in range((last - first).days + 1))
    return sum(d.weekday() < 5 for d in days) - 1


dates = st.dates(min_value=date(1900, 1, 1), max_value=date(2100, 12, 31))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(dates, st.integers(-400, 400)), min_size=50, max_size=200))
def test_equals_counting_day_by_day(spark, starts):
    pairs = [(a, a + timedelta(days=n)) for a, n in starts]
    assert gap(spark, pairs) == [counted_day_by_day(a, b) for a, b in pairs]


def test_type_is_int_and_no_array_is_built(spark):
    df = spark.range(10).select(
        F.date_add(F.lit(MONDAY), F.col("id").cast("int")).alias("a"), F.lit(MONDAY).alias("b")
    )
    result = df.select(business_days("a", "b").alias("gap"))
    assert result.schema["gap"].dataType.simpleString() == "int"
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "sequence(" not in plan

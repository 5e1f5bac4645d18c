"""Checks of raw tables: what is missing, repeated, malformed or padded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.conditions import any_null, any_of, breaks_pattern, has_outer_spaces
from tallyloom.operators.lookup import rows_with_keys
from tallyloom.schemas import DECIMAL_PATTERN


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs per column, under the column's name."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.where(any_null(df.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``count``. NULL counts as one key value."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def rows_of_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows behind the repeated keys. Rows with a NULL in the key match nothing."""
    return rows_with_keys(df, duplicate_keys(df.where(~any_null(keys)), keys).select(*keys))


def bad_format(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Distinct values that do not match the pattern."""
    return df.where(breaks_pattern(column, pattern)).select(column).distinct()


def bad_decimals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (ColumnName, BadValue) over several columns, in one pass.

    Only failing values become rows, so sound data adds nothing to the shuffle.
    """
    failures = {c: breaks_pattern(c, DECIMAL_PATTERN) for c in columns}
    entries = [
        F.when(failed, F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("BadValue")))
        for c, failed in failures.items()
    ]
    flagged = df.where(any_of(failures.values()))
    return flagged.select(F.inline(F.array_compact(F.array(*entries)))).distinct()


def untrimmed_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns has leading or trailing spaces."""
    return df.where(any_of(has_outer_spaces(c) for c in columns))


def row_count(df: DataFrame, alias: str = "RowCount") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (TableName, RowCount) row per table."""
    counts = [row_count(df).select(F.lit(name).alias("TableName"), "RowCount") for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """A repeatable preview: the first ``n`` rows in the given order."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """Column by column: the type found, the type expected, and whether they agree."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = [(c, found.get(c), wanted.get(c), found.get(c) == wanted.get(c)) for c in {**wanted, **found}]
    return df.sparkSession.createDataFrame(rows, "ColumnName string, Found string, Expected string, Agrees boolean")

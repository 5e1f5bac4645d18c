"""Checks of typed tables. Each returns the offending rows, or counts for reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.conditions import any_null, is_below
from tallyloom.operators.lookup import rows_without_match
from tallyloom.schemas import Minimum


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column."""
    return df.where(any_null(keys))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent; a NULL key is an orphan too."""
    return rows_without_match(child, child_key, parent, parent_key)


def out_of_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where the later date lies before the earlier one. Missing dates are not flagged."""
    return df.where(F.col(later) < F.col(earlier))


def below_minimum(df: DataFrame, minimum: Minimum) -> DataFrame:
    """Rows under the allowed range. NULLs are not flagged."""
    return df.where(is_below(minimum))


def reconcile(layers: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows per table before and after standardising: TableName, RawRows, StoreRows, Difference."""

    def counted(name: str, df: DataFrame, is_store: int) -> DataFrame:
        counts = df.agg(F.count("*").alias("n"))
        return counts.select(
            F.lit(name).alias("TableName"),
            (F.col("n") * (1 - is_store)).alias("raw"),
            (F.col("n") * is_store).alias("store"),
        )

    parts = [counted(name, df, i) for name, pair in layers.items() for i, df in enumerate(pair)]
    totals = reduce(DataFrame.unionAll, parts).groupBy("TableName")
    return totals.agg(
        F.sum("raw").alias("RawRows"),
        F.sum("store").alias("StoreRows"),
        (F.sum("store") - F.sum("raw")).alias("Difference"),
    )

"""All row-level checks of a raw table in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.conditions import breaks_pattern, has_outer_spaces, is_below
from tallyloom.functions.typing import lost_in_typing
from tallyloom.operators.standardise import apply_types
from tallyloom.schemas import DATE_PATTERN, DECIMAL_PATTERN, LAYOUTS, Layouts, TableLayout
from tallyloom.sources.csv import RawTables


def _raw_checks(layout: TableLayout) -> list[tuple[str, str, Column]]:
    """(check, column, condition) for conditions on the raw text."""
    return [
        *[("null", c, F.col(c).isNull()) for c in layout.columns],
        *[("bad_date", c, breaks_pattern(c, DATE_PATTERN)) for c in layout.of_type("date")],
        *[("bad_decimal", c, breaks_pattern(c, DECIMAL_PATTERN)) for c in layout.of_type("double")],
        *[("untrimmed", c, has_outer_spaces(c)) for c in layout.trimmed],
        *[("lost_in_typing", c, lost_in_typing(c, t)) for c, t in layout.typed.items()],
    ]


def _store_checks(layout: TableLayout) -> list[tuple[str, str, Column]]:
    """(check, column, condition) for conditions on the typed values."""
    checks = [("null_key", layout.key, F.col(layout.key).isNull())]
    checks += [("below_minimum", m.column, is_below(m)) for m in layout.minimums]
    if {"OrderDate", "ShipDate"} <= set(layout.columns):
        checks.append(("before_order_date", "ShipDate", F.col("ShipDate") < F.col("OrderDate")))
    return checks


def table_quality(raw: DataFrame, layout: TableLayout) -> DataFrame:
    """TableName, CheckName, ColumnName, FailedRows, TotalRows for one table, from one scan."""
    raw_checks, store_checks = _raw_checks(layout), _store_checks(layout)
    flagged = raw.select("*", *[c.alias(f"_raw_{i}") for i, (_, _, c) in enumerate(raw_checks)])
    flagged = apply_types(flagged, layout.typed)
    flags = [F.col(f"_raw_{i}") for i in range(len(raw_checks))] + [c for _, _, c in store_checks]
    counts = flagged.agg(
        F.count("*").alias("TotalRows"), *[F.count_if(flag).alias(f"_n_{i}") for i, flag in enumerate(flags)]
    )
    lines = [
        F.struct(
            F.lit(layout.name).alias("TableName"),
            F.lit(check).alias("CheckName"),
            F.lit(column).alias("ColumnName"),
            F.col(f"_n_{i}").alias("FailedRows"),
            F.col("TotalRows").alias("TotalRows"),
        )
        for i, (check, column, _) in enumerate(raw_checks + store_checks)
    ]
    return counts.select(F.inline(F.array(*lines)))


def quality_summary(raw: RawTables, layouts: Layouts = LAYOUTS) -> DataFrame:
    """The lines of ``table_quality`` for all three tables."""
    return reduce(DataFrame.unionAll, [table_quality(df, layout) for df, layout in zip(raw, layouts)])

"""Repairs that turn raw text tables into typed store tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.typing import typed


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip leading and trailing spaces (spaces only, tabs stay)."""
    return df.withColumns({c: F.trim(c) for c in columns})


def most_complete(df: DataFrame, keys: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """One row per key: the one with the fewest gaps in ``wanted``, earlier columns first.

    Rows that are equally complete are told apart by their other columns, in
    order and NULL first, so the choice does not depend on how rows arrive.
    It is a plain aggregate: each task keeps one row per key before the shuffle,
    whatever share of the table one key holds. NULL keys form one group.
    """
    others = [c for c in df.columns if c not in keys]
    gaps = [F.col(c).isNull().alias(f"gap_{c}") for c in wanted]
    best = F.min(F.struct(*gaps, F.struct(*others).alias("row"))).alias("_best")
    kept = df.groupBy(*keys).agg(best)
    return kept.select(*[F.col(c) if c in keys else F.col(f"_best.row.{c}").alias(c) for c in df.columns])


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; bad text becomes NULL and other columns stay as they are."""
    return df.withColumns({c: typed(c, t) for c, t in types.items()})

"""Raw to store: trimmed, one row per product, typed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tallyloom.functions.categories import CATEGORY, SUBCATEGORY
from tallyloom.operators.standardise import apply_types, most_complete, trim_columns
from tallyloom.schemas import LAYOUTS, ORDER_DETAIL, ORDER_HEADER, PRODUCT, Layouts, TableLayout
from tallyloom.sources.csv import RawTables


class StoreTables(NamedTuple):
    product: DataFrame
    header: DataFrame
    detail: DataFrame


def clean_product(raw: DataFrame, layout: TableLayout = PRODUCT) -> DataFrame:
    """Trimmed and one row per key, still as text."""
    return most_complete(trim_columns(raw, layout.trimmed), [layout.key], [CATEGORY, SUBCATEGORY])


def store_product(raw: DataFrame, layout: TableLayout = PRODUCT) -> DataFrame:
    """Colour stays NULL here, so that null checks on the store show the real gaps."""
    return apply_types(clean_product(raw, layout), layout.typed)


def store_header(raw: DataFrame, layout: TableLayout = ORDER_HEADER) -> DataFrame:
    return apply_types(raw, layout.typed)


def store_detail(raw: DataFrame, layout: TableLayout = ORDER_DETAIL) -> DataFrame:
    return apply_types(raw, layout.typed)


def store_tables(raw: RawTables, layouts: Layouts = LAYOUTS) -> StoreTables:
    """Keys are 64-bit unless the layouts, made with ``TableLayout.with_types``, say otherwise."""
    product, header, detail = layouts
    return StoreTables(
        store_product(raw.product, product), store_header(raw.header, header), store_detail(raw.detail, detail)
    )

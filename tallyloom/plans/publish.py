"""Store to publish: the product master and the enriched order lines, with their checks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.categories import CATEGORY, SUBCATEGORY, backfilled_category, covered_by_rule
from tallyloom.functions.dates import business_days
from tallyloom.operators.review import first_rows
from tallyloom.plans.store import StoreTables
from tallyloom.schemas import MISSING_COLOR, PRODUCT

_HEADER_COLUMNS = ("OrderDate", "ShipDate", "OnlineOrderFlag", "AccountNumber", "CustomerID", "SalesPersonID")


class PublishTables(NamedTuple):
    product: DataFrame
    orders: DataFrame


def publish_product(store: DataFrame) -> DataFrame:
    """Missing colours get a label; missing categories come from the subcategory where a rule covers it."""
    return store.withColumns(
        {"Color": F.coalesce("Color", F.lit(MISSING_COLOR)), CATEGORY: backfilled_category()}
    )


def publish_orders(detail: DataFrame, header: DataFrame) -> DataFrame:
    """Order lines with their header, lead time and extended price.

    Both computed columns are worked out before the join: the lead time once
    per order instead of once per line, and the line total so that reports
    which need only the total shuffle one column in place of three. Orders and
    lines meet straight from their scans, so adaptive execution can split an
    order that holds much of the lines. Lines without an order are dropped.
    The freight belongs to the order and repeats on each line: do not sum it here.
    """
    orders = header.select(
        "SalesOrderID",
        *_HEADER_COLUMNS,
        F.col("Freight").alias("TotalOrderFreight"),
        business_days("OrderDate", "ShipDate").alias("LeadTimeInBusinessDays"),
    )
    lines = detail.withColumn(
        "TotalLineExtendedPrice", F.col("OrderQty") * (F.col("UnitPrice") - F.col("UnitPriceDiscount"))
    )
    return lines.join(orders, "SalesOrderID").select(
        *detail.columns,
        *_HEADER_COLUMNS,
        "TotalOrderFreight",
        "LeadTimeInBusinessDays",
        "TotalLineExtendedPrice",
    )


def publish_tables(store: StoreTables) -> PublishTables:
    return PublishTables(publish_product(store.product), publish_orders(store.detail, store.header))


def rows_without_color(product: DataFrame) -> DataFrame:
    """Published products whose colour is still missing: expected to be none."""
    return product.where(F.col("Color").isNull())


def labelled_color_sample(product: DataFrame, n: int) -> DataFrame:
    """The first few products, by key, that carry the missing-colour label."""
    return first_rows(product.where(F.col("Color") == MISSING_COLOR), n, [PRODUCT.key])


def rows_covered_by_category_rule(product: DataFrame) -> DataFrame:
    return product.where(covered_by_rule()).select(PRODUCT.key, SUBCATEGORY, CATEGORY)


def backfill_counts(store: DataFrame) -> DataFrame:
    """One pass: products due a category before the backfill, and those still without one after it."""
    due = covered_by_rule() & F.col(CATEGORY).isNull()
    return store.agg(
        F.count_if(due).alias("EligibleBefore"),
        F.count_if(covered_by_rule() & backfilled_category().isNull()).alias("RemainingAfter"),
    )

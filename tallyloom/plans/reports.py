"""The two reports and their intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.categories import CATEGORY
from tallyloom.functions.totals import merge_mean, merge_sum, partial_mean, partial_sum
from tallyloom.operators.lookup import aggregate_by_attribute
from tallyloom.operators.ranking import ranked_within
from tallyloom.schemas import PRODUCT


def revenue_by_year_color(orders: DataFrame, product: DataFrame) -> DataFrame:
    """Year, Color, TotalRevenue. Lines without an order date have no year and are left out.

    A line whose product is unknown has a NULL colour, not the missing-colour label.
    """
    lines = orders.where(F.col("OrderDate").isNotNull()).select(
        F.year("OrderDate").alias("Year"), PRODUCT.key, "TotalLineExtendedPrice"
    )
    parts = partial_sum("TotalLineExtendedPrice")
    partial = aggregate_by_attribute(lines, ["Year"], parts, product, PRODUCT.key, "Color")
    return partial.groupBy("Year", "Color").agg(merge_sum().alias("TotalRevenue"))


def ranked_colors(orders: DataFrame, product: DataFrame, spread: bool = False) -> DataFrame:
    """Every colour with its ``rank`` within the year, highest revenue first, ties by colour.

    The window sees one row per year and colour, after all lines are added up, and gives each year to one task. Where
    a year has many millions of colours, ``spread`` divides it over tasks, at the cost of writing those rows once.
    """
    best_first = [F.desc_nulls_last("TotalRevenue"), F.asc_nulls_first("Color")]
    revenue = revenue_by_year_color(orders, product)
    if spread:
        return ranked_within(revenue, ["Year"], best_first).withColumn("rank", F.col("rank").cast("int"))
    return revenue.withColumn("rank", F.row_number().over(Window.partitionBy("Year").orderBy(*best_first)))


def top_color_per_year(orders: DataFrame, product: DataFrame) -> DataFrame:
    """Year, Color, TotalRevenue of the colour that ranks first, by an aggregate and not a sort."""
    revenue = F.col("TotalRevenue")
    place = F.struct(revenue.isNull(), ~F.isnan(revenue), -revenue, "Color")
    winner = F.min_by(F.struct("Color", "TotalRevenue"), place).alias("_winner")
    return revenue_by_year_color(orders, product).groupBy("Year").agg(winner).select("Year", "_winner.*")


def lead_time_by_category(orders: DataFrame, product: DataFrame) -> DataFrame:
    """Mean lead time over the order lines of each category, longest first, lines of no category included."""
    lines = orders.select(PRODUCT.key, "LeadTimeInBusinessDays")
    parts = partial_mean("LeadTimeInBusinessDays")
    partial = aggregate_by_attribute(lines, [], parts, product, PRODUCT.key, CATEGORY)
    means = partial.groupBy(CATEGORY).agg(merge_mean().alias("AvgLeadTimeInBusinessDays"))
    return means.orderBy(F.desc("AvgLeadTimeInBusinessDays"), CATEGORY)


def lead_time_by_known_category(orders: DataFrame, product: DataFrame) -> DataFrame:
    """The same without the lines of no category."""
    return lead_time_by_category(orders, product).where(F.col(CATEGORY).isNotNull())

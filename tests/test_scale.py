"""The plans hold when one key has a third of all rows, and read no more than they need."""

import re

import pytest
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from tallyloom.operators import lookup, review, standardise, validate
from tallyloom.plans import publish, reports
from tallyloom.plans.store import store_detail, store_header
from tallyloom.sources.scratch import settle

SF_DIR = "/root/testdata/sf0.001"
LINES = 30_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as it ran, after adaptive changes."""
    df.collect()
    return plan_of(df)


@pytest.fixture
def skew_settings(setting):
    """Thresholds low enough for the small test tables to count as skewed."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )


@pytest.fixture
def hot_lines(spark):
    """Raw order lines: a third belong to one order and one product, and some to no product."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, LINES, 1, 16).select(
        F.when(hot, 7).otherwise(F.col("id") % 5000).cast("string").alias("SalesOrderID"),
        F.col("id").cast("string").alias("SalesOrderDetailID"),
        F.lit("2").alias("OrderQty"),
        F.when(hot, 1).when(F.col("id") % 3 == 1, F.col("id") % 200).cast("string").alias("ProductID"),
        F.lit("1.50").alias("UnitPrice"),
        F.lit("0.25").alias("UnitPriceDiscount"),
    )


@pytest.fixture
def headers(spark):
    return spark.range(0, 5000, 1, 4).select(
        F.col("id").cast("string").alias("SalesOrderID"),
        F.lit("2021-06-07").alias("OrderDate"),
        F.lit("2021-06-09").alias("ShipDate"),
        F.lit("1").alias("OnlineOrderFlag"),
        F.lit("A").alias("AccountNumber"),
        F.lit("1").alias("CustomerID"),
        F.lit("1").alias("SalesPersonID"),
        F.lit("1").alias("Freight"),
    )


@pytest.mark.usefixtures("skew_settings")
def test_hot_order_is_split_in_the_main_join(hot_lines, headers):
    orders = publish.publish_orders(store_detail(hot_lines), store_header(headers))
    assert "SortMergeJoin(skew=true)" in final_plan(orders)
    assert orders.count() == LINES


@pytest.mark.usefixtures("skew_settings")
def test_hot_order_is_split_in_the_reports(hot_lines, headers):
    """Prices differ from line to line here, as equal ones compress to less than any threshold."""
    price = (F.abs(F.xxhash64("SalesOrderDetailID")) % 1_000_000).cast("string")
    lines = store_detail(hot_lines.withColumn("UnitPrice", price))
    orders = publish.publish_orders(lines, store_header(headers))
    product = lines.select("ProductID").distinct().withColumn("Color", F.lit("Red"))
    revenue = reports.revenue_by_year_color(orders, product)
    assert "SortMergeJoin(skew=true)" in final_plan(revenue)
    net = F.col("UnitPrice").cast("decimal(12,2)") - F.col("UnitPriceDiscount").cast("decimal(12,2)")
    [(expected,)] = lines.agg(F.sum(F.col("OrderQty") * net)).collect()
    assert sum(r.TotalRevenue for r in revenue.collect()) == float(expected)


@pytest.mark.usefixtures("skew_settings")
def test_hot_orphan_is_split_when_the_missing_keys_are_too_many_to_broadcast(hot_lines, headers, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    parents = store_header(headers).where("SalesOrderID <> 7 AND SalesOrderID % 2 = 1")
    found = validate.orphans(store_detail(hot_lines), parents, "SalesOrderID", "SalesOrderID")
    assert "SortMergeJoin(skew=true)" in final_plan(found)
    lines = store_detail(hot_lines)
    assert found.count() == lines.where("SalesOrderID = 7 OR SalesOrderID % 2 = 0").count()


def test_rows_of_exceptions_are_fetched_without_a_shuffle(hot_lines):
    found = review.rows_of_duplicate_keys(hot_lines, ["SalesOrderID"])
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_orphans_of_a_small_parent_take_one_read_and_no_shuffle(hot_lines, headers):
    plan = plan_of(validate.orphans(store_detail(hot_lines), store_header(headers), "SalesOrderID", "SalesOrderID"))
    assert "LeftAnti, BuildRight" in plan
    assert plan.count("hashpartitioning") == 0


def test_most_complete_combines_before_the_shuffle(hot_lines):
    kept = standardise.most_complete(hot_lines, ["ProductID"], ["UnitPrice", "OrderQty"])
    plan = plan_of(kept)
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning") and "Window" not in plan
    assert kept.count() == hot_lines.select("ProductID").distinct().count()


def test_large_dimension_is_met_after_rows_are_added_up(hot_lines, headers, monkeypatch):
    """With a dimension too large to broadcast, the join sees products and not lines."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    orders = publish.publish_orders(store_detail(hot_lines), store_header(headers))
    product = settle(orders.select("ProductID").distinct().where("ProductID IS NOT NULL").withColumn("Color", F.lit("Red")))
    revenue = reports.revenue_by_year_color(orders, product)
    tree = revenue._jdf.queryExecution().optimizedPlan().toString()
    join = tree.index("Join LeftOuter")
    assert "Aggregate" in tree[join:].split("\n")[1]
    totals = {r.Color: r.TotalRevenue for r in revenue.collect()}
    no_product = orders.where("ProductID IS NULL").count()
    assert totals == {"Red": (LINES - no_product) * 2.5, None: no_product * 2.5}


def test_small_dimension_is_joined_while_the_lines_are_read(hot_lines, headers):
    orders = publish.publish_orders(store_detail(hot_lines), store_header(headers))
    product = settle(orders.select("ProductID").distinct().withColumn("Color", F.lit("Red")))
    plan = plan_of(reports.revenue_by_year_color(orders, product))
    assert not re.search(r"hashpartitioning\(ProductID", plan)


def test_reports_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["q2_lead_time"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lines = next(s for s in schemas if "l_orderkey" in s)
    assert lines == "l_orderkey:bigint,l_partkey:bigint"


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["customer_below_zero_balance"](spark, SF_DIR))
    assert "LessThan(c_acctbal,0.0)" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for banned in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


def test_hot_bad_values_and_keys_collapse_before_the_shuffle(hot_lines):
    for df in (
        review.bad_decimals(hot_lines, ["SalesOrderID"]),
        review.bad_format(hot_lines, "ProductID", "^x$"),
        review.duplicate_keys(hot_lines, ["SalesOrderID"]),
    ):
        plan = plan_of(df)
        assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
        assert plan.rindex("HashAggregate") > plan.index("Exchange")

from datetime import date

import pytest
from conftest import as_list, as_set
from pyspark.sql import functions as F

from tallyloom.functions.categories import backfilled_category
from tallyloom.plans import publish
from tallyloom.plans.quality import quality_summary, table_quality
from tallyloom.plans.store import StoreTables, store_detail, store_header
from tallyloom.schemas import ACCESSORIES, CLOTHING, COMPONENTS, ORDER_DETAIL, ORDER_HEADER, PRODUCT
from tallyloom.sources.csv import RawTables


@pytest.fixture
def products(rows):
    data = [
        (1, "Red", "Gloves", None),
        (2, None, "Gloves", "Kept"),
        (3, None, "Road Frames", None),
        (4, "Red", "frames", None),
        (5, "Red", "Wheels and more", None),
        (6, "Red", None, None),
        (7, "", "Pumps", ""),
        (8, None, "Jersey", None),
    ]
    return rows(data, "ProductID int, Color string, ProductSubCategoryName string, ProductCategoryName string")


def test_publish_product(products):
    result = publish.publish_product(products)
    assert result.columns == products.columns
    assert as_set(result) == {
        (1, "Red", "Gloves", "Clothing"),
        (2, "N/A", "Gloves", "Kept"),
        (3, "N/A", "Road Frames", "Components"),
        (4, "Red", "frames", None),
        (5, "Red", "Wheels and more", None),
        (6, "Red", None, None),
        (7, "", "Pumps", ""),
        (8, "N/A", "Jersey", None),
    }


def test_each_listed_subcategory_gets_its_category(rows):
    expected = {
        **dict.fromkeys(CLOTHING, "Clothing"),
        **dict.fromkeys(ACCESSORIES, "Accessories"),
        **dict.fromkeys(COMPONENTS, "Components"),
        "Mountain Frames": "Components",
    }
    df = rows([(s, None) for s in expected], "ProductSubCategoryName string, ProductCategoryName string")
    assert dict(df.select("ProductSubCategoryName", backfilled_category()).collect()) == expected


def test_backfill_never_overwrites_and_counts_agree(products):
    published = publish.publish_product(products)
    changed = products.alias("a").join(published.alias("b"), "ProductID").where(
        ~F.col("a.ProductCategoryName").eqNullSafe(F.col("b.ProductCategoryName"))
    )
    assert changed.where(F.col("a.ProductCategoryName").isNotNull()).count() == 0
    [(before, after)] = as_list(publish.backfill_counts(products))
    assert (before, after) == (2, 0)
    assert before - after == changed.count()


def test_checks_of_published_products(products):
    published = publish.publish_product(products)
    assert publish.rows_without_color(published).count() == 0
    assert publish.rows_without_color(products).count() == 3
    assert [r.ProductID for r in publish.labelled_color_sample(published, 2).collect()] == [2, 3]
    assert as_set(publish.rows_covered_by_category_rule(published)) == {
        (1, "Gloves", "Clothing"),
        (2, "Gloves", "Kept"),
        (3, "Road Frames", "Components"),
        (7, "Pumps", ""),
    }


DETAIL = [
    # SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount
    ("1", "10", "2", "7", "10.50", "0.50"),
    ("1", "11", "-1", "7", "10.50", "0"),
    ("2", "12", "1", "8", "x", "0"),
    ("9", "13", "1", "7", "1", "0"),
    (None, "14", "1", "7", "1", "0"),
]
HEADER = [
    # SalesOrderID, OrderDate, ShipDate, OnlineOrderFlag, AccountNumber, CustomerID, SalesPersonID, Freight
    ("1", "2021-06-11", "2021-06-14", "1", "A-1", "5", None, "3.5"),
    ("2", "2021-06", "2021-06-14", "0", "A-2", "6", "9", "-1"),
    ("3", "2021-06-14", "2021-06-11", "0", "A-3", "6", "9", "1"),
]


@pytest.fixture
def raw(spark):
    return RawTables(
        spark.createDataFrame([], PRODUCT.raw_schema),
        spark.createDataFrame(HEADER, ORDER_HEADER.raw_schema),
        spark.createDataFrame(DETAIL, ORDER_DETAIL.raw_schema),
    )


@pytest.mark.usefixtures("either_ansi")
def test_publish_orders(raw):
    result = publish.publish_orders(store_detail(raw.detail), store_header(raw.header))
    assert result.columns == [
        "SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount",
        "OrderDate", "ShipDate", "OnlineOrderFlag", "AccountNumber", "CustomerID", "SalesPersonID",
        "TotalOrderFreight", "LeadTimeInBusinessDays", "TotalLineExtendedPrice",
    ]
    friday, monday = date(2021, 6, 11), date(2021, 6, 14)
    assert as_list(result) == [
        (1, 10, 2, 7, 10.5, 0.5, friday, monday, True, "A-1", 5, None, 3.5, 1, 20.0),
        (1, 11, -1, 7, 10.5, 0.0, friday, monday, True, "A-1", 5, None, 3.5, 1, -10.5),
        (2, 12, 1, 8, None, 0.0, None, monday, False, "A-2", 6, 9, -1.0, None, None),
    ]


def test_lead_time_is_worked_out_below_the_join(raw, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    result = publish.publish_orders(store_detail(raw.detail), store_header(raw.header))
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("unix_date") > plan.index("Join Inner")


@pytest.mark.usefixtures("either_ansi")
def test_table_quality(raw):
    found = {(r.CheckName, r.ColumnName): r.FailedRows for r in table_quality(raw.header, ORDER_HEADER).collect()}
    flagged = {check: n for check, n in found.items() if n}
    assert flagged == {
        ("null", "SalesPersonID"): 1,
        ("bad_date", "OrderDate"): 1,
        ("bad_decimal", "Freight"): 1,
        ("below_minimum", "Freight"): 1,
        ("before_order_date", "ShipDate"): 1,
    }
    details = {(r.CheckName, r.ColumnName): r.FailedRows for r in table_quality(raw.detail, ORDER_DETAIL).collect()}
    assert {check: n for check, n in details.items() if n} == {
        ("null", "SalesOrderID"): 1,
        ("bad_decimal", "UnitPrice"): 1,
        ("lost_in_typing", "UnitPrice"): 1,
        ("below_minimum", "OrderQty"): 1,
    }


def test_impossible_date_is_lost_in_typing_not_malformed(spark):
    header = spark.createDataFrame([("1", "2001-02-30", None, "1", "A", "1", None, "1")], ORDER_HEADER.raw_schema)
    found = {(r.CheckName, r.ColumnName): r.FailedRows for r in table_quality(header, ORDER_HEADER).collect()}
    assert (found["bad_date", "OrderDate"], found["lost_in_typing", "OrderDate"]) == (0, 1)


def test_quality_summary_reads_each_table_once(raw):
    summary = quality_summary(raw)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 3
    assert {r.TableName for r in summary.collect()} == {"Product", "SalesOrderHeader", "SalesOrderDetail"}


def test_publish_tables(raw, products):
    store = StoreTables(products, store_header(raw.header), store_detail(raw.detail))
    published = publish.publish_tables(store)
    assert (published.product.count(), published.orders.count()) == (8, 3)

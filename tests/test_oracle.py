"""Every registered query gives the rows that its SQL gives in DuckDB."""

import pytest

import __spark_entry__
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duck, ORACLE[name]) == []


def test_entry_answers_the_first_report(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["Year", "Color", "TotalRevenue"]
    years = [row.Year for row in result.collect()]
    assert years and len(years) == len(set(years))


@pytest.mark.parametrize("name", sorted(x for x in QUERIES if x.startswith(("worse_", "ragged_", "store_write"))))
def test_worse_tables_hold_what_is_looked_for(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert not result.isEmpty()
    if name == "store_write_report":
        counts = {r.TableName: r for r in result.collect()}
        assert all(r.StoreRows > r.NullKeys for r in counts.values())
        assert counts["Product"].LostKeys > 0 and counts["SalesOrderHeader"].LostKeys > 0
        assert counts["SalesOrderHeader"].OutOfOrder > 0 and counts["SalesOrderDetail"].BelowMinimum > 0


# Counts found in DuckDB for the planted defects, at sf0.01.
@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("duplicate_product_ids", 40),
        ("bad_order_dates", 65),
        ("untrimmed_unit_codes", 1013),
        ("pk_duplicates_detail", 11784),
        ("pk_nulls_detail", 15),
        ("orphans_header", 61),
        ("orphans_product", 32),
        ("ship_before_order", 30),
        ("range_order_qty", 16),
        ("range_freight", 22),
        ("publish_orders", 59939),
        ("store_product", 2000),
    ],
)
def test_planted_defects_are_found(spark, name, expected):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() == expected

"""The queries still match their SQL on tables where one key has a third of the rows and others are NULL."""

import shutil

import pytest

from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from compare import connect, differences
from tallyloom.operators import lookup

SF_DIR = "/root/testdata/sf0.001"

LINES = """SELECT * REPLACE (
    CASE WHEN n % 3 = 0 THEN 707 WHEN n % 50 = 1 THEN NULL ELSE l_orderkey END AS l_orderkey,
    CASE WHEN n % 3 = 0 THEN 11 WHEN n % 7 = 1 THEN NULL ELSE l_partkey END AS l_partkey,
    CASE WHEN n % 3 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
    CASE WHEN n % 11 = 1 THEN NULL ELSE l_discount END AS l_discount,
    CASE WHEN n % 13 = 1 THEN NULL ELSE l_shipdate END AS l_shipdate)
  FROM (SELECT *, row_number() OVER () AS n FROM lineitem)"""
HEADERS = """SELECT * REPLACE (
    CASE WHEN o_orderkey % 9 = 1 THEN NULL ELSE o_orderdate END AS o_orderdate,
    CASE WHEN o_orderkey % 17 = 1 THEN NULL ELSE o_orderkey END AS o_orderkey) FROM orders"""
PARTS = """SELECT * REPLACE (
    CASE WHEN p_partkey % 3 = 0 THEN 11 WHEN p_partkey % 5 = 1 THEN NULL ELSE p_partkey END AS p_partkey) FROM part"""

NAMES = (
    "store_product",
    "publish_orders",
    "duplicate_product_rows",
    "lineitem_duplicate_rows",
    "lineitem_orphans_orders",
    "orders_without_lines",
    "orphans_header",
    "orphans_product",
    "pk_duplicates_detail",
    "row_reconciliation",
    "quality_summary",
    "lineitem_lead_time",
    "q1_top_color",
    "q2_with_null_category",
    "ranked_colors",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    tables = connect(SF_DIR)
    for name, sql in (("lineitem", LINES), ("orders", HEADERS), ("part", PARTS)):
        tables.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    for name in ("customer", "documents", "labels", "events"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", folder)
    tables.close()
    return str(folder)


@pytest.fixture(params=["broadcast", "shuffle"], autouse=True)
def join_choice(request, monkeypatch, setting):
    if request.param == "shuffle":
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
        setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, skewed, name):
    with connect(skewed) as duck:
        assert differences(QUERIES[name](spark, skewed), duck, ORACLE[name]) == []

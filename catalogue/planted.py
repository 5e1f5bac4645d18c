"""Raw retail tables derived from the test tables, with defects planted in known places.

The retail source files are not available, so three of the test tables stand in
for them: part for the products, orders for the order headers, lineitem for the
order lines. Every row of the base table is kept. The remainders only decide
which rows get a defect, and which products get a second, less complete record.

The same text runs in Spark and in DuckDB; ``{part}``, ``{orders}`` and
``{lineitem}`` stand for the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.csv import RawTables

RAW_PRODUCT = r"""
WITH base AS (
  SELECT
    p_partkey,
    CAST(p_partkey AS VARCHAR(20)) AS ProductID,
    CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END AS MakeFlag,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS Color,
    CAST(p_size * 10 AS VARCHAR(20)) AS SafetyStockLevel,
    CAST(p_size * 7 AS VARCHAR(20)) AS ReorderPoint,
    CASE WHEN p_partkey % 401 = 5 THEN '1,200.50'
         ELSE CAST(p_retailprice AS VARCHAR(30)) END AS StandardCost,
    CAST(p_retailprice AS VARCHAR(30)) AS ListPrice,
    CASE WHEN p_partkey % 5 = 0 THEN NULL
         WHEN p_partkey % 5 = 1 THEN '.75'
         ELSE CAST(p_size AS VARCHAR(20)) END AS Weight,
    CASE WHEN p_partkey % 3 = 0 THEN ' CM '
         WHEN p_partkey % 3 = 1 THEN 'CM'
         ELSE NULL END AS SizeUnitMeasureCode,
    CASE WHEN p_partkey % 4 = 0 THEN 'LB '
         WHEN p_partkey % 4 = 1 THEN 'LB'
         ELSE NULL END AS WeightUnitMeasureCode,
    CASE p_partkey % 9
         WHEN 0 THEN 'Gloves' WHEN 1 THEN 'Socks' WHEN 2 THEN 'Helmets'
         WHEN 3 THEN 'Pumps' WHEN 4 THEN 'Road Frames' WHEN 5 THEN 'Wheels'
         WHEN 6 THEN 'Saddles' WHEN 7 THEN 'Tires'
         ELSE NULL END AS ProductSubCategoryName,
    CASE WHEN p_partkey % 4 = 0 THEN NULL
         WHEN p_partkey % 9 IN (0, 1) THEN 'Clothing'
         WHEN p_partkey % 9 IN (2, 3) THEN 'Accessories'
         WHEN p_partkey % 9 IN (4, 5, 6) THEN 'Components'
         ELSE 'Bikes' END AS ProductCategoryName
  FROM {part})
SELECT ProductID, MakeFlag, Color, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight,
       SizeUnitMeasureCode, WeightUnitMeasureCode, ProductSubCategoryName, ProductCategoryName
FROM base
UNION ALL
SELECT ProductID, MakeFlag, Color, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight,
       SizeUnitMeasureCode, WeightUnitMeasureCode,
       'Jersey' AS ProductSubCategoryName, NULL AS ProductCategoryName
FROM base
WHERE p_partkey % 50 = 1
"""

RAW_HEADER = r"""
SELECT
  CAST(o_orderkey AS VARCHAR(20)) AS SalesOrderID,
  CASE WHEN o_orderkey % 101 = 0 THEN substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 7)
       WHEN o_orderkey % 1501 = 7 THEN '2001-02-30'
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS OrderDate,
  CAST(CAST(o_orderdate AS DATE)
       + CAST(CASE WHEN o_orderkey % 500 = 3 THEN -2 ELSE o_orderkey % 12 END AS INT) AS VARCHAR(10)) AS ShipDate,
  CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '0' END AS OnlineOrderFlag,
  CONCAT('10-4020-', CAST(o_custkey AS VARCHAR(20))) AS AccountNumber,
  CAST(o_custkey AS VARCHAR(20)) AS CustomerID,
  CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE CAST(o_custkey % 17 AS VARCHAR(20)) END AS SalesPersonID,
  CASE WHEN o_orderkey % 700 = 1 THEN '-5.00' ELSE CAST(o_totalprice AS VARCHAR(30)) END AS Freight
FROM {orders}
"""

RAW_DETAIL = r"""
SELECT
  CAST(CASE WHEN l_orderkey % 997 = 5 THEN l_orderkey + 100000000 ELSE l_orderkey END AS VARCHAR(20)) AS SalesOrderID,
  CASE WHEN l_orderkey % 2500 = 11 THEN NULL
       ELSE CAST(l_orderkey * 8 + l_linenumber AS VARCHAR(20)) END AS SalesOrderDetailID,
  CASE WHEN l_orderkey % 5000 = 7 THEN '-1'
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR(20)) END AS OrderQty,
  CASE WHEN l_orderkey % 1999 = 3 THEN NULL ELSE CAST(l_partkey AS VARCHAR(20)) END AS ProductID,
  CAST(l_extendedprice AS VARCHAR(30)) AS UnitPrice,
  CAST(l_discount AS VARCHAR(30)) AS UnitPriceDiscount
FROM {lineitem}
"""

# The same tables with the defects that they lack: every label of the category rules, lost, missing and repeated
# keys ('012' beside '12'), equally complete rows, malformed shipping dates, negative prices and discounts.
WORSE_PRODUCT = r"""
WITH base AS (SELECT *, CAST(ProductID AS BIGINT) AS id FROM {raw_product}),
worse AS (
  SELECT
    id,
    CASE WHEN id % 97 = 5 THEN CONCAT('P', ProductID) WHEN id % 89 = 7 THEN NULL
         WHEN id % 83 = 11 THEN CONCAT('0', CAST(id - 1 AS VARCHAR(20))) ELSE ProductID END AS ProductID,
    MakeFlag, Color, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight,
    SizeUnitMeasureCode, WeightUnitMeasureCode,
    CASE id % 15
         WHEN 0 THEN 'Gloves' WHEN 1 THEN 'Shorts' WHEN 2 THEN 'Socks' WHEN 3 THEN 'Tights' WHEN 4 THEN 'Vests'
         WHEN 5 THEN 'Locks' WHEN 6 THEN 'Lights' WHEN 7 THEN 'Headsets' WHEN 8 THEN 'Helmets' WHEN 9 THEN 'Pedals'
         WHEN 10 THEN 'Pumps' WHEN 11 THEN 'Wheels' WHEN 12 THEN 'Saddles' WHEN 13 THEN 'Touring Frames'
         ELSE 'Chains' END AS ProductSubCategoryName,
    CASE WHEN id % 4 = 1 THEN 'Sundries' ELSE NULL END AS ProductCategoryName
  FROM base)
SELECT ProductID, MakeFlag, Color, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight,
       SizeUnitMeasureCode, WeightUnitMeasureCode, ProductSubCategoryName, ProductCategoryName
FROM worse
UNION ALL
SELECT ProductID, MakeFlag, 'tied' AS Color, SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Weight,
       SizeUnitMeasureCode, WeightUnitMeasureCode, ProductSubCategoryName, ProductCategoryName
FROM worse
WHERE id % 41 = 2
"""

WORSE_HEADER = r"""
WITH base AS (SELECT *, CAST(SalesOrderID AS BIGINT) AS id FROM {raw_header})
SELECT
  CASE WHEN id % 211 = 3 THEN NULL WHEN id % 223 = 4 THEN CONCAT('SO', SalesOrderID) ELSE SalesOrderID END AS SalesOrderID,
  OrderDate,
  CASE WHEN id % 103 = 0 THEN substr(ShipDate, 1, 7) ELSE ShipDate END AS ShipDate,
  OnlineOrderFlag, AccountNumber, CustomerID, SalesPersonID, Freight
FROM base
UNION ALL
SELECT SalesOrderID, OrderDate, ShipDate, OnlineOrderFlag, AccountNumber, CustomerID, SalesPersonID, '-1.25' AS Freight
FROM base
WHERE id % 307 = 1
"""

WORSE_DETAIL = r"""
SELECT
  SalesOrderID, SalesOrderDetailID, OrderQty, ProductID,
  CASE WHEN CAST(SalesOrderID AS BIGINT) % 307 = 2 THEN '-1.50' ELSE UnitPrice END AS UnitPrice,
  CASE WHEN CAST(SalesOrderID AS BIGINT) % 311 = 3 THEN '-0.05' ELSE UnitPriceDiscount END AS UnitPriceDiscount
FROM {raw_detail}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_PRODUCT, part=table(spark, sf_dir, "part"))


def raw_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_HEADER, orders=table(spark, sf_dir, "orders"))


def raw_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_DETAIL, lineitem=table(spark, sf_dir, "lineitem"))


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(raw_product(spark, sf_dir), raw_header(spark, sf_dir), raw_detail(spark, sf_dir))


def worse_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WORSE_PRODUCT, raw_product=raw_product(spark, sf_dir))


def worse_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WORSE_HEADER, raw_header=raw_header(spark, sf_dir))


def worse_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WORSE_DETAIL, raw_detail=raw_detail(spark, sf_dir))


def worse_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(worse_product(spark, sf_dir), worse_header(spark, sf_dir), worse_detail(spark, sf_dir))

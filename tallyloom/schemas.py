"""Table layouts, and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Text patterns, labels and word lists.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DECIMAL_PATTERN = r"^(\d+(\.\d+)?|\.\d+)$"
MISSING_COLOR = "N/A"
CLOTHING = ("Gloves", "Shorts", "Socks", "Tights", "Vests")
ACCESSORIES = ("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps")
COMPONENTS = ("Wheels", "Saddles")
COMPONENT_PART = "Frames"


@dataclass(frozen=True)
class CategoryRule:
    """Subcategories that imply a category: exact labels, or any label holding ``part``."""

    category: str
    labels: tuple[str, ...]
    part: str | None = None


CATEGORY_RULES = (
    CategoryRule("Clothing", CLOTHING),
    CategoryRule("Accessories", ACCESSORIES),
    CategoryRule("Components", COMPONENTS, part=COMPONENT_PART),
)


@dataclass(frozen=True)
class Minimum:
    """Smallest value a column may hold; ``inclusive`` allows the bound itself."""

    column: str
    value: float = 0
    inclusive: bool = True


@dataclass(frozen=True)
class TableLayout:
    """Name, source file, columns with their store types, and rules of one table."""

    name: str
    file_name: str
    columns: dict[str, str]
    key: str
    trimmed: tuple[str, ...] = ()
    minimums: tuple[Minimum, ...] = ()

    def of_type(self, spark_type: str) -> list[str]:
        return [c for c, t in self.columns.items() if t == spark_type]

    def with_types(self, **types: str) -> TableLayout:
        """The same layout with other store types, such as bigint for keys beyond 32 bits."""
        return replace(self, columns={**self.columns, **types})

    @property
    def typed(self) -> dict[str, str]:
        """The columns whose store type is not text."""
        return {c: t for c, t in self.columns.items() if t != "string"}

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def store_schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in self.columns.items()))


PRODUCT = TableLayout(
    name="Product",
    file_name="products.csv",
    columns={
        "ProductID": "bigint",
        "MakeFlag": "boolean",
        "Color": "string",
        "SafetyStockLevel": "int",
        "ReorderPoint": "int",
        "StandardCost": "double",
        "ListPrice": "double",
        "Weight": "double",
        "SizeUnitMeasureCode": "string",
        "WeightUnitMeasureCode": "string",
        "ProductSubCategoryName": "string",
        "ProductCategoryName": "string",
    },
    key="ProductID",
    trimmed=("SizeUnitMeasureCode", "WeightUnitMeasureCode"),
)

ORDER_HEADER = TableLayout(
    name="SalesOrderHeader",
    file_name="sales_order_header.csv",
    columns={
        "SalesOrderID": "bigint",
        "OrderDate": "date",
        "ShipDate": "date",
        "OnlineOrderFlag": "boolean",
        "AccountNumber": "string",
        "CustomerID": "bigint",
        "SalesPersonID": "bigint",
        "Freight": "double",
    },
    key="SalesOrderID",
    minimums=(Minimum("Freight"),),
)

ORDER_DETAIL = TableLayout(
    name="SalesOrderDetail",
    file_name="sales_order_detail.csv",
    columns={
        "SalesOrderID": "bigint",
        "SalesOrderDetailID": "bigint",
        "OrderQty": "int",
        "ProductID": "bigint",
        "UnitPrice": "double",
        "UnitPriceDiscount": "double",
    },
    key="SalesOrderDetailID",
    minimums=(
        Minimum("OrderQty", inclusive=False),
        Minimum("UnitPrice"),
        Minimum("UnitPriceDiscount"),
    ),
)

Layouts = tuple[TableLayout, TableLayout, TableLayout]
LAYOUTS: Layouts = (PRODUCT, ORDER_HEADER, ORDER_DETAIL)

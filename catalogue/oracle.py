"""The SQL each registered query is checked against, written for DuckDB.

Written apart from the Spark plans and, where it can be, in another way: lead
times count listed days, reports join line by line, duplicates use windows.
"""

from __future__ import annotations

from catalogue.planted import RAW_DETAIL, RAW_HEADER, RAW_PRODUCT, WORSE_DETAIL, WORSE_HEADER, WORSE_PRODUCT
from catalogue.queries import PREVIEW_ROWS, PRIORITY_PATTERN
from tallyloom.schemas import ORDER_DETAIL, ORDER_HEADER, PRODUCT, TableLayout

# Fixed values, written out here apart from those of the library.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DECIMAL_PATTERN = r"^(\d+(\.\d+)?|\.\d+)$"
MISSING_COLOR = "N/A"
CLOTHING = ("Gloves", "Shorts", "Socks", "Tights", "Vests")
ACCESSORIES = ("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps")
COMPONENTS = ("Wheels", "Saddles")
COMPONENT_PART = "Frames"


def _quoted(labels: tuple[str, ...]) -> str:
    return ", ".join(f"'{label}'" for label in labels)


def _typed(layout: TableLayout, skip: tuple[str, ...] = ()) -> str:
    def one(column: str, spark_type: str) -> str:
        if column in skip:
            return f"trim({column}, ' ') AS {column}"
        if spark_type == "string":
            return column
        text = column
        if spark_type == "date":
            text = f"CASE WHEN regexp_matches({column}, '{DATE_PATTERN}') THEN {column} END"
        return f"TRY_CAST({text} AS {spark_type.upper()}) AS {column}"

    return ", ".join(one(c, t) for c, t in layout.columns.items())


_CATEGORY_CASE = f"""CASE
  WHEN ProductCategoryName IS NOT NULL THEN ProductCategoryName
  WHEN ProductSubCategoryName IN ({_quoted(CLOTHING)}) THEN 'Clothing'
  WHEN ProductSubCategoryName IN ({_quoted(ACCESSORIES)}) THEN 'Accessories'
  WHEN contains(ProductSubCategoryName, '{COMPONENT_PART}')
    OR ProductSubCategoryName IN ({_quoted(COMPONENTS)}) THEN 'Components' END"""

_COVERED = f"""(ProductSubCategoryName IN ({_quoted(CLOTHING + ACCESSORIES + COMPONENTS)})
  OR contains(ProductSubCategoryName, '{COMPONENT_PART}'))"""

# Weekdays among the listed days from one date to the other, whichever is first, less one.
_LEAD_TIME = """CASE WHEN OrderDate IS NOT NULL AND ShipDate IS NOT NULL THEN CAST(len(list_filter(
    generate_series(CAST(least(OrderDate, ShipDate) AS TIMESTAMP), CAST(greatest(OrderDate, ShipDate) AS TIMESTAMP),
                    INTERVAL 1 DAY),
    lambda d: dayofweek(d) BETWEEN 1 AND 5)) - 1 AS INTEGER) END"""

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_product": ((), RAW_PRODUCT.format(part="part")),
    "raw_header": ((), RAW_HEADER.format(orders="orders")),
    "raw_detail": ((), RAW_DETAIL.format(lineitem="lineitem")),
    "store_product": (
        ("raw_product",),
        f"""SELECT {_typed(PRODUCT, skip=PRODUCT.trimmed)} FROM raw_product
        QUALIFY row_number() OVER (PARTITION BY ProductID ORDER BY
          ProductCategoryName IS NULL, ProductSubCategoryName IS NULL,
          {", ".join(f"{c} ASC NULLS FIRST" for c in PRODUCT.columns if c != PRODUCT.key)}) = 1""",
    ),
    "store_header": (("raw_header",), f"SELECT {_typed(ORDER_HEADER)} FROM raw_header"),
    "store_detail": (("raw_detail",), f"SELECT {_typed(ORDER_DETAIL)} FROM raw_detail"),
    "publish_product": (
        ("store_product",),
        f"""SELECT * REPLACE (coalesce(Color, '{MISSING_COLOR}') AS Color, {_CATEGORY_CASE} AS ProductCategoryName)
        FROM store_product""",
    ),
    "publish_orders": (
        ("store_detail", "store_header"),
        f"""SELECT {", ".join(f"d.{c}" for c in ORDER_DETAIL.columns)}, OrderDate, ShipDate, OnlineOrderFlag,
          AccountNumber, CustomerID, SalesPersonID, Freight AS TotalOrderFreight,
          {_LEAD_TIME} AS LeadTimeInBusinessDays,
          OrderQty * (UnitPrice - UnitPriceDiscount) AS TotalLineExtendedPrice
        FROM store_detail d JOIN store_header h ON d.SalesOrderID = h.SalesOrderID""",
    ),
    # Prices have two decimals, so the decimal sum is exact.
    "color_revenue": (
        ("publish_orders", "publish_product"),
        """SELECT CAST(year(o.OrderDate) AS INTEGER) AS "Year", p.Color,
          CAST(sum(o.OrderQty * (CAST(o.UnitPrice AS DECIMAL(12,2)) - CAST(o.UnitPriceDiscount AS DECIMAL(12,2))))
            AS DOUBLE) AS TotalRevenue
        FROM publish_orders o LEFT JOIN publish_product p ON o.ProductID = p.ProductID
        WHERE o.OrderDate IS NOT NULL GROUP BY ALL""",
    ),
    "color_rank": (
        ("color_revenue",),
        """SELECT *, CAST(row_number() OVER (PARTITION BY "Year"
          ORDER BY TotalRevenue DESC NULLS LAST, Color ASC NULLS FIRST) AS INTEGER) AS "rank" FROM color_revenue""",
    ),
    "category_lead_time": (
        ("publish_orders", "publish_product"),
        """SELECT p.ProductCategoryName, avg(o.LeadTimeInBusinessDays) AS AvgLeadTimeInBusinessDays
        FROM publish_orders o LEFT JOIN publish_product p ON o.ProductID = p.ProductID GROUP BY ALL""",
    ),
    "dated_lines": (
        (),
        """SELECT l_orderkey AS o_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS ShipDate,
          CAST(o_orderdate AS DATE) AS OrderDate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    # Every day between the first and last date, with the weekdays so far.
    "calendar": (
        ("dated_lines",),
        """SELECT d, dayofweek(d) BETWEEN 1 AND 5 AS is_weekday,
          sum(CASE WHEN dayofweek(d) BETWEEN 1 AND 5 THEN 1 ELSE 0 END) OVER (ORDER BY d) AS weekdays
        FROM (SELECT CAST(unnest(generate_series(
            (SELECT CAST(least(min(OrderDate), min(ShipDate)) AS TIMESTAMP) FROM dated_lines),
            (SELECT CAST(greatest(max(OrderDate), max(ShipDate)) AS TIMESTAMP) FROM dated_lines),
            INTERVAL 1 DAY)) AS DATE) AS d)""",
    ),
}

_VIEWS |= {
    "worse_product": (("raw_product",), WORSE_PRODUCT.format(raw_product="raw_product")),
    "worse_header": (("raw_header",), WORSE_HEADER.format(raw_header="raw_header")),
    "worse_detail": (("raw_detail",), WORSE_DETAIL.format(raw_detail="raw_detail")),
} | {
    name.replace("store", "worse_store"): ((name.replace("store", "worse"),), _VIEWS[name][1].replace("raw_", "worse_"))
    for name in ("store_product", "store_header", "store_detail")
}
_VIEWS["worse_publish_product"] = (("worse_store_product",), _VIEWS["publish_product"][1].replace("store_product", "worse_store_product"))


def _sql(body: str, *views: str) -> str:
    """Prefix the query with the views it needs, each after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in ordered) + "\n" + body


def _all_of(view: str, where: str = "") -> str:
    return _sql(f"SELECT * FROM {view} {where}", view)


def _null_profile(table: str, columns: list[str], *views: str) -> str:
    return _sql(
        "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in columns) + f" FROM {table}", *views
    )


def _any_null(columns: list[str]) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


def _duplicates(table: str, keys: str, *views: str) -> str:
    return _sql(f'SELECT {keys}, count(*) AS "count" FROM {table} GROUP BY {keys} HAVING count(*) > 1', *views)


def _duplicate_rows(table: str, keys: list[str], *views: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return _sql(
        f"SELECT * FROM {table} WHERE {present} QUALIFY count(*) OVER (PARTITION BY {', '.join(keys)}) > 1", *views
    )


def _orphans(child: str, child_key: str, parent: str, parent_key: str, *views: str) -> str:
    return _sql(
        f"SELECT c.* FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{child_key})",
        *views,
    )


def _bad_decimals() -> str:
    tables = (("raw_product", PRODUCT), ("raw_header", ORDER_HEADER), ("raw_detail", ORDER_DETAIL))
    parts = [
        f"""SELECT DISTINCT '{layout.name}' AS TableName, '{c}' AS ColumnName, {c} AS BadValue FROM {view}
        WHERE NOT regexp_matches({c}, '{DECIMAL_PATTERN}')"""
        for view, layout in tables
        for c in layout.of_type("double")
    ]
    return _sql(" UNION ALL ".join(parts), *[view for view, _ in tables])


def _quality_summary() -> str:
    """One count per check, table and column: each its own query."""

    def line(layout: TableLayout, view: str, check: str, column: str, condition: str) -> str:
        return f"""SELECT '{layout.name}' AS TableName, '{check}' AS CheckName, '{column}' AS ColumnName,
        count(*) FILTER ({condition}) AS FailedRows, count(*) AS TotalRows FROM {view}"""

    parts = []
    for view, layout in (("raw_product", PRODUCT), ("raw_header", ORDER_HEADER), ("raw_detail", ORDER_DETAIL)):
        parts += [line(layout, view, "null", c, f"{c} IS NULL") for c in layout.columns]
        for c in layout.of_type("date"):
            parts.append(line(layout, view, "bad_date", c, f"NOT regexp_matches({c}, '{DATE_PATTERN}')"))
        for c in layout.of_type("double"):
            parts.append(line(layout, view, "bad_decimal", c, f"NOT regexp_matches({c}, '{DECIMAL_PATTERN}')"))
        parts += [line(layout, view, "untrimmed", c, f"{c} <> trim({c}, ' ')") for c in layout.trimmed]
        for c, t in layout.typed.items():
            shaped = f"regexp_matches({c}, '{DATE_PATTERN}')" if t == "date" else f"{c} IS NOT NULL"
            parts.append(
                line(layout, view, "lost_in_typing", c, f"{shaped} AND TRY_CAST({c} AS {t.upper()}) IS NULL")
            )
        parts.append(line(layout, view, "null_key", layout.key, f"TRY_CAST({layout.key} AS INTEGER) IS NULL"))
        for m in layout.minimums:
            sign = "<" if m.inclusive else "<="
            parts.append(
                line(layout, view, "below_minimum", m.column, f"TRY_CAST({m.column} AS DOUBLE) {sign} {m.value}")
            )
    parts.append(line(ORDER_HEADER, "store_header", "before_order_date", "ShipDate", "ShipDate < OrderDate"))
    return _sql(" UNION ALL ".join(parts), "raw_product", "raw_detail", "store_header")


def _row_counts() -> str:
    tables = (("raw_product", PRODUCT), ("raw_header", ORDER_HEADER), ("raw_detail", ORDER_DETAIL))
    return _sql(
        " UNION ALL ".join(f"SELECT '{x.name}' AS TableName, count(*) AS RowCount FROM {view}" for view, x in tables),
        *[view for view, _ in tables],
    )


def _reconciliation() -> str:
    tables = (("product", PRODUCT), ("header", ORDER_HEADER), ("detail", ORDER_DETAIL))
    parts = [
        f"""SELECT '{layout.name}' AS TableName, r AS RawRows, s AS StoreRows, s - r AS "Difference" FROM (
        SELECT (SELECT count(*) FROM raw_{t}) AS r, (SELECT count(*) FROM store_{t}) AS s)"""
        for t, layout in tables
    ]
    return _sql(" UNION ALL ".join(parts), *[f"store_{t}" for t, _ in tables])


def _store_write_report() -> str:
    """Each count its own query over the tables as they are stored."""
    parts = []
    for t, layout, low in (
        ("product", PRODUCT, ()),
        ("header", ORDER_HEADER, ("Freight < 0",)),
        ("detail", ORDER_DETAIL, ("OrderQty <= 0", "UnitPrice < 0", "UnitPriceDiscount < 0")),
    ):
        view, key = f"worse_store_{t}", layout.key
        below = " + ".join(f"(SELECT count(*) FROM {view} WHERE {x})" for x in low) or "0"
        late = f"(SELECT count(*) FROM {view} WHERE ShipDate < OrderDate)" if t == "header" else "0"
        # products are reduced to one row per text key before they are typed
        kept = f"SELECT {'DISTINCT' * (t == 'product')} {key} FROM worse_{t}"
        parts.append(
            f"""SELECT '{layout.name}' AS TableName, (SELECT count(*) FROM {view}) AS StoreRows,
            (SELECT count(*) FROM ({kept}) WHERE {key} IS NOT NULL AND TRY_CAST({key} AS BIGINT) IS NULL) AS LostKeys,
            (SELECT count(*) FROM {view} WHERE {key} IS NULL) AS NullKeys,
            CAST({late} AS BIGINT) AS OutOfOrder, CAST({below} AS BIGINT) AS BelowMinimum"""
        )
    return _sql(" UNION ALL ".join(parts), *(f"worse_store_{t}" for t in ("product", "header", "detail")))


_RAGGED = "CAST(SalesOrderID AS BIGINT) % 701 = 1", "CAST(SalesOrderID AS BIGINT) % 709 = 2"
_LINE = [f"coalesce({c}, '')" for c in ORDER_DETAIL.columns]

_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

_UNTRIMMED_CODES = " OR ".join(f"{c} <> trim({c}, ' ')" for c in PRODUCT.trimmed)

ORACLE: dict[str, str] = {
    "read_csv_roundtrip": _all_of("raw_product"),
    "read_csv_header_roundtrip": _all_of("raw_header"),
    "q1_from_csv": _sql('SELECT * EXCLUDE ("rank") FROM color_rank WHERE "rank" = 1', "color_rank"),
    "q2_from_csv": _sql(
        """SELECT * FROM category_lead_time WHERE ProductCategoryName IS NOT NULL
        ORDER BY AvgLeadTimeInBusinessDays DESC""",
        "category_lead_time",
    ),
    "q1_from_layers": _sql('SELECT * EXCLUDE ("rank") FROM color_rank WHERE "rank" = 1', "color_rank"),
    "q1_from_restarted_layers": _sql('SELECT * EXCLUDE ("rank") FROM color_rank WHERE "rank" = 1', "color_rank"),
    "raw_row_counts": _row_counts(),
    "first_products": _sql(
        f"""SELECT * FROM raw_product
        ORDER BY {", ".join(f"{c} ASC NULLS FIRST" for c in PRODUCT.columns)} LIMIT {PREVIEW_ROWS}""",
        "raw_product",
    ),
    "null_profile_product": _null_profile("raw_product", list(PRODUCT.columns), "raw_product"),
    "null_profile_header": _null_profile("raw_header", list(ORDER_HEADER.columns), "raw_header"),
    "null_profile_detail": _null_profile("raw_detail", list(ORDER_DETAIL.columns), "raw_detail"),
    "rows_with_nulls": _all_of("raw_product", "WHERE " + _any_null(list(PRODUCT.columns))),
    "duplicate_product_ids": _duplicates("raw_product", "ProductID", "raw_product"),
    "duplicate_order_ids": _duplicates("raw_header", "SalesOrderID", "raw_header"),
    "duplicate_line_ids": _duplicates("raw_detail", "SalesOrderDetailID", "raw_detail"),
    "duplicate_product_rows": _duplicate_rows("raw_product", ["ProductID"], "raw_product"),
    "bad_order_dates": _sql(
        f"SELECT DISTINCT OrderDate FROM raw_header WHERE NOT regexp_matches(OrderDate, '{DATE_PATTERN}')",
        "raw_header",
    ),
    "bad_ship_dates": _sql(
        f"SELECT DISTINCT ShipDate FROM raw_header WHERE NOT regexp_matches(ShipDate, '{DATE_PATTERN}')",
        "raw_header",
    ),
    "bad_decimals": _bad_decimals(),
    "untrimmed_unit_codes": _all_of("raw_product", f"WHERE {_UNTRIMMED_CODES}"),
    "untrimmed_after_trim": _sql(
        f"""SELECT count(*) AS UntrimmedRows FROM (
        SELECT {", ".join(f"trim({c}, ' ') AS {c}" for c in PRODUCT.trimmed)} FROM raw_product)
        WHERE {_UNTRIMMED_CODES}""",
        "raw_product",
    ),
    "quality_summary": _quality_summary(),
    "store_product": _all_of("store_product"),
    "store_header": _all_of("store_header"),
    "store_detail": _all_of("store_detail"),
    "pk_duplicates_product": _duplicates("store_product", "ProductID", "store_product"),
    "pk_duplicates_header": _duplicates("store_header", "SalesOrderID", "store_header"),
    "pk_duplicates_detail": _duplicates("store_detail", "SalesOrderDetailID", "store_detail"),
    "pk_nulls_product": _all_of("store_product", "WHERE ProductID IS NULL"),
    "pk_nulls_header": _all_of("store_header", "WHERE SalesOrderID IS NULL"),
    "pk_nulls_detail": _all_of("store_detail", "WHERE SalesOrderDetailID IS NULL"),
    "orphans_header": _orphans(
        "store_detail", "SalesOrderID", "store_header", "SalesOrderID", "store_detail", "store_header"
    ),
    "orphans_product": _orphans(
        "store_detail", "ProductID", "store_product", "ProductID", "store_detail", "store_product"
    ),
    "ship_before_order": _all_of("store_header", "WHERE ShipDate < OrderDate"),
    "range_order_qty": _all_of("store_detail", "WHERE OrderQty <= 0"),
    "range_unit_price": _all_of("store_detail", "WHERE UnitPrice < 0"),
    "range_discount": _all_of("store_detail", "WHERE UnitPriceDiscount < 0"),
    "range_freight": _all_of("store_header", "WHERE Freight < 0"),
    "row_reconciliation": _reconciliation(),
    "store_reconciliation": _reconciliation(),
    "publish_reconciliation": _sql(
        """SELECT 'PublishedOrders' AS TableName, r AS RawRows, s AS StoreRows, s - r AS "Difference" FROM (
        SELECT (SELECT count(*) FROM store_detail) AS r, (SELECT count(*) FROM publish_orders) AS s)""",
        "store_detail",
        "publish_orders",
    ),
    "wide_key_orders": _sql(
        """SELECT SalesOrderID + 1099511627776 AS SalesOrderID, SalesOrderDetailID + 1099511627776 AS SalesOrderDetailID,
          ProductID + 1099511627776 AS ProductID, OrderDate FROM publish_orders""",
        "publish_orders",
    ),
    "fine_amount_totals": "SELECT l_returnflag, round(sum(l_linenumber) / 4194304.0::DOUBLE, 12) AS Total FROM lineitem GROUP BY 1",
    "ragged_records": _sql(
        f"""SELECT '{ORDER_DETAIL.name}' AS TableName, {" || ',' || ".join(_LINE)} || ',extra' AS Record
        FROM raw_detail WHERE {_RAGGED[0]}
        UNION ALL SELECT '{ORDER_DETAIL.name}', {" || ',' || ".join(_LINE[:-1])} FROM raw_detail
        WHERE {_RAGGED[1]} AND NOT ({_RAGGED[0]})""",
        "raw_detail",
    ),
    "lines_without_ragged": _all_of("raw_detail", f"WHERE NOT ({' OR '.join(_RAGGED)})"),
    "store_write_report": _store_write_report(),
    "worse_order_ids": _duplicates("worse_header", "SalesOrderID", "worse_header"),
    "worse_ship_dates": _sql(
        f"SELECT DISTINCT ShipDate FROM worse_header WHERE NOT regexp_matches(ShipDate, '{DATE_PATTERN}')",
        "worse_header",
    ),
    "worse_store_product": _all_of("worse_store_product"),
    "worse_pk_duplicates_product": _duplicates("worse_store_product", "ProductID", "worse_store_product"),
    "worse_pk_duplicates_header": _duplicates("worse_store_header", "SalesOrderID", "worse_store_header"),
    "worse_pk_nulls_product": _all_of("worse_store_product", "WHERE ProductID IS NULL"),
    "worse_pk_nulls_header": _all_of("worse_store_header", "WHERE SalesOrderID IS NULL"),
    "worse_unit_prices": _all_of("worse_store_detail", "WHERE UnitPrice < 0"),
    "worse_discounts": _all_of("worse_store_detail", "WHERE UnitPriceDiscount < 0"),
    "worse_publish_product": _all_of("worse_publish_product"),
    "publish_product": _all_of("publish_product"),
    "publish_orders": _all_of("publish_orders"),
    "color_still_null": _all_of("publish_product", "WHERE Color IS NULL"),
    "color_na_sample": _all_of(
        "publish_product", f"WHERE Color = '{MISSING_COLOR}' ORDER BY ProductID LIMIT {PREVIEW_ROWS}"
    ),
    "category_rule_rows": _sql(
        f"SELECT ProductID, ProductSubCategoryName, ProductCategoryName FROM publish_product WHERE {_COVERED}",
        "publish_product",
    ),
    "backfill_counts": _sql(
        f"""SELECT
        (SELECT count(*) FROM store_product WHERE ProductCategoryName IS NULL AND {_COVERED}) AS EligibleBefore,
        (SELECT count(*) FROM publish_product WHERE ProductCategoryName IS NULL AND {_COVERED}) AS RemainingAfter""",
        "publish_product",
    ),
    "q1_top_color": _sql('SELECT * EXCLUDE ("rank") FROM color_rank WHERE "rank" = 1', "color_rank"),
    "q2_lead_time": _sql(
        """SELECT * FROM category_lead_time WHERE ProductCategoryName IS NOT NULL
        ORDER BY AvgLeadTimeInBusinessDays DESC""",
        "category_lead_time",
    ),
    "q2_with_null_category": _all_of("category_lead_time", "ORDER BY AvgLeadTimeInBusinessDays DESC"),
    "revenue_by_year_color": _all_of("color_revenue"),
    "ranked_colors": _all_of("color_rank"),
    "ranked_colors_spread": _all_of("color_rank"),
    "null_profile_lineitem": _null_profile("lineitem", _LINEITEM),
    "null_profile_documents": _null_profile("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "rows_with_nulls_events": "SELECT * FROM events WHERE "
    + _any_null(["event_id", "ts", "user_id", "event_type", "value", "props"]),
    "untrimmed_documents": "SELECT * FROM documents WHERE "
    + " OR ".join(f"{c} <> trim({c}, ' ')" for c in ("text", "lang", "source")),
    "bad_order_priorities": f"""SELECT DISTINCT o_orderpriority FROM orders
        WHERE NOT regexp_matches(o_orderpriority, '{PRIORITY_PATTERN}')""",
    "lineitem_duplicate_keys": _duplicates("lineitem", "l_orderkey, l_linenumber"),
    "lineitem_duplicate_rows": _duplicate_rows("lineitem", ["l_orderkey", "l_linenumber"]),
    "lineitem_orphans_orders": _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "orders_without_lines": _orphans("orders", "o_orderkey", "lineitem", "l_orderkey"),
    "documents_without_labels": _orphans("documents", "doc_id", "labels", "doc_id"),
    "lineitem_ship_before_order": _all_of("dated_lines", "WHERE ShipDate < OrderDate"),
    "lineitem_lead_time": _sql(
        """SELECT l_returnflag, count(*) AS "Lines", CAST(sum(gap) AS BIGINT) AS TotalLeadTime, avg(gap) AS AvgLeadTime
        FROM (SELECT l_returnflag, CASE WHEN OrderDate IS NOT NULL AND ShipDate IS NOT NULL THEN
            CAST(b.weekdays - a.weekdays + CASE WHEN a.is_weekday THEN 1 ELSE 0 END - 1 AS INTEGER) END AS gap
          FROM dated_lines
          LEFT JOIN calendar a ON a.d = least(OrderDate, ShipDate)
          LEFT JOIN calendar b ON b.d = greatest(OrderDate, ShipDate))
        GROUP BY l_returnflag""",
        "calendar",
    ),
    "lineitem_price_ranks": """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS LAST,
          l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST) AS price_rank FROM lineitem""",
    "customer_below_zero_balance": "SELECT * FROM customer WHERE c_acctbal < 0",
}

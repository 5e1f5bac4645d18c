"""One entry per registered query: a function of the session and the folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.planted import raw_detail, raw_header, raw_product, raw_tables, table, worse_detail, worse_header, worse_product, worse_tables
from tallyloom.functions.dates import business_days
from tallyloom.functions.totals import merge_sum, partial_sum
from tallyloom.operators import review, standardise, validate
from tallyloom.operators.ranking import ranked_within
from tallyloom.plans import pipeline, publish, quality, reports, store
from tallyloom.schemas import DATE_PATTERN, LAYOUTS, ORDER_DETAIL, ORDER_HEADER, PRODUCT, Minimum
from tallyloom.sources.csv import RawTables, ragged_records, read_csv, read_raw_tables, without_ragged, write_csv
from tallyloom.sources.layers import write_table
from tallyloom.sources.scratch import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]
PREVIEW_ROWS = 5
NAMES = tuple(layout.name for layout in LAYOUTS)
MINIMUMS = {minimum.column: minimum for layout in LAYOUTS for minimum in layout.minimums}
PRIORITY_PATTERN = "^[0-9]-[A-Z]+$"


def _table(name: str) -> Query:
    return lambda spark, sf_dir: table(spark, sf_dir, name)


def _over(source: Query, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(source(spark, sf_dir))


def _orphans(child: Query, child_key: str, parent: Query, parent_key: str) -> Query:
    return lambda spark, sf_dir: validate.orphans(child(spark, sf_dir), parent(spark, sf_dir), child_key, parent_key)


def _report(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(published_orders(spark, sf_dir), published_product(spark, sf_dir))


stored_product = _over(raw_product, store.store_product)
stored_header = _over(raw_header, store.store_header)
stored_detail = _over(raw_detail, store.store_detail)
worse_stored_product = _over(worse_product, store.store_product)
worse_stored_header = _over(worse_header, store.store_header)
worse_stored_detail = _over(worse_detail, store.store_detail)
published_product = _over(stored_product, publish.publish_product)


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.publish_orders(stored_detail(spark, sf_dir), stored_header(spark, sf_dir))


def _raw_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.row_counts(dict(zip(NAMES, raw_tables(spark, sf_dir))))


def _quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(raw_tables(spark, sf_dir))


def _bad_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        review.bad_decimals(df, layout.of_type("double")).select(F.lit(layout.name).alias("TableName"), "*")
        for df, layout in zip(raw_tables(spark, sf_dir), LAYOUTS)
    ]
    return reduce(DataFrame.unionAll, parts)


def _untrimmed_after_trim(product: DataFrame) -> DataFrame:
    trimmed = standardise.trim_columns(product, PRODUCT.trimmed)
    return review.row_count(review.untrimmed_rows(trimmed, PRODUCT.trimmed), "UntrimmedRows")


def _reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    return validate.reconcile(dict(zip(NAMES, zip(raw, store.store_tables(raw)))))


def _read_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw products as CSV and read them back as text."""
    path = fresh_folder(spark, "csv") + f"/{PRODUCT.file_name}"
    write_csv(raw_product(spark, sf_dir), path)
    return read_csv(spark, path)


def _read_csv_header_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the order headers, with the names given and checked against the file."""
    path = fresh_folder(spark, "csv") + f"/{ORDER_HEADER.file_name}"
    write_csv(raw_header(spark, sf_dir), path)
    return read_csv(spark, path, schema=ORDER_HEADER.raw_schema)


def _top_color_from_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first report from stored Parquet layers instead of one plan over the raw tables."""
    folder = fresh_folder(spark, "layers")
    stored = pipeline.write_store(raw_tables(spark, sf_dir), folder)
    published = pipeline.write_publish(stored, folder)
    return reports.top_color_per_year(published.orders, published.product)


def _top_color_from_restarted_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a run broke after its first table and a second one wrote the others."""
    folder = fresh_folder(spark, "layers")
    write_table(stored_product(spark, sf_dir), folder, "store_product")
    stored = pipeline.write_store(raw_tables(spark, sf_dir), folder, restart=True)
    published = pipeline.write_publish(stored, folder)
    return reports.top_color_per_year(published.orders, published.product)


def _ranked_colors_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranked_colors(published_orders(spark, sf_dir), published_product(spark, sf_dir), spread=True)


def _lineitem_price_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by price within the few values of their return flag, each far larger than a task at scale."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc_nulls_last("l_extendedprice"), F.asc_nulls_first("l_orderkey"), F.asc_nulls_first("l_linenumber")]
    return ranked_within(lines, ["l_returnflag"], order, rank="price_rank")


def _from_csv(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A report over the whole way: raw tables as CSV files, read as text, stored, published."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = fresh_folder(spark, "csv")
        for df, layout in zip(raw_tables(spark, sf_dir), LAYOUTS):
            write_csv(df, f"{folder}/{layout.file_name}")
        stored = pipeline.write_store(read_raw_tables(spark, folder), folder)
        published = pipeline.write_publish(stored, folder)
        return build(published.orders, published.product)

    return query


def _store_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the raw tables against those of the store as read back from its files."""
    raw = raw_tables(spark, sf_dir)
    stored = pipeline.write_store(raw, fresh_folder(spark, "layers"))
    return validate.reconcile(dict(zip(NAMES, zip(raw, stored))))


def _publish_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored order lines against published ones as read back: the difference was dropped by the join."""
    folder = fresh_folder(spark, "layers")
    stored = pipeline.write_store(raw_tables(spark, sf_dir), folder)
    published = pipeline.write_publish(stored, folder)
    return validate.reconcile({"PublishedOrders": (stored.detail, published.orders)})


def _store_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was counted while the store of the worse tables was written."""
    return pipeline.write_store_reported(worse_tables(spark, sf_dir), fresh_folder(spark, "layers")).report


def _ragged_files(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw tables as files in which some order lines have a field too many, or one too few."""
    folder = fresh_folder(spark, "csv")
    product, header, detail = raw_tables(spark, sf_dir)
    write_csv(product, f"{folder}/{PRODUCT.file_name}")
    write_csv(header, f"{folder}/{ORDER_HEADER.file_name}")
    order = F.col("SalesOrderID").cast("bigint")
    fields = [F.coalesce(c, F.lit("")) for c in detail.columns]
    line = F.when(order % 701 == 1, F.concat_ws(",", *fields, F.lit("extra"))).when(order % 709 == 2, F.concat_ws(",", *fields[:-1]))
    lines = detail.select(F.coalesce(line, F.concat_ws(",", *fields)).alias(",".join(detail.columns)))
    # one column of whole lines under the names of all columns; with a separator that does not occur, none is quoted
    lines.write.options(header=True, sep="\x01").csv(f"{folder}/{ORDER_DETAIL.file_name}")
    return read_raw_tables(spark, folder, ragged="_ragged")


def _ragged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ragged_records(_ragged_files(spark, sf_dir), "_ragged")


def _lines_without_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_ragged(_ragged_files(spark, sf_dir), "_ragged").detail


def _wide_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders where every order, line and product number is beyond 32 bits."""
    wide = lambda df, *keys: df.withColumns({k: (F.col(k).try_cast("bigint") + 2**40).cast("string") for k in keys})
    detail = store.store_detail(wide(raw_detail(spark, sf_dir), "SalesOrderID", "SalesOrderDetailID", "ProductID"))
    header = store.store_header(wide(raw_header(spark, sf_dir), "SalesOrderID"))
    return publish.publish_orders(detail, header).select("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderDate")


def _fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of amounts with nine decimals, by the sum of the reports: nothing below a millionth is lost."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_linenumber") / F.lit(2.0**22)).alias("x"))
    return lines.groupBy("l_returnflag").agg(*partial_sum("x")).groupBy("l_returnflag").agg(F.round(merge_sum(), 12).alias("Total"))


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("OrderDate"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ShipDate"),
    )
    return lines.join(orders, "o_orderkey")


def _lineitem_ship_before_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.out_of_order(_orders_with_lines(spark, sf_dir), "OrderDate", "ShipDate")


def _lineitem_lead_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business days over gaps of months and years, reversed ones included."""
    lead_time = _orders_with_lines(spark, sf_dir).withColumn("LeadTime", business_days("OrderDate", "ShipDate"))
    return lead_time.groupBy("l_returnflag").agg(
        F.count("*").alias("Lines"), F.sum("LeadTime").alias("TotalLeadTime"), F.avg("LeadTime").alias("AvgLeadTime")
    )


QUERIES: dict[str, Query] = {
    # Sources and layers
    "read_csv_roundtrip": _read_csv_roundtrip,
    "read_csv_header_roundtrip": _read_csv_header_roundtrip,
    "q1_from_layers": _top_color_from_layers,
    "q1_from_restarted_layers": _top_color_from_restarted_layers,
    "q1_from_csv": _from_csv(reports.top_color_per_year),
    "q2_from_csv": _from_csv(reports.lead_time_by_known_category),
    # Review of the raw tables
    "raw_row_counts": _raw_row_counts,
    "first_products": _over(raw_product, lambda df: review.first_rows(df, PREVIEW_ROWS, df.columns)),
    "null_profile_product": _over(raw_product, review.null_profile),
    "null_profile_header": _over(raw_header, review.null_profile),
    "null_profile_detail": _over(raw_detail, review.null_profile),
    "rows_with_nulls": _over(raw_product, review.rows_with_nulls),
    "duplicate_product_ids": _over(raw_product, lambda df: review.duplicate_keys(df, ["ProductID"])),
    "duplicate_order_ids": _over(raw_header, lambda df: review.duplicate_keys(df, ["SalesOrderID"])),
    "duplicate_line_ids": _over(raw_detail, lambda df: review.duplicate_keys(df, ["SalesOrderDetailID"])),
    "duplicate_product_rows": _over(raw_product, lambda df: review.rows_of_duplicate_keys(df, ["ProductID"])),
    "bad_order_dates": _over(raw_header, lambda df: review.bad_format(df, "OrderDate", DATE_PATTERN)),
    "bad_ship_dates": _over(raw_header, lambda df: review.bad_format(df, "ShipDate", DATE_PATTERN)),
    "bad_decimals": _bad_decimals,
    "untrimmed_unit_codes": _over(raw_product, lambda df: review.untrimmed_rows(df, PRODUCT.trimmed)),
    "untrimmed_after_trim": _over(raw_product, _untrimmed_after_trim),
    "quality_summary": _quality_summary,
    # Store layer
    "store_product": stored_product,
    "store_header": stored_header,
    "store_detail": stored_detail,
    # Validation of the store layer
    "pk_duplicates_product": _over(stored_product, lambda df: review.duplicate_keys(df, [PRODUCT.key])),
    "pk_duplicates_header": _over(stored_header, lambda df: review.duplicate_keys(df, [ORDER_HEADER.key])),
    "pk_duplicates_detail": _over(stored_detail, lambda df: review.duplicate_keys(df, [ORDER_DETAIL.key])),
    "pk_nulls_product": _over(stored_product, lambda df: validate.null_keys(df, [PRODUCT.key])),
    "pk_nulls_header": _over(stored_header, lambda df: validate.null_keys(df, [ORDER_HEADER.key])),
    "pk_nulls_detail": _over(stored_detail, lambda df: validate.null_keys(df, [ORDER_DETAIL.key])),
    "orphans_header": _orphans(stored_detail, "SalesOrderID", stored_header, "SalesOrderID"),
    "orphans_product": _orphans(stored_detail, "ProductID", stored_product, "ProductID"),
    "ship_before_order": _over(stored_header, lambda df: validate.out_of_order(df, "OrderDate", "ShipDate")),
    "range_order_qty": _over(stored_detail, lambda df: validate.below_minimum(df, MINIMUMS["OrderQty"])),
    "range_unit_price": _over(stored_detail, lambda df: validate.below_minimum(df, MINIMUMS["UnitPrice"])),
    "range_discount": _over(stored_detail, lambda df: validate.below_minimum(df, MINIMUMS["UnitPriceDiscount"])),
    "range_freight": _over(stored_header, lambda df: validate.below_minimum(df, MINIMUMS["Freight"])),
    "row_reconciliation": _reconciliation,
    "store_reconciliation": _store_reconciliation,
    "publish_reconciliation": _publish_reconciliation,
    "wide_key_orders": _wide_key_orders,
    "fine_amount_totals": _fine_amounts,
    # Records of the wrong length, and the raw tables with defects that they lack otherwise
    "ragged_records": _ragged_records,
    "lines_without_ragged": _lines_without_ragged,
    "store_write_report": _store_write_report,
    "worse_order_ids": _over(worse_header, lambda df: review.duplicate_keys(df, ["SalesOrderID"])),
    "worse_ship_dates": _over(worse_header, lambda df: review.bad_format(df, "ShipDate", DATE_PATTERN)),
    "worse_store_product": worse_stored_product,
    "worse_pk_duplicates_product": _over(worse_stored_product, lambda df: review.duplicate_keys(df, [PRODUCT.key])),
    "worse_pk_duplicates_header": _over(worse_stored_header, lambda df: review.duplicate_keys(df, [ORDER_HEADER.key])),
    "worse_pk_nulls_product": _over(worse_stored_product, lambda df: validate.null_keys(df, [PRODUCT.key])),
    "worse_pk_nulls_header": _over(worse_stored_header, lambda df: validate.null_keys(df, [ORDER_HEADER.key])),
    "worse_unit_prices": _over(worse_stored_detail, lambda df: validate.below_minimum(df, MINIMUMS["UnitPrice"])),
    "worse_discounts": _over(worse_stored_detail, lambda df: validate.below_minimum(df, MINIMUMS["UnitPriceDiscount"])),
    "worse_publish_product": _over(worse_stored_product, publish.publish_product),
    # Publish layer and its checks
    "publish_product": published_product,
    "publish_orders": published_orders,
    "color_still_null": _over(published_product, publish.rows_without_color),
    "color_na_sample": _over(published_product, lambda df: publish.labelled_color_sample(df, PREVIEW_ROWS)),
    "category_rule_rows": _over(published_product, publish.rows_covered_by_category_rule),
    "backfill_counts": _over(stored_product, publish.backfill_counts),
    # Reports
    "q1_top_color": _report(reports.top_color_per_year),
    "q2_lead_time": _report(reports.lead_time_by_known_category),
    "q2_with_null_category": _report(reports.lead_time_by_category),
    "revenue_by_year_color": _report(reports.revenue_by_year_color),
    "ranked_colors": _report(reports.ranked_colors),
    "ranked_colors_spread": _ranked_colors_spread,
    # The same operators on the test tables as they are: other types, composite keys, long date gaps
    "null_profile_lineitem": _over(_table("lineitem"), review.null_profile),
    "null_profile_documents": _over(_table("documents"), review.null_profile),
    "rows_with_nulls_events": _over(_table("events"), review.rows_with_nulls),
    "untrimmed_documents": _over(_table("documents"), lambda df: review.untrimmed_rows(df, ["text", "lang", "source"])),
    "bad_order_priorities": _over(
        _table("orders"), lambda df: review.bad_format(df, "o_orderpriority", PRIORITY_PATTERN)
    ),
    "lineitem_duplicate_keys": _over(
        _table("lineitem"), lambda df: review.duplicate_keys(df, ["l_orderkey", "l_linenumber"])
    ),
    "lineitem_duplicate_rows": _over(
        _table("lineitem"), lambda df: review.rows_of_duplicate_keys(df, ["l_orderkey", "l_linenumber"])
    ),
    "lineitem_orphans_orders": _orphans(_table("lineitem"), "l_orderkey", _table("orders"), "o_orderkey"),
    "orders_without_lines": _orphans(_table("orders"), "o_orderkey", _table("lineitem"), "l_orderkey"),
    "documents_without_labels": _orphans(_table("documents"), "doc_id", _table("labels"), "doc_id"),
    "lineitem_ship_before_order": _lineitem_ship_before_order,
    "lineitem_lead_time": _lineitem_lead_time,
    "lineitem_price_ranks": _lineitem_price_ranks,
    "customer_below_zero_balance": _over(
        _table("customer"), lambda df: validate.below_minimum(df, Minimum("c_acctbal"))
    ),
}

"""From source files to stored layers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.conditions import is_below
from tallyloom.functions.typing import lost_in_typing
from tallyloom.operators.standardise import apply_types
from tallyloom.plans.publish import PublishTables, publish_orders, publish_product
from tallyloom.plans.store import StoreTables, clean_product, store_tables
from tallyloom.schemas import LAYOUTS, Layouts, TableLayout
from tallyloom.sources.csv import RawTables
from tallyloom.sources.layers import entries, missing_tables, read_tables, write_table


_STORE = tuple(f"store_{name}" for name in StoreTables._fields)
_PUBLISHED = tuple(f"publish_{name}" for name in PublishTables._fields)


def write_store(raw: RawTables, folder: str, layouts: Layouts = LAYOUTS, restart: bool = False) -> StoreTables:
    """Write the three store tables, and return them as read back.

    ``restart`` goes on with a run over the same raw tables that broke: tables that are complete stay as they are.
    """
    spark = raw.product.sparkSession
    store = dict(zip(_STORE, store_tables(raw, layouts)))
    for name in missing_tables(spark, folder, _STORE, restart):
        write_table(store[name], folder, name)
    return read_store(spark, folder)


class WrittenStore(NamedTuple):
    tables: StoreTables
    report: DataFrame


_REPORT = "TableName string, StoreRows long, LostKeys long, NullKeys long, OutOfOrder long, BelowMinimum long"
_LOST = "_lost_key"


def _counters(layout: TableLayout) -> dict[str, Column]:
    """What can be counted row by row, for ``DataFrame.observe``."""
    below = [F.count_if(is_below(m)) for m in layout.minimums]
    none = F.max(F.lit(0))
    return {
        "StoreRows": F.count(F.lit(1)),
        "LostKeys": F.count_if(_LOST),
        "NullKeys": F.count_if(F.col(layout.key).isNull()),
        "OutOfOrder": F.count_if(F.col("ShipDate") < F.col("OrderDate")) if "ShipDate" in layout.columns else none,
        "BelowMinimum": sum(below[1:], below[0]) if below else none,
    }


def write_store_reported(
    raw: RawTables, folder: str, layouts: Layouts = LAYOUTS, restart: bool = False
) -> WrittenStore:
    """Write the three store tables, and count in the writing tasks what went into them: no table is read twice.

    The report has a row per table: rows written, keys whose text was lost in typing, NULL keys (those among them),
    reversed dates, and values below a minimum, added up over the columns that have one. Counters are taken where
    the last stage writes, so a task that is run again replaces its counts. They are kept in the manifest, so that a
    ``restart`` reports tables of the broken run too; a table that ``write_store`` wrote has NULLs. Repeated keys and
    orphans need a shuffle of their own; see ``operators.review`` and ``operators.validate``.
    """
    spark = raw.product.sparkSession
    texts = (clean_product(raw.product, layouts[0]), raw.header, raw.detail)
    missing = missing_tables(spark, folder, _STORE, restart)
    for name, text, layout in zip(_STORE, texts, layouts):
        if name in missing:
            marked = text.withColumn(_LOST, lost_in_typing(layout.key, layout.typed[layout.key]))
            seen = Observation()
            counters = [counter.alias(k) for k, counter in _counters(layout).items()]
            write_table(apply_types(marked, layout.typed).observe(seen, *counters).drop(_LOST), folder, name, seen)
    counted = entries(spark, folder)
    rows = [
        (layout.name, *(counted[name].counts.get(k) for k in _counters(layout)))
        for name, layout in zip(_STORE, layouts)
    ]
    return WrittenStore(read_store(spark, folder), spark.createDataFrame(rows, _REPORT))


def read_store(spark: SparkSession, folder: str) -> StoreTables:
    return StoreTables(*read_tables(spark, folder, _STORE))


def write_publish(store: StoreTables, folder: str, restart: bool = False) -> PublishTables:
    """Write the two published tables, and return them as read back. ``restart`` as for ``write_store``."""
    spark = store.product.sparkSession
    published = dict(zip(_PUBLISHED, (publish_product(store.product), publish_orders(store.detail, store.header))))
    for name in missing_tables(spark, folder, _PUBLISHED, restart):
        write_table(published[name], folder, name)
    return read_publish(spark, folder)


def read_publish(spark: SparkSession, folder: str) -> PublishTables:
    return PublishTables(*read_tables(spark, folder, _PUBLISHED))

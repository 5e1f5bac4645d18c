"""Joins to key sets and dimensions whose size decides how they are joined."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tallyloom.sources.scratch import settle

BROADCAST_BYTES = 128 * 1024 * 1024
_BYTES_PER_ROW = 32
_BYTES_PER_VALUE = 8


def is_small(table: DataFrame, limit: int | None = None) -> bool:
    """Measure a narrow table from its rows: a fixed cost for each row and value, plus the text it holds.

    This is an aggregate over the table's few columns; only the two numbers come back. No table is small in a
    session that forbids broadcasts (``spark.sql.autoBroadcastJoinThreshold`` of -1), and none is measured there.
    """
    if table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-1"):
        return False
    text = [f.name for f in table.schema if isinstance(f.dataType, (StringType, BinaryType))]
    bytes_of_text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0)).cast("long")
    rows, in_text = table.agg(F.count("*"), F.sum(bytes_of_text)).first()
    return rows * (_BYTES_PER_ROW + _BYTES_PER_VALUE * len(table.columns)) + (in_text or 0) <= (BROADCAST_BYTES if limit is None else limit)


def rows_with_keys(rows: DataFrame, keys: DataFrame, null_matches: bool = False) -> DataFrame:
    """Rows whose key is among ``keys``, a table of distinct keys under the same column names.

    The keys are found first, in a narrow plan that combines equal keys before
    any shuffle, and settled. If they are few, as in a report of exceptions,
    they go to every task and the wide rows are not shuffled at all. Otherwise
    both sides are shuffled on the key, straight from their scans, so adaptive
    execution can split a key that holds much of the table.
    """
    settled = settle(keys)
    wanted = settled.select(*[F.col(c).alias(f"_wanted_{c}") for c in keys.columns])
    if is_small(settled):
        wanted = F.broadcast(wanted)
    pairs = [(F.col(c), F.col(f"_wanted_{c}")) for c in keys.columns]
    same = [a.eqNullSafe(b) if null_matches else a == b for a, b in pairs]
    return rows.join(wanted, reduce(and_, same), "left_semi")


def rows_without_match(
    rows: DataFrame, key: str, parent: DataFrame, parent_key: str, limit: int | None = None
) -> DataFrame:
    """Rows whose key is not in the parent; a NULL key has no match.

    The parent's distinct keys are settled, measured and joined. Few keys, of
    at most ``limit`` bytes (default ``BROADCAST_BYTES``), go to every task, and the rows are read once and
    not shuffled. More are joined by shuffle, which adaptive execution splits
    where one key holds much of the rows.
    """
    keys = parent.select(F.col(parent_key).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct()
    keys = settle(keys)
    if is_small(keys, limit):
        keys = F.broadcast(keys)
    return rows.join(keys, F.col(key) == F.col("_parent_key"), "left_anti")


def aggregate_by_attribute(
    rows: DataFrame, groups: list[str], parts: list[Column], dimension: DataFrame, key: str, attribute: str
) -> DataFrame:
    """Aggregate rows by ``groups`` and an attribute that a left join to the dimension adds.

    Returns one or more rows per group and attribute, holding the partial
    aggregates ``parts``; the caller merges them. A small dimension is joined
    first, in the tasks that read the rows. For a large one the rows are
    aggregated by its key first, so that the join meets one row per group and
    key, however many rows a key has.
    """
    lookup = dimension.select(key, attribute).where(F.col(key).isNotNull())
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), key, "left").groupBy(*groups, attribute).agg(*parts)
    return rows.groupBy(*groups, key).agg(*parts).join(lookup, key, "left").drop(key)

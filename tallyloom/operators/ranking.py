"""Ranks within groups that may each be larger than a task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.lookup import is_small
from tallyloom.sources.layers import read_layer, write_layer
from tallyloom.sources.scratch import fresh_folder, settle

_PLACE, _PIECE, _SHIFT = "_ranked_place", "_ranked_piece", "_ranked_shift"
_ROWS_IN_TASK = 33  # bits that monotonically_increasing_id keeps for rows of one task


def ranked_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], rank: str = "rank", folder: str | None = None
) -> DataFrame:
    """The rows with their number, from 1, in their group's order, as a long column ``rank``.

    A window gives each group to one task. Here the table is sorted as a whole, by group and order, so that each task
    holds a range of rows, many small groups or a part of a large one. It is written once, with each row's place, and
    only the first place and the number of rows of each group and task are gathered to work out where a part begins.

    Rows that agree in ``groups`` and ``order`` stay in one task and are numbered as they come, so ``order`` should
    end with what tells rows apart. NULL is a group of its own. A column named ``rank`` is replaced. The result reads
    the written table, in ``folder`` or a new folder beside the session's other intermediate tables; the caller
    deletes it when the result is no longer needed.
    """
    spark = df.sparkSession
    path = folder or fresh_folder(spark, "ranked")
    write_layer(df.orderBy(*groups, *order).withColumn(_PLACE, F.monotonically_increasing_id()), path)
    placed = read_layer(spark, path).withColumn(_PIECE, F.shiftright(_PLACE, _ROWS_IN_TASK))

    parts = placed.groupBy(*groups, _PIECE).agg(F.min(_PLACE).alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(*groups).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1
    keys = [*groups, _PIECE]
    shifts = settle(parts.select(*(F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)), shift.alias(_SHIFT)))
    if is_small(shifts):
        shifts = F.broadcast(shifts)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)))
    kept = [F.col(c) for c in df.columns if c != rank]
    return placed.join(shifts, same).select(*kept, (F.col(_PLACE) + F.col(_SHIFT)).alias(rank))

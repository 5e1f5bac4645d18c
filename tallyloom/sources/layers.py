"""Parquet layers: written once, so that later checks and reports do not parse text again.

A folder of layers has a manifest, a small table with a row for each table that is complete. A table is entered after
its last file is in place, and only entered tables are read, so what a broken run leaves behind is never taken for a
table, and a later run can go on with what is missing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql.types import StructType

_MANIFEST = "manifest"
_ENTRY = "name string, path string, schema string, counts map<string, bigint>"


def write_layer(df: DataFrame, path: str) -> None:
    """Write a table as Parquet, from the tasks that computed it."""
    df.write.mode("errorifexists").parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def entries(spark: SparkSession, folder: str) -> dict[str, Row]:
    """The complete tables of a folder by name: path within the folder, schema, and what was counted while writing.

    A folder without a manifest, or with one whose first entry was never finished, has none.
    """
    try:
        found = spark.read.schema(_ENTRY).parquet(f"{folder}/{_MANIFEST}").collect()
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    by_name = {entry["name"]: entry for entry in found}
    if len(by_name) < len(found):
        raise ValueError(f"{folder}: two runs have written the same table")
    return by_name


def missing_tables(spark: SparkSession, folder: str, names: Sequence[str], restart: bool) -> list[str]:
    """Which of the tables are still to be written. Complete ones are an error unless the run is a restart."""
    complete = entries(spark, folder)
    if not restart and any(name in complete for name in names):
        raise FileExistsError(f"{folder} already has some of {', '.join(names)}; restart=True writes the others")
    return [name for name in names if name not in complete]


def write_table(df: DataFrame, folder: str, name: str, seen: Observation | None = None) -> None:
    """Write a table of a layer, then enter it with the counters of ``seen``, which ``df`` must observe.

    The files go to a folder that no other run uses. The entry is one file of one row, put in place by the same
    commit as any Parquet file. Leftovers of broken runs are folders that the manifest does not name; they may be
    deleted when no run is under way.
    """
    path = f"{name}-{uuid.uuid4().hex}"
    write_layer(df, f"{folder}/{path}")
    counts = {k: int(v or 0) for k, v in seen.get.items()} if seen else {}
    entry = df.sparkSession.createDataFrame([(name, path, df.schema.json(), counts)], _ENTRY)
    entry.coalesce(1).write.mode("append").parquet(f"{folder}/{_MANIFEST}")


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> list[DataFrame]:
    """The named tables, all of them complete; otherwise an error and no table."""
    complete = entries(spark, folder)
    if absent := [name for name in names if name not in complete]:
        raise FileNotFoundError(f"{folder} has no complete {', '.join(absent)}")
    found = [complete[name] for name in names]
    return [
        spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(f"{folder}/{entry.path}")
        for entry in found
    ]

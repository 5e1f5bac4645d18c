"""Comparing a Spark result with the result of SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

# DuckDB type names by Spark type; anything else compares by its own name.
_SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return sorted(picked, key=repr)


def differences(df, connection, sql) -> list[str]:
    """What differs between the two results: columns, types, or rows compared exactly."""
    result = connection.execute(sql)
    oracle_types = {c[0]: str(c[1]) for c in result.description}
    oracle_rows = result.fetchall()
    spark_types = {f.name: _SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if spark_types != oracle_types:
        odd = {c: (spark_types.get(c), oracle_types.get(c)) for c in {**spark_types, **oracle_types}}
        return [f"{c}: {a} in Spark, {b} in SQL" for c, (a, b) in odd.items() if a != b]
    spark_rows = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    oracle_rows = _sorted_rows(list(oracle_types), oracle_rows)
    if len(spark_rows) != len(oracle_rows):
        return [f"{len(spark_rows)} rows in Spark, {len(oracle_rows)} in SQL"]
    return [f"{a} in Spark, {b} in SQL" for a, b in zip(spark_rows, oracle_rows) if a != b][:5]

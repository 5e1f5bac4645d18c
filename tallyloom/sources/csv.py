"""CSV in, every column as text, so that nothing is miscast before it is reviewed."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.schemas import LAYOUTS

_DIALECT = {"header": True, "quote": '"', "escape": '"'}


class RawTables(NamedTuple):
    product: DataFrame
    header: DataFrame
    detail: DataFrame


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multi_line: bool = False,
    ragged: str | None = None,
) -> DataFrame:
    """Read a CSV with a header line; empty fields become NULL.

    Without ``schema`` the names come from the header, which costs a small job.
    With one, the header of every file must name the same columns in the same order.
    ``multi_line`` keeps quoted line breaks inside a field, but a file can then
    no longer be split between tasks: leave it off for large files.

    A record with fewer fields than there are columns is filled with NULL, one with more is cut. ``ragged`` names a
    column that then holds the record as it stands in the file, and NULL where the number of fields is right.
    """
    options = {**_DIALECT, "inferSchema": False, "multiLine": multi_line}
    if ragged is not None:
        if schema is None:
            schema = read_csv(spark, path, multi_line=multi_line).schema
        if ragged in schema.names:
            raise ValueError(f"the file has a column {ragged!r}")
        first = schema.names[0]
        schema = StructType([*schema.fields, StructField(ragged, StringType())])
        # fields are counted only where all of them are parsed
        options |= {"columnNameOfCorruptRecord": ragged, "mode": "PERMISSIVE", "columnPruning": False}
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    if ragged is None:
        return df
    # Spark refuses to read the record alone, so the column also refers to a field, without adding any of it
    return df.withColumn(ragged, F.concat(ragged, F.substring(F.coalesce(first, F.lit("")), 1, 0)))


def ragged_records(tables: RawTables, ragged: str) -> DataFrame:
    """TableName and Record of every record that was short or long, of tables read with ``ragged``."""
    parts = [
        df.where(F.col(ragged).isNotNull()).select(F.lit(layout.name).alias("TableName"), F.col(ragged).alias("Record"))
        for df, layout in zip(tables, LAYOUTS)
    ]
    return reduce(DataFrame.unionAll, parts)


def without_ragged(tables: RawTables, ragged: str) -> RawTables:
    """The tables without their ragged records and without the column that tells them."""
    return RawTables(*[df.where(F.col(ragged).isNull()).drop(ragged) for df in tables])


def write_csv(df: DataFrame, path: str) -> None:
    """Write a CSV that ``read_csv`` reads back, outer spaces included.

    Two values do not come back as they were: an empty text comes back as NULL,
    and a text with a line break needs ``multi_line`` when it is read.
    """
    options = {**_DIALECT, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).mode("errorifexists").csv(path)


def read_raw_tables(spark: SparkSession, folder: str, ragged: str | None = None) -> RawTables:
    """The three source files of a folder. Extra columns in a file are kept. ``ragged`` is as in ``read_csv``.

    A source may be many files; their headers must name the same columns in the same order, or reading fails.
    """
    paths = [f"{folder}/{layout.file_name}" for layout in LAYOUTS]
    return RawTables(*[read_csv(spark, path, schema=read_csv(spark, path).schema, ragged=ragged) for path in paths])

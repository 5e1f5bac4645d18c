"""The folder for intermediate tables, which every executor must be able to reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else its warehouse folder."""
    return spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a table once and keep it in the folder that ``spark.checkpoint.dir`` names.

    A session that names none gets the table as it is, computed again wherever it is used.
    """
    spark = df.sparkSession
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        return df
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()

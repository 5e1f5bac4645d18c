"""Ranks that do not need a task per group are those of a window."""

import pytest
from conftest import as_list, as_set
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import lookup
from tallyloom.operators.ranking import ranked_within

def order():
    return [F.desc_nulls_last("v"), F.asc_nulls_first("name")]


@pytest.fixture(params=["small", "large"])
def parts_size(request, monkeypatch):
    """Run with the parts' first places treated as few, and as too many to broadcast."""
    if request.param == "large":
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)


@pytest.mark.usefixtures("parts_size")
def test_a_group_with_nearly_all_rows_is_spread_over_tasks(spark, tmp_path, setting):
    setting(spark__sql__adaptive__coalescePartitions__enabled="false")  # the table is small enough for two tasks
    hot = F.when(F.col("id") % 50 > 0, 2020).otherwise(F.col("id") % 300)
    value = F.when(F.col("id") % 3 > 0, F.xxhash64("id") % 1000)  # a third without a value, the others with ties
    df = spark.range(0, 400_000, 1, 16).select(hot.alias("g"), value.cast("double").alias("v"), F.hex("id").alias("name"))
    folder = str(tmp_path / "ranked")
    got = ranked_within(df, ["g"], order(), folder=folder)
    plain = df.withColumn("wanted", F.row_number().over(Window.partitionBy("g").orderBy(*order())))
    assert got.join(plain, ["g", "name"]).where("rank = wanted").count() == got.count() == 400_000
    files = spark.read.parquet(folder).where("g = 2020").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 4 and max(n for _, n in files) < 200_000


@pytest.mark.usefixtures("parts_size")
def test_null_groups_ties_nan_and_a_column_that_is_called_rank(rows):
    nan = float("nan")
    data = [(None, 1.0, "a", 7), (None, 1.0, "a", 7), (None, None, "b", 7), (1, nan, None, 7), (1, 5.0, "x", None), (1, -0.0, "x", 7)]
    df = rows(data, "g int, v double, name string, rank int")
    got = ranked_within(df, ["g"], order())
    assert got.columns == ["g", "v", "name", "rank"]
    assert as_list(got.select("g", "name", "rank")) == as_list(
        rows(
            [(None, "a", 1), (None, "a", 2), (None, "b", 3), (1, None, 1), (1, "x", 2), (1, "x", 3)],
            "g int, name string, rank long",
        )
    )
    assert as_set(ranked_within(df, [], order()).select("rank")) == {(n,) for n in range(1, 7)}
    assert ranked_within(df.limit(0), ["g"], order()).collect() == []

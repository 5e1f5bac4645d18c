"""Connected components by alternating large-star and small-star steps, with state in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (least node of its component) for all nodes of links a, b (long).

    Each step points neighbours at a least one; only the least is gathered per node, which is summed up before the
    shuffle, so a node with very many links is no burden. The steps end when they change nothing; their number grows
    with the logarithm of the longest chain, so most_rounds could be passed by no chain that fits a table.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("w")), F.struct(F.col("v").alias("u"), F.col("m").alias("w")))).alias("e"))
        edges = written(small.select("e.u", F.col("e.w").alias("v")).where("u <> v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            nodes = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return nodes.unionByName(roots)
        seen = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")

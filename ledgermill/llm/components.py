"""Connected components of a table of links, by alternating star operations until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import stage


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v and the least of u and its neighbours. The minimum is combined before its shuffle, and the join on u is one
    that Spark splits where a node has very many links."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("least", F.least("u", "least"))


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node that links reach) for every node of ``links`` (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges, mark = stage(edges, "links"), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")
        down = _with_least(large.distinct())
        small = down.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            down.select("u", F.col("least").alias("v"))
        )
        edges = stage(small.where("u != v").distinct(), "links")
        seen = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(seen) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        mark = tuple(seen)
    return edges.toDF("node", "label")

"""Connected components of an edge table by alternating star contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioforge.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs → (node, component): the smallest node reachable, for each node with an edge."""
    now = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = staged(_small_star(_large_star(now)).filter("a <> b").distinct(), "edges")
    stars = now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return stars.union(stars.select(F.col("component"), F.col("component"))).groupBy("node").agg(F.min("component").alias("component"))

"""Connected components by rounds of Spark joins (no driver-side union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, saved


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, root)`` for every linked node; root = smallest node.

    Alternating stars: each round first ties every node's larger neighbours to its smallest
    neighbour, then every node's smaller neighbours to the smallest one. A component of n
    nodes settles in O(log n) rounds and no round widens the link table. Each grouping is a
    minimum (combined map-side), so a hub with a third of all links costs one partial row per
    task. Null and self links are dropped; an empty input gives an empty result.
    """
    edges = saved(links.where("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  "links")
    before = None
    for _ in range(max_rounds):
        # every neighbour, both ways
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = (edges.join(low.withColumnRenamed("u", "v"), "v")          # v < u: tie u to the least around v
                 .select("u", F.col("m").alias("v")).distinct())
        large = saved(large, "large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct())
        nxt = saved(small, "links")
        state = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for t in (edges, low, large, least):
            drop_saved(t)
        edges = nxt
        if state == before:
            roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

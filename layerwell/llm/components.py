"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerwell.sinks.parquet import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b (long); the result has one row per node that
    occurs in a link: node, root (the smallest node of its component).

    Every node points at a smaller node of its component. A round lets each node
    and each node's target take the smallest target seen over a link, and then
    lets every node point where its target points; this halves paths, so rounds
    grow with the logarithm of the longest one. Proposals are reduced to their
    minimum before they are shuffled. Each round is written to the shared
    scratch folder, which cuts the lineage and survives lost executors.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.where("a <> b").distinct())
    parent = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    while True:
        target = parent.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        reach = stage(parent.join(target, "root", "left").select(
            "node", "root", F.coalesce("grand", "root").alias("grand")
        ))
        seen = (
            both.join(reach.select(F.col("node").alias("b"), F.col("grand").alias("offer")), "b")
            .groupBy("a").agg(F.min("offer").alias("offer"))
            .join(reach.withColumnRenamed("node", "a"), "a")
        )
        offers = (
            seen.select(F.col("root").alias("node"), "offer")
            .union(seen.select(F.col("a").alias("node"), "offer"))
            .groupBy("node").agg(F.min("offer").alias("offer"))
        )
        moved = stage(
            reach.join(offers, "node", "left").select(
                "node",
                F.least("grand", F.coalesce("offer", "grand")).alias("root"),
                F.col("root").alias("was"),
            )
        )
        parent = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return parent

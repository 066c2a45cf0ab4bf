"""Connected components of links, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.common import stored


def _any(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (``a, b``: longs).

    Each round every node points to its smallest neighbour, pointers are doubled until they end at
    roots, and links are drawn anew between roots; a round at least halves what is still linked.
    Tables are written between the steps, so nothing is recomputed if an executor is lost; only
    whether any link is left comes to the driver.  A node with very many links is one group of a
    combined minimum, and a single row of the joined side.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct())
    labels = None
    while _any(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(
            both.groupBy("a").agg(F.min("b").alias("least")).select(
                F.col("a").alias("node"), F.least("a", "least").alias("root")
            )
        )
        while True:
            above = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            doubled = stored(
                parent.join(above, "root").select(
                    "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
                )
            )
            parent = doubled.drop("moved")
            if not _any(doubled.where("moved")):
                break
        if labels is None:
            labels = parent.withColumnRenamed("root", "component")
        else:
            moved = parent.select(F.col("node").alias("component"), "root")
            labels = stored(
                labels.join(moved, "component", "left").select(
                    "node", F.coalesce("root", "component").alias("component")
                )
            )
        left = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        between = links.join(left, "a").join(right, "b").where("ra <> rb")
        links = stored(between.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels

"""Connected components by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm._common import discard, materialise


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that an edge touches; root is the smallest node of its component.

    Large-star and small-star steps alternate until nothing changes: the first links the larger neighbours of a node
    to its smallest neighbour, the second the smaller ones. Each step is a minimum by key, combined before the shuffle,
    and a join with it. In that join a node has one row on the side of the minima, so where a node has very many links,
    Spark can split its rows of the other side over tasks (adaptive skew join). Every round is written to the shared
    folder. Edges with a null end and loops carry no link.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    links, seen = materialise(links, "links"), None
    while True:
        both = links.union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        discard(links)
        links = after
        if mark == seen or not mark[0]:
            break
        seen = mark
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v")).distinct()

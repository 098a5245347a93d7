"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import staged


def _settled(edges: DataFrame) -> bool:
    """Every node is tied to one smaller node at most, and none of these is tied further."""
    ends = edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("b")))
    found = ends.groupBy("node").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.max(F.col("b").isNull()).alias("below"))
    return not found.agg(F.max(F.expr("least < most OR (below AND least IS NOT NULL)"))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for all ends of the edges (long a, b), which are read several times.

    Alternates two steps until all nodes are tied to their roots: every larger
    neighbour of a node is tied to the node's smallest neighbour, then every
    smaller one.  A node's neighbours are never gathered: only their minimum is,
    which is summed up before the shuffle.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = large = staged(large, "edges")
        if _settled(edges):
            break
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = staged(small, "edges")
        if _settled(edges):
            break
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return staged(tied.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), "components")

"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each component, for all nodes with an edge (a, b).

    Large-star and small-star steps by turns: each node's neighbours are joined to the least
    of them, until every edge leads to a root. Only the least neighbour of a node is
    aggregated, so a node with very many edges is no large group.
    """
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = _digest(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # A table of its own, so that a node with very many edges can be split in the join.
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        first = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(first, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(first.select("a", F.col("m").alias("b")))
        now = materialise(small.filter("a <> b").distinct(), "small")
        before, found = found, _digest(now)
        if found == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

"""Connected components by alternating stars, as joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for all nodes of the edges ``a``, ``b`` (bigint).

    Each round first links the larger neighbours of a node to its smallest
    neighbour, then the smaller ones; it ends when every node but the smallest
    of its component has one edge, to that one. Only minima are gathered per
    node, and the joins that hand them out are ordinary ones on the node.
    Self-links and repeated edges do not matter.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.filter("a <> b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(lowest.select("a", F.col("low").alias("b"))))
        edges = stored(small.distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

"""Connected components of a link table, by alternating star contraction.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): in a
large-star step every node links its larger neighbours to its smallest
neighbour; in a small-star step its smaller ones. Links shrink to one star per
component in a logarithmic number of rounds. Minima are combined before the
shuffle and joined back by an ordinary join, so a hub of any degree is split
by adaptive execution and never gathered in one task. Each round is written to
the shared checkpoint folder and the one before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        keep = F.col("v") > F.col("u")
    else:  # every stored link points from the larger node a to the smaller node b
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        keep = F.lit(True)
    j = both.filter(keep).join(low, "u")
    out = j.select(F.col("v").alias("x"), F.col("m").alias("y"))
    if not large:
        out = out.unionByName(low.select(F.col("u").alias("x"), F.col("m").alias("y")))
    return (out.filter(F.col("x") != F.col("y"))
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link and is no smaller end."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("high")).unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("high")))
    return ends.groupBy("n").agg(F.sum("high").alias("h"), F.min("high").alias("l")).filter("h > 1 or (h = 1 and l = 0)").isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) links of longs -> (node, component) with the smallest node of each component.

    Only nodes that have a link appear. Null ends and self links are ignored;
    repeated links and either direction are fine; an empty table gives an empty one.
    """
    e = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = scratch.write(e, "links")
    while not _stars(e):
        nxt = scratch.write(_star(_star(e, large=True), large=False), "stars")
        scratch.drop(e)
        e = nxt
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of links in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Scratch

#: Far beyond what the halving of distances needs; a guard, not a limit on results.
ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for nodes of ``links`` (a, b).

    Alternating large-star and small-star steps: neighbours above a node, then those
    below it, are tied to the smallest node around it. Every step is a grouping that
    adds up before its shuffle and a join on the node, whose hot keys adaptive
    execution splits. Nodes without a link to another are not returned.
    """
    pairs = links.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    scratch = Scratch(links.sparkSession)
    edges = scratch.settle(pairs.distinct(), "edges")
    state = None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        smallest = both.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        smallest = smallest.select("node", F.least("node", "m").alias("m"))
        # Large star: what lies above a node goes to the smallest around the node.
        above = both.where("lo > hi").join(smallest, F.col("hi") == F.col("node"))
        large = scratch.settle(
            above.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct(),
            "edges",
        )
        lowest = large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        below = large.join(lowest, F.col("hi") == F.col("node"))
        small = below.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        kept = lowest.select(F.col("node").alias("hi"), F.col("m").alias("lo"))
        old, edges = edges, scratch.settle(small.unionByName(kept).distinct(), "edges")
        scratch.drop(old, large)
        total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        now = tuple(edges.agg(F.count("*"), total).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    ends = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return ends.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())

"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.session import cut


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _hang_on_least(pairs: DataFrame, larger: bool) -> DataFrame:
    """Join the neighbours of every node to the least of them, the node included.

    ``larger`` moves the neighbours above a node (large star), else those below it and
    the node itself (small star). Minima combine before the shuffle; the join of a node
    of very many neighbours is left to the skew handling of adaptive execution.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = pairs.join(least, "u")
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        below = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = below.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``u, v`` pairs -> ``node, root``: the least node of its component, for all but roots.

    Alternating large and small stars; every round ends in a written table, so no
    lineage grows and a lost executor costs one round's tasks. The number of rounds
    grows with the logarithm of the longest chain. Loops and repeated pairs are allowed,
    an empty table gives an empty result.
    """
    edges = cut(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        large = _hang_on_least(_neighbours(edges), larger=True)
        # All neighbours in ``large`` lie below their node.
        edges = cut(_hang_on_least(large, larger=False), "edges")
        after = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after

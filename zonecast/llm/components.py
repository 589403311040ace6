"""Connected components of an edge table, as alternating star rounds over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _shape(edges: DataFrame) -> tuple:
    r = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")
    ).first()
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not its component's smallest node.

    ``edges`` has long columns ``hi`` > ``lo``.  A round sends each node's larger
    neighbours to its smallest neighbour, then each node's smaller neighbours;
    rounds repeat until the table no longer changes, which takes about the
    logarithm of the longest shortest path.  Minima are pre-aggregated before
    the shuffle and stored, so that both sides of a join come straight from an
    exchange: there the skew-join rule may split a hub's edges over many tasks.
    No neighbour list is ever gathered.  Each step is written to the shared folder.
    """
    edges = stored(edges.select("hi", "lo").distinct(), "edges")
    before = _shape(edges)
    while before[0]:
        # the smallest neighbour of a node, itself included, seen from either end
        least = stored(
            edges.select(F.col("lo").alias("lo"), F.col("lo").alias("m"))
            .unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("m")))
            .groupBy("lo").agg(F.min("m").alias("m")), "least",
        )
        large = edges.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()
        large = stored(large, "edges")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        joined = large.join(least, "hi")
        small = (
            joined.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        edges = stored(small, "edges")
        after = _shape(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))

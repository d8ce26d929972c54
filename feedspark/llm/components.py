"""Connected components of an edge list, by alternating star contraction.

Each round rewires every node's larger neighbours to its smallest one (large
star), then its smaller neighbours (small star); the number of rounds grows with
the logarithm of the graph. Hubs are safe: minima are combined before the
shuffle and written, so that the join that returns them to the edges is between
two plain exchanges, whose skewed partitions adaptive execution splits. Each round
is checkpointed, so lineage stays short and a lost executor costs one round at most.
What a round leaves behind (plans, minima, shuffles) is released before the next one:
the driver's heap would otherwise grow with the number of rounds up to its limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, release


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest v of the u."""
    mins = cut_lineage(pairs.groupBy("u").agg(F.min("v").alias("m")))
    return pairs.join(mins.hint("merge"), "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node of its component) of every node that
    has an edge (`a`, `b`, longs) to another one. Loops and repeats are ignored."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    e = cut_lineage(edges.where("a != b").select(high.alias("u"), low.alias("v")).distinct())
    n, state = e.count(), None
    while n:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_min(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u != v").distinct())
        large = cut_lineage(large)
        small = _with_min(large)
        e = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = cut_lineage(e)
        now = tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)),
                          ).first())
        n = now[0]
        if now == state:
            break
        state = now
        del both, large, small
        release(e.sparkSession)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Mergeable sketches of the ids (A02, A03, A13): counts and overlaps without a
shuffle of ids.

Each day and source keeps two small sketches, HyperLogLog for its number of distinct ids
and Theta for set operations. They are stored, and merged for any span of days; ids are
read once, when their day is loaded. The figures are estimates (`HLL_ERROR` and
`THETA_ERROR` are three standard errors), for progress and reports; gates use exact
counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.num import idiv

DAY_MS = 86_400_000
LG_HLL, LG_THETA = 14, 14
#: Three relative standard errors: 1.04 / sqrt(2**lg) and 1 / sqrt(2**lg).
HLL_ERROR = 3 * 1.04 / 2 ** (LG_HLL / 2)
THETA_ERROR = 3 / 2 ** (LG_THETA / 2)


def daily_sketches(deliveries: DataFrame, key: str = "id", source: str = "strategy", ms: str = "ms") -> DataFrame:
    """`day`, `source`, `n_rows`, `hll`, `theta`: one row a day and source, combined
    map-side, so a task sends at most one row of each whatever it holds."""
    rows = deliveries.where(F.col(key).isNotNull())
    return rows.groupBy(idiv(ms, DAY_MS).alias("day"), F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(key, LG_HLL).alias("hll"),
        F.theta_sketch_agg(key, LG_THETA).alias("theta"))


def distinct_estimates(sketches: DataFrame, by: str = "source") -> DataFrame:
    """`by`, `offered`, `distinct_est` over all stored days."""
    return sketches.groupBy(by).agg(F.sum("n_rows").cast("long").alias("offered"),
                                    F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distinct_est"))


def overlap_estimates(sketches: DataFrame) -> DataFrame:
    """`source`, `other`, `both_est`: ids that two sources delivered. One row a source
    after the merge, so the pairs are as few as the sources' square."""
    merged = sketches.groupBy("source").agg(F.theta_union_agg("theta").alias("theta"))
    all_of = merged.agg(F.array_sort(F.collect_list(F.struct("source", "theta"))).alias("_s"))
    pairs = all_of.select(F.explode("_s").alias("a"), "_s").select("a", F.explode("_s").alias("b"))
    pairs = pairs.where(F.col("a.source") < F.col("b.source"))
    return pairs.select(F.col("a.source").alias("source"), F.col("b.source").alias("other"),
                        F.theta_sketch_estimate(F.theta_intersection(F.col("a.theta"), F.col("b.theta"))).alias("both_est"))

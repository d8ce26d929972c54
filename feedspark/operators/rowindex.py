"""Distributed dense row index over a total order.

`row_number()` over an unpartitioned window pulls every row into one task.
Instead: range-partition on the order, sort inside each partition, tag rows
with `monotonically_increasing_id` (partition id in the upper bits, local
position in the lower 33), cut lineage so both passes see identical
partitions, count per partition, and add each partition's running offset.
The offsets frame has one row per partition -- its size is bounded by the
partition count, not by the data -- so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOCAL_BITS = 33


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_row_index(df: DataFrame, order: list[Column], idx: str = "idx",
                   num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based dense index following `order` (which must be total).

    `df` is materialised as given (Catalyst cannot prune columns through the
    checkpoint), so project to the columns needed downstream first.

    The result stays range-partitioned on `order`, so a later aggregate on
    `idx div k` groups mostly inside partitions.
    """
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (ranged.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(idx, (F.col("_off") + local).cast("long"))
            .drop("_mid", "_pid", "_off"))

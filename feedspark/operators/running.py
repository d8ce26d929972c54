"""Running sums that stay parallel when one group holds most of the rows.

A window partitioned by worker sends each worker's whole history to one
task; with six workers one of them may hold a third of all batches. The
segmented form splits the order into fixed-size blocks: block totals (one
row per group and block), their prefix sums per group (a window over the
block totals, which are `block_rows` times fewer), and a window partitioned
by (group, block) inside each block. No task sees more than `block_rows`
rows of one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.num import idiv


def running_sums(df: DataFrame, by: list[str], order: str, values: dict[str, str],
                 block_rows: int = 1_000_000) -> DataFrame:
    """Add ``out = sum(value)`` over rows of the same `by` group with
    `order` <= this row's, for each ``out: value`` in `values`.

    `order` must be an integer column unique within a group (a batch or
    sequence number); blocks are ranges of it.
    """
    blk = "_blk"
    d = df.withColumn(blk, idiv(order, block_rows))
    totals = d.groupBy(*by, blk).agg(*[F.sum(v).alias(f"_t_{o}") for o, v in values.items()])
    before = Window.partitionBy(*by).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, blk, *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0))
                                        .alias(f"_o_{o}") for o in values])
    inside = Window.partitionBy(*by, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = d.join(offsets, [*by, blk])
    for o, v in values.items():
        out = out.withColumn(o, (F.col(f"_o_{o}") + F.sum(v).over(inside)).cast("long"))
    return out.drop(blk, *[f"_o_{o}" for o in values])

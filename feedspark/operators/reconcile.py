"""Completeness and reconciliation reports.

All counts are exact. `approx_count_distinct` is never used for a gate
(it gave 9571 for 10000 ids here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ESTIMATE_EXACT_BELOW, SHORTFALL_MAX_PASSES
from ..functions.num import idiv
from .rowindex import with_row_index


def exact_count(df: DataFrame) -> DataFrame:
    """One row, `n`."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def offered_vs_distinct(offered: DataFrame, key: str = "id") -> DataFrame:
    """Rows offered vs distinct keys (the source mixes the two in its stop tests)."""
    return (offered.agg(F.count(F.lit(1)).alias("offered"),
                        F.count_distinct(key).alias("distinct_ids"))
            .withColumn("repeats", F.col("offered") - F.col("distinct_ids")))


def distribution(df: DataFrame, by: str, name: str = "category") -> DataFrame:
    """Rows per category and share of the total (fraction, not percent)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(by).alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", F.col("n") / total))


def completeness_by_category(loaded: DataFrame, expected: DataFrame, by: str,
                             name: str = "category") -> DataFrame:
    """Expected vs loaded per category by a full outer join of two
    aggregates (each one row per category); missing = expected - loaded."""
    e = expected.groupBy(F.col(by).alias(name)).agg(F.count(F.lit(1)).alias("expected"))
    a = loaded.groupBy(F.col(by).alias(name)).agg(F.count(F.lit(1)).alias("loaded"))
    return (e.join(a, name, "full_outer")
            .select(name, F.coalesce("expected", F.lit(0)).cast("long").alias("expected"),
                    F.coalesce("loaded", F.lit(0)).cast("long").alias("loaded"))
            .withColumn("missing", F.col("expected") - F.col("loaded")))


def shortfall(loaded: DataFrame, expected_total, passes_done: int = 1,
              max_passes: int = SHORTFALL_MAX_PASSES) -> DataFrame:
    """Count vs expected and the decision: ``complete``, ``retry`` (more
    passes allowed) or ``give_up``."""
    exp = F.lit(expected_total) if isinstance(expected_total, int) else expected_total
    out = loaded.agg(F.count(F.lit(1)).alias("loaded")).select(
        exp.cast("long").alias("expected"), "loaded")
    missing = F.col("expected") - F.col("loaded")
    return (out.withColumn("missing", missing)
            .withColumn("decision", F.when(missing <= 0, F.lit("complete"))
                        .when(F.lit(passes_done) < F.lit(max_passes), F.lit("retry"))
                        .otherwise(F.lit("give_up"))))


def source_overlap(deliveries: DataFrame, sources: tuple[str, ...], key: str = "id",
                   source_col: str = "strategy") -> DataFrame:
    """Ids per combination of sources that delivered them.

    With a known, small source list each id folds to a bitmask (`bit_or`,
    map-side partial aggregation) instead of collecting sets.
    """
    bit = F.lit(0)
    for i, s in enumerate(sources):
        bit = F.when(F.col(source_col) == s, F.lit(1 << i)).otherwise(bit)
    per_id = deliveries.groupBy(key).agg(F.bit_or(bit).alias("mask"))
    label = F.concat_ws("+", *[F.when((F.col("mask").bitwiseAND(F.lit(1 << i))) != 0, F.lit(s))
                               for i, s in enumerate(sources)])
    return per_id.groupBy(label.alias("sources")).agg(F.count(F.lit(1)).alias("n_ids"))


def time_gaps(loaded: DataFrame, expected: DataFrame, bucket_ms: int,
              ms: str = "ms") -> DataFrame:
    """Time buckets holding fewer loaded rows than expected.

    Bucket counts are two aggregates joined on the bucket; a spine of every
    bucket between the bounds (generated with `spark.range`, distributed) keeps
    empty buckets visible. Returns buckets with missing > 0.
    """
    spark: SparkSession = loaded.sparkSession
    b = idiv(ms, bucket_ms)
    e = expected.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("expected"))
    a = loaded.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("loaded"))
    bounds = expected.agg(F.min(b).alias("lo"), F.max(b).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return spark.createDataFrame([], "bucket long, bucket_start_ms long, expected long, loaded long, missing long")
    spine = spark.range(bounds["lo"], bounds["hi"] + 1).select(F.col("id").alias("bucket"))
    rep = (spine.join(e, "bucket", "left").join(a, "bucket", "left")
           .select("bucket", (F.col("bucket") * bucket_ms).alias("bucket_start_ms"),
                   F.coalesce("expected", F.lit(0)).alias("expected"),
                   F.coalesce("loaded", F.lit(0)).alias("loaded")))
    return rep.withColumn("missing", F.col("expected") - F.col("loaded")).where(F.col("missing") > 0)


def gap_ranges(gaps: DataFrame, bucket_ms: int) -> DataFrame:
    """A15 missing ranges: runs of consecutive short buckets from `time_gaps`
    merged into ``[since_ms, until_ms)`` ranges (what a targeted re-fetch
    with since/until needs), with the rows missing in each.

    Gaps and islands: within a run, ``bucket - position`` is constant. The position
    comes from the distributed row index (range partitions, one count carried for
    each), so no task sees all gaps; the runs are folded map-side, so neither does a
    run as long as the whole span.
    """
    island = F.col("bucket") - F.col("_pos")
    gaps = with_row_index(gaps.select("bucket", "missing"), [F.col("bucket")], "_pos")
    return (gaps.withColumn("_island", island).groupBy("_island")
            .agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"),
                 F.sum("missing").cast("long").alias("missing"),
                 F.count(F.lit(1)).alias("buckets"))
            .select((F.col("_lo") * bucket_ms).alias("since_ms"),
                    ((F.col("_hi") + 1) * bucket_ms).alias("until_ms"), "buckets", "missing"))


def estimated_count(spark: SparkSession, table_name: str,
                    exact_below: int = ESTIMATE_EXACT_BELOW) -> DataFrame:
    """Row estimate from table statistics (refreshed with
    ANALYZE); exact count when the estimate is at or below `exact_below`.
    Never use the estimate as a gate."""
    spark.sql(f"ANALYZE TABLE {table_name} COMPUTE STATISTICS")
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").where(
        F.col("col_name") == "Statistics").select("data_type").first()
    est = None
    if stats is not None:
        import re
        m = re.search(r"(\d+) rows", stats[0])
        est = int(m.group(1)) if m else None
    if est is not None and est > exact_below:
        return spark.createDataFrame([(est, "estimate")], "n bigint, method string")
    return spark.table(table_name).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "method", F.lit("exact"))

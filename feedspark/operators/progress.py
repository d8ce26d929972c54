"""Operations metrics.

Running totals are always partitioned by worker or strategy; a global
series is aggregated to bucket level first, so no window sees raw rows in
one task. The checkpoint fold needs no window at all: a keyed `max(seq)`
(combined map-side even when one strategy holds most of the log) and a semi
join back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (DEAD_AFTER_MS, RATE_WINDOW_MS, RECENT_SAMPLES, STUCK_AFTER_MS,
                         TREND_DOWN_RATIO, TREND_UP_RATIO)
from ..functions.text import request_outcome
from ..functions.num import idiv
from .running import running_sums

def _last_per_strategy(log: DataFrame) -> DataFrame:
    """Newest row per strategy: a hash `max(seq)` per strategy (one row per
    strategy, so AQE broadcasts it) and a semi join back, so the log itself
    is neither sorted nor shuffled."""
    last = log.groupBy("strategy").agg(F.max("seq").alias("seq"))
    return log.join(last, ["strategy", "seq"], "left_semi")


def checkpoint_state(log: DataFrame, as_written: bool = False) -> DataFrame:
    """K03 fold of an append-only checkpoint log ordered by `seq`.

    Intent (default): a ``completed`` row closes the open row of its
    strategy, so what remains is every completed row plus, per strategy,
    the newest row when it is still open. As written (the source's partial
    unique index never matches a completed row): every completed row plus
    the newest non-completed row per strategy.
    """
    if "metadata" in log.columns:                    # missing metadata is an empty object
        log = log.withColumn("metadata", F.coalesce("metadata", F.lit("{}")))
    done = log.where(F.col("status") == "completed")
    if as_written:
        open_rows = _last_per_strategy(log.where(F.col("status") != "completed"))
    else:
        open_rows = _last_per_strategy(log).where(F.col("status") != "completed")
    return done.unionByName(open_rows.select(*log.columns))


def latest_open_checkpoint(state: DataFrame) -> DataFrame:
    """Newest non-completed checkpoint (top-1 by `updated_at` if there is one, then `seq`)."""
    order = [F.col(c).desc() for c in ("updated_at", "seq") if c in state.columns]
    return state.where(F.col("status") != "completed").orderBy(*order).limit(1)


def milestones(batches: DataFrame, every: int, by: str = "worker", order: str = "batch",
               events: str = "events", exact: bool = False,
               block_rows: int = 1_000_000) -> DataFrame:
    """Batches at which a worker's running count crosses a
    multiple of `every` (W01: ``cum % every < batch``), or lands on one
    exactly (W02: ``cum % every = 0``, which misses uneven batches).
    Running counts are segmented (`running.running_sums`)."""
    cum = running_sums(batches, [by], order, {"fetched": events}, block_rows)
    hit = (F.col("fetched") % every == 0) if exact else (F.col("fetched") % every < F.col(events))
    return cum.where(hit)


def running_totals(batches: DataFrame, by: str = "strategy", order: str = "batch",
                   block_rows: int = 1_000_000) -> DataFrame:
    """Running offered and inserted per strategy in load order (segmented)."""
    out = running_sums(batches, [by], order,
                       {"offered_total": "events", "inserted_total": "inserted"}, block_rows)
    return out.select(by, order, "offered_total", "inserted_total")


def rate_in_window(samples: DataFrame, now_ms, window_ms: int = RATE_WINDOW_MS,
                   by: str | None = "strategy", ts: str = "ts_ms",
                   events: str = "events") -> DataFrame:
    """Events per second over the samples newer than ``now - window``.

    The time base is from the earliest sample in the window to `now` (not
    the window length); 0 when no time has passed.
    """
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    recent = samples.where(F.col(ts) >= now - F.lit(window_ms))
    keys = [by] if by else []
    agg = recent.groupBy(*keys).agg(F.sum(events).cast("long").alias("events_in_window"),
                                    F.min(ts).alias("earliest_ms"))
    if by:
        # a strategy seen before the window has rate 0, not no row
        agg = samples.select(by).distinct().join(agg, by, "left")
    secs = (now - F.col("earliest_ms")) / F.lit(1000.0)
    return (agg.withColumn("events_in_window", F.coalesce("events_in_window", F.lit(0)).cast("long"))
            .withColumn("rate", F.when(secs > 0, F.col("events_in_window") / secs)
                        .otherwise(F.lit(0.0))).drop("earliest_ms"))


def best_strategy(samples: DataFrame, now_ms, window_ms: int = RATE_WINDOW_MS,
                  ts: str = "ts_ms") -> DataFrame:
    """Strategy with the highest rate; the first seen wins ties; NULL
    when every rate is 0. One row."""
    rates = rate_in_window(samples, now_ms, window_ms, "strategy", ts)
    first_seen = samples.groupBy("strategy").agg(F.min(ts).alias("first_seen"))
    r = rates.join(first_seen, "strategy").where(F.col("rate") > 0)
    best = r.agg(F.max_by(F.struct("strategy", "rate"),
                          F.struct("rate", -F.col("first_seen"))).alias("b"))
    return best.select(F.col("b.strategy").alias("best_strategy"),
                       F.col("b.rate").alias("best_rate"))


def worker_health(heartbeats: DataFrame, now_ms, name: str = "name",
                  ts: str = "last_progress_ms", fetched: str = "fetched",
                  stuck_ms: int = STUCK_AFTER_MS, dead_ms: int = DEAD_AFTER_MS) -> DataFrame:
    """A10: last progress per worker and its state (strictly greater ages:
    > 60 s dead, > 30 s stuck, else active). Among heartbeats with the same
    time the largest `fetched` counts, so the result is deterministic."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    last = heartbeats.groupBy(name).agg(F.max(ts).alias("last_progress_ms"),
                                        F.max_by(fetched, F.struct(ts, fetched)).alias("fetched"))
    age = now - F.col("last_progress_ms")
    return last.withColumn("age_ms", age).withColumn(
        "state", F.when(age > dead_ms, F.lit("dead")).when(age > stuck_ms, F.lit("stuck"))
        .otherwise(F.lit("active")))


def worker_health_counts(health: DataFrame) -> DataFrame:
    """A10: workers per state."""
    return health.groupBy("state").agg(F.count(F.lit(1)).alias("workers"))


def progress_summary(expected_total, loaded: DataFrame, offered: DataFrame,
                     start_ms, now_ms) -> DataFrame:
    """Pct loaded, rate over max(elapsed, 1 s), eta minutes (NULL when
    the rate is 0), queue lag = offered - loaded. One row."""
    lit = lambda x: F.lit(x) if isinstance(x, (int, float)) else x
    n_loaded = loaded.agg(F.count(F.lit(1))).scalar()
    n_offered = offered.agg(F.count(F.lit(1))).scalar()
    spark = loaded.sparkSession
    elapsed = F.greatest((lit(now_ms) - lit(start_ms)) / F.lit(1000.0), F.lit(1.0))
    rate = n_loaded / elapsed
    exp = lit(expected_total)
    return spark.range(1).select(
        exp.cast("long").alias("expected"), n_loaded.alias("loaded"), n_offered.alias("offered"),
        (n_loaded * F.lit(100.0) / exp).alias("pct"),
        rate.alias("rate"),
        F.when(rate > 0, (exp - n_loaded) / rate / F.lit(60.0)).alias("eta_min"),
        (n_offered - n_loaded).alias("lag"))


def throughput_trend(samples: DataFrame, bucket_ms: int, ts: str = "ts_ms",
                     events: str = "events") -> DataFrame:
    """Rate per time bucket and the controller's reaction to it:
    > 1.05x the previous ``ramp_up``, < 0.85x ``back_off``, else ``hold``;
    no label while the previous rate is 0 or absent. Every bucket between the first and
    the last sample counts, also an idle one (rate 0).

    Samples are aggregated to buckets, and the buckets are dense, so a bucket's
    predecessor is an equi-join on its number: no ordered window in one task.
    """
    per = samples.groupBy(idiv(ts, bucket_ms).alias("bucket")).agg(F.sum(events).cast("long").alias("events"))
    bounds = samples.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(
        idiv("lo", bucket_ms).alias("lo"), idiv("hi", bucket_ms).alias("hi")).first()
    if bounds["lo"] is None:
        spine = samples.sparkSession.range(0)
    else:
        spine = samples.sparkSession.range(bounds["lo"], bounds["hi"] + 1)
    b = (spine.select(F.col("id").alias("bucket")).join(per, "bucket", "left")
         .withColumn("events", F.coalesce("events", F.lit(0)))
         .withColumn("rate", F.col("events") / F.lit(bucket_ms / 1000.0)))
    prev = b.select((F.col("bucket") + 1).alias("bucket"), F.col("rate").alias("prev_rate"))
    b = b.join(prev, "bucket", "left")
    return b.withColumn("action", F.when(F.col("prev_rate") > 0,
                                         F.when(F.col("rate") > F.col("prev_rate") * TREND_UP_RATIO,
                                                F.lit("ramp_up"))
                                         .when(F.col("rate") < F.col("prev_rate") * TREND_DOWN_RATIO,
                                               F.lit("back_off"))
                                         .otherwise(F.lit("hold"))))


def recent_samples(samples: DataFrame, n: int = RECENT_SAMPLES, ts: str = "ts_ms",
                   tie: str = "batch") -> DataFrame:
    """The newest `n` samples (top-k; the bound is the feature)."""
    return samples.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)


def request_outcome_rollup(log: DataFrame, status: str = "status",
                           by: list[str] | None = None) -> DataFrame:
    """Requests per outcome class (and optional grouping columns)."""
    by = by or []
    return log.groupBy(*by, request_outcome(F.col(status)).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))

"""Event-time windowed counts on a stream.

Update mode with a watermark keeps state bounded; every micro-batch
appends the windows it changed (with their running totals) to a log, and
the final value of a window is the row from its newest batch -- the same
append-log-and-fold shape as the checkpoint table. Only for time-ordered
input: the feed's newest-first order would make almost everything late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timefmt import epoch_ms


def log_batch(log_path: str):
    """foreachBatch body: append the batch's rows, tagged with `batch_id`, to a
    log that a fold reads back (a replayed batch rewrites the same values)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(
            log_path)
    return run


def stream_window_counts(spark: SparkSession, landing: str, schema: StructType | str,
                         log_path: str, checkpoint: str, window: str, slide: str | None = None,
                         by: list[str] | None = None, ts: str = "ts", delay: str = "1 hour",
                         files_per_trigger: int | None = None):
    """Windowed row counts per `by`, appended per batch to `log_path`; drains and stops.
    Returns the ended query (see `loader.watermark_figures`)."""
    by = by or []
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    s = reader.load(landing).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    agg = s.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("events")).select(
        epoch_ms(F.col("w.start")).alias("window_start_ms"),
        epoch_ms(F.col("w.end")).alias("window_end_ms"), *by, "events")
    q = (agg.writeStream.outputMode("update").foreachBatch(log_batch(log_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def fold_window_log(log: DataFrame, keys: list[str]) -> DataFrame:
    """Final count per window: the value from the newest batch that updated it."""
    return log.groupBy(*keys).agg(F.max_by("events", "batch_id").alias("events"))

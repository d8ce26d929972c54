"""Structured Streaming loaders.

T01 is the default loader: a file stream of landed deliveries, and per
micro-batch the same K01 step as the batch loader (collapse the batch on the
key, anti join with the target, append). It keeps no streaming state and no
watermark, so newest-to-oldest input loses nothing, and a replayed batch
(after a failure between the write and the checkpoint commit) adds nothing
because the anti join sees the rows it already wrote.

T02 bounds memory with `dropDuplicatesWithinWatermark`; it is exact only
for time-ordered input (duplicates of an event arrive within the delay).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.load import distinct_ids


def create_target(spark: SparkSession, path: str, key: str = "id",
                  seed: DataFrame | None = None) -> None:
    """K07 for a path table: write the (possibly empty) starting id set."""
    if seed is None:
        seed = spark.createDataFrame([], f"{key} string")
    seed.select(F.col(key).cast("string").alias(key)).write.mode("errorifexists").parquet(path)


BROADCAST_KEYS_MAX = 5_000_000


def load_batch(target_path: str, key: str = "id", broadcast_max: int = BROADCAST_KEYS_MAX):
    """foreachBatch body: append the batch's unseen keys to the target.

    The target grows without bound while a micro-batch is bounded by the
    trigger limits, so the batch's distinct keys are counted and, when at
    most `broadcast_max`, broadcast to filter the target scan (semi join,
    no shuffle of the target); only the few matches meet the batch in the
    anti join. Above the bound it falls back to the shuffled anti join.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = spark.read.parquet(target_path).select(key)
        keys = distinct_ids(batch, key).persist()
        try:
            if keys.count() <= broadcast_max:
                seen = target.join(F.broadcast(keys), key, "left_semi")
                new = keys.join(seen, key, "left_anti")
            else:
                new = keys.join(target, key, "left_anti")
            new.write.mode("append").parquet(target_path)
        finally:
            keys.unpersist()
    return run


def stream_idempotent_load(spark: SparkSession, landing: str, schema: StructType | str,
                           target_path: str, checkpoint: str, key: str = "id",
                           files_per_trigger: int | None = None, fmt: str = "parquet",
                           available_now: bool = True,
                           broadcast_max: int = BROADCAST_KEYS_MAX):
    """Continuous idempotent load from a landing folder.

    `checkpoint` makes a restart resume at the first unprocessed file (T03).
    With `available_now` the query drains what has landed and stops (T08);
    the call returns after termination. Otherwise the running query is
    returned.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(landing).select(key)
    writer = (stream.writeStream.foreachBatch(load_batch(target_path, key, broadcast_max))
              .option("checkpointLocation", checkpoint))
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()


def watermark_figures(q) -> dict[str, int]:
    """Of an ended query, from its progress: `batches` with data, `rows` read, `late` rows
    that state operators dropped because the watermark had passed them, and `state_rows`
    kept at the end."""
    seen = [p for p in q.recentProgress]
    ops = [[o for o in p["stateOperators"]] for p in seen]
    return {"batches": sum(p["numInputRows"] > 0 for p in seen), "rows": sum(p["numInputRows"] for p in seen),
            "late": sum(o["numRowsDroppedByWatermark"] for x in ops for o in x),
            "state_rows": sum(o["numRowsTotal"] for o in ops[-1]) if ops else 0}


def stream_dedup_within_watermark(spark: SparkSession, landing: str, schema: StructType | str,
                                  sink: str, checkpoint: str, key: str = "id",
                                  ts: str = "ts", delay: str = "1 hour",
                                  files_per_trigger: int | None = None):
    """Bounded-state de-duplication for time-ordered input; drains and stops. Returns
    the ended query; `watermark_figures` tells how many rows came too late."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    s = reader.load(landing).withColumn(ts, F.col(ts).cast("timestamp"))
    out = s.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key]).select(key)
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def land_in_time_order(df: DataFrame, path: str, ms: str = "ms", n_chunks: int = 6,
                       files_per_chunk: int = 2) -> None:
    """Write `df` to a landing folder as `n_chunks` time-ordered appends, so the
    file source (which takes files oldest first) sees time-ordered input.
    Chunk bounds come from one min/max aggregate."""
    df = df.persist()  # one derivation of the input for all chunk writes
    try:
        b = df.agg(F.min(ms).alias("lo"), F.max(ms).alias("hi")).first()
        if b is None or b["lo"] is None:
            return
        lo, hi = int(b["lo"]), int(b["hi"])
        width = max(-(-(hi - lo + 1) // n_chunks), 1)
        for i in range(n_chunks):
            part = df.where((F.col(ms) >= lo + i * width) & (F.col(ms) < lo + (i + 1) * width))
            part.repartition(files_per_chunk).write.mode("append").parquet(path)
    finally:
        df.unpersist()

"""Streaming: batch = stream, resume after stop, replay adds nothing, health state."""

import time

from pyspark.sql import functions as F

from feedspark.operators import load
from feedspark.plans import fixtures as fx
from feedspark.streaming import create_target, stream_idempotent_load
from feedspark.streaming.health import worker_health_stream

SF = "/root/testdata/sf0.001"


def _ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_stream_equals_batch_and_resumes(spark, tmp_dir):
    ev = fx.events(spark, SF)
    d = fx.deliveries(ev).select("id", "strategy", "seq")
    landing, target, ckpt = tmp_dir + "/landing", tmp_dir + "/target", tmp_dir + "/ckpt"
    create_target(spark, target, seed=fx.existing_target(ev))
    # first part lands (newest first is fine: no watermark), stream drains it and stops
    d.where(F.col("strategy") == "feed").repartition(3).write.parquet(landing)
    stream_idempotent_load(spark, landing, d.schema, target, ckpt, files_per_trigger=2)
    first = _ids(spark.read.parquet(target))
    # more files land; a restart with the same checkpoint reads only the new files
    d.where(F.col("strategy") != "feed").repartition(3).write.mode("append").parquet(landing)
    stream_idempotent_load(spark, landing, d.schema, target, ckpt, files_per_trigger=2)
    final = spark.read.parquet(target)
    batch = load.loaded_ids(d, fx.existing_target(ev))
    assert _ids(final) == _ids(batch)
    assert final.count() == final.select("id").distinct().count()
    assert set(first) <= set(_ids(final))
    # full replay with a fresh checkpoint adds nothing
    stream_idempotent_load(spark, landing, d.schema, target, tmp_dir + "/ckpt2")
    assert spark.read.parquet(target).count() == final.count()


def test_health_transitions(spark, tmp_dir):
    landing, sink, ckpt = tmp_dir + "/hb", tmp_dir + "/out", tmp_dir + "/hbckpt"
    schema = "name string, last_progress_ms long, fetched long"
    spark.createDataFrame([("w0", 1, 1), ("w1", 1, 1)], schema).write.parquet(landing)
    stream = spark.readStream.schema(schema).parquet(landing)
    q = (worker_health_stream(stream, stuck_ms=1500, dead_ms=3000).writeStream
         .format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(processingTime="250 milliseconds").start())
    try:
        deadline = time.time() + 12
        n = 2
        while time.time() < deadline:
            spark.createDataFrame([("w0", n, n)], schema).write.mode("append").parquet(landing)
            n += 1
            time.sleep(0.5)
            got = spark.read.parquet(sink).collect() if n > 4 else []
            states = {(r["name"], r["state"]) for r in got}
            if ("w1", "dead") in states:
                break
    finally:
        q.stop()
    states = {(r["name"], r["state"]) for r in spark.read.parquet(sink).collect()}
    assert ("w1", "active") in states and ("w1", "stuck") in states and ("w1", "dead") in states
    assert ("w0", "active") in states and ("w0", "dead") not in states


def test_newest_first_input_loses_nothing(spark, tmp_dir):
    """The feed arrives newest to oldest; the keyed loader has no watermark."""
    ev = fx.events(spark, SF)
    d = fx.deliveries(ev).select("id", "ms")
    landing, target, ckpt = tmp_dir + "/l", tmp_dir + "/t", tmp_dir + "/c"
    create_target(spark, target)
    bounds = d.agg(F.min("ms"), F.max("ms")).first()
    lo, hi = bounds[0], bounds[1] + 1
    step = (hi - lo) // 4 + 1
    for k in range(3, -1, -1):  # newest chunk lands first
        d.where((F.col("ms") >= lo + k * step) & (F.col("ms") < lo + (k + 1) * step)).write.mode(
            "append").parquet(landing)
    stream_idempotent_load(spark, landing, d.schema, target, ckpt, files_per_trigger=1)
    assert _ids(spark.read.parquet(target)) == _ids(d.select("id").distinct())


def test_event_time_health_progress_across_batches(spark, tmp_dir):
    from feedspark.streaming.health import fold_transitions, worker_health_event_time
    from feedspark.streaming.windows import log_batch
    schema = "name string, last_progress_ms long, fetched long, hb_ts timestamp"
    landing, log, ckpt = tmp_dir + "/hb", tmp_dir + "/log", tmp_dir + "/ck"
    s = 1000
    t0 = 1_700_000_000_000  # heartbeats at the epoch would sit on the initial watermark

    def land(rows):
        rows = [(n, t0 + t, f) for n, t, f in rows]
        spark.createDataFrame(rows, "name string, last_progress_ms long, fetched long").withColumn(
            "hb_ts", F.timestamp_millis("last_progress_ms")).coalesce(1).write.mode("append").parquet(landing)
    land([("a", 0, 1), ("b", 0, 1), ("c", 0, 1)])
    land([("a", 40 * s, 2), ("b", 10 * s, 2)])
    land([("a", 95 * s, 3)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    q = (worker_health_event_time(stream).writeStream.outputMode("append").foreachBatch(log_batch(log))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["name"]: (r["state"], r["last_progress_ms"], r["fetched"])
           for r in fold_transitions(spark.read.parquet(log)).collect()}
    # now = 95 s: a is fresh; b silent 85 s (dead); c silent 95 s (dead)
    assert got == {"a": ("active", t0 + 95 * s, 3), "b": ("dead", t0 + 10 * s, 2), "c": ("dead", t0, 1)}


def test_stream_load_fallback_equals_broadcast_path(spark, tmp_dir):
    ev = fx.events(spark, SF)
    d = fx.deliveries(ev).select("id", "strategy")
    d.repartition(4).write.parquet(tmp_dir + "/land")
    out = {}
    for name, bound in (("bcast", 10**9), ("shuffle", 0)):
        target = f"{tmp_dir}/t_{name}"
        create_target(spark, target, seed=fx.existing_target(ev))
        stream_idempotent_load(spark, tmp_dir + "/land", d.schema, target, f"{tmp_dir}/c_{name}",
                               files_per_trigger=2, broadcast_max=bound)
        out[name] = _ids(spark.read.parquet(target))
    assert out["bcast"] == out["shuffle"] == _ids(load.loaded_ids(d, fx.existing_target(ev)))


def test_watermark_dedup_loses_newest_first_input(spark, tmp_dir):
    """The late-data trap: on newest-first input the watermark jumps to the
    newest event and older rows count as late, so T02 drops them (T01 keeps
    them, see test_newest_first_input_loses_nothing). T02 is for
    time-ordered input only."""
    from feedspark.streaming import stream_dedup_within_watermark
    ev = fx.events(spark, SF)
    d = fx.deliveries(ev).select("id", "ms", F.timestamp_millis("ms").alias("ts"))
    landing = tmp_dir + "/l"
    lo, hi = d.agg(F.min("ms"), F.max("ms")).first()
    step = (hi + 1 - lo) // 4 + 1
    for k in range(3, -1, -1):  # newest chunk lands first
        d.where((F.col("ms") >= lo + k * step) & (F.col("ms") < lo + (k + 1) * step)).write.mode(
            "append").parquet(landing)
    stream_dedup_within_watermark(spark, landing, d.schema, tmp_dir + "/sink", tmp_dir + "/c",
                                  files_per_trigger=1)
    kept = spark.read.parquet(tmp_dir + "/sink").count()
    assert kept < d.select("id").distinct().count()


def test_worker_health_in_keyed_state(spark, tmp_dir):
    """Timers, late and equal heartbeats, a worker that returns; the caller's settings stay."""
    from feedspark.streaming.health import fold_transitions, run_worker_health
    landing, log, ckpt = tmp_dir + "/hb", tmp_dir + "/log", tmp_dir + "/ck"
    t0, s = 1_700_000_000_000, 1000
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")

    def land(rows):
        spark.createDataFrame([(n, t0 + t, f) for n, t, f in rows], "name string, last_progress_ms long, fetched long").coalesce(
            1).write.mode("append").parquet(landing)
    land([("a", 0, 1), ("b", 0, 1), ("c", 0, 1), ("c", 0, 7), ("c", 0, 3)] + [("a", -k, 0) for k in range(500)])
    land([("a", 40 * s, 2), ("b", 10 * s, 2)])
    land([("a", 95 * s, 3), ("d", 60 * s, 1), ("e", 34 * s, 1), ("e", 35 * s, 1)])
    land([("a", 95 * s, 9), ("b", 95 * s, 4), ("d", 50 * s, 2)])       # b returns; d has one that is older than its last
    q = run_worker_health(spark, landing, log, ckpt, files_per_trigger=1)
    assert q.exception() is None and len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    rows = spark.read.parquet(log)
    got = {r["name"]: (r["state"], r["last_progress_ms"] - t0, r["fetched"]) for r in fold_transitions(rows).collect()}
    # now = 95 s: c silent 95 s, e 60 s (not more than 60: stuck), d 35 s (its heartbeat at 50 s came late)
    assert got == {"a": ("active", 95 * s, 9), "b": ("active", 95 * s, 4), "c": ("dead", 0, 7),
                   "d": ("stuck", 60 * s, 1), "e": ("stuck", 35 * s, 1)}
    steps = {n: [r["state"] for r in rows.where(f"name = '{n}'").collect()] for n in "bce"}
    assert sorted(steps["c"]) == ["active", "dead", "stuck"] and steps["b"] == ["active"] * 3
    assert sorted(steps["e"]) == ["active", "stuck"]
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")) == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_state_gets_one_row_per_worker_and_task(spark):
    from feedspark.streaming.health import latest_heartbeats
    hb = spark.range(5000).select(F.lit("w").alias("name"), (F.col("id") % 100).alias("last_progress_ms"), F.col("id").alias("fetched"))
    rows = latest_heartbeats(hb.repartition(3)).collect()
    assert len(rows) == 3 and max((r["last_progress_ms"], r["fetched"]) for r in rows) == (99, 4999)

"""Silent-worker detection on a heartbeat stream.

Keyed state per worker with processing-time timeouts: a heartbeat marks
the worker ``active`` and arms a `stuck_ms` timer; when it fires with no
new heartbeat the worker turns ``stuck`` and a second timer arms for the
rest of `dead_ms`; when that fires it is ``dead`` and its state is dropped.
Each transition is one output row, so the sink is an append-only log of
state changes. State is one small row per worker. The batch form of the
same rule is `operators.progress.worker_health`.

`run_worker_health` is the form to use for many heartbeats: event time, one pre-aggregated
row per worker, task and batch into the state, which lies in RocksDB with its timers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..constants import DEAD_AFTER_MS, STUCK_AFTER_MS

OUTPUT_SCHEMA = "name string, state string, last_progress_ms long, fetched long"
STATE_SCHEMA = "last_progress_ms long, fetched long, state string"


def _transitions(stuck_ms: int, dead_ms: int):
    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name = key[0]
        if state.hasTimedOut:
            last, fetched, status = state.get
            if status == "active":
                state.update((last, fetched, "stuck"))
                state.setTimeoutDuration(max(dead_ms - stuck_ms, 1))
                new_status = "stuck"
            else:
                state.remove()
                new_status = "dead"
            yield pd.DataFrame({"name": [name], "state": [new_status],
                                "last_progress_ms": [last], "fetched": [fetched]})
            return
        last, fetched = None, None
        for pdf in pdfs:
            if pdf.empty:
                continue
            i = pdf["last_progress_ms"].idxmax()
            if last is None or pdf.at[i, "last_progress_ms"] >= last:
                last, fetched = int(pdf.at[i, "last_progress_ms"]), int(pdf.at[i, "fetched"])
        if last is None:
            return
        if state.exists and state.get[0] > last:        # a late, older heartbeat
            last, fetched = state.get[0], state.get[1]
        was = state.get[2] if state.exists else None
        state.update((last, fetched, "active"))
        state.setTimeoutDuration(stuck_ms)
        if was != "active":
            yield pd.DataFrame({"name": [name], "state": ["active"],
                                "last_progress_ms": [last], "fetched": [fetched]})
    return run


def worker_health_stream(heartbeats: DataFrame, stuck_ms: int = STUCK_AFTER_MS,
                         dead_ms: int = DEAD_AFTER_MS) -> DataFrame:
    """State transitions per worker from a heartbeat stream
    (name, last_progress_ms, fetched)."""
    return heartbeats.groupBy("name").applyInPandasWithState(
        _transitions(stuck_ms, dead_ms), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.ProcessingTimeTimeout)


STATE_RANK = {"active": 0, "stuck": 1, "dead": 2}


def _event_time_transitions(stuck_ms: int, dead_ms: int):
    """Same state machine on event time: the timer is `last + stuck_ms`
    (then `last + dead_ms`) and fires when the watermark passes it. When it
    fires after the watermark already passed the dead mark, both steps are
    emitted at once (no later batch may come to fire the second timer)."""
    def row(name, status, last, fetched):
        return pd.DataFrame({"name": [name], "state": [status], "last_progress_ms": [last],
                             "fetched": [fetched]})

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name = key[0]
        if state.hasTimedOut:
            last, fetched, status = state.get
            wm = state.getCurrentWatermarkMs()
            if status == "active":
                yield row(name, "stuck", last, fetched)
                if wm > last + dead_ms:
                    state.remove()
                    yield row(name, "dead", last, fetched)
                else:
                    state.update((last, fetched, "stuck"))
                    state.setTimeoutTimestamp(last + dead_ms)
            else:
                state.remove()
                yield row(name, "dead", last, fetched)
            return
        best = None
        for pdf in pdfs:
            if pdf.empty:
                continue
            top = pdf.sort_values(["last_progress_ms", "fetched"]).iloc[-1]
            cand = (int(top["last_progress_ms"]), int(top["fetched"]))
            best = cand if best is None or cand > best else best
        if best is None:
            return
        prev = state.get if state.exists else None
        if prev is not None and (prev[0], prev[1]) > best:
            best = (prev[0], prev[1])
        state.update((best[0], best[1], "active"))
        state.setTimeoutTimestamp(best[0] + stuck_ms)
        # One row per worker and batch when its state or progress changes, so
        # the folded log always holds the newest progress.
        if prev is None or prev[2] != "active" or (prev[0], prev[1]) != best:
            yield row(name, "active", best[0], best[1])
    return run


def worker_health_event_time(heartbeats: DataFrame, ts: str = "hb_ts",
                             stuck_ms: int = STUCK_AFTER_MS, dead_ms: int = DEAD_AFTER_MS,
                             delay: str = "0 seconds") -> DataFrame:
    """T06 on event time: state transitions per worker from a time-ordered
    heartbeat stream (name, last_progress_ms, fetched, `ts` = the heartbeat
    time). `now` is the watermark, so a replay gives the same transitions."""
    return (heartbeats.withWatermark(ts, delay).groupBy("name").applyInPandasWithState(
        _event_time_transitions(stuck_ms, dead_ms), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout))


def fold_transitions(log: DataFrame) -> DataFrame:
    """Latest state per worker from a transition log with `batch_id`: the
    newest batch wins, and within a batch the later state (dead > stuck > active)."""
    from pyspark.sql import functions as F

    rank = F.element_at(F.create_map(*[x for k, v in STATE_RANK.items()
                                       for x in (F.lit(k), F.lit(v))]), F.col("state"))
    packed = F.struct("state", "last_progress_ms", "fetched")
    return (log.groupBy("name").agg(F.max_by(packed, F.struct("batch_id", rank)).alias("s"))
            .select("name", "s.state", "s.last_progress_ms", "s.fetched"))


def start_with_state_partitions(writer, spark, state_partitions: int | None):
    """Start a stateful streaming query with `state_partitions` state-store
    partitions. Spark takes the count from ``spark.sql.shuffle.partitions`` at
    the first start and keeps it in the checkpoint; a stream keyed by a few
    workers wants a few partitions, not the batch jobs' thousands (each
    partition runs a task, and here a Python worker, every micro-batch)."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


# ------------------------------------------- keyed state with timers (RocksDB)

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def latest_heartbeats(heartbeats: DataFrame) -> DataFrame:
    """(name, last_progress_ms, fetched) with one row per worker and task: the newest
    heartbeat, of equal times the one with the largest `fetched`. Stateless, so it also
    runs on a stream; what reaches a worker's state no longer grows with its heartbeats."""
    def run(batches):
        last: dict = {}
        for b in batches:
            pdf = b.sort_values(["last_progress_ms", "fetched"]).drop_duplicates("name", keep="last")
            for name, ms, n in zip(pdf["name"].tolist(), pdf["last_progress_ms"].tolist(), pdf["fetched"].tolist()):
                if name not in last or (ms, n) > last[name]:
                    last[name] = (ms, n)
        if last:
            yield pd.DataFrame([(k, *v) for k, v in last.items()], columns=["name", "last_progress_ms", "fetched"])

    return heartbeats.select("name", "last_progress_ms", "fetched").mapInPandas(
        run, "name string, last_progress_ms long, fetched long")


def _health_processor(stuck_ms: int, dead_ms: int):
    from pyspark.sql.streaming import StatefulProcessor

    class Health(StatefulProcessor):
        """One value (newest heartbeat, state) and at most one timer a worker. A worker is
        stuck or dead when the watermark is more than `stuck_ms` or `dead_ms` past it."""

        def init(self, handle) -> None:
            self.handle = handle
            self.value = handle.getValueState("health", STATE_SCHEMA)

        def _row(self, name, status, last, fetched):
            return pd.DataFrame({"name": [name], "state": [status], "last_progress_ms": [last], "fetched": [fetched]})

        def _settle(self, name, last, fetched, was, now):
            """Rows for the steps from `was` to the state at `now`; the value and the next timer."""
            if now > last + dead_ms:
                self.value.clear()
                steps = ["stuck", "dead"] if was == "active" else ["dead"]
            elif now > last + stuck_ms:
                self.value.update((last, fetched, "stuck"))
                self.handle.registerTimer(last + dead_ms + 1)
                steps = ["stuck"] if was == "active" else []
            else:
                self.value.update((last, fetched, was))
                self.handle.registerTimer(last + (stuck_ms if was == "active" else dead_ms) + 1)
                steps = []
            for s in steps:
                yield self._row(name, s, last, fetched)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            best = None
            for pdf in rows:
                for got in zip(pdf["last_progress_ms"].tolist(), pdf["fetched"].tolist()):
                    best = got if best is None or got > best else best
            if best is None:
                return
            prev = self.value.get() if self.value.exists() else None
            if prev is not None and (prev[0], prev[1]) >= best:     # late or repeated: nothing is newer
                return
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            yield self._row(key[0], "active", *best)
            yield from self._settle(key[0], *best, "active", timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            if self.value.exists():
                last, fetched, was = self.value.get()
                yield from self._settle(key[0], last, fetched, was, timerValues.getCurrentWatermarkInMs())

        def close(self) -> None:
            pass

    return Health()


def run_worker_health(spark, landing: str, log_path: str, checkpoint: str, files_per_trigger: int | None = None,
                      stuck_ms: int = STUCK_AFTER_MS, dead_ms: int = DEAD_AFTER_MS, delay: str = "0 seconds",
                      state_partitions: int = 2):
    """Drain the heartbeats (name, last_progress_ms, fetched) that have landed and append
    each worker's transitions, with `batch_id`, to a log; `now` is the watermark, so a
    replay gives the same transitions. Returns the ended query.

    The state store and the number of state partitions are set in a session of the
    query's own; the caller's settings are not touched."""
    from pyspark.sql import functions as F

    from .windows import log_batch

    own = spark.newSession()
    for k, v in {**STATE_CONF, "spark.sql.shuffle.partitions": str(state_partitions),
                 "spark.sql.session.timeZone": "UTC"}.items():
        own.conf.set(k, v)
    reader = own.readStream.schema("name string, last_progress_ms long, fetched long")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    beats = latest_heartbeats(reader.parquet(landing)).withColumn("hb_ts", F.timestamp_millis("last_progress_ms"))
    out = beats.withWatermark("hb_ts", delay).groupBy("name").transformWithStateInPandas(
        statefulProcessor=_health_processor(stuck_ms, dead_ms), outputStructType=OUTPUT_SCHEMA,
        outputMode="append", timeMode="eventTime")
    q = (out.writeStream.outputMode("append").foreachBatch(log_batch(log_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q

"""Operators on the edge tables of FIXTURES.md §3 and the laws of SURVEY §5."""

from pyspark.sql import functions as F

from feedspark.functions.timefmt import ts_format_class
from feedspark.functions.json import strict_parse
from feedspark.operators import load, progress, reconcile, scans
from feedspark.operators.rowindex import with_row_index
from feedspark.plans import fixtures as fx

SF = "/root/testdata/sf0.001"

CKPT = [(1, "feed", "running", "c1", 10), (2, "feed", "running", "c2", 20),
        (3, "feed", "completed", None, 30), (4, "feed", "running", "c9", 5),
        (5, "type", "running", "t1", 7), (6, "feed", "completed", None, 9),
        (7, "feed", "completed", None, 9)]
CKPT_SCHEMA = "seq long, strategy string, status string, cursor string, events_count long"


def test_checkpoint_fold(spark):
    log = spark.createDataFrame(CKPT, CKPT_SCHEMA)
    intent = sorted(r["seq"] for r in progress.checkpoint_state(log).collect())
    written = sorted(r["seq"] for r in progress.checkpoint_state(log, as_written=True).collect())
    assert intent == [3, 5, 6, 7]
    assert written == [3, 4, 5, 6, 7]
    latest = progress.latest_open_checkpoint(progress.checkpoint_state(log)).collect()
    assert [r["seq"] for r in latest] == [5]


def test_ts_format_classes(spark):
    vals = ['"2026-01-01T00:00:00Z"', "1767225600", "1767225600000", "1000000000", "500000000000",
            "null", '"yesterday"', "true"]
    df = spark.createDataFrame([(v,) for v in vals], "j string")
    got = [r[0] for r in df.select(ts_format_class(strict_parse("j"))).collect()]
    assert got == ["iso", "unix_s", "unix_ms", "unknown", "unknown", None, "unknown", "unknown"]


def test_worker_health_ages(spark):
    now = 1_000_000
    ages = {"a": 0, "b": 30_000, "c": 31_000, "d": 60_000, "e": 61_000}
    hb = spark.createDataFrame([(k, now - a, 1) for k, a in ages.items()],
                               "name string, last_progress_ms long, fetched long")
    got = {r["name"]: r["state"] for r in progress.worker_health(hb, now).collect()}
    assert got == {"a": "active", "b": "active", "c": "stuck", "d": "stuck", "e": "dead"}


def test_throughput_trend_labels(spark):
    day = 86_400_000
    rates = [0, 100, 105, 111, 94]
    s = spark.createDataFrame([(i * day, r * 86400) for i, r in enumerate(rates)], "ts_ms long, events long")
    got = [r["action"] for r in progress.throughput_trend(s, day).orderBy("bucket").collect()]
    assert got == [None, None, "hold", "ramp_up", "back_off"]


def test_rate_and_best_strategy(spark):
    s = spark.createDataFrame([(1000, 10, "a"), (2000, 10, "b"), (3000, 30, "b"), (500, 99, "a")],
                              "ts_ms long, events long, strategy string")
    rates = {r["strategy"]: r["rate"] for r in progress.rate_in_window(s, 4000, 3000).collect()}
    assert rates == {"a": 10 / 3.0, "b": 40 / 2.0}
    late = {r["strategy"]: (r["events_in_window"], r["rate"])
            for r in progress.rate_in_window(s, 4000, 1500).collect()}
    assert late == {"a": (0, 0.0), "b": (30, 30 / 1.0)}  # "a" has no sample in the window
    best = progress.best_strategy(s, 4000, 3000).first()
    assert best["best_strategy"] == "b"
    none = progress.best_strategy(s, 100_000, 10).first()
    assert none["best_strategy"] is None


def test_row_index_matches_single_window(spark):
    ev = fx.events(spark, SF)
    idx = with_row_index(ev, scans.feed_order(), num_partitions=7)
    got = [r["event_id"] for r in idx.orderBy("idx").collect()]
    want = [r["event_id"] for r in ev.orderBy(*scans.feed_order()).collect()]
    assert got == want
    assert [r["idx"] for r in idx.orderBy("idx").collect()] == list(range(len(want)))


def test_slices_partition_input_exactly_once(spark):
    ev = fx.events(spark, SF)
    sliced = scans.with_time_slice(ev, 6)
    assert sliced.where(F.col("slice").isNull()).count() == 0
    assert sliced.count() == ev.count()
    assert sorted(r["slice"] for r in sliced.select("slice").distinct().collect()) == list(range(6))


def test_pages_concatenate_to_sorted_input(spark):
    ev = fx.events(spark, SF)
    paged = scans.with_pages(ev, 97, scans.feed_order())
    summary = scans.page_summary(paged, 97, "event_id").orderBy("page_no").collect()
    assert sum(r["n_rows"] for r in summary) == ev.count()
    assert all(r["n_rows"] == 97 for r in summary[:-1])
    assert [r["has_more"] for r in summary] == [True] * (len(summary) - 1) + [False]


def test_load_laws(spark):
    ev = fx.events(spark, SF)
    offered = fx.deliveries(ev).select("id")
    target = fx.existing_target(ev)
    once = load.loaded_ids(offered, target)
    twice = load.loaded_ids(offered, once)
    assert sorted(r[0] for r in once.collect()) == sorted(r[0] for r in twice.collect())
    c = load.load_counts(offered, target).first()
    assert c["inserted"] + c["rejected"] == c["offered"]
    asked = ev.select((F.col("event_id") * 3).cast("string").alias("id"))
    found = load.lookup_found(ev.select("id"), asked).count()
    missing = load.lookup_missing(ev, asked).count()
    assert found + missing == asked.distinct().count()


def test_load_order_independent(spark):
    ev = fx.events(spark, SF)
    a, b = fx.two_sources(ev)
    t = fx.existing_target(ev)
    ab = load.loaded_ids(load.union_sources(a, b), t)
    ba = load.loaded_ids(load.union_sources(b, a), t)
    assert sorted(r[0] for r in ab.collect()) == sorted(r[0] for r in ba.collect())


def test_first_wins(spark):
    d = spark.createDataFrame([("x", 2, "late"), ("x", 1, "early"), ("y", 5, "only")],
                              "id string, seq long, payload string")
    got = {r["id"]: r["payload"] for r in load.first_wins(d, "seq", payload=["payload"]).collect()}
    assert got == {"x": "early", "y": "only"}


def test_shortfall_decisions(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("id"))
    assert reconcile.shortfall(df, 5).first()["decision"] == "complete"
    assert reconcile.shortfall(df, 6, passes_done=1).first()["decision"] == "retry"
    assert reconcile.shortfall(df, 6, passes_done=3).first()["decision"] == "give_up"


def test_gated_export(spark, tmp_dir):
    from feedspark.operators import sinks
    ids = spark.range(10).select(F.col("id").cast("string").alias("id"))
    refused = sinks.gated_export(ids, tmp_dir + "/a", required=11)
    assert refused["status"] == "refused_count" and refused["exported"] == 0
    ok = sinks.gated_export(ids.unionByName(ids), tmp_dir + "/b", required=10, batch=3)
    assert ok == {"exact": 10, "exported": 10, "required": 10, "status": "exported"}
    assert sorted(r[0] for r in spark.read.text(tmp_dir + "/b").collect()) == sorted(str(i) for i in range(10))


def test_scan_by_type_prunes_folders(spark, tmp_dir):
    ev = fx.events(spark, SF).select("event_id", "event_type")
    scans.store_by_type(ev, tmp_dir + "/by_type")
    stored = spark.read.parquet(tmp_dir + "/by_type")
    picked = scans.scan_by_type(stored, ["click", "view"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_type" in plan and "IN (click,view)" in plan
    assert "PushedFilters: []" in plan  # folders pruned, no row filter left
    want = ev.where(F.col("event_type").isin("click", "view")).count()
    assert picked.count() == want


def test_gap_ranges_merge_runs(spark):
    h = 3_600_000
    expected = spark.createDataFrame([(b * h,) for b in range(10) for _ in range(2)], "ms long")
    loaded = spark.createDataFrame([(b * h,) for b in (0, 1, 1, 4, 4, 5, 6, 6, 9, 9)], "ms long")
    gaps = reconcile.time_gaps(loaded, expected, h)
    got = sorted(tuple(r) for r in reconcile.gap_ranges(gaps, h).select(
        "since_ms", "until_ms", "buckets", "missing").collect())
    # bucket 0 short by 1, 2-3 empty, 4 full, 5 short by 1, 6 full, 7-8 empty
    assert got == [(0, h, 1, 1), (2 * h, 4 * h, 2, 4), (5 * h, 6 * h, 1, 1), (7 * h, 9 * h, 2, 4)]


def _plain_ranges(rows, slices):
    out = []
    for key, ms in rows:
        hits = [k for k, lo, hi in slices if ms is not None and lo <= ms < hi]
        out += [(key, k) for k in hits] or [(key, None)]
    return sorted(out, key=str)


def test_interval_join_equals_a_double_loop(spark):
    """Uneven, overlapping, empty and far slices; a hot instant; rows without a time."""
    rows = [(i, 1000) for i in range(400)] + [(1000 + i, i * i % 7919) for i in range(500)] + [(5000, None), (5001, -50), (5002, 10 ** 15)]
    slices = [(0, 0, 10), (1, 5, 2000), (2, 1000, 1001), (3, 999, 1000), (4, 3000, 3000), (5, -100, 10 ** 6), (6, 7000, 6000)]
    slices += [(10 + i, i * 11, i * 11 + 23) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, ms long").repartition(4)
    sl = spark.createDataFrame(slices, "slice long, since_ms long, until_ms long")
    for buckets, parts in ((64, 64), (4, 8), (1, 1)):
        got = scans.range_join_slices(df, sl, buckets=buckets, hot_parts=parts)
        assert sorted(((r["k"], r["slice"]) for r in got.select("k", "slice").collect()), key=str) == _plain_ranges(rows, slices)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = scans.range_join_slices(df.where("k < 0"), sl)
    assert none.collect() == []


def test_interval_join_deals_out_a_hot_instant(spark):
    """Half of all rows have one time; on the join no task gets all of them."""
    hot = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("ms")).repartition(4)
    sl = spark.range(50).select(F.col("id").alias("slice"), (F.col("id") * 400).alias("since_ms"), (F.col("id") * 400 + 400).alias("until_ms"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = scans.range_join_slices(hot, sl)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 20000 and max(sizes) < 7000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_page_after_skips_newer_row_groups(spark, tmp_dir):
    """What the cursor says of `ts` reaches the scan, and a stored feed is sought, not read."""
    df = spark.range(40000).select(F.col("id").alias("event_id"), (F.col("id") * 250).alias("ms"),
                                   F.timestamp_millis(F.col("id") * 250).alias("ts"))
    scans.store_keyset(df, tmp_dir + "/feed", num_files=20)
    stored = spark.read.parquet(tmp_dir + "/feed/data")
    at = 12345
    page = scans.page_after(stored, at * 250, at, 100)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan[plan.index("PushedFilters"):]
    want = [(i, i * 250) for i in range(at - 1, at - 101, -1)]
    assert [(r["event_id"], r["ms"]) for r in page.collect()] == want
    sought = scans.page_after_stored(spark, tmp_dir + "/feed", at * 250, at, 100)
    assert [(r["event_id"], r["ms"]) for r in sought.collect()] == want
    assert len(scans.page_files(spark, tmp_dir + "/feed", at * 250, at, 100)) <= 2
    assert len(scans.page_files(spark, tmp_dir + "/feed", at * 250, at, 5000)) <= 5
    assert len(scans.page_files(spark, tmp_dir + "/feed", 10 ** 12, 0, 10 ** 9)) == len(stored.inputFiles())
    assert scans.page_after_stored(spark, tmp_dir + "/feed", 0, 0, 10).collect() == []
    short = scans.page_after_stored(spark, tmp_dir + "/feed", 750, 3, 10).collect()
    assert [r["event_id"] for r in short] == [2, 1, 0]


def test_no_ordered_window_in_one_task(spark):
    """Gap ranges and the trend rank nothing in a single partition."""
    h = 3_600_000
    gaps = spark.range(1000).select(F.col("id").alias("bucket"), F.lit(1).alias("missing")).where("bucket % 10 < 7")
    ranges = reconcile.gap_ranges(gaps, h)
    assert ranges.count() == 100 and ranges.agg(F.sum("buckets")).first()[0] == 700
    samples = spark.range(200).select((F.col("id") * h * 3).alias("ts_ms"), F.lit(5).alias("events"))
    trend = progress.throughput_trend(samples, h)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    rows = trend.orderBy("bucket").collect()
    assert len(rows) == 598 and [r["events"] for r in rows[:4]] == [5, 0, 0, 5]
    assert [r["action"] for r in rows[:4]] == [None, "back_off", None, None]
    assert progress.throughput_trend(samples.where("false"), h).collect() == []


def test_row_index_balanced_when_one_timestamp_holds_all_rows(spark):
    """A hot sort key: every row has the same ts. The unique tie-breaker lets
    range partitioning split it, so no partition takes the whole set."""
    df = spark.range(20000).select(F.col("id").alias("event_id"),
                                   F.lit(1_700_000_000_000).alias("ts"))
    idx = with_row_index(df, [F.col("ts").desc(), F.col("event_id").desc()], num_partitions=8)
    sizes = [r["n"] for r in idx.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 2 * 20000 / 8
    got = idx.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()
    assert tuple(got) == (0, 19999, 20000)
    first = idx.where(F.col("idx") == 0).first()["event_id"]
    assert first == 19999  # newest first, then the key descending


def test_hot_id_collapses_before_the_shuffle(spark):
    """One id is a third of all offered rows: the dedup aggregates map-side
    (a partial aggregate below the exchange), so the hot id crosses the
    shuffle as one row per task."""
    hot = spark.range(10000).select(F.lit("hot").alias("id"))
    rest = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    offered = hot.unionByName(rest)
    target = spark.range(0, 20000, 2).select(F.col("id").cast("string").alias("id"))
    new = load.new_ids(offered, target)
    plan = new._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(id"):]
    assert "HashAggregate(keys=[id" in below  # partial aggregate before the shuffle
    assert new.count() == 10001 and new.where(F.col("id") == "hot").count() == 1


def test_segmented_running_sums_one_hot_worker(spark):
    """Every batch belongs to one worker: the segmented form still windows by
    (worker, block), and equals the plain per-worker running sum."""
    from pyspark.sql import Window
    from feedspark.operators.running import running_sums
    b = spark.range(5000).select(F.lit("w0").alias("worker"), F.col("id").alias("batch"),
                                 (F.col("id") % 7 + 1).alias("events"))
    seg = running_sums(b, ["worker"], "batch", {"fetched": "events"}, block_rows=300)
    plan = seg._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan.split("Window [")[1].split("]")[1]  # window partitioned by the block too
    w = Window.partitionBy("worker").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    plain = b.withColumn("fetched", F.sum("events").over(w))
    key = ["worker", "batch", "fetched"]
    assert sorted(tuple(r) for r in seg.select(*key).collect()) == sorted(
        tuple(r) for r in plain.select(*key).collect())


def test_sketches_merge_and_stay_within_their_error(spark):
    """Merged days equal one sketch of all; estimates within three standard errors."""
    from feedspark.operators import sketches as S
    n = 60_000
    d = (spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 30 * S.DAY_MS).alias("ms"), F.lit("a").alias("strategy"))
         .unionByName(spark.range(n // 2, n * 2).select(F.col("id").cast("string").alias("id"), F.lit(0).cast("long").alias("ms"),
                                                         F.lit("b").alias("strategy"))))
    d = d.unionByName(d.where("id = '7'")).unionByName(spark.createDataFrame([(None, 1, "a")], "id string, ms long, strategy string"))
    daily = S.daily_sketches(d)
    assert daily.count() == 31
    got = {r["source"]: (r["offered"], r["distinct_est"]) for r in S.distinct_estimates(daily).collect()}
    assert got["a"][0] == n + 1 and got["b"][0] == n * 3 // 2
    for k, exact in (("a", n), ("b", n * 3 // 2)):
        assert abs(got[k][1] - exact) <= exact * S.HLL_ERROR
    whole = S.distinct_estimates(S.daily_sketches(d.withColumn("ms", F.lit(0).cast("long")))).collect()
    assert all(abs(r["distinct_est"] - got[r["source"]][1]) <= got[r["source"]][1] * S.HLL_ERROR for r in whole)
    both = S.overlap_estimates(daily).first()
    assert (both["source"], both["other"]) == ("a", "b") and abs(both["both_est"] - n // 2) <= n * 2 * S.THETA_ERROR
    assert S.distinct_estimates(S.daily_sketches(d.where("false"))).collect() == []


def test_field_profile_holds_a_row_a_group(spark):
    """Counted in a hash table; the preview is the first record's, whatever the order of the rows."""
    from pyspark.sql import DataFrame

    from feedspark.functions.json import with_strict_parse
    from feedspark.operators import profile
    rows = [(5, '{"a":"five","b":[1,2,3]}'), (2, '{"a":"two","c":null}'), (None, '{"a":"none","d":{"x":1}}'),
            (3, '{"a":3,"b":[7]}'), (2, '{"a":"two","b":[1,2]}'), (9, "oops")]
    records = with_strict_parse(spark.createDataFrame(rows, "event_id long, json string"), "json")
    plans, cut = [], profile.cut_lineage

    def keep(df: DataFrame) -> DataFrame:
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    profile.cut_lineage = keep
    try:
        got = profile.field_type_profile(records).collect()
    finally:
        profile.cut_lineage = cut
    assert sorted((r["field"], r["kind"], r["n_rows"], r["max_array_len"], r["preview"]) for r in got) == [
        ("a", "number", 1, None, "3"), ("a", "string", 4, None, "two"), ("b", "array", 3, 3, "[1,2]"),
        ("c", "null", 1, None, "null"), ("d", "object", 1, None, None)]
    assert plans and all("SortAggregate" not in p for p in plans)

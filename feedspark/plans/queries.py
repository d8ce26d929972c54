"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or text Spark derives from them) in
full; the only limits are those that are the feature (a page, a top-k, a
stop-at-target). Column names match `plans.oracle.ORACLE_SQL`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.ids import invalid_reason, is_uuid, is_valid_id, with_id_pick
from ..functions.json import with_strict_parse
from ..functions.num import idiv, keep_rows
from ..operators import extract, load, profile, progress, reconcile, scans, sinks, sketches
from ..session import hadoop_fs, scratch_path
from ..sources import feed, split
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# --- parameters of the registered queries (chosen once, documented) -------
TYPES_SCANNED = ("click", "purchase")        # S12 category scan
FILTER_SINCE_MS = 1_704_844_800_000          # P05: 2024-01-10T00:00:00Z
FILTER_UNTIL_MS = 1_705_708_800_000          # P05: 2024-01-20T00:00:00Z
CURSOR_MS = 1_705_320_000_000                # S15: 2024-01-15T12:00:00Z
CURSOR_KEY = 0
N_RANGES = 6                                 # S13
N_CHAINS = 4                                 # S16
EXPORT_CHUNK = 5000                          # S10 / U05 (the server page cap)
MILESTONE_EVERY = 1000                       # W01 / W02
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
TREND_BUCKET_MS = 1_800_000                  # W03: half-hour buckets, some of them idle
HREF_PATTERN = r'<a[^>]+href="([^"]+)"'      # P12 with a pattern that the test pages hold
HEALTH_STATE_PARTITIONS = 2                  # T06: state partitions for a stream keyed by worker


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _records(spark, sf_dir) -> DataFrame:
    """Raw JSON events parsed to Variant: (event_id, event_type, json, v)."""
    raw = fx.raw_events(fx.events(spark, sf_dir))
    return with_strict_parse(raw, "json", "v")


def _slice_load(spark, sf_dir):
    """Minimum slice inputs: events, two sources, existing target, loaded rows."""
    ev = fx.events(spark, sf_dir)
    a, b = fx.two_sources(ev)
    offered = load.union_sources(a, b)
    target = ev.where(F.col("event_id") % 10 == 3).select("id", "event_id", "event_type", "ms")
    new = load.new_rows(offered.select("id", "event_id", "event_type", "ms"), target,
                        same_per_key=True)
    loaded = target.unionByName(new)
    return ev, offered, target, loaded


# ------------------------------------------------------------ 7.1 minimum

@query("completeness_by_type")
def completeness_by_type(spark, sf_dir):
    ev, _, _, loaded = _slice_load(spark, sf_dir)
    return reconcile.completeness_by_category(loaded, ev, "event_type", name="event_type")


# --------------------------------------------------------------- loading

@query("idempotent_load")
def idempotent_load(spark, sf_dir):
    _, offered, target, _ = _slice_load(spark, sf_dir)
    return load.new_ids(offered, target)


@query("idempotent_load_counts")
def idempotent_load_counts(spark, sf_dir):
    _, offered, target, _ = _slice_load(spark, sf_dir)
    return load.load_counts(offered, target)


@query("combined_sources")
def combined_sources(spark, sf_dir):
    _, offered, _, _ = _slice_load(spark, sf_dir)
    return offered.groupBy("id").agg(F.count(F.lit(1)).alias("deliveries"))


@query("first_wins_load")
def first_wins_load(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return load.first_wins_new(fx.deliveries(ev), fx.existing_target(ev), "seq",
                               payload=["strategy", "payload"])


@query("duplicate_rate")
def duplicate_rate(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return load.duplicate_rate(fx.deliveries(ev), fx.existing_target(ev), "seq")


@query("known_duplicates")
def known_duplicates(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return load.known_duplicates(fx.deliveries(ev), fx.existing_target(ev), by=["strategy"])


@query("offered_vs_distinct")
def offered_vs_distinct(spark, sf_dir):
    return reconcile.offered_vs_distinct(fx.deliveries(fx.events(spark, sf_dir)))


@query("source_overlap")
def source_overlap(spark, sf_dir):
    return reconcile.source_overlap(fx.deliveries(fx.events(spark, sf_dir)), fx.STRATEGIES)


@query("capped_load")
def capped_load(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return load.capped_ids(fx.deliveries(ev), idiv(fx.n_rows(ev), 2), [F.col("seq")])


@query("bulk_lookup_found")
def bulk_lookup_found(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    asked = ev.select((F.col("event_id") * 3).cast("string").alias("id"))
    return load.lookup_found(ev.select("id", "event_id", "event_type"), asked)


@query("bulk_lookup_missing")
def bulk_lookup_missing(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    asked = ev.select((F.col("event_id") * 3).cast("string").alias("id"))
    return load.lookup_missing(ev, asked)


@query("exact_count")
def exact_count(spark, sf_dir):
    _, _, _, loaded = _slice_load(spark, sf_dir)
    return reconcile.exact_count(loaded)


@query("shortfall")
def shortfall(spark, sf_dir):
    ev, _, _, loaded = _slice_load(spark, sf_dir)
    return reconcile.shortfall(loaded, fx.n_rows(ev), passes_done=1)


@query("progress_summary")
def progress_summary(spark, sf_dir):
    ev, offered, _, loaded = _slice_load(spark, sf_dir)
    start = ev.agg(F.min("ms")).scalar()
    now = ev.agg(F.max("ms")).scalar()
    return progress.progress_summary(fx.n_rows(ev), loaded, offered, start, now)


@query("time_gaps")
def time_gaps(spark, sf_dir):
    ev, _, _, loaded = _slice_load(spark, sf_dir)
    return reconcile.time_gaps(loaded, ev, HOUR_MS)


@query("gap_ranges")
def gap_ranges(spark, sf_dir):
    ev, _, _, loaded = _slice_load(spark, sf_dir)
    return reconcile.gap_ranges(reconcile.time_gaps(loaded, ev, HOUR_MS), HOUR_MS)


@query("type_distribution")
def type_distribution(spark, sf_dir):
    return reconcile.distribution(fx.events(spark, sf_dir), "event_type", name="event_type")


@query("entity_counts")
def entity_counts(spark, sf_dir):
    return profile.entity_counts(fx.events(spark, sf_dir))


# ------------------------------------------------------------------- ids

@query("extract_id")
def extract_id(spark, sf_dir):
    r = with_id_pick(_records(spark, sf_dir), "v", field_col="field")
    return r.select("event_id", "id", "field")


@query("valid_ids")
def valid_ids(spark, sf_dir):
    r = with_id_pick(_records(spark, sf_dir), "v")
    return keep_rows(r.select("event_id", "id"), is_valid_id("id"))


@query("quarantine_ids")
def quarantine_ids(spark, sf_dir):
    r = with_id_pick(_records(spark, sf_dir), "v")
    reason = invalid_reason("id", "id_kind", parsed_ok=F.col("v").isNotNull())
    return keep_rows(r.select("event_id", reason.alias("reason")), F.col("reason").isNotNull())


@query("uuid_check")
def uuid_check(spark, sf_dir):
    s = fx.format_strings(fx.events(spark, sf_dir))
    return s.groupBy(is_uuid("uuid").alias("is_valid")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("string_format_profile")
def string_format_profile(spark, sf_dir):
    s = fx.format_strings(fx.events(spark, sf_dir))
    return profile.string_format_profile(s, ["event_id_text", "cursor", "uuid", "name"])


# ------------------------------------------------------------- profiling

@query("type_filter_check")
def type_filter_check(spark, sf_dir):
    return profile.type_filter_check(_records(spark, sf_dir), "event_type")


@query("ts_format_profile")
def ts_format_profile(spark, sf_dir):
    return profile.ts_format_profile(_records(spark, sf_dir))


@query("ts_normalised")
def ts_normalised(spark, sf_dir):
    return profile.ts_normalised(_records(spark, sf_dir), keep=["event_id"])


@query("field_type_profile")
def field_type_profile(spark, sf_dir):
    return profile.field_type_profile(_records(spark, sf_dir))


@query("schema_variants")
def schema_variants(spark, sf_dir):
    return profile.schema_variants(_records(spark, sf_dir))


@query("candidate_field_presence")
def candidate_field_presence(spark, sf_dir):
    return profile.candidate_field_presence(_records(spark, sf_dir))


@query("probe_field_presence")
def probe_field_presence(spark, sf_dir):
    """A07 with the wider candidate lists of a first look at an unknown feed."""
    return profile.candidate_field_presence(_records(spark, sf_dir), {"id": K.ID_FIELDS_PROBE, "time": K.TIME_FIELDS_PROBE})


# ----------------------------------------------------------------- scans

@query("time_range")
def time_range(spark, sf_dir):
    return scans.time_bounds(fx.events(spark, sf_dir))


@query("time_range_filter")
def time_range_filter(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return scans.time_filter(ev, FILTER_SINCE_MS, FILTER_UNTIL_MS).select("event_id", "ms")


@query("scan_time_slices")
def scan_time_slices(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    sliced = scans.with_time_slice(ev, K.TIME_SLICES)
    counts = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n_rows"))
    return scans.slice_table(ev, K.TIME_SLICES).join(counts, "slice", "left").select(
        "slice", "since_ms", "until_ms", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("range_join_slices")
def range_join_slices(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    joined = scans.range_join_slices(ev, scans.slice_table(ev, K.TIME_SLICES))
    return joined.groupBy("slice").agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_by_type")
def scan_by_type(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return scans.scan_by_type(ev, list(TYPES_SCANNED)).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query("scan_offset_ranges")
def scan_offset_ranges(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    # project before indexing: the row index materialises its input
    r = scans.with_offset_range(ev.select("event_id", "ts"), N_RANGES, scans.feed_order())
    return r.groupBy("range_no").agg(
        F.min("idx").alias("start_offset"), (F.max("idx") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by("event_id", "idx").alias("first_event_id"),
        F.max_by("event_id", "idx").alias("last_event_id"))


@query("keyset_pages")
def keyset_pages(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    paged = scans.with_pages(ev.select("event_id", "ts", "ms"), fx.PAGE_SIZE, scans.feed_order())
    return scans.page_summary(paged, fx.PAGE_SIZE, "event_id",
                              cursor=fx.cursor_text(F.col("ms"), F.col("event_id")))


@query("keyset_page_after")
def keyset_page_after(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return scans.page_after(ev, CURSOR_MS, CURSOR_KEY, fx.PAGE_SIZE).select("event_id", "ms")


@query("keyset_seek_stored")
def keyset_seek_stored(spark, sf_dir):
    """S15 as a seek into a feed stored in keyset order."""
    path = scratch_path(spark, "keyset")
    scans.store_keyset(fx.events(spark, sf_dir).select("event_id", "ms", "ts"), path, num_files=32)
    return scans.page_after_stored(spark, path, CURSOR_MS, CURSOR_KEY, fx.PAGE_SIZE).select("event_id", "ms")


@query("range_join_uneven")
def range_join_uneven(spark, sf_dir):
    """J06 on many uneven, overlapping slices (one for each load batch) and rows a third of
    which have one time."""
    ev = fx.events(spark, sf_dir)
    b = F.col("slice")
    iv = ev.groupBy(idiv("event_id", 20).alias("slice")).agg(F.min("ms").alias("since_ms")).select(
        "slice", "since_ms", (F.col("since_ms") + 1000 * (1 + b % 97) * F.when(b % 41 == 0, 901).otherwise(1)).alias("until_ms"))
    hot = ev.select("event_id", F.when(F.col("event_id") % 3 == 0, ev.agg(F.min("ms")).scalar()).otherwise(F.col("ms")).alias("ms"))
    return scans.range_join_slices(hot, iv).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").cast("long").alias("key_sum"))


@query("staggered_chain_overlap")
def staggered_chain_overlap(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    paged = scans.with_pages(ev.select("event_id", "ts"), fx.PAGE_SIZE, scans.feed_order())
    d = scans.staggered_chains(paged, N_CHAINS)
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.count_distinct("page_no").alias("n_pages"),
                                   F.min("page_no").alias("first_page"))


@query("project_ids")
def project_ids(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"))


@query("export_batches")
def export_batches(spark, sf_dir):
    ids = fx.events(spark, sf_dir).select("id")
    b = scans.export_chunks(ids, EXPORT_CHUNK, [F.col("id")])
    return b.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_ids"),
                                     F.min("id").alias("first_id"), F.max("id").alias("last_id"))


# --------------------------------------------------------------- sources

@query("src_paged_flat")
def src_paged_flat(spark, sf_dir):
    return feed.parse_pages(fx.page_texts(fx.events(spark, sf_dir)), nested=False)


@query("src_paged_nested")
def src_paged_nested(spark, sf_dir):
    return feed.parse_pages(fx.page_texts(fx.events(spark, sf_dir)), nested=True)


@query("src_dump_json")
def src_dump_json(spark, sf_dir):
    return feed.parse_dump(fx.dump_texts(fx.events(spark, sf_dir)), keep=["page_no"])


@query("dump_split")
def dump_split(spark, sf_dir):
    """S03 at any size: four dump files, cut in parallel; rejects are rows too."""
    path = scratch_path(spark, "dump-files")
    fx.dump_files(fx.events(spark, sf_dir), path)
    return split.split_dump(spark, path, keep=["form"]).select("form", "element", "id", "reason")


@query("page_quarantine")
def page_quarantine(spark, sf_dir):
    return feed.page_quarantine(fx.damaged(fx.page_texts(fx.events(spark, sf_dir))), ["page_no"]).select(
        "page_no", "reason", F.length("value").alias("n_chars"))


@query("dump_quarantine")
def dump_quarantine(spark, sf_dir):
    return feed.dump_quarantine(fx.damaged(fx.dump_texts(fx.events(spark, sf_dir))), ["page_no"]).select(
        "page_no", "reason")


@query("load_with_rejects")
def load_with_rejects(spark, sf_dir):
    """Pages parsed once, events and rejected pages stored by one job, counted per page."""
    pages = feed.parse_pages(fx.damaged(fx.page_texts(fx.events(spark, sf_dir))), keep=["page_no"], rejects=True)
    rows, rejects = sinks.write_with_rejects(pages, scratch_path(spark, "with-rejects"))
    return (rows.groupBy("page_no").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("string").alias("reason"))
            .unionByName(rejects.select("page_no", F.lit(0).cast("long").alias("n_rows"), "reason")))


@query("src_ndjson_lenient")
def src_ndjson_lenient(spark, sf_dir):
    return feed.parse_ndjson_lenient(fx.ndjson_lines(fx.events(spark, sf_dir)), keep=["event_id"])


@query("src_ndjson_strict")
def src_ndjson_strict(spark, sf_dir):
    return feed.parse_ndjson_strict(fx.strict_ndjson_lines(fx.events(spark, sf_dir)),
                                    keep=["event_id"])


@query("src_sse")
def src_sse(spark, sf_dir):
    return feed.parse_sse(fx.sse_lines(fx.events(spark, sf_dir)), keep=["event_id"])


@query("src_csv")
def src_csv(spark, sf_dir):
    path = scratch_path(spark, "landing-csv")
    fx.csv_rows(fx.events(spark, sf_dir)).write.option("header", True).csv(path)
    return feed.read_csv_ids(spark, path)


@query("src_csv_mixed")
def src_csv_mixed(spark, sf_dir):
    """S06 over files whose headers differ, are spaced or quoted, or name no id."""
    path = scratch_path(spark, "landing-csv-mixed")
    fx.csv_files(fx.events(spark, sf_dir), path)
    return feed.read_csv_ids(spark, path, keep=["shape"])


@query("journal_replay")
def journal_replay(spark, sf_dir):
    """K06 appends two batches to a journal (padded, with blank lines); S08
    replays it into the target with K01 and reports lines, ids, recovered."""
    ev = fx.events(spark, sf_dir)
    d = fx.deliveries(ev)
    pad = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("  "), F.col("id"), F.lit(" ")))
    line = pad.otherwise(F.col("id"))
    blank = F.when(F.col("event_id") % 13 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    lines = d.select("strategy", F.explode(blank).alias("id"))
    path = scratch_path(spark, "journal")
    sinks.journal_append(lines.where(F.col("strategy") == "feed"), path)
    sinks.journal_append(lines.where(F.col("strategy") != "feed"), path)
    text = spark.read.text(path)
    ids = feed.parse_id_lines(text)
    counts = load.load_counts(ids, fx.existing_target(ev))
    return counts.select(text.agg(F.count(F.lit(1))).scalar().alias("lines"),
                         F.col("offered").alias("ids"), F.col("inserted").alias("recovered"))


@query("stats_doc_rows")
def stats_doc_rows(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    device = fx.pick_value(F.col("user_id") % 3, K.DEVICE_TYPES)
    counts = ev.agg(F.create_map(
        F.lit("events"), F.count(F.lit(1)),
        F.lit("users"), F.count_distinct("user_id"),
        F.lit("types"), F.count_distinct("event_type"))).scalar()

    def dist(col):
        # one row per category, so the collected list is bounded by the category count
        return (ev.groupBy(col.alias("type")).agg(F.count(F.lit(1)).alias("count"))
                .agg(F.array_sort(F.collect_list(F.struct("type", "count")))).scalar())

    doc = F.struct(counts.alias("counts"),
                   F.struct(dist(F.col("event_type")).alias("eventTypes"),
                            dist(device).alias("deviceTypes"), dist((F.col("user_id") % 5).cast("string")).alias("shards"),
                            F.create_map(F.lit("n"), ev.agg(F.count(F.lit(1))).scalar()).alias("total")).alias("distributions"),
                   F.create_map(F.lit("hits"), F.lit("0")).alias("cache"), F.lit("v2").alias("build"))
    text = spark.range(2).select(F.when(F.col("id") == 0, F.to_json(doc)).otherwise("no json").alias("value"))
    return feed.parse_stats_doc(text)


@query("export_ids")
def export_ids(spark, sf_dir):
    _, _, _, loaded = _slice_load(spark, sf_dir)
    path = scratch_path(spark, "export")
    sinks.export_ids(loaded.select("id"), path)
    return spark.read.text(path).select(F.col("value").alias("id"))


@query("export_gate")
def export_gate(spark, sf_dir):
    """K05, a row for each outcome: published; too few ids; ids with line breaks, whose lines
    are more than the ids."""
    ev = fx.events(spark, sf_dir)
    n = ev.count()
    broken = F.when(F.col("event_id") % 97 == 0, F.concat("id", F.lit("\n"), "id")).otherwise(F.col("id")).alias("id")
    rows = []
    for ids, required in ((ev.select("id"), n), (ev.select("id"), n + 1), (ev.select(broken), n)):
        path = scratch_path(spark, "export-gate")
        res = sinks.gated_export(ids, path, required)
        fs, to_path = hadoop_fs(spark, path)
        rows.append((res["exact"], res["exported"], res["required"], res["status"], fs.exists(to_path(path))))
    return spark.createDataFrame(rows, "exact long, exported long, required long, status string, published boolean")


# ---------------------------------------------------------- page text

def _pages(spark, sf_dir):
    return fx.spread(fx.table(spark, sf_dir, "pages"))


def _script_pages(spark, sf_dir):
    return fx.script_pages(_pages(spark, sf_dir))


@query("page_script_srcs")
def page_script_srcs(spark, sf_dir):
    return extract.script_srcs(_script_pages(spark, sf_dir))


@query("page_href_links")
def page_href_links(spark, sf_dir):
    return extract.script_srcs(_pages(spark, sf_dir), pattern=HREF_PATTERN, keep_suffix=None,
                               keep_contains=None, max_per_page=None)


@query("page_call_urls")
def page_call_urls(spark, sf_dir):
    return extract.call_urls(_script_pages(spark, sf_dir))


@query("page_path_literals")
def page_path_literals(spark, sf_dir):
    return extract.path_literals(_script_pages(spark, sf_dir))


@query("page_query_params")
def page_query_params(spark, sf_dir):
    return extract.query_params(_pages(spark, sf_dir), text="url")


@query("page_header_names")
def page_header_names(spark, sf_dir):
    return extract.header_names(_script_pages(spark, sf_dir))


@query("link_rel_extract")
def link_rel_extract(spark, sf_dir):
    return extract.link_rel_url(fx.link_headers(fx.events(spark, sf_dir)), keep=["event_id"])


@query("request_outcome_rollup")
def request_outcome_rollup(spark, sf_dir):
    return progress.request_outcome_rollup(fx.request_log(fx.events(spark, sf_dir)),
                                           by=["channel"])


# ----------------------------------------------------------- operations

def _batches(spark, sf_dir):
    return fx.batches(fx.events(spark, sf_dir))


def _now(b: DataFrame):
    return b.agg(F.max("ts_ms")).scalar() + F.lit(1000)


@query("checkpoint_state")
def checkpoint_state(spark, sf_dir):
    return progress.checkpoint_state(fx.checkpoint_log(fx.events(spark, sf_dir)))


@query("checkpoint_state_as_written")
def checkpoint_state_as_written(spark, sf_dir):
    return progress.checkpoint_state(fx.checkpoint_log(fx.events(spark, sf_dir)), as_written=True)


@query("latest_checkpoint")
def latest_checkpoint(spark, sf_dir):
    state = progress.checkpoint_state(fx.checkpoint_log(fx.events(spark, sf_dir)))
    return progress.latest_open_checkpoint(state)


@query("milestones")
def milestones(spark, sf_dir):
    return progress.milestones(_batches(spark, sf_dir), MILESTONE_EVERY).select(
        "worker", "batch", "events", "fetched")


@query("milestones_exact")
def milestones_exact(spark, sf_dir):
    return progress.milestones(_batches(spark, sf_dir), MILESTONE_EVERY, exact=True).select(
        "worker", "batch", "events", "fetched")


@query("running_totals")
def running_totals(spark, sf_dir):
    return progress.running_totals(_batches(spark, sf_dir))


@query("throughput_rate")
def throughput_rate(spark, sf_dir):
    b = _batches(spark, sf_dir)
    return progress.rate_in_window(b, _now(b), DAY_MS)


@query("best_strategy")
def best_strategy(spark, sf_dir):
    b = _batches(spark, sf_dir)
    return progress.best_strategy(b, _now(b), DAY_MS)


@query("throughput_trend")
def throughput_trend(spark, sf_dir):
    return progress.throughput_trend(_batches(spark, sf_dir), TREND_BUCKET_MS)


@query("recent_samples")
def recent_samples(spark, sf_dir):
    return progress.recent_samples(_batches(spark, sf_dir)).select(
        "batch", "ts_ms", "events", "strategy")


@query("worker_health")
def worker_health(spark, sf_dir):
    return progress.worker_health(fx.heartbeats(fx.events(spark, sf_dir)), 1_000_000_000_000)


@query("worker_health_counts")
def worker_health_counts(spark, sf_dir):
    return progress.worker_health_counts(worker_health(spark, sf_dir))


@query("sketch_counts")
def sketch_counts(spark, sf_dir):
    """A02 / A03 / A13 by stored daily sketches: exact counts, and whether the estimates lie
    within three standard errors of them."""
    d = fx.deliveries(fx.events(spark, sf_dir))
    path = scratch_path(spark, "sketches")
    sketches.daily_sketches(d).write.parquet(path)
    stored = spark.read.parquet(path)
    exact = d.groupBy(F.col("strategy").alias("source")).agg(F.count_distinct("id").alias("exact"))
    est = sketches.distinct_estimates(stored).join(exact, "source")
    close = F.abs(F.col("distinct_est") - F.col("exact")) <= F.col("exact") * sketches.HLL_ERROR + 1
    rows = est.select("source", F.lit("").alias("other"), "offered", "exact", close.alias("within"))
    a = d.select("id", F.col("strategy").alias("source")).distinct()
    both = (a.join(a.withColumnRenamed("source", "other"), "id").where("source < other")
            .groupBy("source", "other").agg(F.count(F.lit(1)).alias("exact")))
    pairs = sketches.overlap_estimates(stored).join(both, ["source", "other"], "left").withColumn(
        "exact", F.coalesce("exact", F.lit(0)))
    least = F.greatest(F.col("both_est"), F.col("exact"))
    close = F.abs(F.col("both_est") - F.col("exact")) <= least * 3 * sketches.THETA_ERROR + 1
    return rows.unionByName(pairs.select("source", "other", F.lit(None).cast("long").alias("offered"), "exact", close.alias("within")))


@query("estimated_count")
def estimated_count(spark, sf_dir):
    name = "feedspark_est_" + scratch_path(spark, "t").rsplit("-", 1)[-1][:12]
    path = scratch_path(spark, "estimated")
    fx.events(spark, sf_dir).select("id").write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return reconcile.estimated_count(spark, name)


# -------------------------------------------------------------- streaming

def _stream_dirs(spark, name):
    base = scratch_path(spark, name)
    return base + "/landing", base + "/target", base + "/checkpoint"


@query("stream_idempotent_load")
def stream_idempotent_load(spark, sf_dir):
    """Deliveries land newest-first-agnostic in several files; a file
    stream loads them into a keyed target that already holds the existing ids."""
    from ..streaming.keyed import KeyedTarget, stream_keyed_load
    ev = fx.events(spark, sf_dir)
    landing, path, ckpt = _stream_dirs(spark, "stream-load")
    d = fx.deliveries(ev).select("id", "strategy", "seq")
    d.repartition(12).write.parquet(landing)  # 12 files, strategies mixed; T01 is order-free
    target = KeyedTarget(spark, path).create(fx.existing_target(ev), n_buckets=16)
    stream_keyed_load(spark, landing, d.schema, path, ckpt, files_per_trigger=4, tend_every=2, max_files=3)
    return target.read().select("id")


@query("stream_dedup_watermark")
def stream_dedup_watermark(spark, sf_dir):
    """Time-ordered deliveries, duplicates dropped within a 1 hour watermark."""
    from ..streaming import land_in_time_order, stream_dedup_within_watermark
    ev = fx.events(spark, sf_dir)
    landing, sink, ckpt = _stream_dirs(spark, "stream-dedup")
    d = fx.deliveries(ev).select("id", "strategy", "ms", F.timestamp_millis("ms").alias("ts"))
    land_in_time_order(d, landing)
    stream_dedup_within_watermark(spark, landing, d.schema, sink, ckpt, files_per_trigger=4)
    return spark.read.parquet(sink)


@query("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """T02 / T07 with late data: events land in time order but for one in 50, which lands
    with the newest. What the windows count, and how many rows the watermark dropped."""
    from ..streaming import fold_window_log, land_in_time_order, stream_window_counts, watermark_figures
    ev = fx.events(spark, sf_dir)
    last = ev.agg(F.max("ms")).scalar()
    late = F.col("event_id") % 50 == 0
    ev = ev.select("event_id", F.col("ms").alias("event_ms"), F.when(late, last).otherwise(F.col("ms")).alias("ms"),
                   F.timestamp_millis("ms").alias("ts"))
    landing, log, ckpt = _stream_dirs(spark, "stream-late")
    land_in_time_order(ev, landing)
    q = stream_window_counts(spark, landing, ev.schema, log, ckpt, "1 day", delay="0 seconds", files_per_trigger=2)
    figures = watermark_figures(q)
    kept = fold_window_log(spark.read.parquet(log), ["window_start_ms", "window_end_ms"])
    landed = F.lit(figures["rows"]).cast("long")
    return kept.agg(F.sum("events").cast("long").alias("counted")).select(
        landed.alias("landed"), "counted", (landed - F.col("counted")).alias("dropped"),
        F.lit(figures["late"] > 0).alias("measured"), F.lit(figures["batches"]).cast("long").alias("batches"))


def _stream_counts(spark, sf_dir, name, window, slide, by):
    from ..streaming import fold_window_log, land_in_time_order, stream_window_counts
    ev = fx.events(spark, sf_dir).select("event_id", "event_type", "ms",
                                         F.timestamp_millis("ms").alias("ts"))
    landing, log, ckpt = _stream_dirs(spark, name)
    land_in_time_order(ev, landing)
    stream_window_counts(spark, landing, ev.schema, log, ckpt, window, slide, by=by, files_per_trigger=4)
    return fold_window_log(spark.read.parquet(log), ["window_start_ms", "window_end_ms", *by])


@query("stream_throughput")
def stream_throughput(spark, sf_dir):
    """Sliding 1-day windows every 12 hours; rate over the fixed window length."""
    out = _stream_counts(spark, sf_dir, "stream-rate", "1 day", "12 hours", [])
    return out.withColumn("rate", F.col("events") / F.lit(DAY_MS / 1000.0))


@query("stream_daily_counts")
def stream_daily_counts(spark, sf_dir):
    """Tumbling 1-day counts per event type."""
    return _stream_counts(spark, sf_dir, "stream-daily", "1 day", None, ["event_type"])


@query("stream_worker_health")
def stream_worker_health(spark, sf_dir):
    """T06 / A10 on a stream: heartbeats land in time order, keyed state with
    event-time timers turns silent workers stuck, then dead; the transition
    log is folded to each worker's latest state (now = the last heartbeat)."""
    from ..streaming.health import fold_transitions, run_worker_health
    from ..streaming.loader import land_in_time_order
    hb = fx.heartbeats(fx.events(spark, sf_dir))
    landing, log, ckpt = _stream_dirs(spark, "stream-health")
    land_in_time_order(hb, landing, ms="last_progress_ms")
    run_worker_health(spark, landing, log, ckpt, files_per_trigger=4, state_partitions=HEALTH_STATE_PARTITIONS)
    return fold_transitions(spark.read.parquet(log))

"""Scan shapes over a keyed, time-stamped feed (S11-S16, S18, S20, P05, J06,
O02, U05, W07).

The source splits a feed into time slices, types, offset ranges and keyset
pages, each fetched by its own worker. In Spark these are columns derived
from one scan: the slice, range or page a row belongs to. Bounds come from
one aggregate evaluated as a scalar subquery (no cross join, no driver
round-trip); positions come from the distributed row index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TIME_SLICES
from .rowindex import with_row_index
from ..functions.num import idiv


def feed_order(ts: str = "ts", key: str = "event_id") -> list[Column]:
    """Newest first; the key breaks ties so the order is total."""
    return [F.col(ts).desc(), F.col(key).desc()]


# --------------------------------------------------------------------- time

def time_bounds(df: DataFrame, ms: str = "ms") -> DataFrame:
    """(min_ms, max_ms) of the feed in one aggregate."""
    return df.agg(F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"))


def with_time_slice(df: DataFrame, n_slices: int = TIME_SLICES, ms: str = "ms",
                    out: str = "slice") -> DataFrame:
    """Slice number of each row for `n_slices` slices of ceil(range/n) ms.

    The last slice is clamped so the maximum falls inside it; the width is
    at least 1 ms so a single-instant feed does not divide by zero.
    """
    lo = df.agg(F.min(ms)).scalar()
    hi = df.agg(F.max(ms)).scalar()
    width = F.greatest(F.ceil((hi - lo) / F.lit(n_slices)), F.lit(1))
    idx = idiv(F.col(ms) - lo, width).cast("int")
    return df.withColumn(out, F.least(idx, F.lit(n_slices - 1)))


def slice_table(df: DataFrame, n_slices: int = TIME_SLICES, ms: str = "ms") -> DataFrame:
    """The slice list the source builds: (slice, since_ms, until_ms), half-open; the last
    one ends just after the newest row, so that every row lies in a slice."""
    spark = df.sparkSession
    lo = df.agg(F.min(ms)).scalar()
    hi = df.agg(F.max(ms)).scalar()
    width = F.greatest(F.ceil((hi - lo) / F.lit(n_slices)), F.lit(1))
    return (spark.range(n_slices).select(F.col("id").cast("int").alias("slice"))
            .select("slice",
                    (lo + F.col("slice") * width).alias("since_ms"),
                    F.least(lo + (F.col("slice") + 1) * width, hi + 1).alias("until_ms")))


def time_filter(df: DataFrame, since_ms: int | None = None, until_ms: int | None = None,
                ts: str = "ts") -> DataFrame:
    """Half-open [since, until); a bound is applied only when > 0.

    Bounds are compared on the timestamp column itself so the predicate
    reaches the Parquet scan (PushedFilters) instead of a derived column.
    """
    cond = F.lit(True)
    col = F.col(ts)
    if since_ms and since_ms > 0:
        cond = cond & (col >= F.timestamp_millis(F.lit(since_ms)).cast(_ts_type(df, ts)))
    if until_ms and until_ms > 0:
        cond = cond & (col < F.timestamp_millis(F.lit(until_ms)).cast(_ts_type(df, ts)))
    return df.where(cond)


def _ts_type(df: DataFrame, ts: str) -> str:
    return df.schema[ts].dataType.simpleString()


#: Buckets of an interval join, at most, and parts of a hot bucket, at most.
RANGE_BUCKETS = 64
HOT_PARTS = 64


def _bucket_of(col: Column, edges: list[int]) -> Column:
    """How many of the ascending `edges` are <= `col`, by a tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(edges[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return F.when(col.isNotNull(), tree(0, len(edges)))


def range_join_slices(df: DataFrame, slices: DataFrame, ms: str = "ms", buckets: int = RANGE_BUCKETS,
                      hot_parts: int = HOT_PARTS) -> DataFrame:
    """Rows with the slices (slice, since_ms, until_ms) that hold their time, by an
    interval join: `since_ms` <= `ms` < `until_ms`; rows in no slice, and rows without a
    time, have NULLs. Slices may overlap, leave gaps, and be as many as the rows.

    The time axis is cut at quantiles of the rows, so buckets hold about as many rows
    each wherever the rows lie. A slice is copied into every bucket that it touches (at
    most `buckets`), and the join is an equi-join on the bucket with the range test: no
    nested loop, nothing broadcast by hand. A bucket that still holds much more than its
    share, an instant that very many rows have, is dealt into parts, each with its own
    copy of the bucket's slices.
    """
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.agg(F.percentile_approx(ms, probs, 10 * buckets)).first()[0] or [])) if probs else []
    d = df.withColumn("_b", _bucket_of(F.col(ms), cuts))
    sizes = {r["_b"]: r["n"] for r in d.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()
             if r["_b"] is not None}                                    # at most `buckets` rows
    share = max(1, 2 * sum(sizes.values()) // max(len(sizes), 1))
    parts = {b: min(hot_parts, -(-n // share)) for b, n in sizes.items() if n > share}
    n_parts = F.lit(1)
    for b, n in parts.items():
        n_parts = F.when(F.col("_b") == b, F.lit(n)).otherwise(n_parts)
    # the part only says where a row is joined: any part of its bucket gives the same rows
    d = d.withColumn("_p", F.pmod(F.monotonically_increasing_id(), n_parts).cast("int"))
    s = slices.where(F.col("since_ms") < F.col("until_ms"))
    s = s.withColumn("_b", F.explode(F.sequence(_bucket_of(F.col("since_ms"), cuts), _bucket_of(F.col("until_ms") - 1, cuts))))
    s = s.withColumn("_p", F.explode(F.sequence(F.lit(0), (n_parts - 1).cast("int"))))
    cond = ((d["_b"] == s["_b"]) & (d["_p"] == s["_p"]) & (d[ms] >= s["since_ms"]) & (d[ms] < s["until_ms"]))
    return d.join(s, cond, "left").drop("_b", "_p")


# ------------------------------------------------------------- category scan

def scan_by_type(df: DataFrame, types: list[str] | None = None,
                 type_col: str = "event_type") -> DataFrame:
    """One filtered scan per category, unioned. With `types` the filter
    is an `IN` list pushed to the scan; stored data written with
    `partitionBy(type_col)` prunes whole folders."""
    return df if types is None else df.where(F.col(type_col).isin(*types))


def store_by_type(df: DataFrame, path: str, type_col: str = "event_type",
                  mode: str = "errorifexists") -> None:
    """S12 storage: one folder per category, so `scan_by_type` on the stored
    data prunes folders (PartitionFilters) instead of filtering rows."""
    df.write.mode(mode).partitionBy(type_col).parquet(path)


# ------------------------------------------------------ positional scans

def with_offset_range(df: DataFrame, n_ranges: int, order: list[Column],
                      total: int | Column | None = None, out: str = "range_no") -> DataFrame:
    """N disjoint [start, end) offset ranges of ceil(total / N) rows.

    Clamped: the source's worker could overrun its end by part of a page.
    """
    total_c = total if total is not None else df.agg(F.count(F.lit(1))).scalar()
    if isinstance(total_c, int):
        total_c = F.lit(total_c)
    size = F.greatest(F.ceil(total_c / F.lit(n_ranges)), F.lit(1))
    indexed = with_row_index(df, order)
    return (indexed.withColumn(out, F.least(idiv("idx", size.cast("long")),
                                            F.lit(n_ranges - 1)).cast("int"))
            .withColumn("range_size", size.cast("long")))


def with_pages(df: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """Page number of each row for pages of `limit` rows in feed order."""
    return with_row_index(df, order).withColumn("page_no", idiv("idx", limit))


def page_summary(paged: DataFrame, limit: int, key: str = "event_id",
                 cursor: Column | None = None) -> DataFrame:
    """Per page its row count, first/last key, `next_cursor` (last row's
    cursor) and `has_more` (false only on the final page).

    Pages are dense ranges of the row index, so only each page's first and
    last rows matter: they are filtered out first (2 rows per page) and the
    aggregate runs on those alone.
    """
    cur = cursor if cursor is not None else F.col(key).cast("string")
    last_idx = paged.agg(F.max("idx")).scalar()
    pos = F.col("idx") % F.lit(limit)
    first = pos == 0
    last = (pos == limit - 1) | (F.col("idx") == last_idx)
    ends = paged.where(first | last).select(
        "page_no", "idx", F.col(key).alias("_k"), F.when(last, cur).alias("_c"),
        first.alias("_first"), last.alias("_last"))
    return (ends.groupBy("page_no")
            .agg((F.max("idx") - F.min("idx") + 1).alias("n_rows"),
                 F.min_by("_k", "idx").alias("first_key"),
                 F.max_by("_k", "idx").alias("last_key"),
                 F.max_by("_c", "idx").alias("next_cursor"))
            .withColumn("has_more", F.col("page_no") < idiv(last_idx, limit)))


def _after(cursor_ms: int, cursor_key: int, ms: str, key: str) -> Column:
    return (F.col(ms) < F.lit(cursor_ms)) | ((F.col(ms) == F.lit(cursor_ms)) & (F.col(key) < F.lit(cursor_key)))


def page_after(df: DataFrame, cursor_ms: int, cursor_key: int, limit: int,
               ms: str = "ms", key: str = "event_id", ts: str | None = "ts") -> DataFrame:
    """`limit` rows strictly after a keyset cursor, newest first.

    The limit is the feature (one page); Spark plans it as a top-k per partition, not a full
    sort. What the cursor says of the stored column `ts` itself (`ms` is its milliseconds) is
    a conjunct of its own, so it reaches the scan and row groups newer than the cursor are
    skipped by their statistics. For a feed that is read page by page, store it with
    `store_keyset` and use `page_after_stored`, which reads a page's files only.
    """
    rows = df
    if ts:
        rows = rows.where(F.col(ts) < F.timestamp_millis(F.lit(cursor_ms + 1)).cast(_ts_type(df, ts)))
    return (rows.where(_after(cursor_ms, cursor_key, ms, key))
            .orderBy(F.col(ms).desc(), F.col(key).desc()).limit(limit))


def store_keyset(df: DataFrame, path: str, num_files: int, ms: str = "ms", key: str = "event_id") -> None:
    """S14 / S15 storage: the feed in files that each hold one range of the keyset order,
    sorted, under ``path/data``, and one row a file (`file`, `lo`, `hi`, `n_rows`) under
    ``path/index``."""
    order = [F.col(ms).desc(), F.col(key).desc()]
    df.repartitionByRange(num_files, *order).sortWithinPartitions(*order).write.parquet(path + "/data")
    stored = df.sparkSession.read.parquet(path + "/data")
    at = F.struct(F.col(ms).alias("ms"), F.col(key).alias("key"))
    (stored.groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n_rows"))
     .write.parquet(path + "/index"))


def page_files(spark: SparkSession, path: str, cursor_ms: int, cursor_key: int, limit: int) -> list[str]:
    """The files of a `store_keyset` feed that hold the page after a cursor: by their ranges
    the newest that reach below the cursor, until those that lie wholly below it have
    `limit` rows. A few index rows are fetched at a time, however many files there are."""
    cursor = F.struct(F.lit(cursor_ms).cast("long").alias("ms"), F.lit(cursor_key).cast("long").alias("key"))
    index = spark.read.parquet(path + "/index").where(F.col("lo") < cursor).orderBy(F.col("hi").desc())
    take = 16
    while True:
        rows = index.limit(take).collect()
        files, have = [], 0
        for r in rows:
            if have >= limit:
                break
            files.append(r["file"])
            have += r["n_rows"] if tuple(r["hi"]) < (cursor_ms, cursor_key) else 0
        if have >= limit or len(rows) < take:
            return files
        take *= 4


def page_after_stored(spark: SparkSession, path: str, cursor_ms: int, cursor_key: int, limit: int,
                      ms: str = "ms", key: str = "event_id") -> DataFrame:
    """S15 as a seek: `page_after` of a feed stored by `store_keyset`. Reads the few files
    that hold the page, whatever the size of the feed."""
    files = page_files(spark, path, cursor_ms, cursor_key, limit)
    schema = spark.read.parquet(path + "/data").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return page_after(rows, cursor_ms, cursor_key, limit, ms, key, ts=None)


def staggered_chains(paged: DataFrame, n_chains: int) -> DataFrame:
    """Deliveries of N staggered cursor chains.

    Seeding reads pages 0..N-2 once (source ``seed``); chain k starts at page
    k and reads to the end. Each row is copied once per chain that reaches
    it (at most N copies, a fixed parameter), so no cross join is needed.
    """
    chains = F.sequence(F.lit(0), F.least(F.col("page_no"), F.lit(n_chains - 1)).cast("int"))
    by_chain = (paged.withColumn("_chain", F.explode(chains))
                .withColumn("source", F.concat(F.lit("chain-"), F.col("_chain").cast("string")))
                .drop("_chain"))
    seeds = paged.where(F.col("page_no") < n_chains - 1).withColumn("source", F.lit("seed"))
    return by_chain.unionByName(seeds)


def export_chunks(df: DataFrame, size: int, order: list[Column]) -> DataFrame:
    """Fixed-size batches of `size` rows in a total order."""
    return with_row_index(df, order).withColumn("batch_no",
                                                idiv("idx", size))

"""Idempotent loading and key-conflict semantics (K01, K02, S17, S24, J01-J04,
A14, O03, U01, U02, W06).

A keyed table with "insert, ignore on conflict" becomes: collapse the batch
on the key (map-side partial aggregation, so a hot key costs one row per
task), then a left-anti join against the target. The aggregate leaves the
batch hash-partitioned on `id`, so the anti join only shuffles the target;
a target written bucketed on `id` (see `sinks.create_id_table`) does not
shuffle at all. `NOT IN` is never used: it is null-aware and plans a
broadcast nested loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_ids(offered: DataFrame, key: str = "id") -> DataFrame:
    """U02 on one batch: the distinct key set (duplicates inside a batch collapse)."""
    return offered.select(key).where(F.col(key).isNotNull()).dropDuplicates([key])


def new_ids(offered: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Keys of `offered` not yet in `target`, each once."""
    return distinct_ids(offered, key).join(target.select(key), key, "left_anti")


def new_rows(offered: DataFrame, target: DataFrame, key: str = "id",
             same_per_key: bool = False) -> DataFrame:
    """K01 keeping the offered columns: one row per unseen key (any of its copies).

    `dropDuplicates` keeps the other columns with `first()`, which for text
    columns may keep any copy. With `same_per_key` the copy that is kept is the
    largest as a row, always one that was delivered: the same rows whatever the order,
    also where copies do differ.
    """
    rows = offered.where(F.col(key).isNotNull())
    if same_per_key:
        # Combined map-side, and the batch stays partitioned on the key, so the anti
        # join does not shuffle it again.
        rest = [c for c in rows.columns if c != key]
        if rest:
            rows = rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(*offered.columns)
        else:
            rows = rows.dropDuplicates([key])
    else:
        rows = rows.dropDuplicates([key])
    return rows.join(target.select(key), key, "left_anti")


def loaded_ids(offered: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Target after an idempotent load: old keys plus the new ones."""
    return target.select(key).unionByName(new_ids(offered, target, key))


def load_counts(offered: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """K01 return value as a one-row frame: offered, distinct offered, inserted, rejected.

    `inserted` counts rows actually added (not offered), as the source does.
    One pass: the distinct batch is tagged with whether the target knows it.
    """
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    d = (offered.where(F.col(key).isNotNull())
         .groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
         .join(known, key, "left"))
    return d.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("offered"),
        F.count(F.lit(1)).cast("long").alias("offered_distinct"),
        F.count_if(F.col("_known").isNull()).cast("long").alias("inserted"),
    ).withColumn("rejected", F.col("offered") - F.col("inserted"))


def append_new_ids(offered: DataFrame, target_path: str, key: str = "id",
                   fmt: str = "parquet") -> int:
    """K01 as a job: append unseen keys to the table at `target_path`.

    Returns the number inserted, measured with `observe` on the written
    rows (no second scan). One writer at a time: two concurrent appends to
    plain Parquet are not atomic with respect to each other.
    """
    from pyspark.sql import Observation

    spark = offered.sparkSession
    try:
        target = spark.read.format(fmt).load(target_path).select(key)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":        # any other failure must not reload known ids
            raise
        target = spark.createDataFrame([], offered.select(key).schema)
    obs = Observation("inserted")
    rows = new_ids(offered, target, key).observe(obs, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").format(fmt).save(target_path)
    return int(obs.get["n"])


def append_new_ids_to_table(offered: DataFrame, table: str, key: str = "id") -> int:
    """K01 into a catalog table (see `sinks.create_id_table`). When the table
    is bucketed on `key`, the anti join reads it bucket by bucket and only
    the offered batch is shuffled (to the table's bucket count). Returns the
    number inserted, counted with `observe` on the written rows."""
    from pyspark.sql import Observation

    spark = offered.sparkSession
    obs = Observation("inserted")
    rows = new_ids(offered, spark.table(table), key).observe(obs, F.count(F.lit(1)).alias("n"))
    rows.write.insertInto(table)
    return int(obs.get["n"])


def first_wins(deliveries: DataFrame, order: str | Column, key: str = "id",
               payload: list[str] | None = None) -> DataFrame:
    """W06 / K02 first half: one row per key, the earliest by `order`.

    `min_by` over a struct aggregates map-side, unlike `row_number` which
    must see the whole key group in one task.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    cols = payload if payload is not None else [c for c in deliveries.columns if c != key]
    packed = F.struct(*[F.col(c) for c in cols])
    out = deliveries.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(packed, order_col).alias("_w"))
    return out.select(key, *[F.col("_w")[c].alias(c) for c in cols])


def first_wins_new(deliveries: DataFrame, target: DataFrame, order: str | Column,
                   key: str = "id", payload: list[str] | None = None,
                   stamp: bool = False) -> DataFrame:
    """First payload per unseen key; `stamp` adds `ingested_at` (load time)."""
    out = first_wins(deliveries, order, key, payload).join(target.select(key), key, "left_anti")
    if stamp:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def lookup_found(events: DataFrame, asked: DataFrame, key: str = "id") -> DataFrame:
    """Events whose key is in the asked list (semi join: each event once)."""
    return events.join(asked.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def lookup_missing(events: DataFrame, asked: DataFrame, key: str = "id") -> DataFrame:
    """Asked keys with no event, each once."""
    return distinct_ids(asked, key).join(events.select(key), key, "left_anti")


def known_duplicates(offered: DataFrame, target: DataFrame, key: str = "id",
                     by: list[str] | None = None) -> DataFrame:
    """Offered rows already present in the target, counted per `by` group."""
    hits = offered.join(target.select(key), key, "left_semi")
    by = by or []
    return hits.groupBy(*by).agg(F.count(F.lit(1)).alias("known_rows"),
                                 F.count_distinct(key).alias("known_ids"))


def duplicate_rate(deliveries: DataFrame, target: DataFrame, order: str,
                   key: str = "id", strategy: str = "strategy") -> DataFrame:
    """Per strategy, rows offered, inserted (first delivery of an unseen key), rejected."""
    winners = (first_wins(deliveries, order, key, payload=[strategy])
               .join(target.select(key), key, "left_anti")
               .groupBy(strategy).agg(F.count(F.lit(1)).alias("inserted")))
    offered = deliveries.groupBy(strategy).agg(F.count(F.lit(1)).alias("offered"))
    return (offered.join(winners, strategy, "left")
            .select(strategy, "offered",
                    F.coalesce("inserted", F.lit(0)).cast("long").alias("inserted"))
            .withColumn("rejected", F.col("offered") - F.col("inserted")))


def capped_ids(offered: DataFrame, target_count: int | Column, order: list[Column],
               key: str = "id") -> DataFrame:
    """Stop at a target count, applied to the distinct set in a total order
    (each key ranked by its first delivery).

    The cap is the feature here (the source stops once it holds
    `target_count` ids). A target that is a fraction of the data is too big
    for a top-k buffer, so the distinct keys get a distributed row index and
    the first `target_count` positions are kept.
    """
    from .rowindex import with_row_index

    d = offered.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.min(c).alias(f"_o{i}") for i, c in enumerate(order)])
    ranked = with_row_index(d, [*[F.col(f"_o{i}") for i in range(len(order))], F.col(key)], "_r")
    cap = F.lit(target_count) if isinstance(target_count, int) else target_count
    return ranked.where(F.col("_r") < cap).select(key)

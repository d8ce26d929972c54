"""Profiling loosely structured records.

One pass per report: keys are exploded once, candidates are counted with
`count_if` side by side, never one job per field. Reports aggregate the
whole table; a sample is only what the caller passes in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ID_FIELDS, TIME_FIELDS_REPORT, TYPE_FIELDS
from ..functions.json import _c, field_path, vget, vkind, vtext
from ..functions.text import string_format_class
from ..functions.timefmt import epoch_ms, ts_format_class, ts_normalise
from ..functions.num import idiv
from ..session import cut_lineage

#: Groups of a report that may be sent to every task.
BROADCAST_GROUPS = 10_000


def type_matches(v, value, fields=TYPE_FIELDS) -> Column:
    """A record matches when any of the type fields equals `value`."""
    value = F.lit(value) if isinstance(value, str) else _c(value)
    m = F.lit(False)
    for f in fields:
        m = m | F.coalesce(F.try_variant_get(_c(v), field_path(f), "string") == value, F.lit(False))
    return m


def type_filter_check(records: DataFrame, requested: str, v: str = "v",
                      fields=TYPE_FIELDS) -> DataFrame:
    """P04 all-rows form: per requested type, rows scanned and whether every
    row matched it (`bool_and`)."""
    staged = records.select(F.col(requested).alias("requested_type"),
                            type_matches(F.col(v), F.col(requested), fields).alias("_m"))
    return staged.groupBy("requested_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("_m").alias("n_matching"),
        F.bool_and("_m").alias("all_match"))


def first_present(v, fields) -> Column:
    """Variant of the first candidate that is present and not JSON null."""
    vals = [vget(_c(v), field_path(f)) for f in fields]
    return F.coalesce(*[F.when(~F.is_variant_null(x), x) for x in vals])


def _with_time_value(records: DataFrame, v: str, fields, keep: list[str]) -> DataFrame:
    """Stage the first present time value (`_t`) and its format class, so the
    candidate lookups run once per row, not once per use."""
    staged = records.select(*keep, first_present(F.col(v), fields).alias("_t"))
    return staged.withColumn("format", F.coalesce(ts_format_class(F.col("_t")), F.lit("none")))


def ts_format_profile(records: DataFrame, v: str = "v", fields=TIME_FIELDS_REPORT) -> DataFrame:
    """Rows per timestamp format class of the first present time field
    (``none`` when no candidate is present)."""
    return (_with_time_value(records, v, fields, []).groupBy("format")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def ts_normalised(records: DataFrame, v: str = "v", fields=TIME_FIELDS_REPORT,
                  keep: list[str] | None = None) -> DataFrame:
    """One instant per record (epoch ms), with the format it came from."""
    keep = keep or []
    staged = _with_time_value(records, v, fields, keep)
    return staged.select(*keep, "format", epoch_ms(ts_normalise(F.col("_t"))).alias("norm_ms"))


def field_type_profile(records: DataFrame, v: str = "v", order: str = "event_id",
                       preview_len: int = 100) -> DataFrame:
    """Per top-level field and JSON kind, rows, largest array
    length and a preview (first `preview_len` characters of the value in the
    first record by `order`)."""
    def exploded(rows: DataFrame) -> DataFrame:
        kv = rows.select(order, F.explode(F.try_variant_get(F.col(v), "$", "map<string,variant>"))
                         .alias("field", "val"))
        return kv.withColumn("kind", vkind(F.col("val")))  # staged: used three times below

    # Numbers only: one row a group in a hash table. A text beside them (`min_by`) would
    # make Spark sort every exploded row.
    alen = F.when(F.col("kind") == "array", F.size(F.try_variant_get(F.col("val"), "$", "array<variant>")))
    groups = (exploded(records).select("field", "kind", order, alen.alias("_alen"))
              .groupBy("field", "kind")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.max("_alen").alias("max_array_len"),
                   F.min(order).alias("_first")))
    groups = cut_lineage(groups)
    # The previews are read from the groups' first records alone.
    few = groups.count() <= BROADCAST_GROUPS
    shared = F.broadcast if few else lambda df: df
    first = records.join(shared(groups.select(F.col("_first").alias(order)).distinct()), order, "left_semi")
    kind = F.col("kind")
    text = F.when(kind == "null", F.lit("null")).when(kind.isin("object", "array"),
                                                      F.to_json(F.col("val"))).otherwise(vtext("val"))
    shown = (exploded(first).select("field", "kind", F.col(order).alias("_first"),
                                    F.substring(text, 1, preview_len).alias("_preview"))
             .join(shared(groups.select("field", "kind", "_first")), ["field", "kind", "_first"], "left_semi")
             .groupBy("field", "kind").agg(F.min("_preview").alias("preview")))
    return groups.join(shared(shown), ["field", "kind"], "left").select("field", "kind", "n_rows", "max_array_len", "preview")


def schema_variants(records: DataFrame, v: str = "v") -> DataFrame:
    """Rows per sorted key list (all rows, not a sample)."""
    keys = F.array_join(F.array_sort(F.map_keys(
        F.try_variant_get(F.col(v), "$", "map<string,variant>"))), ",")
    return records.groupBy(keys.alias("key_set")).agg(F.count(F.lit(1)).alias("n_rows"))


def candidate_field_presence(records: DataFrame, families: dict[str, tuple[str, ...]] | None = None,
                             v: str = "v") -> DataFrame:
    """Per candidate field, rows where it is present and not null, and
    whether it is the first candidate of its family with any such row.

    One aggregate computes every count; `stack` turns the row into a table.
    """
    families = families or {"id": ID_FIELDS, "time": TIME_FIELDS_REPORT}
    aggs, rows = [], []
    for fam, fields in families.items():
        for pos, f in enumerate(fields):
            name = f"c_{fam}_{pos}"
            x = vget(F.col(v), field_path(f))
            aggs.append(F.count_if(x.isNotNull() & ~F.is_variant_null(x)).alias(name))
            rows.append((fam, pos, f, name))
    counts = records.agg(*aggs)
    stack = "stack({n}, {items}) as (family, position, field, n_present)".format(
        n=len(rows), items=", ".join(f"'{fam}', {pos}, '{f}', {name}" for fam, pos, f, name in rows))
    long = counts.select(F.expr(stack))
    first = long.where(F.col("n_present") > 0).groupBy("family").agg(
        F.min("position").alias("_first"))
    return (long.join(first, "family", "left")
            .withColumn("is_used", F.coalesce(F.col("position") == F.col("_first"), F.lit(False)))
            .drop("_first"))


def string_format_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """P10: rows per (column, format class), one pass over all columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         string_format_class(F.col(c)).alias("format"))
                                for c in columns]))
    return (df.select(pairs.alias("p")).select("p.column", "p.format")
            .groupBy("column", "format").agg(F.count(F.lit(1)).alias("n_rows")))


def entity_counts(ev: DataFrame, session_gap_ms: int = 1_800_000) -> DataFrame:
    """Named totals in one aggregate: events, users, sessions (user and
    30-minute bucket), types."""
    return ev.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("user_id", idiv("ms", session_gap_ms)).alias("sessions"),
        F.count_distinct("event_type").alias("types"))

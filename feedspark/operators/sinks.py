"""Sinks: id export, gated export, journal append, table creation
(K04-K07, S09, S10, P03).

Exports write in parallel (one file per task, `maxRecordsPerFile` as the
chunk size) and count what they wrote with `observe`, so a gate costs no
second scan. Nothing is coalesced to one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import EXPORT_BATCH

#: Bytes of an exported file, about.
EXPORT_FILE_BYTES = 128 << 20


def export_ids(ids: DataFrame, path: str, key: str = "id", batch: int = EXPORT_BATCH,
               mode: str = "errorifexists") -> int:
    """One id per line, at most `batch` lines per file.

    Unlike the source, every line ends with a newline and the export is
    many part files. Returns the number of lines written.
    """
    obs = Observation("export")
    out = ids.select(F.col(key).cast("string")).observe(obs, F.count(F.lit(1)).alias("n"))
    out.write.mode(mode).option("maxRecordsPerFile", batch).text(path)
    return int(obs.get["n"])


def gated_export(ids: DataFrame, path: str, required: int, key: str = "id",
                 batch: int | None = None, file_bytes: int = EXPORT_FILE_BYTES) -> dict:
    """Refuse when the exact distinct count is below `required`; write to a folder
    beside `path`; refuse again, and remove what was written, when the lines read back
    are not as many as the ids (an id that holds a line break, say); else publish the
    folder as `path` by one rename.

    Files hold `batch` lines, or as many as give about `file_bytes`. Returns a dict with
    `exact`, `exported`, `required` and `status` (``refused_count``, ``refused_mismatch``
    or ``exported``). `path` exists only after an export, with `exported` lines.
    """
    from ..session import cut_lineage, hadoop_fs

    spark = ids.sparkSession
    fs, to_path = hadoop_fs(spark, path)
    if fs.exists(to_path(path)):
        raise FileExistsError(path)
    # The distinct set is computed once (reliable checkpoint in the shared
    # folder) and both counted and written from there.
    distinct = cut_lineage(ids.select(key).where(F.col(key).isNotNull()).dropDuplicates([key]))
    exact, size = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 1), F.lit(0))).first()
    if exact < required:
        return {"exact": exact, "exported": 0, "required": required, "status": "refused_count"}
    staged = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex[:12]}"
    try:
        export_ids(distinct, staged, key, batch or max(1, file_bytes * exact // max(size, 1)))
        lines = spark.read.text(staged).count()
        if lines == exact and fs.rename(to_path(staged), to_path(path)):
            return {"exact": exact, "exported": lines, "required": required, "status": "exported"}
        return {"exact": exact, "exported": lines, "required": required, "status": "refused_mismatch"}
    finally:
        fs.delete(to_path(staged), True)             # gone already after the rename


def write_with_rejects(df: DataFrame, path: str, reason: str = "reason",
                       mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """P03 as a sink: rows and rejects (`reason` not NULL) of one frame, e.g. of
    `feed.parse_pages(..., rejects=True)`, stored by one job under ``rejected=false`` and
    ``rejected=true``. Returns (rows, rejects), each reading its own folder only."""
    flagged = df.withColumn("rejected", F.col(reason).isNotNull())
    flagged.write.mode(mode).partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return stored.where(~F.col("rejected")).drop("rejected"), stored.where("rejected").drop("rejected")


def journal_append(ids: DataFrame, path: str, key: str = "id") -> None:
    """Append a batch of ids to the journal folder (one line each)."""
    ids.select(F.col(key).cast("string")).write.mode("append").text(path)


def create_id_table(spark: SparkSession, name: str, location: str | None = None,
                    buckets: int | None = None, payload: bool = False) -> None:
    """Create the id table (or the id + payload table) when absent.

    With `buckets` the table is bucketed and sorted on `id`, so the
    idempotent load's anti join reads it without a shuffle.
    """
    cols = "id STRING NOT NULL"
    if payload:
        cols += ", data STRING, ingested_at TIMESTAMP"
    clauses = ["USING parquet"]
    if buckets:
        clauses.append(f"CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS")
    if location:
        clauses.append(f"LOCATION '{location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) " + " ".join(clauses))

"""Helpers shared by the operators of this subpackage.

Every operator takes a DataFrame that has at least `doc_id` and `text`, projects
it to the columns it needs first (so extra columns, whatever their names, never
clash), and treats a null text as empty unless its docstring says otherwise.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..session import ensure_checkpoint_dir, scratch_path

#: Bytes of one Arrow batch sent to a Python worker. Rows alone do not bound a
#: batch: ten thousand texts of a megabyte each would be ten gigabytes.
ARROW_BATCH_BYTES = 8 << 20

#: Code points of text that a Python worker holds as word lists at once.
CHUNK_CHARS = 1_000_000

#: The characters that the exact contracts treat as white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"

_MASK64 = (1 << 64) - 1


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on: a shared checkpoint folder
    (read from ``spark.checkpoint.dir``) and Arrow batches bounded in bytes."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(df: DataFrame, *, empty_null: bool = True) -> DataFrame:
    """`doc_id` (long) and `text` (string; null becomes empty if `empty_null`)."""
    text = F.col("text").cast("string")
    if empty_null:
        text = F.coalesce(text, F.lit(""))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def fold(col: str | Column, n: int) -> Column:
    """crc32 of the value as text, modulo `n` (null: the empty text's crc32)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """`mapInArrow` after `prepare`: batches in, batches out, nothing shuffled. A
    worker that has finished gives back the memory that it holds in reserve."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this process to the system: what Arrow keeps in reserve,
    and the pages between blocks that are still in use, which the C library keeps. An
    idle Python worker would hold them beside the executor's later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about `limit` code points."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def splitmix64(n: int, seed: int) -> list[int]:
    """`n` well-mixed 64-bit numbers, the same on every machine and release."""
    out, x = [], seed & _MASK64
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & _MASK64
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK64
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK64
        out.append(z ^ (z >> 31))
    return out


def attach_by_key(rows: DataFrame, groups: DataFrame, key: str, size: str,
                  n_rows: int) -> DataFrame:
    """Inner join of `rows` with one row per `key` from `groups`, safe for a key
    that holds any share of the rows.

    Keys with more than `n_rows` / 1000 rows number fewer than 1000, whatever the
    data: that proven bound lets their groups be broadcast, and their rows never
    meet in one task. All other keys are joined by a shuffle in which no key has
    more than a thousandth of the rows.
    """
    limit = max(1000, n_rows // 1000)
    heavy = groups.where(F.col(size) > limit)
    light = groups.where(F.col(size) <= limit)
    tagged = rows.join(F.broadcast(heavy.select(key, F.lit(True).alias("_heavy"))), key, "left")
    hot = (tagged.where(F.col("_heavy")).drop("_heavy").join(F.broadcast(heavy), key))
    rest = (tagged.where(F.col("_heavy").isNull()).drop("_heavy")
            .join(light.hint("merge"), key))
    return hot.unionByName(rest)



def hash_filter(ids: DataFrame, cols: list[str], bits: int) -> DataFrame:
    """A Bloom filter with one hash over `cols` as rows of 64 bits: at most
    bits / 64 rows, so it may be broadcast whatever the data."""
    at = F.pmod(F.xxhash64(*cols), F.lit(bits))
    return (ids.select(at.alias("p")).groupBy(F.shiftright("p", 6).alias("_word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("_mask")))


def repeated_filter(rows: DataFrame, cols: list[str], bits: int) -> DataFrame:
    """As `hash_filter`, of the positions that more than one row marks."""
    at = F.pmod(F.xxhash64(*cols), F.lit(bits))
    twice = rows.select(at.alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (twice.groupBy(F.shiftright("p", 6).alias("_word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("_mask")))


def marked(rows: DataFrame, words: DataFrame, cols: list[str], bits: int, flag: str) -> DataFrame:
    """`rows` with `flag`: false if the row's position is surely not in the filter."""
    at = F.pmod(F.xxhash64(*cols), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    hit = F.coalesce(F.col("_mask").bitwiseAND(bit), F.lit(0)) != 0
    return (rows.join(F.broadcast(words), F.shiftright(at, 6) == F.col("_word"), "left")
            .withColumn(flag, hit).drop("_word", "_mask"))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to
    any more. It waits for a collection on the driver, which may come only when
    the disks are full. What the driver's JVM has freed goes back to the system."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_driver(spark)


def trim_driver(spark: SparkSession) -> bool:
    """Have the driver's JVM return the memory that it has freed off its heap: compiler and
    collector leave it with the C library, which keeps it beside what later steps take.
    False where the JVM has no such command (Java 17.0.9 or later, glibc)."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    find = jvm.java.lang.Class.forName
    kinds, args = new_array(jvm.java.lang.Class, 4), new_array(jvm.java.lang.Object, 4)
    for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = find(kind)
    args[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    args[1] = "systemTrimNativeHeap"
    try:        # the server's class is not public, its interface's method is
        find("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(
            jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JJavaError:
        return False
    return True


def heap_share(spark: SparkSession) -> float:
    """The share of the heap's limit that the driver has taken from the system."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return heap.totalMemory() / heap.maxMemory()


def settle(spark: SparkSession) -> None:
    """`release` after a step that has grown the driver's heap beyond half its limit. The
    plans of many small steps leave little behind that is in use, but the heap would grow
    to its limit before it is collected, beside the memory that the driver has off the heap."""
    if heap_share(spark) > 0.5:
        release(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The session's reliable checkpoint, with the driver's heap kept small."""
    out = session.cut_lineage(df)
    settle(df.sparkSession)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder, read again. It is
    deleted when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    settle(spark)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["cut_lineage", "prepare", "table", "docs_of", "fold", "map_batches", "give_back", "chunks",
           "splitmix64", "attach_by_key", "hash_filter", "repeated_filter", "marked", "written", "release",
           "trim_driver", "heap_share", "settle",
           "ARROW_BATCH_BYTES", "CHUNK_CHARS", "SPACE_CLASS"]

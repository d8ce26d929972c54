"""Exact deduplication with two-pass Bloom filtering, on DataFrame functions only.

Texts are equal when they are identical without white space. The texts are read
once, into a digest table (id, length, SHA-256 of the normalised text), written
to the shared checkpoint folder. Then

1. first pass: every digest marks `HASHES` positions of a Bloom filter, and the
   positions marked more than once are gathered (counted before the shuffle, so a
   text that a third of the rows share sends one row a task);
2. second pass: a digest all of whose positions were marked more than once may be
   repeated. Only those rows shuffle; all others pass straight through as groups
   of one.

The filter's size follows the row count up to `MAX_BITS`, which bounds the
broadcast (a row of 64 bits for each word that has a repeated position). Beyond
that bound the filter lets more single rows through to the shuffle; the result
does not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_by_key, cut_lineage, docs_of, prepare

HASHES = 2
MAX_BITS = 1 << 27


def digest_table(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_chars`, `text_sha256` (of the normalised text), and a row
    number `uid`, checkpointed."""
    df = docs_of(docs)
    norm = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")
    return cut_lineage(df.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                                 F.sha2(norm, 256).alias("text_sha256"),
                                 F.monotonically_increasing_id().alias("uid")))


def _positions(bits: int) -> list:
    """`HASHES` positions in the filter, from separate parts of one 64-bit hash."""
    h = F.xxhash64("text_sha256")
    return [F.shiftrightunsigned(h, 32 * i).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def repeated_words(digests: DataFrame, bits: int) -> DataFrame:
    """First pass: the filter's words (`word`, `mask`) with the positions that
    were marked more than once. At most bits / 64 rows."""
    pos = digests.select(F.explode(F.array(*_positions(bits))).alias("pos"))
    twice = pos.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (twice.groupBy(F.shiftright("pos", 6).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(pos & 63 as int)))").alias("mask")))


def maybe_repeated(digests: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """Second pass: adds `maybe`, true unless the digest surely occurs once."""
    out, hits = digests, []
    for i, p in enumerate(_positions(bits)):
        w = F.broadcast(words.select(F.col("word").alias(f"_w{i}"), F.col("mask").alias(f"_m{i}")))
        out = out.join(w, F.shiftright(p, 6) == F.col(f"_w{i}"), "left")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                              p.bitwiseAND(F.lit(63)).cast("int"))
        hits.append(F.coalesce(F.col(f"_m{i}").bitwiseAND(bit), F.lit(0)) != 0)
    keep = hits[0]
    for h in hits[1:]:
        keep = keep & h
    return out.withColumn("maybe", keep).select(*digests.columns, "maybe")


def exact_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: `doc_id`, `keep_id`, `group_size`, `kept`,
    `text_sha256`, `n_chars`.

    Null counts as empty, so null, empty and all-white texts are one group. Of
    equal texts the row with the most code points stays, then the smallest
    `doc_id` (null ids last), then any one of rows that are alike in both.
    """
    prepare(docs.sparkSession)
    digests = digest_table(docs)
    n = digests.count()
    bits = 1 << 16
    while bits < 16 * n and bits < max_bits:
        bits *= 2
    words = cut_lineage(repeated_words(digests, bits))
    marked = maybe_repeated(digests, words, bits)
    once = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "n_chars")
    again = marked.where("maybe").drop("maybe")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("uid")))
    groups = (again.groupBy("text_sha256")
              .agg(F.count(F.lit(1)).alias("group_size"), best.alias("b"))
              .select("text_sha256", "group_size", F.col("b.doc_id").alias("keep_id"),
                      F.col("b.uid").alias("keep_uid")))
    rest = attach_by_key(again, groups, "text_sha256", "group_size", n).select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
        "text_sha256", "n_chars")
    return once.unionByName(rest)

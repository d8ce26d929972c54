"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed from left to right into the shortest phrases not met before
(LZ78). Texts with much in common share many phrases, as they would share a
compressor's dictionary, so the Jaccard likeness of two phrase sets estimates
how well one text compresses the other. The set is kept as a minimum-hash
signature: `LANES` independent hash orders, 16 bits of each minimum, written in
hexadecimal. The likeness of two signatures is the share of equal lanes.

Equal texts have equal fingerprints. An empty text has no phrase; its lanes are
all ones, which is alike (1.0) to another empty text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, docs_of, map_batches, splitmix64

LANES = 128
#: A phrase is closed at this length. It takes over eight million code points of
#: one repeated pattern to reach it; it keeps parsing linear beyond.
MAX_PHRASE = 4096
_MUL = np.array([x | 1 for x in splitmix64(LANES, 11)], np.uint64)
_BASE = np.uint64(splitmix64(1, 12)[0] | 1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_POW = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POW
    while len(_POW) < n:
        with np.errstate(over="ignore"):
            step = _POW[-1] * _BASE
            _POW = np.concatenate([_POW, _POW * step])
    return _POW


def lz_parse(text: str, phrases: dict[str, None], open_phrase: str = "") -> str:
    """Add the phrases of `text` to `phrases` (in order), beginning inside
    `open_phrase`; returns the phrase that is still open at the end."""
    p = open_phrase
    if len(text) + sum(map(len, phrases)) < MAX_PHRASE * MAX_PHRASE // 2:
        for c in text:
            p += c
            if p not in phrases:
                phrases[p] = None
                p = ""
        return p
    for c in text:
        p += c
        if p not in phrases:
            phrases[p] = None
            p = ""
        elif len(p) >= MAX_PHRASE:
            p = ""
    return p


def _minima(phrases: list[str]) -> np.ndarray:
    """Per lane the smallest hash of a phrase, as 64 bits."""
    out = np.full(LANES, _NONE)
    for lo in range(0, len(phrases), 4096):
        part = phrases[lo:lo + 4096]
        code = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        size = np.fromiter(map(len, part), np.int64, len(part))
        start = np.cumsum(size) - size
        with np.errstate(over="ignore"):
            at = np.arange(len(code)) - np.repeat(start, size)
            h = np.add.reduceat((code + np.uint64(1)) * _powers(int(size.max()))[at], start)
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            for at in range(0, len(h), 512):       # a block that stays in the cache
                np.minimum(out, (h[at:at + 512, None] * _MUL).min(0), out=out)
    return out


def _signature(minima: np.ndarray) -> np.ndarray:
    # The upper bits of a minimum are near zero in any long text; take lower ones.
    return ((minima >> np.uint64(16)) & np.uint64(0xFFFF)).astype(">u2")


def lz_signature(text: str) -> np.ndarray:
    phrases: dict[str, None] = {}
    lz_parse(text, phrases)
    return _signature(_minima(list(phrases)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """`doc_id` and `fingerprint` of every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "fingerprint": pa.array([lz_signature(t).tobytes().hex()
                                         for t in b.column("text").to_pylist()], pa.string())})

    return map_batches(docs_of(docs), run, "doc_id long, fingerprint string")


def with_next_row(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Rows laid out so that each row's next row (by descending `doc_id`, null
    ids last, the last row followed by the first) comes directly after it.

    Rows go to blocks of neighbouring ids (quantiles of the ids, so that blocks
    are even). The first row of a block is copied to the end of the block before
    it, marked `edge`. One shuffle moves the texts; no task holds more than its
    share and there is no global sort. Ties on `doc_id` are ordered by a hash of
    the text; equal rows are interchangeable.
    """
    spark = docs.sparkSession
    df = docs_of(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = blocks or 4 * parts
    cuts = df.select(F.col("doc_id").cast("double").alias("x")).approxQuantile(
        "x", [i / n for i in range(1, n)], 0.2 / n)
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    keyed = Bucketizer(splits=splits, inputCol="_x", outputCol="_b", handleInvalid="keep").transform(
        df.withColumn("_x", F.col("doc_id").cast("double")))
    # A null id goes to the last block of a descending order.
    df = keyed.select("doc_id", "text", F.when(F.col("doc_id").isNull(), -1)
                      .otherwise(F.col("_b").cast("int")).alias("block"))
    heads = sorted((r["block"], r["id"]) for r in
                   df.groupBy("block").agg(F.max("doc_id").alias("id")).collect())  # a row a block
    to = [(heads[(i + 1) % len(heads)][0], h[0], h[1]) for i, h in enumerate(heads)]
    edge = spark.createDataFrame(to or [(0, 0, 0)], "to int, of int, id long")
    joined = df.join(F.broadcast(edge), (F.col("block") == F.col("of"))
                     & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    here = F.struct(F.col("block").alias("block"), F.lit(0).alias("edge"))
    there = F.struct(F.col("to").alias("block"), F.lit(1).alias("edge"))
    out = joined.select("doc_id", "text", F.explode(
        F.when(F.col("to").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("_p"))
    return (out.select("doc_id", "text", "_p.block", "_p.edge")
            .repartition(parts, "block")
            .sortWithinPartitions("block", "edge", F.col("doc_id").desc_nulls_last(),
                                  F.xxhash64("text")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint each text and an edited copy of it, and compare.

    The edited copy replaces the last floor(n/2) code points by the first as many
    (or all) of the next row's text (see `with_next_row`). Returns `doc_id`,
    `n_chars`, `edited` (the edited text), `fingerprint`, `edited_fingerprint`,
    `near_edited` and `near_next` (likeness to the edited copy and to the next
    row's text). The kept first half is parsed once for both texts.
    """
    schema = ("doc_id long, n_chars long, edited string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def parse(text: str):
        keep = len(text) - len(text) // 2
        phrases: dict[str, None] = {}
        rest = lz_parse(text[:keep], phrases)
        half = dict(phrases)
        first = _minima(list(phrases))
        lz_parse(text[keep:], phrases, rest)
        own = np.minimum(first, _minima(list(phrases)[len(half):]))
        return half, rest, first, _signature(own)

    def emit(row, nxt_text: str, nxt_sig: np.ndarray):
        doc_id, _, text, (half, rest, first, sig) = row
        cut = len(text) // 2
        tail = nxt_text[:cut]
        size = len(half)
        lz_parse(tail, half, rest)
        esig = _signature(np.minimum(first, _minima(list(half)[size:])))
        return (doc_id, len(text), text[:len(text) - cut] + tail, sig.tobytes().hex(),
                esig.tobytes().hex(), likeness(sig, esig), likeness(sig, nxt_sig))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        names = [f.split()[0] for f in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                     # the row that waits for its next one
        for b in batches:
            out, size = [], 0
            for doc_id, text, block, edge in zip(*(b.column(c).to_pylist()
                                                   for c in ("doc_id", "text", "block", "edge"))):
                if held is None and edge:
                    continue                            # a second copy of an edge
                row = (doc_id, block, text, parse(text))
                if held is not None and held[1] == block:
                    out.append(emit(held, text, row[3][3]))
                    size += len(held[2])
                held = None if edge else row
                if size > 4_000_000:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

    return map_batches(with_next_row(docs), run, schema)


__all__ = ["LANES", "lz_parse", "lz_signature", "likeness", "fingerprint_documents",
           "fingerprint_edits", "with_next_row", "cut_lineage"]

"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it
as Parquet in the shared checkpoint folder and hands it to the next stage. All
stages but the last return the columns of `documents`, with `n_chars` kept true.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm import line_dedup, ngram_join, packing, secrets, toxicity
from feedspark.llm.common import prepare, table, written


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line is similar to go; every document stays."""
    return _measured(line_dedup.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return ngram_join.keep_one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _measured(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, placed in sequences."""
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: The stages are learned, tokenised or iterative: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table, and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, exact_dedup, fingerprint, language, line_dedup, merkle,
               ngram_join, packing, passages, secrets, toxicity)
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op3_exact_dedup_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op4_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.round_trip(table(spark, sf_dir, "documents"), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(joined, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(
        ":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return out.select("conv_id", "perspective", "block", "n_turns", "rendered",
                      spans.alias("mask_spans"))


@query
def op6_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return out.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


@query
def op10_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_languages(docs, fold("doc_id", 4) != 2)
    return language.predict_languages(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = ngram_join.JoinParams(words=3, num=90, den=100)
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), params).select(
        "doc_id", "n_shingles", "component_id")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_decisions(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                      F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = passages.fit_quality(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return passages.score_quality(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))

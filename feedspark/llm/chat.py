"""Perspective rotation of multi-party dialogues, on DataFrame functions only.

Every participant of a dialogue is in turn the assistant: its turns are rendered
as the assistant's, those of the others as a named user's, and the mask covers
the assistant's contents. System turns are rendered as such in every perspective
and are no participant.

A dialogue is rendered in blocks of `block_turns` turns, in order, so that a
dialogue with any number of turns never meets in one task: nearly all dialogues
are one block. Blocks are cut by a distributed row index (range partitioned), so
turns that repeat or share a number are spread as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rowindex import with_row_index
from .common import attach_by_key, prepare

SYSTEM = "system"
BLOCK_TURNS = 64


def rotate_perspectives(conversations: DataFrame, block_turns: int = BLOCK_TURNS,
                        system: str = SYSTEM) -> DataFrame:
    """One row per dialogue, perspective and block: `conv_id`, `perspective`,
    `block` (from 0), `n_turns`, `rendered`, `mask` (array of struct start, end:
    code points of the assistant's contents in `rendered`, end exclusive).

    A turn is rendered as a header line and its content with a line feed:
    ``<|assistant|>``, ``<|user name=...|>`` or ``<|system|>``. Turns are in
    order of `turn` (null first), then speaker, then text; repeated rows are
    repeated turns. A null `conv_id` is a dialogue of its own; a null speaker is
    the participant "unknown"; a null text is empty (its mask span is empty). A
    dialogue of system turns only has no perspective and gives no row.
    """
    prepare(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    indexed = with_row_index(turns, [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
                                     F.col("speaker"), F.col("text")])
    indexed = indexed.withColumn("_k", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")))
    talks = indexed.groupBy("_k").agg(
        F.min("idx").alias("first"), F.count(F.lit(1)).alias("_n"),
        F.collect_set(F.when(F.col("speaker") != system, F.col("speaker"))).alias("people"))
    placed = attach_by_key(indexed, talks, "_k", "_n", indexed.count())
    block = F.floor((F.col("idx") - F.col("first")) / block_turns).cast("long")
    each = (placed.withColumn("block", block).groupBy("conv_id", "block")
            .agg(F.array_sort(F.collect_list(F.struct("idx", "speaker", "text"))).alias("turns"),
                 F.first("people").alias("people"))
            .withColumn("perspective", F.explode("people")))
    me = F.col("perspective")
    parts = F.transform("turns", lambda t: F.struct(
        F.when(t["speaker"] == me, F.lit("<|assistant|>\n"))
        .when(t["speaker"] == system, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), t["speaker"], F.lit("|>\n"))).alias("head"),
        t["text"].alias("text"), (t["speaker"] == me).alias("mine")))
    each = each.withColumn("_p", parts)
    kind = "struct<at:int,out:array<struct<start:int,end:int>>>"
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("out")).cast(kind)

    def step(s, p):
        a = s["at"] + F.length(p["head"])
        b = a + F.length(p["text"])
        span = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + 1).alias("at"), F.when(p["mine"], F.concat(s["out"], span))
                        .otherwise(s["out"]).alias("out")).cast(kind)

    return each.select(
        "conv_id", "perspective", "block", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["text"], F.lit("\n"))), "")
        .alias("rendered"), F.aggregate("_p", start, step)["out"].alias("mask"))


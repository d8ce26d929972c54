"""Dumps of any size, cut in parallel.

A dump is one JSON text: an array, or an object that holds one. As one row it would be
one task's work and one value's memory. Here the file is read in pieces between commas,
by as many tasks as its bytes ask for, and a structural scan finds which commas separate
elements:

1. Each task reads its pieces in order and joins them to chunks of about a quarter of a
   megabyte, stored with the number of quotes, and the change of bracket depth both for
   a chunk that begins outside a string and for one that begins inside.
2. Running sums of the chunks, one row of numbers each, tell each chunk its real state at
   its start.
3. A comma outside strings at depth 1 ends a member (or an element of a bare array), at
   depth 2 an element of a member's array. A chunk is cut at such commas where it lies; only
   what crosses a chunk's edge is shuffled.

No row is longer than a chunk or one element, and a text is written twice. Nothing is
lost silently: `split_dump` returns rejects as rows beside the ids, from the same pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DUMP_ARRAY_FIELDS, ID_FIELDS
from ..functions.ids import is_valid_id, with_element_id
from ..functions.json import with_strict_parse
from ..functions.num import keep_rows
from ..session import cut_lineage

#: Characters of a rejected document that its reject row shows.
SHOWN = 200
_BLANK = " \t\n\r"


#: Bytes of text that one row of the scan holds (more only if one piece is longer).
CHUNK_BYTES = 1 << 18

#: Bytes of one batch that is sent to a Python worker.
BATCH_BYTES = 8 << 20

#: Rows of a table with one row a chunk or file that may be sent to every task.
BROADCAST_ROWS = 100_000


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: where its quotes, brackets and commas are, the running number
    of quotes, and the running depth of a text that begins outside and inside a string.
    An escaped sign counts as none, but a comma always ends a piece."""
    data = re.sub(rb"\\[^,]", b"__", text)
    sign = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(_SIGN[sign])
    sign = sign[at]
    quotes = np.cumsum(sign == 34)
    step = _STEP[sign]
    return at, quotes, np.cumsum(np.where(quotes & 1, 0, step)), np.cumsum(np.where(quotes & 1, step, 0))


_SIGN, _STEP = np.zeros(256, bool), np.zeros(256, np.int64)
for _c, _d in ((b'"', 0), (b",", 0), (b"[", 1), (b"{", 1), (b"]", -1), (b"}", -1)):
    _SIGN[_c[0]], _STEP[_c[0]] = True, _d


def _chunks(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """The files' text in chunks of whole pieces (what lies between commas): `_block` (start
    of the file block) and `_mid` give their order, `_t` is the text, `_q` its quotes, `_d0`
    and `_d1` its change of depth if it begins outside or inside a string, `_first` its
    first piece's beginning."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    raw = spark.read.option("lineSep", ",").text(path)
    raw = raw.select(*keep, F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("_block"), F.col("value").cast("binary").alias("_t"))
    schema = T.StructType([*raw.schema.fields, *T._parse_datatype_string("_q long, _d0 long, _d1 long, _first binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, size = None, [], 0

        def close() -> pa.RecordBatch:
            text = b",".join(held)
            _, quotes, d0, d1 = _marks(text)
            ends = [int(x[-1]) if len(x) else 0 for x in (quotes, d0, d1)]
            return pa.RecordBatch.from_arrays(
                [*head, *(pa.array([x], t) for x, t in zip((text, *ends), (pa.binary(), *[pa.int64()] * 3))),
                 pa.array([held[0]], pa.binary())], names=schema.names)

        for b in batches:
            if not b.num_rows:
                continue
            file, block = b.column("file"), b.column("_block")
            new = np.flatnonzero(np.r_[True, pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
                                       .to_numpy(zero_copy_only=False)])
            for lo, hi in zip(new, [*new[1:], b.num_rows]):
                mine = [b.column(c).slice(lo, 1) for c in (*keep, "file", "_block")]
                if held and any(x[0] != y[0] for x, y in zip(mine, head)):
                    yield close()
                    held, size = [], 0
                head = mine
                for piece in b.column("_t").slice(lo, hi - lo).to_pylist():
                    held.append(piece)
                    size += len(piece) + 1
                    if size >= CHUNK_BYTES:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    rows = raw.mapInArrow(run, schema).withColumn("_mid", F.monotonically_increasing_id())
    return cut_lineage(rows)


def _before(by: list[str], *order: str):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _small(df: DataFrame) -> DataFrame:
    """A table with one row a chunk or file, to be joined: sent to every task unless it is long."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _parts(spark: SparkSession, path: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The parts between cuts of every chunk (`_m` and `_e`: cuts at member and element depth
    before it in the chunk, `_text`, `_depth` after it), and one row a chunk (`_mid`) with its
    state at the end (`_in`, `_depth`), its cuts, and the cuts of the file before it (`_m0`, `_e0`)."""
    local = _chunks(spark, path, keep)
    place = ["_block", "_mid"]
    before = _before(["file"], *place)
    totals = local.select("file", *place, "_q", "_d0", "_d1", "_first")
    carry = totals.withColumn("_cin", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2)
    moved = F.when(F.col("_cin") == 0, F.col("_d0")).otherwise(F.col("_d1"))
    carry = carry.withColumn("_cd", F.coalesce(F.sum(moved).over(before), F.lit(0)))
    root = F.substring(F.ltrim(F.regexp_replace(F.first(F.col("_first").cast("string")).over(
        Window.partitionBy("file").orderBy(*place)), r"^[﻿\s]+", "")), 1, 1)
    carry = _small(carry.select("_mid", "_cin", "_cd", root.alias("_root")))
    state = local.drop("_q", "_d0", "_d1", "_first").join(carry, "_mid")
    state = state.select("_mid", "_root", "_cin", "_cd", "_t")
    schema = T._parse_datatype_string(
        "_mid long, _m long, _e long, _cuts byte, _closed int, _in boolean, _depth long, _text binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1)
                data, root = row.column("_t")[0].as_py(), row.column("_root")[0].as_py()
                inside, depth = row.column("_cin")[0].as_py(), row.column("_cd")[0].as_py()
                at, quotes, d0, d1 = _marks(data)
                # a comma is a piece's end, and so is the chunk's end
                end = np.flatnonzero(np.frombuffer(data, np.uint8)[at] == 44)
                pos = np.r_[at[end], len(data)]
                end = np.r_[end, len(at) - 1] if len(at) else np.array([-1])
                q = inside + np.where(end >= 0, quotes[end] if len(at) else 0, 0)
                level = depth + np.where(end >= 0, (d1 if inside else d0)[end] if len(at) else 0, 0)
                out = q % 2 == 0
                one, two = out & (level <= 1), out & (level == 2) & (root == "{")
                cut = np.flatnonzero(one | two)
                if not len(cut) or cut[-1] != len(pos) - 1:
                    cut = np.r_[cut, len(pos) - 1]              # an open part
                m, e = np.cumsum(one) - one, np.cumsum(two) - two
                start = np.r_[0, pos[cut[:-1]] + 1]
                n = len(cut)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.column("_mid")[0].as_py()] * n, pa.int64()), pa.array(m[cut], pa.int64()), pa.array(e[cut], pa.int64()),
                     pa.array((one + 2 * two)[cut], pa.int8()), pa.array([int((one & (level <= 0)).sum())] * n, pa.int32()),
                     pa.array(~out[cut]), pa.array(level[cut], pa.int64()),
                     pa.array([data[i:j] for i, j in zip(start, pos[cut])], pa.binary())], names=schema.names)

    parts = cut_lineage(state.mapInArrow(run, schema))
    ends = parts.groupBy("_mid").agg(
        F.max(F.struct("_m", "_e", "_cuts", "_in", "_depth")).alias("_z"), F.max("_closed").alias("_closed"))
    ends = ends.join(local.select(*keep, "file", *place, F.left(F.col("_first").cast("string"), F.lit(SHOWN)).alias("_first")), "_mid").join(
        carry.select("_mid", "_root"), "_mid")
    m1, e1 = (F.col("_z._cuts") == 1).cast("long"), (F.col("_z._cuts") == 2).cast("long")
    numbers = [F.coalesce(F.sum(F.col(f"_z.{a}") + b).over(before), F.lit(0)).alias(c)
               for a, b, c in (("_m", m1, "_m0"), ("_e", e1, "_e0"))]
    return parts, cut_lineage(ends.select("*", *numbers))


def _elements(parts: DataFrame, ends: DataFrame, keep: list[str]) -> DataFrame:
    """`file`, `member`, `element` (numbers in the file), `text`, `_depth` after it, `_root`."""
    at = _small(ends.select(*keep, "file", "_block", "_mid", "_root", "_m0", "_e0", F.col("_z._m").alias("_mz"), F.col("_z._e").alias("_ez")))
    parts = parts.join(at, "_mid")
    edge = ((F.col("_m") == 0) & (F.col("_e") == 0)) | ((F.col("_m") == F.col("_mz")) & (F.col("_e") == F.col("_ez")))
    parts = parts.select(*keep, "file", "_block", "_mid", "_root", F.col("_text").cast("string").alias("text"), "_depth",
                         (F.col("_m0") + F.col("_m")).alias("member"), (F.col("_e0") + F.col("_e")).alias("element"),
                         edge.alias("_edge"))
    inner = parts.where(~F.col("_edge")).drop("_block", "_mid", "_edge")
    crossing = (parts.where("_edge").groupBy("file", "member", "element", "_root", *keep)
                .agg(F.array_sort(F.collect_list(F.struct("_block", "_mid", "text", "_depth"))).alias("_x"))
                .select(*keep, "file", "_root", F.array_join(F.col("_x.text"), ",").alias("text"),
                        F.element_at("_x", -1)["_depth"].alias("_depth"), "member", "element"))
    return inner.unionByName(crossing)


def _without_end(text: Column, depth: Column, ends: dict[int, str]) -> Column:
    """`text` less the closing brackets that bring the depth down to `depth`; as it is if
    it does not end with them (the strict parse then refuses it)."""
    found = text
    for level, closing in ends.items():
        rest = F.rtrim(text, F.lit(_BLANK))
        for c in reversed(closing):
            rest = F.rtrim(F.when(rest.endswith(c), F.left(rest, F.length(rest) - 1)).otherwise(rest), F.lit(_BLANK))
        found = F.when(depth == level, rest).otherwise(found)
    return found


def split_dump(spark: SparkSession, path: str, fields=ID_FIELDS, array_fields=DUMP_ARRAY_FIELDS,
               keep: list[str] | None = None) -> DataFrame:
    """`keep` (partition columns), `file`, `element` (its number in the array), `id`, `reason`, `text`
    of the dump files under `path`.

    A row with `reason` NULL is an element with a valid id, found as in `parse_dump`; the
    array is the file's own, or that of the first of `array_fields` that holds one (of a
    repeated key the last value counts). Other rows are rejects: ``not parsed`` with the
    whole text of one element; ``unbalanced`` (it ends in a string or a bracket),
    ``not one value`` and ``no array`` for a file that gives no elements, with its beginning.
    Elements that hold no valid id give no row, as elsewhere. One bad element rejects
    itself, not its file. An empty file gives nothing."""
    keep = keep or []
    parts, ends = _parts(spark, path, keep)
    place = F.struct("_block", "_mid")
    files = ends.groupBy("file").agg(
        F.max_by(F.struct("_z", "_root"), place).alias("_l"), F.sum("_closed").alias("_closed"),
        F.min_by("_first", place).alias("_first"), F.first("_root").alias("_root"))
    shut = F.col("_l._z._depth") == 0
    # cuts at depth 0: only the last piece of a file may end there
    early = F.col("_closed") - F.when(shut & ~F.col("_l._z._in"), F.lit(1)).otherwise(F.lit(0)) > 0
    blank = (F.col("_root") == "") & (F.col("_closed") <= 1)
    bad = (F.when(blank, F.lit("blank")).when(F.col("_l._z._in") | (F.col("_l._z._depth") > 0), F.lit("unbalanced"))
           .when(early | (F.col("_l._z._depth") < 0), F.lit("not one value"))
           .when(~F.col("_root").isin("[", "{"), F.lit("no array")))
    files = cut_lineage(files.select("file", bad.alias("_bad"), F.left("_first", F.lit(SHOWN)).alias("_shown")))

    el = _elements(parts, ends, keep)
    # members of an object: key and kind from their first element
    spans = _small(el.where(F.col("_root") == "{").groupBy("file", "member")
                   .agg(F.min("element").alias("_e0"), F.max("element").alias("_ez")))
    head = spans.join(el.where(F.col("_root") == "{").select(
        "file", "member", F.col("element").alias("_e0"), F.left("text", F.lit(1000)).alias("_h")), ["file", "member", "_e0"])
    key = r'^[﻿\s]*\{?\s*"([^"]*)"\s*:\s*\['
    named = head.select("file", "member", "_e0", "_ez", F.regexp_extract("_h", r'^[﻿\s]*\{?\s*"([^"]*)"\s*:', 1).alias("_key"),
                        F.col("_h").rlike(key).alias("_array")).where(F.col("_key").isin(*array_fields))
    rank = F.coalesce(*[F.when(F.col("_key") == f, F.lit(i)) for i, f in enumerate(array_fields)])
    latest = named.groupBy("file", "_key").agg(F.max_by(F.struct("member", "_e0", "_ez", "_array"), "member").alias("_n"))
    chosen = (latest.where("_n._array").groupBy("file").agg(F.min(F.struct(rank.alias("_r"), "_n")).alias("_c"))
              .select("file", "_c._n.member", F.col("_c._n._e0").alias("_e0"), F.col("_c._n._ez").alias("_ez")))
    bare = (el.where(F.col("_root") == "[").groupBy("file").agg(F.max("member").alias("_ez"))
            .select("file", F.lit(None).cast("long").alias("member"), F.lit(0).cast("long").alias("_e0"), "_ez"))
    arrays = cut_lineage(chosen.unionByName(bare))
    # one row a file, shared by all its elements
    good = _small(files.where(F.col("_bad").isNull()).join(arrays, "file", "left"))
    lost = files.join(arrays, "file", "left").select(
        "file", F.coalesce("_bad", F.when(F.col("_ez").isNull(), F.lit("no array"))).alias("reason"),
        F.col("_shown").alias("text")).where("reason IS NOT NULL AND reason != 'blank'")
    mine = el.withColumnRenamed("member", "_member").join(
        good.select("file", F.col("member").alias("_want"), "_e0", "_ez").where("_ez IS NOT NULL"), "file")
    mine = mine.where(F.col("_want").isNull() | (F.col("_want") == F.col("_member")))
    place = F.when(F.col("_want").isNull(), F.col("_member")).otherwise(F.col("element"))
    mine = mine.select(*keep, "file", "_want", (place - F.col("_e0")).alias("element"), (F.col("_ez") - F.col("_e0")).alias("_last"),
                       "text", "_depth")
    start = F.when(F.col("_want").isNull(), F.regexp_replace("text", r"^[﻿\s]*\[", "")).otherwise(
        F.regexp_replace("text", key, ""))
    begun = mine.withColumn("text", F.when(F.col("element") == 0, start).otherwise(F.col("text")))
    ended = F.when(F.col("_want").isNull(), _without_end(F.col("text"), F.col("_depth"), {0: "]"})).otherwise(
        _without_end(F.col("text"), F.col("_depth"), {1: "]", 0: "]}"}))
    done = begun.withColumn("text", F.when(F.col("element") == F.col("_last"), ended).otherwise(F.col("text")))
    done = keep_rows(done, ~((F.col("_last") == 0) & (F.trim(F.col("text"), F.lit(_BLANK)) == "")))      # an empty array
    parsed = with_strict_parse(done.select(*keep, "file", "element", "text"), "text", "_v")
    rows = with_element_id(parsed, "_v", fields)
    rows = rows.withColumn("reason", F.when(F.col("_v").isNull(), F.lit("not parsed")))
    rows = keep_rows(rows.drop("_v"), F.col("reason").isNotNull() | is_valid_id(F.col("id")))
    rows = rows.select(*keep, "file", "element", F.when(F.col("reason").isNull(), F.col("id")).alias("id"), "reason",
                       F.when(F.col("reason").isNotNull(), F.col("text")).alias("text"))
    none = [F.lit(None).alias(c) for c in keep]
    return rows.unionByName(lost.select(*none, "file", F.lit(None).cast("long").alias("element"),
                                        F.lit(None).cast("string").alias("id"), "reason", "text"))


def read_dump_ids(spark: SparkSession, path: str, fields=ID_FIELDS, array_fields=DUMP_ARRAY_FIELDS,
                  keep: list[str] | None = None) -> DataFrame:
    """The valid ids of `split_dump`: `keep`, `file`, `element`, `id`."""
    return split_dump(spark, path, fields, array_fields, keep).where(F.col("reason").isNull()).drop("reason", "text")

"""Landed feed payloads to id rows.

Every parser takes a DataFrame with a text column `value` -- what
`spark.read.text` returns -- so the same code serves files in a landing
folder, a stream of files, and text derived in Spark. `read_*` wrappers do
the file read. Parsing stays in JVM expressions (Variant, regex); nothing
goes through Python rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (BARE_ID_MAX_LEN_EXCL, BARE_ID_MIN_LEN_EXCL, DUMP_ARRAY_FIELDS,
                         ID_FIELDS, ID_FIELDS_CSV, ID_SENTINELS, SSE_DATA_PREFIX, SSE_DONE,
                         SSE_ID_GATE_FIELDS)
from ..functions.ids import is_valid_id, with_element_id, with_id_pick
from ..functions.json import field_path, truthy_of, vget, vkind, vtext, with_strict_parse
from ..functions.num import keep_rows
from ..session import cut_lineage


def _bare_ok(t: Column) -> Column:
    n = F.length(t)
    return (n > BARE_ID_MIN_LEN_EXCL) & (n < BARE_ID_MAX_LEN_EXCL)


def _js_trim(col: Column) -> Column:
    """Trim whitespace the way JavaScript's trim() does (not only spaces)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def _parsed(df: DataFrame, text: str, keep: list[str], raw: str = "_raw") -> DataFrame:
    """Project `keep`, `text` as `raw`, its strict parse `_v` and the kind `_k`
    (two projections, so the parse runs once per row)."""
    df = with_strict_parse(df.select(*keep, F.col(text).alias(raw)), raw, "_v")
    return df.withColumn("_k", vkind(F.col("_v")))


#: Documents of more bytes are not tried as one Variant (its limit is near 128 MB).
WHOLE_BYTES = 32 << 20
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _documents(text: DataFrame, keep: list[str], fields: str) -> DataFrame:
    """`_parsed` whole documents. A document that is no Variant as a whole (too
    large) is cut into its parts, each a Variant of its own: `_o` holds the
    `fields` of an object, `_a` the elements of an array, both NULL otherwise.
    Of a repeated key the last value counts, as in JavaScript."""
    raw = F.col("value")
    p = text.select(*keep, raw.alias("_raw"), F.when(F.octet_length(raw) <= WHOLE_BYTES, raw).alias("_whole"))
    p = _parsed(p, "_whole", [*keep, "_raw"], "_whole").drop("_whole", "_k")
    wrapped = F.concat(F.lit("["), F.col("_raw"), F.lit("]"))     # refuses junk after the document
    array = F.col("_raw").rlike(r"^\s*\[")

    def cut(test: Column, kind: str) -> Column:
        parts = F.from_json(wrapped, f"array<{kind}>", _STRICT)
        return F.when(F.col("_v").isNull() & test, F.when(F.size(parts) == 1, parts[0]))

    return p.withColumns({"_o": cut(~array, f"struct<{fields}>"), "_a": cut(array, "array<variant>")})


def _lost_reason() -> Column:
    parsed = F.col("_v").isNotNull() | F.col("_o").isNotNull() | F.col("_a").isNotNull()
    return F.when(parsed, "no array").otherwise("not parsed")


def _quarantine(p: DataFrame, keep: list[str], elements: Column) -> DataFrame:
    """The documents of `p` (`_documents`) that hold no array of elements, whole."""
    lost = F.col("_raw").isNotNull() & elements.isNull()
    return keep_rows(p, lost).select(*keep, _lost_reason().alias("reason"), F.col("_raw").alias("value"))


def _exploded(p: DataFrame, cols: list, elements: Column, rejects: bool) -> DataFrame:
    """`cols` and one element `_e` a row; with `rejects` also one row for each document
    that holds no array of elements, with `reason` and its whole `value`."""
    if not rejects:
        return p.select(*cols, F.explode(elements).alias("_e"))
    none = F.lit(None).cast("string")
    rows = F.coalesce(
        F.transform(elements, lambda e: F.struct(e.alias("e"), none.alias("reason"), none.alias("value"))),
        F.when(F.col("_raw").isNotNull(), F.array(F.struct(F.lit(None).cast("variant").alias("e"), _lost_reason().alias("reason"),
                                                           F.col("_raw").alias("value")))))
    return p.select(*cols, F.explode(rows).alias("_r")).select(
        "*", F.col("_r.e").alias("_e"), F.col("_r.reason").alias("reason"), F.col("_r.value").alias("value")).drop("_r")


def _valid_or_rejected(rows: DataFrame, rejects: bool, cols: list[str]) -> DataFrame:
    ok = is_valid_id(F.col("id"))
    if not rejects:
        return keep_rows(rows, ok).select(*cols)
    return keep_rows(rows, F.col("reason").isNotNull() | ok).select(*cols, "reason", "value")


# ----------------------------------------------------------- page envelopes

_PAGE_FIELDS = "data array<variant>, hasMore variant, nextCursor variant, pagination variant"


def _page_events() -> Column:
    return F.coalesce(F.try_variant_get(F.col("_v"), "$.data", "array<variant>"), F.col("_o.data"))


def page_quarantine(text: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`keep`, `reason` (``not parsed`` or ``no array``) and the whole `value` of
    every page from which `parse_pages` takes no events array. NULL texts are no pages."""
    keep = keep or []
    return _quarantine(_documents(text, keep, _PAGE_FIELDS), keep, _page_events())


def parse_pages(text: DataFrame, nested: bool = True, fields=ID_FIELDS,
                keep: list[str] | None = None, rejects: bool = False) -> DataFrame:
    """One row per event of every page, with the page's `has_more`
    and `next_cursor`, valid ids only. With `rejects` the pages that give no
    events array are rows too, with `reason` and `value` (NULL in event rows), from
    the same pass; `sinks.write_with_rejects` stores both at once.

    Nested reader: ``hasMore = pagination.hasMore ?? hasMore ?? false`` and
    the cursor likewise. Flat reader (``nested=False``): top-level fields only
    (NULL when a page carries only the nested form). Pages without a readable
    events array give no rows here; `page_quarantine` returns them.
    """
    keep = keep or []
    p = _documents(text, keep, _PAGE_FIELDS)

    def field(name: str, kind: str, part: str = "") -> Column:
        whole = F.try_variant_get(F.col("_v"), f"$.{part or name}" + (f".{name}" if part else ""), kind)
        return F.coalesce(whole, F.try_variant_get(F.col(f"_o.{part or name}"), f"$.{name}" if part else "$", kind))

    flat_more, flat_cur = field("hasMore", "boolean"), field("nextCursor", "string")
    if nested:
        more = F.coalesce(field("hasMore", "boolean", "pagination"), flat_more, F.lit(False))
        cur = F.coalesce(field("nextCursor", "string", "pagination"), flat_cur)
    else:
        more, cur = flat_more, flat_cur
    rows = _exploded(p, [*keep, more.alias("has_more"), cur.alias("next_cursor")], _page_events(), rejects)
    rows = with_id_pick(rows, "_e", fields, field_col=None, kind_col=None)
    return _valid_or_rejected(rows, rejects, [*keep, "id", "has_more", "next_cursor"])


def read_pages(spark: SparkSession, path: str, whole_file: bool = True,
               nested: bool = True) -> DataFrame:
    """Pages landed as files: one page per file (``whole_file``) or per line."""
    return parse_pages(spark.read.text(path, wholetext=whole_file), nested=nested)


# -------------------------------------------------------------------- dumps

def _dump_fields(array_fields) -> str:
    return ", ".join(f"`{f}` array<variant>" for f in array_fields)


def _dump_elements(array_fields) -> Column:
    v = F.col("_v")
    arrays = [F.try_variant_get(v, "$", "array<variant>"), F.col("_a")]
    arrays += [F.try_variant_get(v, field_path(f), "array<variant>") for f in array_fields]
    return F.coalesce(*arrays, *[F.col("_o").getField(f) for f in array_fields])


def dump_quarantine(text: DataFrame, keep: list[str] | None = None,
                    array_fields=DUMP_ARRAY_FIELDS) -> DataFrame:
    """As `page_quarantine`, of the dumps from which `parse_dump` takes no array."""
    keep = keep or []
    return _quarantine(_documents(text, keep, _dump_fields(array_fields)), keep, _dump_elements(array_fields))


def parse_dump(text: DataFrame, fields=ID_FIELDS, keep: list[str] | None = None,
               array_fields=DUMP_ARRAY_FIELDS, rejects: bool = False) -> DataFrame:
    """Whole-dump JSON: a bare array, or the first of `data` / `ids` /
    `events` that is present. Each element decides for itself whether it is
    an id string or an event object (a superset of deciding by the first).
    Dumps without a readable array give no rows here; `dump_quarantine` returns them, and
    `rejects` adds them as in `parse_pages`. A dump file that is too large for one row is
    read by `split.split_dump`."""
    keep = keep or []
    p = _documents(text, keep, _dump_fields(array_fields))
    rows = _exploded(p, keep, _dump_elements(array_fields), rejects)
    rows = with_element_id(rows, "_e", fields)
    return _valid_or_rejected(rows, rejects, [*keep, "id"])


# ------------------------------------------------------------------- NDJSON

def parse_ndjson_lenient(lines: DataFrame, fields=ID_FIELDS,
                         keep: list[str] | None = None) -> DataFrame:
    """Blank lines skipped; a JSON string is the id, a JSON object goes
    through the pick; a line that is valid JSON of another kind yields
    nothing; an unparsable line is a bare id when its trimmed length is
    between 5 and 200 (exclusive)."""
    keep = keep or []
    p = _parsed(keep_rows(lines, _js_trim(F.col("value")) != ""), "value", keep)
    p = with_id_pick(p, "_v", fields, id_col="_oid", field_col=None, kind_col=None)
    t = _js_trim(F.col("_raw"))
    k = F.col("_k")
    id_expr = (F.when(F.col("_v").isNull(), F.when(_bare_ok(t), t))
               .when(k == "string", vtext(F.col("_v")))
               .when(k == "object", F.col("_oid")))
    out = p.select(*keep, id_expr.alias("id"))
    return keep_rows(out, is_valid_id(F.col("id")))


def parse_ndjson_strict(lines: DataFrame, fields=ID_FIELDS,
                        keep: list[str] | None = None) -> DataFrame:
    """Every non-blank line must be one JSON value other than null; any other line
    fails the job (`raise_error`), naming the offending text. Only objects hold ids:
    a line that is a string or a number is read, and yields nothing."""
    keep = keep or []
    p = _parsed(keep_rows(lines, _js_trim(F.col("value")) != ""), "value", keep)
    bad = F.col("_v").isNull() | (F.col("_k") == "null")
    p = p.withColumn("_chk", F.when(bad, F.raise_error(
        F.concat(F.lit("bad NDJSON line: "), F.substring(F.col("_raw"), 1, 200)))))
    p = with_id_pick(p, "_v", fields, field_col=None, kind_col=None)
    out = p.select(*keep, F.coalesce(F.col("_chk").cast("string"), F.col("id")).alias("id"))
    return keep_rows(out, is_valid_id(F.col("id")))


# ---------------------------------------------------------------------- SSE

def parse_sse(lines: DataFrame, fields=ID_FIELDS, gate_fields=SSE_ID_GATE_FIELDS,
              keep: list[str] | None = None) -> DataFrame:
    """``data:`` lines only; blank payloads and ``[DONE]`` skipped.

    A string payload is an id; an array yields the id of each element; an
    object yields its id only when one of the gate fields is truthy; bad JSON
    is a bare id when 5 < length < 200 and it holds no ``{``.
    """
    keep = keep or []
    raw = F.col("value")
    data = _js_trim(F.expr(f"substring(value, {len(SSE_DATA_PREFIX) + 1})"))
    # Line filters run as generators (`keep_rows`): a `where` would be pushed
    # into whatever computed `value` and evaluate it twice.
    framed = keep_rows(lines, raw.startswith(SSE_DATA_PREFIX)).select(*keep, data.alias("_d"))
    framed = keep_rows(framed, (F.col("_d") != "") & (F.col("_d") != SSE_DONE))
    p = _parsed(framed, "_d", keep)
    d = F.col("_raw")
    # Stage the gate fields and their kinds: each is read several times below.
    gnames = [f"_g{i}" for i in range(len(gate_fields))]
    p = p.select("*", *[vget(F.col("_v"), field_path(g)).alias(n) for g, n in zip(gate_fields, gnames)])
    p = p.select("*", *[vkind(F.col(n)).alias(n + "k") for n in gnames])
    gate = F.lit(False)
    for n in gnames:
        gate = gate | truthy_of(F.col(n), F.col(n + "k"))
    p = p.withColumn("_gate", gate).drop(*gnames, *[n + "k" for n in gnames])
    elems = (F.when(F.col("_k") == "array", F.try_variant_get(F.col("_v"), "$", "array<variant>"))
             .when(F.col("_k") == "string", F.array(F.col("_v")))
             .when((F.col("_k") == "object") & F.col("_gate"), F.array(F.col("_v"))))
    # One pass: each payload becomes a list of (element, bare text) pairs.
    no_elem = F.lit(None).cast("variant")
    no_text = F.lit(None).cast("string")
    pairs = (F.when(F.col("_v").isNull(),
                    F.when(_bare_ok(d) & ~d.contains("{"),
                           F.array(F.struct(no_elem.alias("e"), d.alias("b")))))
             .otherwise(F.transform(elems, lambda e: F.struct(e.alias("e"), no_text.alias("b")))))
    rows = p.select(*keep, F.explode(pairs).alias("_p")).select(
        *keep, F.col("_p.e").alias("_e"), F.col("_p.b").alias("_b"))
    rows = with_element_id(rows, "_e", fields, id_col="_eid")
    out = rows.select(*keep, F.coalesce(F.col("_b"), F.col("_eid")).alias("id"))
    return keep_rows(out, is_valid_id(F.col("id")))


# ---------------------------------------------------------------------- CSV

def read_csv_ids(spark: SparkSession, path: str, candidates=ID_FIELDS_CSV,
                 sentinels=ID_SENTINELS, keep: list[str] | None = None) -> DataFrame:
    """CSV files, each with a header of its own; the id column of a file is the first
    *column* whose name is a candidate (not the first candidate), names trimmed and
    unquoted. A file without an id column gives no rows. `keep`: partition columns.
    Unlike the source, quoting in rows follows RFC 4180.

    The headers are one row a file (its first line that is not blank); rows meet them on
    the file's name, and one parse as wide as the furthest id column serves all files."""
    keep = keep or []
    lines = spark.read.text(path).select(
        *keep, F.col("_metadata.file_path").alias("_file"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m")).alias("_at"))
    lines = lines.where(F.trim(F.regexp_replace("value", r"^\uFEFF", "")) != "")
    names = F.transform(F.split(F.regexp_replace(F.col("_h.value"), r"^\uFEFF", ""), ","),
                        lambda h: F.replace(F.regexp_replace(h, r"^\s+|\s+$", ""), F.lit('"')))
    place = F.array_position(F.transform(names, lambda h: h.isin(*candidates)), True)
    heads = (lines.groupBy("_file").agg(F.min(F.struct("_at", "value")).alias("_h"))
             .select("_file", F.col("_h._at").alias("_first"), place.cast("int").alias("_i")).where(F.col("_i") > 0))
    heads = cut_lineage(heads)
    width = heads.agg(F.max("_i")).first()[0] or 1
    rows = lines.join(heads, "_file").where(F.col("_at") != F.col("_first"))
    cols = ", ".join(f"c{i} string" for i in range(width))
    cells = F.from_csv("value", cols, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    out = rows.withColumn("_c", cells).select(*keep, F.array(*[F.col(f"_c.c{i}") for i in range(width)]).alias("_c"), "_i")
    out = out.select(*keep, F.element_at("_c", F.col("_i")).alias("id"))
    return keep_rows(out, is_valid_id(F.col("id"), sentinels))


# ----------------------------------------------------------- id-per-line text

def parse_id_lines(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Trimmed, blank lines skipped."""
    keep = keep or []
    t = _js_trim(F.col("value"))
    return lines.select(*keep, t.alias("id")).where(F.col("id") != "")


def read_id_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_id_lines(spark.read.text(path))


# ----------------------------------------------------------- stats document

def parse_stats_doc(text: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A stats document to rows `section`, `name`, `count`, `value`.

    `counts` becomes section ``counts``; each distribution, known or not, a section of its
    own name with a row for each {type, count} (whatever else it holds is one row with its
    JSON as `value`); `cache` section ``cache`` with the texts; every other top-level key a
    row of section ``unexpected``. A text that is no JSON object is a row of section
    ``rejected`` with the whole text. All from one parse and one explode a document."""
    keep = keep or []
    p = _parsed(text, "value", keep)
    v = F.col("_v")

    def entries(path: str) -> Column:
        return F.coalesce(F.map_entries(F.try_variant_get(v, path, "map<string,variant>")),
                          F.array().cast("array<struct<key:string,value:variant>>"))

    def row(section, name, count=None, value=None) -> Column:
        return F.struct(section.alias("section"), name.alias("name"),
                        (F.lit(None) if count is None else count).cast("bigint").alias("count"),
                        (F.lit(None) if value is None else value).cast("string").alias("value"))

    def element(section: Column, x: Column) -> Column:
        kind = F.try_variant_get(x, "$.type", "string")
        return F.when(kind.isNotNull(), row(section, kind, F.try_variant_get(x, "$.count", "bigint"))).otherwise(
            row(section, F.lit(None).cast("string"), value=F.to_json(x)))

    counts = F.transform(entries("$.counts"), lambda e: row(F.lit("counts"), e["key"], F.try_variant_get(e["value"], "$", "bigint")))
    dists = F.flatten(F.transform(entries("$.distributions"), lambda d: F.coalesce(
        F.transform(F.try_variant_get(d["value"], "$", "array<variant>"), lambda x: element(d["key"], x)),
        F.array(row(d["key"], F.lit(None).cast("string"), value=F.to_json(d["value"]))))))
    cache = F.transform(entries("$.cache"), lambda e: row(F.lit("cache"), e["key"], value=F.coalesce(
        F.try_variant_get(e["value"], "$", "string"), F.to_json(e["value"]))))
    other = F.transform(F.filter(entries("$"), lambda e: ~e["key"].isin("counts", "distributions", "cache")),
                        lambda e: row(F.lit("unexpected"), e["key"], value=F.to_json(e["value"])))
    lost = F.array(row(F.lit("rejected"), F.lit(None).cast("string"), value=F.col("_raw")))
    rows = F.when(F.col("_k") == "object", F.concat(counts, dists, cache, other)).when(F.col("_raw").isNotNull(), lost)
    return p.select(*keep, F.explode(rows).alias("_r")).select(*keep, "_r.*")


def read_stats_doc(spark: SparkSession, path: str) -> DataFrame:
    return parse_stats_doc(spark.read.text(path, wholetext=True))

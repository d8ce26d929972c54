"""Inputs derived from the driver's `events` and `pages` tables.

The source reads JSON pages, dumps and logs from a remote feed; here each
such input is a deterministic Spark projection of `events`, so every query
grows with the table. The DuckDB oracle (`plans/oracle.py`) builds the same
inputs with the same rules. Recipes (see FIXTURES.md):

* raw JSON event: id key by ``event_id % 4``; number ids for even
  `event_id`, text ids for odd; special id forms by ``event_id % 50``;
  type key by ``event_id % 3``; time value by ``event_id % 3`` (ISO text,
  ms, seconds) under a key chosen by ``event_id % 7``.
* two overlapping sources: A ``event_id >= 0.4 N``, B ``event_id < 0.6 N``;
  both miss ``event_id % 97 = 0``; existing target ``event_id % 10 = 3``.
* deliveries: ``feed`` (even ids), ``cursor-chain`` (multiples of 3),
  ``type-worker`` (multiples of 5), load order ``seq = rank * N + event_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_ms
from ..operators.scans import feed_order, with_pages
from ..functions.num import idiv

PAGE_SIZE = 500
STRATEGIES = ("feed", "cursor-chain", "type-worker")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster when a scan yields fewer
    partitions than there are task slots (a small file with one row group is
    one task). A large input already has more splits than slots, so this is
    a no-op there and adds no shuffle."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave as is
        return df
    return df.repartition(slots) if parts < slots else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` plus `ms` (epoch milliseconds, truncated) and text `id`."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("ms", epoch_ms("ts")).withColumn("id", F.col("event_id").cast("string"))


def n_rows(ev: DataFrame) -> Column:
    """Row count as a scalar subquery (evaluated once, no join)."""
    return ev.agg(F.count(F.lit(1))).scalar()


def _q(s: Column) -> Column:
    return F.concat(F.lit('"'), s, F.lit('"'))


def pick_value(idx: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def iso_ms(ts: str = "ts") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def raw_event_json(ev: DataFrame) -> Column:
    """JSON text of one raw event (see module docstring)."""
    eid = F.col("event_id")
    txt = eid.cast("string")
    m50 = eid % 50
    idkey = pick_value(eid % 4, ("id", "eventId", "_id", "event_id"))
    idval = F.when(eid % 2 == 0, txt).otherwise(_q(txt))
    id_part = (F.when(m50 == 7, F.concat(_q(idkey), F.lit(':"null"')))
               .when(m50 == 17, F.concat(F.lit('"id":"","eventId":'), idval))
               .when(m50 == 27, F.concat(F.lit('"id":{"n":'), txt, F.lit("}")))
               .when(m50 == 37, F.lit('"id":false,"_id":null'))
               .when(m50 == 47, F.concat(F.lit('"id":null,"event_id":'), _q(txt)))
               .otherwise(F.concat(_q(idkey), F.lit(":"), idval)))
    typekey = pick_value(eid % 3, ("type", "eventType", "event_type"))
    tskey = (F.when(eid % 7 == 0, F.lit("created_at")).when(eid % 7 == 1, F.lit("ts"))
             .otherwise(F.lit("timestamp")))
    ms = F.col("ms")
    tsval = (F.when(m50 == 23, F.lit("1000000000"))
             .when(m50 == 33, F.lit('"yesterday"'))
             .when(m50 == 43, F.lit("null"))
             .when(eid % 3 == 0, _q(iso_ms()))
             .when(eid % 3 == 1, ms.cast("string"))
             .otherwise(idiv(ms, 1000).cast("string")))
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    return F.concat(F.lit("{"), id_part, F.lit(","), _q(typekey), F.lit(":"), _q(F.col("event_type")),
                    F.lit(","), _q(tskey), F.lit(":"), tsval,
                    F.lit(',"user_id":'), F.col("user_id").cast("string"),
                    F.lit(',"value_cents":'), cents,
                    F.lit(',"props":'), F.col("props"), F.lit("}"))


def raw_events(ev: DataFrame) -> DataFrame:
    """(event_id, ts, ms, event_type, json)."""
    return spread(ev).select("event_id", "ts", "ms", "event_type", "user_id",
                             raw_event_json(ev).alias("json"))


def cursor_text(ms: Column, key: Column) -> Column:
    """Opaque keyset cursor the fixture pages carry: base64 of ``ms:key``."""
    return F.base64(F.concat(ms.cast("string"), F.lit(":"), key.cast("string")).cast("binary"))


def paged_raw(ev: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Raw events with `idx` and `page_no` in feed order (newest first)."""
    return with_pages(raw_events(ev), page_size, feed_order("ts", "event_id"))


def page_texts(ev: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """One JSON page envelope per page: (page_no, value).

    Even pages use the nested envelope (``pagination{...}``), odd pages the
    flat one. The last page has ``hasMore false`` and a null cursor. A page
    holds at most `page_size` rows, so collecting it is bounded.
    """
    p = paged_raw(ev, page_size)
    last = p.agg(F.max("page_no")).scalar()
    pages = p.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("idx", "json"))).alias("rows"),
        F.max_by(cursor_text(F.col("ms"), F.col("event_id")), F.col("idx")).alias("cur"))
    data = F.concat(F.lit('{"data":['),
                    F.array_join(F.transform("rows", lambda r: r["json"]), ","), F.lit("]"))
    more = F.col("page_no") < last
    more_txt = F.when(more, F.lit("true")).otherwise(F.lit("false"))
    cur_txt = F.when(more, _q(F.col("cur"))).otherwise(F.lit("null"))
    nested = F.concat(data, F.lit(',"pagination":{"hasMore":'), more_txt,
                      F.lit(',"nextCursor":'), cur_txt, F.lit(',"cursorExpiresIn":119}}'))
    flat = F.concat(data, F.lit(',"hasMore":'), more_txt, F.lit(',"nextCursor":'), cur_txt,
                    F.lit("}"))
    return pages.select("page_no", F.when(F.col("page_no") % 2 == 0, nested)
                        .otherwise(flat).alias("value"))


def dump_texts(ev: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Whole-dump JSON documents, one per page, shape by ``page_no % 4``:
    bare array of objects, ``{"data":[...]}``, ``{"ids":[...]}`` (text ids,
    ``"null"`` for ``event_id % 50 = 7``), ``{"events":[...]}``."""
    p = paged_raw(ev, page_size)
    eid = F.col("event_id")
    id_elem = F.when(eid % 50 == 7, F.lit('"null"')).otherwise(_q(eid.cast("string")))
    pages = p.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("idx", "json", id_elem.alias("idj")))).alias("rows"))
    objs = F.array_join(F.transform("rows", lambda r: r["json"]), ",")
    ids = F.array_join(F.transform("rows", lambda r: r["idj"]), ",")
    form = F.col("page_no") % 4
    doc = (F.when(form == 0, F.concat(F.lit("["), objs, F.lit("]")))
           .when(form == 1, F.concat(F.lit('{"data":['), objs, F.lit("]}")))
           .when(form == 2, F.concat(F.lit('{"ids":['), ids, F.lit("]}")))
           .otherwise(F.concat(F.lit('{"events":['), objs, F.lit("]}"))))
    return pages.select("page_no", doc.alias("value"))


def dump_files(ev: DataFrame, path: str) -> None:
    """Four dumps, each one file and one JSON text over all events of its form
    (``event_id % 4``, the shapes of `dump_texts`), one element an event in the order of
    the ids. Texts hold the signs that a scan could take for structure; for
    ``event_id % 50 = 13`` the element is no JSON."""
    eid = F.col("event_id")
    note = F.lit(',"note":"a,\\"b\\\\],{[","more":[[1,2],{"k":"}"}]}')
    raw = raw_event_json(ev)
    json = F.concat(F.left(raw, F.length(raw) - 1), note)
    ids = F.when(eid % 50 == 7, F.lit('"null"')).otherwise(_q(eid.cast("string")))
    form = eid % 4
    r = spread(ev).withColumn("form", form)
    ends = r.groupBy("form").agg(F.min("event_id").alias("_lo"), F.max("event_id").alias("_hi"))
    # Events are dealt out and sorted; their texts, several times as long, are made after that.
    cols = ["event_id", "ts", "ms", "event_type", "user_id", "value", "props"]
    r = (r.join(F.broadcast(ends), "form").select("form", *cols, (eid == F.col("_lo")).alias("_is_lo"), (eid == F.col("_hi")).alias("_is_hi"))
         .repartition(4, "form").sortWithinPartitions("form", "event_id"))
    body = F.when(eid % 50 == 13, F.concat(F.lit('{"id": oops '), eid.cast("string"), F.lit(', "x": [1, 2]}'))).when(
        form == 2, ids).otherwise(json)
    head = pick_value(F.col("form"), ("[", '{"total":[1, 2],"data":[', '{"ids": [', '{"a":{"data":[7,8]},"events":\n['))
    tail = pick_value(F.col("form"), ("]", '],"hasMore":false}', "] }", "]}\n"))
    text = F.concat(F.when(F.col("_is_lo"), head).otherwise(""), body, F.when(F.col("_is_hi"), tail).otherwise(""))
    # one file a form: the text writer puts the commas between the elements
    r.select("form", text.alias("value")).write.partitionBy("form").option("lineSep", ",").text(path)


def damaged(texts: DataFrame) -> DataFrame:
    """`page_texts` or `dump_texts` of which some are cut off (``page_no % 5 = 2``) or hold
    no events (``page_no % 5 = 4``)."""
    k = F.col("page_no") % 5
    return texts.withColumn("value", F.when(k == 2, F.expr("left(value, length(value) - 9)"))
                            .when(k == 4, F.lit('{"hasMore":false}')).otherwise(F.col("value")))


def ndjson_lines(ev: DataFrame) -> DataFrame:
    """Lenient NDJSON lines, one per event: objects, JSON strings, bare ids
    and junk (scalars, broken JSON, short text, blank lines)."""
    r = raw_events(ev)
    eid = F.col("event_id")
    m50 = eid % 50
    txt = eid.cast("string")
    line = (F.when(m50 == 9, F.lit("123456789"))
            .when(m50 == 19, F.concat(F.lit("{bad json "), txt))
            .when(m50 == 29, F.lit("ab"))
            .when(m50 == 39, F.lit(""))
            .when(m50 == 49, F.lit("true"))
            .when(eid % 5 == 1, _q(txt))
            .when(eid % 5 == 2, F.concat(F.lit("  evt-"), txt, F.lit("-x ")))
            .otherwise(F.col("json")))
    return r.select("event_id", line.alias("value"))


def strict_ndjson_lines(ev: DataFrame) -> DataFrame:
    """NDJSON where every line is one JSON object (the strict loader's input)."""
    return raw_events(ev).select("event_id", F.col("json").alias("value"))


def sse_lines(ev: DataFrame) -> DataFrame:
    """Server-sent-event text lines, one per event."""
    r = raw_events(ev)
    eid = F.col("event_id")
    m50 = eid % 50
    txt = eid.cast("string")
    line = (F.when(m50 == 11, F.concat(F.lit("data: {broken "), txt))
            .when(m50 == 21, F.lit("data:"))
            .when(m50 == 31, F.lit("data: abc"))
            .when(eid % 6 == 0, F.concat(F.lit("data: "), F.col("json")))
            .when(eid % 6 == 1, F.concat(F.lit('data: "'), txt, F.lit('"')))
            .when(eid % 6 == 2, F.concat(F.lit("data: ["), F.col("json"), F.lit("]")))
            .when(eid % 6 == 3, F.lit("event: message"))
            .when(eid % 6 == 4, F.concat(F.lit("data: evt-"), txt, F.lit("-sse")))
            .otherwise(F.lit("data: [DONE]")))
    return r.select("event_id", line.alias("value"))


def csv_rows(ev: DataFrame) -> DataFrame:
    """CSV body: `eventId` is the first id-like *column* although `id` is the
    first candidate; `eventId` holds a sentinel or nothing for some rows."""
    eid = F.col("event_id")
    m50 = eid % 50
    ev_id = (F.when(m50 == 7, F.lit("undefined")).when(m50 == 17, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("e"), eid.cast("string"))))
    return ev.select(F.col("user_id").cast("string").alias("user_id"),
                     ev_id.alias("eventId"), eid.cast("string").alias("id"),
                     F.col("event_type").alias("type"))


def csv_files(ev: DataFrame, path: str) -> None:
    """CSV files of several shapes by ``event_id % 4`` (partition column `shape`): `csv_rows`;
    a spaced header with the id second and quoted commas; no id column; a quoted header."""
    eid, txt = F.col("event_id"), F.col("event_id").cast("string")
    shape = eid % 4
    ev_id = F.when(eid % 50 == 7, F.lit("undefined")).when(eid % 50 == 17, F.lit("")).otherwise(F.concat(F.lit("e"), txt))
    line = (F.when(shape == 0, F.concat_ws(",", F.col("user_id").cast("string"), ev_id, txt, F.col("event_type")))
            .when(shape == 1, F.concat(F.lit('"u, '), F.col("user_id").cast("string"), F.lit('" , '), ev_id, F.lit("  ")))
            .when(shape == 2, F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type")))
            .otherwise(F.concat(F.lit('"'), ev_id, F.lit('",x'))))
    heads = ("user_id,eventId,id,type", "user , id ", "user,type", '"event_id","k"')
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = ev.select(shape.cast("int").alias("shape"), line.alias("_l"))
    for i, head in enumerate(heads):             # every file begins with its header
        part = rows.where(F.col("shape") == i).repartition(2).withColumn("_first", first)
        (part.select(F.when(F.col("_first"), F.concat(F.lit(head + "\n"), F.col("_l"))).otherwise(F.col("_l")).alias("value"))
         .write.text(f"{path}/shape={i}"))


def script_pages(pages: DataFrame) -> DataFrame:
    """`pages` with script text after their `html`, which the default patterns of the text
    scans find: sources, calls, paths (one twice, one that is called too) and headers."""
    k = F.col("page_id").cast("string")
    extra = F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in (
        '<script src="/a', k, '.js"></script><script src="/x.css"></script><script type="module" src="/assets/b"></script>',
        '<script src="c.js"></script><script src="/d.js"></script><script>fetch("/api/v1/pages/', k, '"); fetch( \'https://x.example/', k,
        '\' ); const p = "/api/v1/pages/', k, '", q = "/internal/p/', k, '", r = \'/internal/p/', k,
        '\', h = {"Page-Token": 1, \'Content-Type\': 2, "lower-case": 3};</script>')])
    return pages.withColumn("html", F.concat(F.coalesce("html", F.lit("")), extra))


def existing_target(ev: DataFrame) -> DataFrame:
    """Ids already in the table before the load: ``event_id % 10 = 3``."""
    return ev.where(F.col("event_id") % 10 == 3).select("id")


def two_sources(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overlapping sources A (newest 60 %) and B (oldest 60 %), both missing
    ``event_id % 97 = 0``; columns (id, event_type, source)."""
    n = n_rows(ev)
    miss = F.col("event_id") % 97 == 0
    a = ev.where((F.col("event_id") >= n * F.lit(0.4)) & ~miss)
    b = ev.where((F.col("event_id") < n * F.lit(0.6)) & ~miss)
    cols = ["id", "event_id", "event_type", "ms"]
    return (a.select(*cols, F.lit("feed").alias("source")),
            b.select(*cols, F.lit("cursor-chain").alias("source")))


def deliveries(ev: DataFrame) -> DataFrame:
    """Overlapping deliveries by strategy with an explicit load order `seq`
    and a per-delivery payload."""
    n = n_rows(ev)
    eid = F.col("event_id")
    parts = []
    # The last strategy also delivers what none of the others does: no event is left out.
    rest = (eid % 5 == 0) | ((eid % 2 != 0) & (eid % 3 != 0))
    for rank, (name, mine) in enumerate(zip(STRATEGIES, (eid % 2 == 0, eid % 3 == 0, rest))):
        parts.append(ev.where(mine).select(
            "id", "event_id", "event_type", "ms",
            F.lit(name).alias("strategy"),
            (F.lit(rank) * n + eid).cast("long").alias("seq"),
            F.concat(F.lit(name + ":"), F.col("props")).alias("payload")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batches(ev: DataFrame) -> DataFrame:
    """Load batches for metrics: batch = event_id div 20; events = rows;
    known = rows already in the target; ts_ms = newest ms; strategy by
    ``batch % 3``; worker by ``batch % 6``."""
    b = ev.groupBy(idiv("event_id", 20).alias("batch")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_id") % 10 == 3).alias("known"),
        F.max("ms").alias("ts_ms"))
    return (b.withColumn("inserted", F.col("events") - F.col("known"))
            .withColumn("strategy", pick_value(F.col("batch") % 3, STRATEGIES))
            .withColumn("worker", F.concat(F.lit("w"), (F.col("batch") % 6).cast("string"))))


def heartbeats(ev: DataFrame) -> DataFrame:
    """Worker heartbeats: (name, last_progress_ms, fetched)."""
    w = F.col("user_id") % 6
    return ev.select(F.concat(F.lit("w"), w.cast("string")).alias("name"),
                     (F.lit(1_000_000_000_000) - w * 13000 - (F.col("event_id") % 5) * 100)
                     .cast("long").alias("last_progress_ms"),
                     F.col("event_id").alias("fetched"))


def checkpoint_log(ev: DataFrame) -> DataFrame:
    """Checkpoint log rows: (seq, strategy, status, cursor, events_count, metadata, updated_at ms);
    a third of them without metadata."""
    eid = F.col("event_id")
    return ev.select(eid.alias("seq"), F.col("event_type").alias("strategy"),
                     F.when(eid % 40 == 39, F.lit("completed")).otherwise(F.lit("running"))
                     .alias("status"),
                     F.col("user_id").cast("string").alias("cursor"),
                     eid.alias("events_count"),
                     F.when(eid % 3 != 0, F.concat(F.lit('{"page":'), eid.cast("string"), F.lit("}"))).alias("metadata"),
                     F.col("ms").alias("updated_at"))


def request_log(ev: DataFrame) -> DataFrame:
    """Request log: status by ``event_id % 6`` from (200, 200, 429, 500, 404, 401)."""
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 200, 429, 500, 404, 401)]),
                          (F.col("event_id") % 6 + 1).cast("int"))
    channel = F.when(F.col("event_id") % 2 == 0, F.lit("header")).otherwise(F.lit("query"))
    return ev.select("event_id", status.alias("status"), channel.alias("channel"))


def link_headers(ev: DataFrame) -> DataFrame:
    """A `Link` header per event; rel by ``event_id % 5`` (``next`` is not an export rel)."""
    rel = pick_value(F.col("event_id") % 5, ("stream", "export", "bulk", "download", "next"))
    v = F.concat(F.lit("<https://feed.example/"), F.col("event_type"), F.lit("/"),
                 F.col("id"), F.lit('>; rel="'), rel, F.lit('"'))
    return ev.select("event_id", v.alias("link"))


def format_strings(ev: DataFrame) -> DataFrame:
    """Strings to profile: ids, page cursors, uuids from md5, opaque names,
    and broken uuids."""
    h = F.md5(F.col("id"))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    bad = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                      F.substring(h, 17, 4), F.substring(h, 21, 11), F.lit("g"))
    eid = F.col("event_id")
    return ev.select(
        "event_id",
        F.col("id").alias("event_id_text"),
        cursor_text(F.col("ms"), eid).alias("cursor"),
        F.when(eid % 9 == 4, bad).otherwise(uuid).alias("uuid"),
        F.concat(F.lit("evt_"), F.col("id")).alias("name"))

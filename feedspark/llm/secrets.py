"""Secret scan on DataFrame functions only: patterns, and sliding-window entropy.

Matches of a pattern are located without a UDF: splitting a text at the pattern
gives the pieces between the matches, extracting all gives the matches, and the
running sum of both lengths gives the positions (code points, end exclusive).

Candidate strings for the entropy scan are maximal runs of key characters with a
letter and a digit, or of letters only. Each has a character class (hex; letters of
one case and digits, as base36 and base32; letters of both cases and digits; mixed)
with its own threshold. The window slides by one character over counts of all key
characters that are kept from step to step: when a character with c occurrences
enters, the sum of c*log2(c) changes by (c+1)*log2(c+1) - c*log2(c), and likewise when
one leaves, so the entropy follows. Allow-listed candidates are suppressed.

All of it is linear in the text: no pattern repeats a group (Java matches those by
recursion, which a long candidate would overflow), long candidates are read in
overlapping pieces, and lists are built in blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import docs_of, prepare

# Fixed values of the base kinds, in their listed order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_MIN = 6


@dataclass(frozen=True)
class EntropyParams:
    """Windows in characters, thresholds in bits a character."""
    min_run: int = 20
    hex_window: int = 20
    hex_bits: float = 3.0
    mixed_window: int = 20
    mixed_bits: float = 3.8
    case_bits: float = 3.3      # letters of one case, with or without digits (window of mixed)
    alnum_bits: float = 3.55    # letters of both cases, with or without digits (window of mixed)


#: A word: up to 15 letters, or any length if shaped like words: no six sounds without
#: a vowel, no two of j, x and q without u, no quick changes of case.
_WORD = (r"(?:[A-Za-z]{1,15}"
         r"|(?![A-Za-z]*(?:(?>sch|ch|ck|tz|th|[bcdfghjklmnpqrstvwxz]){6}|[BCDFGHJKLMNPQRSTVWXZ]{7}))"
         r"(?![A-Za-z]*(?:[jxJX]|[qQ](?![uU]))[A-Za-z]*(?:[jxJX]|[qQ](?![uU])))"
         r"(?![A-Za-z]*[A-Z][a-z][A-Z][A-Za-z]*[A-Z][a-z][A-Z])"
         r"(?![A-Za-z]*?(?:[a-z]{1,2}[A-Z]{1,9}){4})[A-Za-z]+)")
_SIGNS, _DIGITS = "-_/=+", "0123456789"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def allowed(hit: Column) -> Column:
    """True for a candidate that is no secret as a whole: a UUID; a date and time; words,
    joined by single signs, and a number of up to 6 digits; a number and a unit of up to
    3 letters."""
    plain = hit.rlike("^(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
                      "|[0-9]{4}-[0-9]{2}-[0-9]{2}[-_T0-9]*)$")
    head = F.rtrim(hit, F.lit(_DIGITS))
    words = F.split(F.rtrim(head, F.lit(_SIGNS)), "[-_/=+]", -1)
    number = F.rtrim(hit, F.lit(_LETTERS))
    return (plain
            | ((F.length(hit) - F.length(head) <= 6) & F.forall(words, lambda w: w.rlike(f"^{_WORD}$")))
            | ((F.length(hit) - F.length(number) <= 3) & number.rlike("^[-_/=+0-9]+$") & number.rlike("[0-9]")))


_RUN = r"A-Za-z0-9+/_="


def _candidates(min_run: int) -> str:
    return (rf"(?<![{_RUN}-])(?:(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])"
            rf"[{_RUN}-]{{{min_run},}}|[A-Za-z]{{{min_run},}}+(?![{_RUN}-]))")


#: Elements of a block that `scan` builds at once.
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once."""
    return F.transform(F.array(value), body)[0]


def scan(items: Column, zero: Column, state: str, step: Callable[[Column, Column], Column],
         out: Callable[[Column, Column], Column], kind: str) -> Column:
    """array<kind>: `out(state before, item)` of every item, where `step` gives the state
    after it. Appending to one growing list would copy it at each item; blocks of
    `_BLOCK` items keep the copies short."""
    none = F.array().cast(f"array<{kind}>")
    acc = f"struct<s:{state},o:array<{kind}>>"

    def block(s0: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(s0.alias("s"), none.alias("o")).cast(acc), lambda a, x: F.struct(
            step(a["s"], x).alias("s"), F.concat(a["o"], F.array(out(a["s"], x))).alias("o")).cast(acc))

    def blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _BLOCK).cast("int")),
                           lambda k: F.slice(xs, k * _BLOCK + 1, F.lit(_BLOCK)))

    whole = f"struct<s:{state},o:array<array<{kind}>>>"
    start = F.struct(zero.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("o")).cast(whole)

    def join(a: Column, part: Column) -> Column:
        return _let(block(a["s"], part), lambda r: F.struct(
            r["s"].alias("s"), F.concat(a["o"], F.array(r["o"])).alias("o")).cast(whole))

    return _let(items, lambda xs: F.when(F.size(xs) == 0, none).otherwise(
        F.flatten(F.aggregate(blocks(xs), start, join)["o"])))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start:int, hit:string>> of the leftmost non-overlapping
    matches of `pattern` (which must not match the empty text)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit"))),
                     lambda p: p["hit"].isNotNull())
    return scan(pairs, F.lit(0), "int", lambda at, p: at + p["gap"] + F.length(p["hit"]),
                lambda at, p: F.struct((at + p["gap"]).alias("start"), p["hit"].alias("hit")),
                "struct<start:int,hit:string>")


#: Characters of a text that `redact` masks as one piece.
_TEXT_PIECE = 4096
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _spans(found: Column, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(KINDS[rank]).alias("kind"),
        (m["start"] + F.length(m["hit"])).alias("end"))).cast(_SPAN)


def _clog(c: Column) -> Column:
    """c * log2(c), 0 for c <= 1."""
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


#: Characters of a candidate that are read as one piece.
_PIECE = 1024
_FIRST, _N_CODES = ord("+"), ord("z") - ord("+") + 1        # key characters as counters


def _hot_piece(piece: Column, window: int, bits: Column) -> Column:
    """struct<first:int, last:int> as `hot_window`, of a piece of bounded length."""
    kind = "struct<i:int,sum:double,counts:array<int>,first:int,last:int>"
    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.array_repeat(F.lit(0), _N_CODES).alias("counts"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last")).cast(kind)

    def step(s: Column, x: Column) -> Column:
        leaves = x["leave"].isNotNull()
        gone = F.when(leaves, s["counts"][x["leave"]]).otherwise(F.lit(0))
        here = s["counts"][x["enter"]] - F.when(x["leave"] == x["enter"], F.lit(1)).otherwise(F.lit(0))
        total = s["sum"] - _clog(gone) + _clog(gone - 1) - _clog(here) + _clog(here + 1)
        hot = (s["i"] >= window - 1) & (F.log2(F.lit(float(window))) - total / window >= bits - F.lit(1e-9))
        counts = F.transform(s["counts"], lambda n, k: n + F.when(k == x["enter"], F.lit(1)).otherwise(F.lit(0))
                             - F.when(k == x["leave"], F.lit(1)).otherwise(F.lit(0)))
        at = s["i"] + 1
        return F.struct(at.alias("i"), total.alias("sum"), counts.alias("counts"),
                        F.when(hot, F.coalesce(s["first"], at - window)).otherwise(s["first"]).alias("first"),
                        F.when(hot, at).otherwise(s["last"]).alias("last")).cast(kind)

    codes = F.transform(F.split(piece, ""), lambda c: F.ascii(c) - _FIRST)
    moves = _let(codes, lambda xs: F.slice(F.zip_with(
        xs, F.concat(F.array_repeat(F.lit(None).cast("int"), window), xs),
        lambda e, l: F.struct(e.alias("enter"), l.alias("leave"))), F.lit(1), F.size(xs)))
    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def hot_window(hit: Column, window: int, bits: float | Column) -> Column:
    """struct<first:int, last:int>: the start of the first and the end of the
    last window of `hit` whose entropy reaches `bits`; null fields if none does.
    A run shorter than the window has no window."""
    least = F.lit(bits) if isinstance(bits, float) else bits
    # pieces overlap by a window less one, so every window lies in one piece
    parts = _let(F.regexp_extract_all(hit, F.lit(f".{{1,{_PIECE}}}"), F.lit(0)), lambda xs: F.zip_with(
        xs, F.slice(F.concat(F.array(F.lit("")), xs), F.lit(1), F.size(xs)),
        lambda x, before: F.struct(x.alias("x"), F.right(before, F.lit(window - 1)).alias("b"))))
    def found(least: Column) -> Column:
        return F.transform(parts, lambda x, k: _let(
            _hot_piece(F.concat(x["b"], x["x"]), window, least),
            lambda w: F.struct((w["first"] + k * _PIECE - F.length(x["b"])).alias("first"),
                               (w["last"] + k * _PIECE - F.length(x["b"])).alias("last"))))
    # the threshold depends on the whole candidate: it is computed once, not at each step
    return _let(_let(least, found), lambda ws: F.struct(F.array_min(F.transform(ws, lambda w: w["first"])).alias("first"),
                                                        F.array_max(F.transform(ws, lambda w: w["last"])).alias("last")))


def _entropy_spans(text: Column, p: EntropyParams) -> Column:
    runs = F.filter(located(text, _candidates(p.min_run)), lambda m: ~allowed(m["hit"]))
    tagged = F.transform(runs, lambda m: F.struct(
        m["start"].alias("start"),
        F.when(m["hit"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), hot_window(m["hit"], p.hex_window, p.hex_bits))
        .otherwise(hot_window(m["hit"], p.mixed_window, F.when(
            m["hit"].rlike("^(?:[a-z0-9]+|[A-Z0-9]+)$"), p.case_bits).when(
            m["hit"].rlike("^[A-Za-z0-9]+$"), p.alnum_bits).otherwise(p.mixed_bits))).alias("w")))
    rank = len(KINDS) - 1
    return F.transform(F.filter(tagged, lambda m: m["w"]["first"].isNotNull()), lambda m: F.struct(
        (m["start"] + m["w"]["first"]).alias("start"), F.lit(rank).alias("rank"),
        F.lit(KINDS[rank]).alias("kind"), (m["start"] + m["w"]["last"]).alias("end"))).cast(_SPAN)


def with_spans(df: DataFrame, text: str, out: str, params: EntropyParams = EntropyParams()) -> DataFrame:
    """`df` with the spans of the non-null string column `text` as `out`."""
    prepare(df.sparkSession)
    t, none = F.col(text), F.array().cast(_SPAN)
    assign = F.filter(located(t, ASSIGN),
                      lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 1)) >= ASSIGN_MIN)
    # A cheap test first: most texts have none of a kind and skip its positions.
    kinds = ((t.rlike(ASSIGN), _spans(assign, 0)),
             (t.contains("AKIA"), _spans(located(t, ACCESS), 1)),
             (t.rlike(HEX), _spans(located(t, HEX), 2)),
             (t.rlike(_candidates(params.min_run)), _entropy_spans(t, params)))
    names = [f"_kind{k}" for k in range(len(kinds))]
    df = df.withColumns({n: F.when(test, spans).otherwise(none) for n, (test, spans) in zip(names, kinds)})
    return df.withColumn(out, F.array_sort(F.concat(*names))).drop(*names)


def scan_secrets(docs: DataFrame, params: EntropyParams = EntropyParams()) -> DataFrame:
    """`doc_id`, `text` and `spans` (array of struct start, rank, kind, end; by
    start, then kind as listed in `KINDS`) of every whole text.

    A null text counts as empty and has no spans. Spans of different kinds may
    overlap. Repeated rows are each scanned.
    """
    return with_spans(docs_of(docs), "text", "spans", params)


def redact(docs: DataFrame, mask: str = "[SECRET]", params: EntropyParams = EntropyParams()) -> DataFrame:
    """The columns of `docs`, with every span in `text` (overlapping ones as one)
    replaced by `mask`. Texts without spans, and null texts, stay as they are."""
    df = docs.withColumn("_secret_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = with_spans(df, "_secret_text", "_secret_spans", params)
    # what goes at each span: from the end of those before it, if they overlap, to its own
    gone = "struct<start:int,end:int,mark:boolean>"
    cuts = scan(F.col("_secret_spans"), F.lit(0), "int", lambda at, m: F.greatest(at, m["end"]),
                lambda at, m: F.struct(F.greatest(at, m["start"]).alias("start"), F.greatest(at, m["end"]).alias("end"),
                                       (m["start"] >= at).alias("mark")), gone)
    df = df.withColumn("_secret_cuts", cuts)
    # piece by piece, so that positions are sought in a short text only
    pieces = F.regexp_extract_all(F.col("_secret_text"), F.lit(f"(?s).{{1,{_TEXT_PIECE}}}"), F.lit(0))

    def masked(piece: Column, k: Column) -> Column:
        lo, size = k * _TEXT_PIECE, F.length(piece)
        mine = F.transform(F.filter("_secret_cuts", lambda c: (c["end"] > lo) & (c["start"] < lo + size)), lambda c: F.struct(
            F.greatest(c["start"] - lo, F.lit(0)).alias("start"), F.least(c["end"] - lo, size).alias("end"),
            (c["mark"] & (c["start"] >= lo)).alias("mark")))
        kept = scan(mine, F.lit(0), "int", lambda at, c: c["end"], lambda at, c: F.concat(
            F.substring(piece, at + 1, c["start"] - at), F.when(c["mark"], F.lit(mask)).otherwise(F.lit(""))), "string")
        return _let(mine, lambda xs: F.when(F.size(xs) == 0, piece).otherwise(
            F.concat(F.array_join(kept, ""), F.substring(piece, F.element_at(xs, -1)["end"] + 1, size))))

    text = F.when(F.size("_secret_cuts") > 0, F.array_join(F.transform(pieces, masked), "")).otherwise(F.col("text"))
    return df.withColumn("text", text).select(*docs.columns)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

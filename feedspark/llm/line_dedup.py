"""Line deduplication by an exact set-similarity join, on DataFrame functions only.

A line's tokens are its distinct lower-cased words. A line goes when an earlier
line (by document id, then line number) has a Jaccard similarity of `num`/`den`
or more to it; lines without a token stay.

1. *Rarity*. Tokens are counted over all lines in a fixed number of hash buckets;
   a line's tokens are ordered by their bucket's count, then by hash.
2. *Prefix filter*. The index keys of a line are its first runs of neighbours in that
   order: a run that starts at a rare token is a pair, any other a triple. Two rare
   tokens are as selective as three common ones, and break less easily: a token that
   only one of two lines has breaks at most two pairs or three triples of that line and
   one or two of the other. So two similar lines of n tokens have a common run before
   the first `broken` + 1 of either end, where `broken` counts a pair as 1/2 and a
   triple as 1/3 of the (1 - t) n tokens that can differ: floor(2 (1 - t) n) if all are
   pairs, floor(3 (1 - t) n) if all are triples. Single tokens would have lists that
   grow with the square of the corpus. Short lines, all of whose triples could break,
   have pairs only.
3. Lines that occur more than once (found by a Bloom filter of fixed size) are
   reduced to one before they are indexed.
4. *Lists*. The lines of a list of up to `short` lines meet each other. Those of a
   longer one are first compared with its few earliest lines (pivots). Lines that turn
   out to have an earlier match are done. Only the others meet the lines before them
   in their lists, so a list of near copies costs its length, not its square. Two lines
   that share many lists meet in the one of the smallest key. Lists over `block` lines do
   this in blocks.
5. *Length and positional filters* drop pairs that cannot reach the threshold: by
   their sizes, by a parity sketch of their tokens, and by the tokens that can still
   agree before and after the common pair. What is left is verified on all its
   words, as 64-bit hashes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (attach_by_key, cut_lineage, docs_of, hash_filter, marked, prepare, release,
                     repeated_filter, written)


@dataclass(frozen=True)
class LineParams:
    num: int = 8                # similarity num / den
    den: int = 10
    buckets: int = 1 << 16      # counters of the rarity order
    filter_bits: int = 1 << 24  # of the broadcast filters (2 MB of bits)
    pivots: int = 4             # earliest lines of a longer list that all its lines meet first
    short: int = 8              # lines of a list that all meet each other
    block: int = 2048           # lines of a list that meet its open lines in one task


def words_of(line: Column) -> Column:
    """Distinct lower-cased words of a line, between spaces."""
    return F.array_distinct(F.filter(F.split(F.lower(line), " "), lambda w: w != ""))


def lines_of(docs: DataFrame) -> DataFrame:
    """`doc_id`, `th` (hash of the document's text), `no` (line number from 0),
    `line`, `a` and `b` (a 128-bit hash of the line), of the lines with a token."""
    return (docs.select("doc_id", F.xxhash64("text").alias("th"),
                        F.posexplode(F.split("text", "\n")).alias("no", "line"))
            .where("trim(line) != ''")
            .withColumns({"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(1), "line")}))


def rarity_rank(docs: DataFrame, p: LineParams) -> tuple[Column, int]:
    """A constant array: the rank (0 .. 32767) of each bucket by its token count. And
    the highest rank of a rare token: its bucket counts a quarter of the root of all
    tokens at most, so that two such tokens meet by chance in a few lines only,
    whatever the size of the corpus."""
    token = docs.select(F.explode(F.split(F.lower(F.replace("text", F.lit("\n"), F.lit(" "))), " ")).alias("w"))
    counts = {r["k"]: r["n"] for r in
              token.groupBy(F.xxhash64("w").bitwiseAND(F.lit(p.buckets - 1)).alias("k"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}             # `buckets` rows at most
    levels = sorted(set(counts.values()))
    place = {n: 1 + i * 32766 // max(1, len(levels) - 1) for i, n in enumerate(levels)}
    ranks = [place.get(counts.get(k), 0) for k in range(p.buckets)]
    rare = max((place[n] for n in levels if 16 * n * n <= sum(counts.values())), default=0)
    return F.from_json(F.lit(json.dumps(ranks, separators=(",", ":"))), "array<long>"), rare


def token_hashes(line: Column) -> Column:
    """array<long>: hashes of the line's distinct tokens."""
    words = F.transform(F.split(F.lower(line), " "), lambda w: F.xxhash64(w))
    return F.array_distinct(F.array_remove(words, F.xxhash64(F.lit(""))))


def token_codes(line: Column, rank: Column, p: LineParams) -> Column:
    """array<long>: the line's distinct tokens in order of rarity, each as its
    bucket's rank (16 bits) and its hash (48 bits). The array is declared free of
    nulls, which lets Spark sort and compare plain longs."""
    def code(word: Column) -> Column:
        h = F.xxhash64(word)
        place = F.coalesce(F.get(rank, h.bitwiseAND(F.lit(p.buckets - 1)).cast("int")), F.lit(0).cast("long"))
        return F.call_function("shiftleft", place, F.lit(48)).bitwiseOR(F.shiftrightunsigned(h, 16))

    codes = F.transform(F.split(F.lower(line), " "), code)
    return F.sort_array(F.array_distinct(F.array_remove(codes, code(F.lit("")))))


# A post carries, in one long, what the filters need: 8 bits of size (in fours,
# rounded up; 255: any), 10 bits of position (1023: any), and a parity sketch in
# which each token flips one of 46 bits. Two sketches differ in at most as many
# bits as their lines differ in tokens.
_BITS, _ANY_POS, _ANY_SIZE = 46, 1023, 255


def _sketch(hashes: Column) -> Column:
    whole = F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(63)).cast("int"))))
    return whole.bitwiseXOR(F.shiftrightunsigned(whole, _BITS)).bitwiseAND(F.lit((1 << _BITS) - 1))


def _wide_sketch(words: Column, hashed: bool = False) -> list[Column]:
    """`s0`, `s1`: a parity sketch of 128 bits, for the pairs that get that far. The
    words may come as their hashes."""
    hashes = words if hashed else F.transform(words, lambda w: F.xxhash64(w))
    flip = lambda s, h: s.bitwiseXOR(F.call_function(
        "shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))
    low = F.filter(hashes, lambda h: h.bitwiseAND(F.lit(64)) == 0)
    high = F.filter(hashes, lambda h: h.bitwiseAND(F.lit(64)) != 0)
    return [F.aggregate(half, F.lit(0).cast("long"), flip).alias(name) for half, name in ((low, "s0"), (high, "s1"))]


def _posts(lines: DataFrame, rank: Column, rare: int, p: LineParams) -> DataFrame:
    """Index rows: `key`, `id` (of the line), `tag` (size, position, sketch). The
    prefix is exploded before its keys are hashed: outside of lambda functions the
    hashing is compiled code."""
    n, at, few = F.col("n"), F.col("at"), F.col("rare")
    small, large = key_sizes(p)
    limit = F.lit((rare + 1) << 48)                  # of the code of a rare token

    # How many keys: pairs only (a line of one token: the token); pairs and triples.
    only = F.greatest(F.lit(1), F.least(n - 1, F.floor(F.lit(2 * (p.den - p.num)) * n / p.den).cast("int") + 1))
    mixed = F.when(few * p.den >= F.lit(2 * (p.den - p.num)) * n, only).otherwise(
        few + F.floor((F.lit(6 * (p.den - p.num)) * n - F.lit(3 * p.den) * few) / F.lit(2 * p.den)).cast("int") + 1)

    def key(k: int) -> Column:
        # 48 bits tell keys apart; a chance meeting ends at the filters. The zero bytes lie
        # next to a row's empty null flags, where the shuffle's compression removes them.
        return F.xxhash64(F.lit(k), "c0", *[F.get("c", at + j) for j in range(1, k)]).bitwiseAND(F.lit(-1 << 16))

    first = (F.when(n < large, F.slice("c", F.lit(1), only)).when(n > small, F.slice("c", F.lit(1), mixed))
             .otherwise(F.concat(F.slice("c", F.lit(1), only), F.slice("c", F.lit(1), mixed))))
    size = F.least(F.ceil(n / 4), F.lit(_ANY_SIZE)).cast("long")
    coded = (lines.select("id", token_codes(F.col("line"), rank, p).alias("c"))
             .select("id", "c", F.size("c").alias("n"), F.size(F.filter("c", lambda x: x < limit)).alias("rare"),
                     _sketch(F.col("c")).alias("s")))
    out = coded.select("id", "c", "n", "rare", "s", F.posexplode(first).alias("pos", "c0"))
    # Lines that have both kinds of prefix: the pairs of the second are among the first.
    pairs = (n < large) | ((n <= small) & (F.col("pos") < only))
    again = (n >= large) & (n <= small) & (F.col("pos") >= only) & (F.col("c0") < limit)
    out = out.withColumn("two", pairs).where(~again)
    out = out.withColumn("at", F.when(F.col("two") | (n > small), F.col("pos")).otherwise(F.col("pos") - only))
    place = F.when(n <= small, F.lit(_ANY_POS)).otherwise(F.least("pos", F.lit(_ANY_POS))).cast("long")
    tag = (F.call_function("shiftleft", size, F.lit(56)).bitwiseOR(F.call_function("shiftleft", place, F.lit(_BITS)))
           .bitwiseOR(F.col("s")))
    two = F.col("two") | (F.col("c0") < limit)
    return out.select(F.when(two, key(2)).otherwise(key(3)).alias("key"), "id", tag.alias("tag"))


def key_sizes(p: LineParams) -> tuple[int, int]:
    """Lines of up to `small` tokens have keys of two neighbours, those of `large`
    or more of two or three, by the first one's rarity; two similar lines have a kind of
    prefix in common. Three neighbours are enough once fewer triples than a line has
    can be broken."""
    large = 3
    while large < 10_000 and not all(3 * (p.den - p.num) * n // p.den < n - 2 for n in range(large, large + 2 * p.den)):
        large += 1
    return (large - 1) * p.den // p.num, large


def _with_id(lines: DataFrame, often: str) -> DataFrame:
    """`id`: 62 bits of the line's hash, and above them whether it occurs often."""
    half = F.shiftrightunsigned("a", 2)
    return lines.withColumn("id", F.when(F.col(often), half).otherwise(half + F.lit(1 << 62)))


def _may_match(a: Column, b: Column, p: LineParams) -> Column:
    """Length, difference and positional filter of two tags with the same key; true
    where it cannot tell. For similar lines of n and m tokens (known in fours here),
    (num + den) * differing <= (den - num) * (n + m)."""
    n, m = (F.shiftrightunsigned(t, 56) for t in (a, b))
    i, j = _position(a), _position(b)
    apart = F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit((1 << _BITS) - 1)))
    most = F.least(i, j) + 1 + F.least(4 * n - i - 1, 4 * m - j - 1)
    placed = (F.greatest(i, j) == _ANY_POS) | (F.lit(p.num + p.den) * most >= F.lit(p.num) * (4 * (n + m) - 6))
    return ((F.greatest(n, m) == _ANY_SIZE)
            | ((F.lit(p.num + p.den) * apart <= F.lit(4 * (p.den - p.num)) * (n + m))
               & (F.lit(p.den) * F.least(n, m) >= F.lit(p.num) * (F.greatest(n, m) - 1)) & placed))


def _position(tag: Column) -> Column:
    return F.shiftrightunsigned(tag, _BITS).bitwiseAND(F.lit(_ANY_POS))


def _reachable(n: Column, m: Column, i: Column, j: Column, p: LineParams) -> Column:
    """Length and positional filter of a pair that shares a key at token
    positions i and j of n and m tokens (the order is the same in both lines, so
    what agrees before the key lies before it in both, and likewise after)."""
    need = F.lit(p.num) * (n + m)                    # (num + den) * overlap >= num * (n + m)
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return ((F.lit(p.den) * F.least(n, m) >= F.lit(p.num) * F.greatest(n, m))
            & ((F.greatest(i, j) == _ANY_POS) | (F.lit(p.num + p.den) * most >= need)))


def _within(x: str, y: str, i: Column, j: Column, p: LineParams) -> Column:
    """`_reachable`, and the difference of the wide sketches, for lines whose sizes and
    sketches are in the structs `x` and `y` (`n`, `s0`, `s1`)."""
    a, b = F.col(x), F.col(y)
    apart = F.bit_count(a["s0"].bitwiseXOR(b["s0"])) + F.bit_count(a["s1"].bitwiseXOR(b["s1"]))
    return (_reachable(a["n"], b["n"], i, j, p)
            & (F.lit(p.num + p.den) * apart <= F.lit(p.den - p.num) * (a["n"] + b["n"])))


_ORD = "struct(isnull(doc_id) as z, doc_id, th, no)"


def _lists(lines: DataFrame, rank: Column, rare: int, p: LineParams) -> DataFrame:
    """The index lists with two lines and more: `key`, `id`, `tag`, `c` (the list's
    length). A list of two is one row with its smallest id as `head` and `htag`, left
    out if the two cannot match; longer ones have a row for each line."""
    once = lines.where("not often").select("id", "line")
    more = lines.where("often").groupBy("a", "b").agg(F.first("id").alias("id"), F.first("line").alias("line"))
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posts = _posts(once.unionByName(more.select("id", "line")), rank, rare, p).repartition(parts, "key")
    # One pass and one frame over each list in order of id: its head and its length.
    run = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lists = posts.select("key", "id", "tag", F.first("id").over(run).alias("head"), F.first("tag").over(run).alias("htag"),
                         F.count(F.lit(1)).over(run).alias("c"))
    lists = lists.where((F.col("c") > 2) | ((F.col("c") == 2) & (F.col("id") != F.col("head"))
                                            & _may_match(F.col("tag"), F.col("htag"), p)))
    two = F.col("c") == 2
    return written(lists.withColumns({"head": F.when(two, F.col("head")), "htag": F.when(two, F.col("htag"))}), "line-lists")


def _close_pairs(lists: DataFrame, p: LineParams) -> DataFrame:
    """The pairs of the lists of up to `short` lines that pass the filters of their
    tags. Most such lists are lines that share a key by chance, and end here."""
    few = lists.where(f"c > 2 and c <= {p.short}")
    one = few.select("key", F.col("id").alias("x"), F.col("tag").alias("xt"))
    two = few.select("key", F.col("id").alias("y"), F.col("tag").alias("yt"))
    met = one.join(two, "key").where((F.col("x") < F.col("y")) & _may_match(F.col("xt"), F.col("yt"), p))
    pair = lists.where("c = 2").select(F.col("id").alias("x"), F.col("tag").alias("xt"),
                                       F.col("head").alias("y"), F.col("htag").alias("yt"))
    return written(_pairs(pair.unionByName(met.select("x", "xt", "y", "yt")), "x", "xt", "y", "yt"), "line-pairs")


def removed_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """`doc_id`, `th`, `no` of every line that goes (one row each).

    Null and empty texts have no line with a token. Rows with the same id and
    text are one document with one decision; rows with the same id and different
    texts are ordered by a hash of the text; null ids come last.
    """
    p, bits = params, params.filter_bits
    if 3 * p.num <= 2 * p.den:
        raise ValueError("the prefix of pairs is exact for similarities above 2/3 only")
    prepare(docs.sparkSession)
    df = docs_of(docs)
    rank, rare = rarity_rank(df, p)
    lines = lines_of(df)
    repeated = cut_lineage(repeated_filter(lines, ["a", "b"], bits))
    lines = _with_id(marked(lines, repeated, ["a", "b"], bits, "often"), "often")
    release(docs.sparkSession)
    lists = _lists(lines, rank, rare, p)
    release(docs.sparkSession)
    close = _close_pairs(lists, p)
    many = lists.where(f"c > {p.short}").select("key", "id", "tag", "c")
    # The lines of the lists: their texts stay where they are read, their sizes and
    # sketches and the first place of each are gathered.
    ids = close.select(F.col("x").alias("id")).unionByName(close.select(F.col("y").alias("id"))).unionByName(
        many.select("id")).distinct()
    near = cut_lineage(hash_filter(ids, ["id"], bits))
    texts = (marked(lines, near, ["id"], bits, "near").where("near")
             .select("id", "a", "b", "doc_id", "th", "no", "line", token_hashes(F.col("line")).alias("w")))
    texts = written(texts.select("id", "a", "b", "doc_id", "th", "no", "line", F.size("w").alias("n"),
                                 *_wide_sketch(F.col("w"), hashed=True)), "line-texts")
    found = (texts.groupBy("id", "a", "b", "n", "s0", "s1").agg(F.expr(f"min({_ORD})").alias("ord"))
             .join(ids, "id", "left_semi"))
    found = written(found, "line-sketches")
    release(docs.sparkSession)
    # Longer lists: every line against the list's earliest ones before it.
    members = cut_lineage(many.groupBy("id").agg(F.collect_list(F.struct("key", "tag", "c")).alias("posts"))
                          .join(found.select("id", "ord", F.struct("n", "s0", "s1").alias("w")), "id"))
    placed = _placed(members)
    early = Window.partitionBy("key").orderBy("ord", "id")
    pivot = cut_lineage(placed.withColumn("_k", F.row_number().over(early)).where(F.col("_k") <= p.pivots)
                        .select("key", F.col("id").alias("y"), F.col("tag").alias("yt"), F.col("ord").alias("yo"),
                                F.col("w").alias("yw")))
    to_pivot = placed.join(pivot, "key").where((F.col("yo") < F.col("ord")) & _within(
        "w", "yw", _position(F.col("tag")), _position(F.col("yt")), p))
    first = cut_lineage(close.unionByName(_pairs(to_pivot, "id", "tag", "y", "yt")))
    release(docs.sparkSession)
    done = _later(first, found, texts, p)
    del pivot, to_pivot, close
    release(docs.sparkSession)
    # Lines that are still open meet the members of their lists that come before them, each
    # in the list of their smallest common key. A list over `block` lines is dealt into
    # blocks, each of which meets the open lines in a task of its own.
    blocks = F.ceil(F.col("c") / F.lit(p.block)).cast("int")
    keys = F.col("posts.key").alias("keys")
    open_ = _placed(members.join(done.select("id").distinct(), "id", "left_anti"), keys).select(
        "key", F.col("id").alias("x"), F.col("tag").alias("xt"), F.col("ord").alias("xo"), F.col("keys").alias("xk"),
        F.col("w").alias("xw"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("part"))
    asked = cut_lineage(hash_filter(open_.select("key"), ["key"], bits))
    other = marked(_placed(members, keys), asked, ["key"], bits, "asked").where("asked").select(
        "key", F.col("id").alias("y"), F.col("tag").alias("yt"), F.col("ord").alias("yo"), F.col("keys").alias("yk"),
        F.col("w").alias("yw"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("part"))
    i, j = _position(F.col("xt")), _position(F.col("yt"))
    rest = open_.join(other.hint("shuffle_hash"), ["key", "part"]).where(
        (F.col("yo") < F.col("xo")) & _within("xw", "yw", i, j, p)
        & (F.col("key") == F.array_min(F.array_intersect("xk", "yk"))))
    rest = rest.select("x", "y", i.alias("i"), j.alias("j")).join(first.select("x", "y"), ["x", "y"], "left_anti")
    done = done.unionByName(_later(rest, found, texts, p))
    gone = cut_lineage(done.select("a", "b").distinct())
    del rest, open_, other, done, asked, placed, members
    release(docs.sparkSession)
    # Every occurrence of such a line goes, and of any other line all but the first.
    hit = cut_lineage(hash_filter(gone, ["a", "b"], bits))
    maybe = marked(lines, hit, ["a", "b"], bits, "_g").where("often or _g").select(
        "doc_id", "th", "no", F.concat(F.hex("a"), F.lit(":"), F.hex("b")).alias("sig"))
    maybe = cut_lineage(maybe)
    gone = gone.select(F.concat(F.hex("a"), F.lit(":"), F.hex("b")).alias("sig"), F.lit(True).alias("gone"))
    classes = (maybe.groupBy("sig").agg(F.expr(f"min({_ORD})").alias("first"), F.count(F.lit(1)).alias("_n"))
               .join(gone, "sig", "left"))
    spot = F.expr(_ORD)
    return (attach_by_key(maybe, classes, "sig", "_n", maybe.count())
            .where(F.col("gone").isNotNull() | (spot != F.col("first")))
            .select("doc_id", "th", "no").distinct())


def _placed(members: DataFrame, *more: Column) -> DataFrame:
    """The members of the longer lists: a row for each of their `posts`."""
    return (members.select("id", "ord", "w", *more, F.explode("posts").alias("post"))
            .select("*", "post.key", "post.tag", "post.c").drop("post"))


def _pairs(rows: DataFrame, x: str, xt: str, y: str, yt: str) -> DataFrame:
    """Distinct pairs `x`, `y` with the positions `i`, `j` of one of their keys."""
    span = F.lit(_ANY_POS + 1)
    at = F.min(_position(F.col(xt)) * span + _position(F.col(yt)))      # one long: a hash aggregate
    return (rows.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(at.alias("at"))
            .select("x", "y", F.floor(F.col("at") / span).alias("i"), (F.col("at") % span).alias("j")))


def _later(pairs: DataFrame, found: DataFrame, texts: DataFrame, p: LineParams) -> DataFrame:
    """`id`, `a`, `b` of the later line of each pair (x, y) that is similar. The
    pairs are filtered by length, position and a wide sketch; only lines of pairs
    that pass are shuffled with their words' hashes."""
    size = found.select("id", F.struct("n", "s0", "s1").alias("w"))
    pairs = cut_lineage(
        pairs.join(size.toDF("x", "xw"), "x").join(size.toDF("y", "yw"), "y")
        .where(_within("xw", "yw", F.col("i"), F.col("j"), p)).select("x", "y"))
    bits = p.filter_bits
    used = cut_lineage(hash_filter(pairs.select(F.explode(F.array("x", "y")).alias("id")), ["id"], bits))
    words = (marked(texts.select("id", "line"), used, ["id"], bits, "used").where("used")
             .groupBy("id").agg(F.first("line").alias("line")).select("id", token_hashes(F.col("line")).alias("w")))
    sets = (marked(found.select("id", "a", "b", "ord"), used, ["id"], bits, "used").where("used").drop("used")
            .join(words, "id"))
    one = sets.select(F.col("id").alias("x"), F.struct("id", "a", "b").alias("p"), F.col("ord").alias("po"),
                      F.col("w").alias("pw"))
    two = sets.select(F.col("id").alias("y"), F.struct("id", "a", "b").alias("q"), F.col("ord").alias("qo"),
                      F.col("w").alias("qw"))
    both = F.size(F.array_intersect("pw", "qw"))
    either = F.size("pw") + F.size("qw") - both
    alike = (pairs.join(one, "x").join(two, "y").where(F.lit(p.den) * both >= F.lit(p.num) * either)
             .select(F.when(F.col("po") > F.col("qo"), F.col("p")).otherwise(F.col("q")).alias("r")))
    return cut_lineage(alike.select("r.*").distinct())


def line_decisions(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """One row per input row: `doc_id`, `n_lines`, `removed` (array of line
    numbers from 0, ascending)."""
    df = docs_of(docs).withColumn("th", F.xxhash64("text"))
    gone = removed_lines(docs, params).groupBy("doc_id", "th").agg(F.sort_array(F.collect_list("no")).alias("removed"))
    rows = df.select("doc_id", "th", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    return _join_decisions(rows, gone).select("doc_id", "n_lines", "removed")


def _join_decisions(rows: DataFrame, gone: DataFrame) -> DataFrame:
    match = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["th"] == gone["th"])
    return rows.join(gone, match, "left").select(
        *[rows[c] for c in rows.columns],
        F.coalesce(gone["removed"], F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """The columns of `docs`, with `text` less the lines that go. Null texts stay
    null; a text none of whose lines goes is unchanged."""
    gone = cut_lineage(removed_lines(docs, params).groupBy("doc_id", "th")
                       .agg(F.sort_array(F.collect_list("no")).alias("removed")))
    th = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    near = hash_filter(gone.withColumn("_i", F.col("doc_id")), ["_i", "th"], params.filter_bits)
    rows = docs.withColumns({"_i": F.col("doc_id").cast("long"), "th": th})
    rows = marked(rows, near, ["_i", "th"], params.filter_bits, "_near")
    cut = gone.select(F.col("doc_id").alias("_j"), F.col("th").alias("_t"), "removed")
    hit = rows.where("_near").join(cut, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("th") == F.col("_t")), "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.col("removed"), i))
    hit = hit.withColumn("text", F.when(F.col("removed").isNull(), F.col("text"))
                         .otherwise(F.array_join(kept, "\n")))
    return rows.where("not _near").select(*docs.columns).unionByName(hit.select(*docs.columns))

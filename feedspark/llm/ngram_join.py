"""Jaccard self-join of documents on word n-grams, with set-relation skipping.

A document is the set of its distinct n-word shingles (64-bit hashes). Two
documents link when their sets' Jaccard similarity reaches a threshold; the
result is the components of the links. No link is lost.

1. *Equal sets* (128-bit signature) have the same answers: one row per class goes
   on, its answers are derived for the rest.
2. *Index*. Shingles are ordered by rarity: by the counts of a fixed number of
   hash buckets over all documents, then by hash. The index key is a pair of
   neighbours in this order. A shingle that only one of two sets has breaks at
   most two pairs of that set and one of the other, so two linked sets share a
   pair among the first floor(2 (1 - t) n) + 1 pairs of each. Such pairs are so
   selective that a list holds hardly any but near copies, and a shingle that
   very many documents share comes last and is no key at all.
3. *Families*: classes connected by shared keys. A list is in order of set size, and cut
   where the next size is out of reach: two linked sets have no such step between them.
   The sets of a short run meet each other, and pairs whose counting sketches differ in
   more than a link allows are no edge; in a longer run, whose sets are mostly near
   copies, all have an edge to the first. Every link lies in a family, and sets that
   share a key by chance do not join their families: the families of near copies would
   else grow together as the corpus grows.
4. Inside a family the sets are taken relative to a centre (the shingles that
   most members have): with D(x) the difference of x and the centre, the symmetric
   difference of x and y is |D(x)| + |D(y)| - 2 |D(x) & D(y)|, so answers follow
   incrementally from the small differences alone. Index lists of the differences
   are in order of member size; the blocks of a list whose positions cannot reach
   the threshold are skipped, and members already reached are not compared again.

Large families are cut into blocks of members that meet pairwise, so no task
holds a family of any size; copies never meet at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (attach_by_key, chunks, cut_lineage, docs_of, hash_filter, map_batches, marked,
                     release, splitmix64)
from .components import connected_components

_M1, _M2, _M3, _M4 = (np.uint64(x | 1) for x in splitmix64(4, 31))
_CACHE_WORDS = 200_000


@dataclass(frozen=True)
class JoinParams:
    words: int = 5              # words of a shingle
    num: int = 8                # similarity num / den
    den: int = 10
    buckets: int = 1 << 16      # counters of the rarity order
    short: int = 32             # sets of a run of a list that all meet each other
    sketch: int = 256           # counters of a set's sketch, a byte each
    block: int = 1024           # members of a family that meet in a task, times two
    filter_bits: int = 1 << 24  # of the broadcast filter of candidate ids (2 MB)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, k: int, cache: dict) -> np.ndarray:
    """Sorted distinct shingle hashes. A-Z in lower case, words between runs of
    the ASCII white space; fewer than k words are one shingle; none: empty."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(k, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - size + 1, np.uint64(size))
        for i in range(size):
            h = (h ^ w[i:i + len(h)]) * _M1
            h ^= h >> np.uint64(29)
        h *= _M2
        h ^= h >> np.uint64(32)
    return np.unique(h)


def rarity_counts(docs: DataFrame, p: JoinParams) -> np.ndarray:
    """Over all documents, how many shingles fall into each hash bucket. A task
    sends `buckets` numbers in pieces; the pieces are added in two steps, so what
    meets in one task grows with the square root of the number of tasks."""
    piece = 1024
    shift = np.uint64(64 - (p.buckets.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total = _Words(), np.zeros(p.buckets, np.int64)
        for b in batches:
            for t in b.column("text").to_pylist():
                total += np.bincount((shingles(t, p.words, cache) >> shift).astype(np.int64),
                                     minlength=p.buckets) if t else 0
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(range(0, p.buckets, piece), pa.int32()),
            "n": pa.array([total[i:i + piece].tobytes() for i in range(0, p.buckets, piece)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("n").to_pylist())
        return pa.table({"piece": pa.array([table.column("piece")[0].as_py()], pa.int32()),
                         "n": pa.array([total.tobytes()], pa.binary())})

    rows = map_batches(docs.select("text"), count, "piece int, n binary")
    rows = rows.withColumn("_s", F.pmod(F.spark_partition_id(), F.lit(16)))
    for keys in (["piece", "_s"], ["piece"]):
        rows = rows.groupBy(*keys).applyInArrow(add, "piece int, n binary")
    out = np.zeros(p.buckets, np.int64)
    for r in rows.collect():                       # buckets / 1024 rows
        out[r["piece"]:r["piece"] + piece] = np.frombuffer(bytes(r["n"]), np.int64)
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Bucket counts as 16-bit ranks, in order (equal counts share a rank)."""
    _, inverse = np.unique(counts, return_inverse=True)
    return (inverse * 65535 // max(1, inverse.max())).astype(np.uint16)


def index_keys(s: np.ndarray, rank: np.ndarray, p: JoinParams) -> np.ndarray:
    """Keys of a set: its first pairs of neighbours in order of rarity."""
    shift = np.uint64(64 - (p.buckets.bit_length() - 1))
    order = np.argsort(rank[(s >> shift).astype(np.int64)], kind="stable")   # s is sorted: ties by hash
    first = s[order[:2 * (p.den - p.num) * len(s) // p.den + 2]]
    with np.errstate(over="ignore"):
        return ((first[:-1] * _M3) ^ (first[1:] * _M4 + (first[:-1] >> np.uint64(31)))).view(np.int64)


def sketch(s: np.ndarray, p: JoinParams) -> bytes:
    """How many shingles fall into each of `sketch` parts of the hashes, 255 at most. The
    counts of two sets differ by no more in all than the sets do."""
    return np.minimum(np.bincount((s % np.uint64(p.sketch)).astype(np.int64), minlength=p.sketch), 255).astype(np.uint8).tobytes()


def _set_table(docs: DataFrame, rank: np.ndarray, p: JoinParams) -> DataFrame:
    """Per row: `doc_id`, `n` (set size), `sig`, `th` (hash of the text), `keys`, `sk`.
    A set that its task has met already carries no keys and no sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, met = _Words(), set()
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in chunks(texts):
                n, sig, keys, sk = [], [], [], []
                for t in texts[lo:hi]:
                    s = shingles(t, p.words, cache)
                    g = xxhash.xxh3_128_digest(s.tobytes())
                    n.append(len(s))
                    sig.append(g.hex())
                    new = len(s) > 1 and g not in met
                    keys.append(index_keys(s, shared.value, p) if new else np.empty(0, np.int64))
                    sk.append(sketch(s, p) if new else None)
                    met.add(g)
                ends = np.cumsum([0, *map(len, keys)])
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array(sig, pa.string()), b.column("th").slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(np.concatenate(keys), pa.int64())),
                    pa.array(sk, pa.binary())],
                    ["doc_id", "n", "sig", "th", "keys", "sk"])

    rows = map_batches(docs.withColumn("th", F.xxhash64("text")), run,
                       "doc_id long, n long, sig string, th long, keys array<long>, sk binary")
    return cut_lineage(rows.withColumn("uid", F.monotonically_increasing_id()))


def _list_pairs(sets: DataFrame, p: JoinParams) -> DataFrame:
    """Distinct pairs (`a`, `b`, uids) of rows that share a key and whose sizes are in
    reach. `near`: the two are not known to be near copies, and it is the pair alone that
    may link them; else `a` is the first of a run that is too long for all its pairs."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    post = sets.select("uid", "n", F.explode("keys").alias("key")).repartition(parts, "key")
    out_of_reach = lambda less, more: F.coalesce(F.lit(p.den) * less < F.lit(p.num) * more, F.lit(True))
    run = Window.partitionBy("key").orderBy("n", "uid")
    post = post.select("key", "uid", "n", out_of_reach(F.lag("n").over(run), F.col("n")).alias("starts"),
                       out_of_reach(F.col("n"), F.lead("n").over(run)).alias("ends")).where("not (starts and ends)")
    post = post.withColumn("run", F.sum(F.col("starts").cast("int")).over(run))
    run = Window.partitionBy("key", "run").orderBy("n", "uid")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    post = post.select("uid", "n", F.count(F.lit(1)).over(whole).alias("c"), F.first("uid").over(whole).alias("head"),
                       F.collect_list(F.struct("n", "uid")).over(run.rowsBetween(1 - p.short, -1)).alias("before"))
    short = F.col("c") <= p.short
    met = F.transform(F.filter("before", lambda x: ~out_of_reach(x["n"], F.col("n"))), lambda x: x["uid"])
    pairs = post.select(F.explode(F.when(short, met).otherwise(F.array("head"))).alias("a"),
                        F.col("uid").alias("b"), short.alias("near")).where("a != b")
    return pairs.groupBy("a", "b").agg(F.min("near").alias("near"))


def _edges(sets: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs (`a`, `b`) of `_list_pairs`, less those that their sketches tell apart."""
    pairs = cut_lineage(_list_pairs(sets, p))
    release(sets.sparkSession)
    size = sets.where("sk is not null").select("uid", "n", "sk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, p.sketch)
                    for c in ("ak", "bk"))
            apart = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64)
            both = b.column("an").to_numpy() + b.column("bn").to_numpy()
            yield b.select(["a", "b"]).filter(pa.array((p.den + p.num) * apart <= (p.den - p.num) * both))

    near = (pairs.where("near").join(size.toDF("a", "an", "ak"), "a").join(size.toDF("b", "bn", "bk"), "b"))
    near = map_batches(near.select("a", "b", "an", "bn", "ak", "bk"), run, "a long, b long")
    return cut_lineage(pairs.where("not near").select("a", "b").unionByName(near))


def linked_members(sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """Of each set the index of its component's first set, where two sets link
    when den * |both| >= num * |either|."""
    m = len(sets)
    order = sorted(range(m), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order], np.int64)
    token, times = np.unique(np.concatenate(sets), return_counts=True)
    centre = token[2 * times > m]
    diff = [np.setxor1d(sets[i], centre, assume_unique=True) for i in order]
    dsize = np.array([len(d) for d in diff], np.int64)
    _, ident = np.unique(np.concatenate(diff), return_inverse=True)
    member = np.repeat(np.arange(m), dsize)
    by = np.argsort(ident, kind="stable")               # lists, members by size
    member, start = member[by], np.searchsorted(ident[by], np.arange(ident.max() + 2 if len(ident) else 1))
    own = np.split(ident, np.cumsum(dsize)[:-1])
    root, fresh = np.full(m, -1), np.ones(m, bool)
    for first in range(m):
        if not fresh[first]:
            continue
        fresh[first], root[first] = False, first
        queue = [first]
        while queue:
            x = queue.pop()
            lo = int(np.searchsorted(size, -(-num * size[x] // den)))
            hi = int(np.searchsorted(size, den * size[x] // num, side="right"))
            left = lo + np.flatnonzero(fresh[lo:hi])
            if not len(left):
                continue                                 # nothing in reach is open
            hits = np.zeros(hi - lo, np.int64)
            parts = []
            for t in own[x]:
                a, b = start[t], start[t + 1]
                if member[a] < lo or member[b - 1] >= hi:    # skip to the sizes in reach
                    a, b = a + np.searchsorted(member[a:b], (lo, hi))
                parts.append(member[a:b])
            if parts:
                hits = np.bincount(np.concatenate(parts) - lo, minlength=hi - lo)
            apart = dsize[x] + dsize[left] - 2 * hits[left - lo]
            both = (size[x] + size[left] - apart) // 2
            near = left[den * both >= num * (size[x] + size[left] - both)]
            fresh[near], root[near] = False, first
            queue += near.tolist()
    out = [0] * m
    for k, i in enumerate(order):
        out[i] = order[root[k]]
    return out


def _link_families(rows: DataFrame, p: JoinParams) -> DataFrame:
    """Edges (`a`, `b`) between linked classes. `rows`: `fam`, `i`, `j` (blocks
    that meet), `cls`, `text`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key, held = _Words(), None, {}

        def close() -> Iterator[pa.RecordBatch]:
            ids = sorted(held)
            if len(ids) > 1:
                first = linked_members([held[i] for i in ids], p.num, p.den)
                pairs = [(ids[k], ids[f]) for k, f in enumerate(first) if f != k]
                if pairs:
                    a, b = zip(*pairs)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for b in batches:
            for fam, i, j, cls, text in zip(*(b.column(c).to_pylist() for c in ("fam", "i", "j", "cls", "text"))):
                if (fam, i, j) != key:
                    yield from close()
                    key, held = (fam, i, j), {}
                if cls not in held:
                    held[cls] = shingles(text, p.words, cache)
        yield from close()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(rows.repartition(parts, "fam", "i", "j").sortWithinPartitions("fam", "i", "j"),
                       run, "a long, b long")


def ngram_components(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """One row per input row: `doc_id`, `th` (a hash of the text), `n_shingles`,
    `component_id` (the smallest doc_id of the component), `uid` (a row number), `first` (whether the row is
    its component's one to keep: the smallest doc_id, null last, then `uid`).

    Null, empty and all-white texts have no shingle, link with nothing and are
    components of their own. Rows that repeat are linked copies. A component
    whose rows all have a null id has a null `component_id`.
    """
    p = params
    if 3 * p.num <= 2 * p.den:
        raise ValueError("the prefix of pairs is exact for similarities above 2/3 only")
    df = docs_of(docs)
    rank = ranks(rarity_counts(df, p))
    release(df.sparkSession)
    sets = _set_table(df, rank, p)
    release(df.sparkSession)
    rows = sets.where("n > 0").select("uid", "doc_id", "n", "sig", "th")
    n_rows = rows.count()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("uid"))
    classes = rows.groupBy("sig").agg(F.min("uid").alias("cls"), F.count(F.lit(1)).alias("copies"),
                                      F.min(order).alias("best"))
    classes = cut_lineage(classes)
    # Pairs of rows; those of one class count, and drop out below.
    edges = _edges(sets, p)
    release(df.sparkSession)
    # From rows to classes: the rows that have an edge, with their class.
    nodes = edges.select(F.col("a").alias("uid")).unionByName(edges.select(F.col("b").alias("uid"))).distinct()
    known = cut_lineage(attach_by_key(rows.join(nodes, "uid").select("uid", "sig"),
                                      classes.select("sig", "cls", "copies"), "sig", "copies", n_rows)
                        .select("uid", "cls"))
    pairs = (edges.join(known.select(F.col("uid").alias("a"), F.col("cls").alias("ca")), "a")
             .join(known.select(F.col("uid").alias("b"), F.col("cls").alias("cb")), "b")
             .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    family = cut_lineage(connected_components(pairs))            # node: cls, root: family
    del edges, nodes, known, pairs
    release(df.sparkSession)
    size = family.groupBy(F.col("root").alias("fam")).agg(F.count(F.lit(1)).alias("members"))
    placed = attach_by_key(family.select(F.col("node").alias("cls"), F.col("root").alias("fam")),
                           size, "fam", "members", n_rows)
    blocks = F.ceil(F.col("members") / F.lit(p.block)).cast("int")
    placed = placed.withColumn("_n", blocks).withColumn("_b", F.pmod(F.xxhash64("cls"), F.col("_n")).cast("int"))
    meet = F.when(F.col("_n") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: k != F.col("_b")),
                    lambda k: F.struct(F.least(k, F.col("_b")).alias("i"), F.greatest(k, F.col("_b")).alias("j"))))
    placed = placed.select("cls", "fam", meet.alias("meet"))
    wanted = cut_lineage(rows.select(F.col("uid").alias("cls"), "doc_id", "th").join(placed, "cls"))
    # Only texts that may be wanted go into the join, by a broadcast filter of fixed size.
    near = hash_filter(wanted, ["doc_id", "th"], p.filter_bits)
    texts = marked(df.withColumn("th", F.xxhash64("text")), near, ["doc_id", "th"], p.filter_bits,
                   "near").where("near")
    match = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["th"] == wanted["th"])
    members = (texts.join(wanted, match).select("cls", "fam", "text", F.explode("meet").alias("_p"))
               .select("cls", "fam", "text", "_p.i", "_p.j"))
    linked = connected_components(_link_families(members, p))    # node: cls, root: cls
    del family, size, placed, wanted, near, texts, members
    release(df.sparkSession)
    # Answers of the classes, then of all their rows.
    classes = cut_lineage(classes.join(linked, F.col("cls") == F.col("node"), "left").select(
        "sig", "copies", "best", F.coalesce("root", "cls").alias("comp")))
    whole = classes.groupBy("comp").agg(F.min("best").alias("keep"), F.count(F.lit(1)).alias("_n"))
    classes = cut_lineage(attach_by_key(classes.select("sig", "copies", "comp"), whole, "comp", "_n", n_rows))
    del linked, whole
    release(df.sparkSession)
    out = attach_by_key(rows, classes.select("sig", "copies", "keep"), "sig", "copies", n_rows).select(
        "doc_id", "th", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"), "uid",
        (F.col("uid") == F.col("keep.uid")).alias("first"))
    empty = sets.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"), "uid", F.lit(True).alias("first"))
    return out.unionByName(empty)


def keep_one_of_each(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """The rows of `docs`, with all their columns, less all but one row of each
    component. Only rows of which some may go are shuffled."""
    bits = params.filter_bits
    found = ngram_components(docs, params).groupBy("doc_id", "th").agg(
        F.sum(F.col("first").cast("int")).alias("stay"), F.count(F.lit(1)).alias("all")).where("stay < all")
    found = cut_lineage(found.select(F.col("doc_id").alias("_j"), F.col("th").alias("_t"), "stay"))
    release(docs.sparkSession)
    near = cut_lineage(hash_filter(found, ["_j", "_t"], bits))    # read three times below
    rows = docs.withColumns({"_i": F.col("doc_id").cast("long"),
                             "_h": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    rows = marked(rows, near, ["_i", "_h"], bits, "_near")
    hit = rows.where("_near").join(found, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("_h") == F.col("_t")), "left")
    pick = hit.where("stay = 1").dropDuplicates(["_i", "_h"])      # rows that repeat as a whole
    return (rows.where("not _near").select(*docs.columns)
            .unionByName(hit.where("stay is null").select(*docs.columns))
            .unionByName(pick.select(*docs.columns)))

"""Phrase collocations per language by Toivonen's mining.

A phrase is 1 to `longest` consecutive words of a piece of text; it is frequent in its
language with `least` occurrences or more. No part of a frequent phrase is rarer than
the phrase itself, so frequent phrases can be mined by their parts:

1. A sample of the documents proposes phrases: those that reach, in the sample, a count
   lowered so far that a frequent phrase is seldom missed (levels one word apart, so a
   longer phrase is only counted if its parts were proposed).
2. A full pass counts, exactly, every proposed phrase and the negative border: the
   phrases that were not proposed though both parts without the first and without the
   last word were. That is decided at each occurrence, so the border is never listed.
3. If a phrase of the border is frequent (a failure), longer phrases over it have not
   been counted. An expansion pass over the whole corpus then counts every phrase that
   no pass has counted and none of whose parts is known to be rare. That closes the
   border in one pass: the parts of a frequent phrase are frequent, so none of them is
   ever known to be rare, and the phrase is counted by the first pass or by this one.

Which phrases to count is asked of Bloom filters over 64-bit phrase hashes, sized from
the number of phrases up to `max_bits` and broadcast. A false positive, or a filter at
its bound, makes a pass count more phrases and changes no result: what is returned was
counted by the phrase's text. A pass first counts by hash and then, by text, the phrases
whose hash is frequent. Equal phrases are combined within a batch, again within a task
and only then shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach_by_key, map_batches, prepare, splitmix64, written

UNKNOWN = "und"


@dataclass(frozen=True)
class PhraseParams:
    longest: int = 5            # words of a phrase
    least: int = 100            # occurrences of a frequent phrase
    share: float = 1 / 8        # of the documents in the sample
    slack: float = 2.5          # standard deviations by which the sample's threshold is lowered
    bits_each: int = 12         # filter bits for a phrase
    max_bits: int = 1 << 28     # 32 MB
    chunk: int = 1 << 21        # bytes of text that a worker holds as arrays at once
    top: int = 2000             # phrases of a language in the report
    bins: int = 64              # parts of a language that are ranked apart first

    @property
    def sample_least(self) -> int:
        mean = self.share * self.least
        return max(2, int(mean - self.slack * mean ** 0.5))


# --------------------------------------------------------------- words and hashes

_KIND = np.zeros(256, np.uint8)                 # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.array(splitmix64(256, 1), np.uint64)
_SEEDS = np.array(splitmix64(16, 2), np.uint64)
_BREAK = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
_PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Consecutive words of some texts: `raw` holds each followed by one space, word i
    at `at[i]` with `size[i]` bytes; its hash, piece and text. `old`: counted before,
    here only as the beginning of phrases."""
    raw: np.ndarray
    at: np.ndarray
    size: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    old: np.ndarray


def read_words(texts: list[bytes], n_old: list[int]) -> Words:
    """The words of `texts`, of which the first `n_old` are old."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[raw]
    word = kind == 0
    edge = np.diff(np.concatenate([[False], word]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    text = np.searchsorted(starts, begin, "right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
    keep = word
    keep[end] = True
    raw = _LOWER[raw[keep]]
    size = end - begin
    at = np.cumsum(size + 1) - size - 1
    raw[at + size] = 0x20
    h = np.zeros(0, np.uint64)
    if len(at):
        place = (np.arange(len(raw)) - np.repeat(at, size + 1)).astype(np.uint64)
        x = _BYTES[raw] + place * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        h = mix(np.add.reduceat(x, at))
    first = np.searchsorted(text, np.arange(len(texts)))
    old = np.arange(len(at)) - first[text] < np.array(n_old, np.int64)[text] if len(at) else np.zeros(0, bool)
    return Words(raw, at, size, h, piece, text, old)


def chunked(langs: list[str], texts: list[str], limit: int, n_lead: int) -> Iterator[tuple[list[str], list[bytes], list[int]]]:
    """Texts in chunks of about `limit` bytes. A longer text is cut between words; the
    last `n_lead` words before the cut lead the next part, as old ones, if the cut is not
    between pieces."""
    out, size = ([], [], []), 0
    for lang, text in zip(langs, texts):
        data, at, n_old = text.encode("utf-8", "replace"), 0, 0
        lead = b""
        while True:
            m = _BREAK.search(data, at + limit) if len(data) - at > limit else None
            part = lead + (data[at:m.start()] if m else data[at:] if at else data)
            out[0].append(lang)
            out[1].append(part)
            out[2].append(n_old)
            size += len(part)
            if size >= limit:
                yield out
                out, size = ([], [], []), 0
            if m is None:
                break
            at = m.start()                       # the break itself begins the next part
            end = part.rstrip(b" \t")
            last = re.split(rb"[\x20\x09]+", _PIECE_END.split(end)[-1])[-n_lead:] if n_lead else []
            last = [x for x in last if x]
            lead, n_old = b" ".join(last), len(last)
    if out[0]:
        yield out


class Bloom:
    """A Bloom filter with two positions a hash; `bits` is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for i in range(2):
            at = positions(h, i) & self.mask
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def positions(h: np.ndarray, i: int) -> np.ndarray:
    return h if i == 0 else (h >> np.uint64(32)) | (h << np.uint64(32))


# ------------------------------------------------------------------- one pass

@dataclass(frozen=True)
class Pass:
    """What a pass counts. `proposed` (None: nothing yet) and `levels`: phrases whose
    parts are all proposed, of these lengths (0: the number of words). With `known`, the filter of the phrases that
    are known to be frequent: those that the pass by `proposed` has not counted, and
    none of whose counted parts is rare (`levels` is not used)."""
    proposed: object
    levels: tuple[int, ...]
    known: object = None


def phrase_hash(before: np.ndarray | None, word: np.ndarray, k: int, lang: np.ndarray) -> np.ndarray:
    """Of a phrase of k words from that of its first k - 1 words and its last word."""
    return mix(word ^ lang) if before is None else mix(before * _SEEDS[k] + word)


def count_chunk(w: Words, lang: np.ndarray, how: Pass, longest: int) -> Iterator[tuple]:
    """(k, first word, count, hash, proposed) of the distinct phrases of k words that
    `how` counts in a chunk. `lang`: each word's language, hashed."""
    n, h = len(w.at), None
    proposed = how.proposed.value if how.proposed else None
    known = how.known.value if how.known else None
    here = good = np.ones(n, bool)              # phrases of k - 1 words: parts proposed / not known to be rare
    for k in range(1, longest + 1):
        m = n - k + 1
        if m <= 0:
            return
        h = phrase_hash(None if k == 1 else h[:m], w.hash[k - 1:], k, lang[:m])
        inside = w.piece[:m] == w.piece[k - 1:]
        parts = inside & here[:m] & (here[1:m + 1] if k > 1 else True)   # both parts proposed: counted by the first pass
        hit = np.zeros(m, bool)
        if proposed is not None and parts.any():
            i = np.flatnonzero(parts)
            hit[i] = proposed.has(h[i])
        if known is None:
            now = parts if k in how.levels else None
        else:
            able = inside & good[:m] & (good[1:m + 1] if k > 1 else True)
            now = able & ~parts
            good = now.copy()
            i = np.flatnonzero(able & parts)
            good[i] = known.has(h[i])
        here = hit
        if now is not None:
            i = np.flatnonzero(now & ~w.old[k - 1:])
            if len(i):
                i = i[np.argsort(h[i])]
                new = np.flatnonzero(np.append(True, h[i][1:] != h[i][:-1]))
                first, count = i[new], np.diff(np.append(new, len(i)))
                yield k, first, count, h[first], hit[first]
        if known is None and (not hit.any() or k >= max(how.levels)):
            return
        if known is not None and not good.any():
            return


def phrase_bytes(w: Words, first: np.ndarray, k: int) -> pa.Array:
    """The phrases' texts as an Arrow string array, gathered from the words' bytes."""
    last = first + k - 1
    size = w.at[last] + w.size[last] - w.at[first]
    ends = np.cumsum(size)
    at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(w.at[first], size)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(w.raw[at].tobytes()))


def _lang_hash(names: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > 100_000:
        known.clear()
    for x in names:
        if x not in known:
            known[x] = int.from_bytes(blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "little")
    return np.array([known[x] for x in names], np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch], p: PhraseParams) -> Iterator[tuple[list[str], Words, np.ndarray]]:
    """Languages of the texts, words, and each word's language, hashed."""
    hashes: dict[str, int] = {}
    for b in batches:
        for langs, texts, n_old in chunked(*(b.column(c).to_pylist() for c in ("lang", "text")), p.chunk, p.longest - 1):
            w = read_words(texts, n_old)
            yield langs, w, _lang_hash(langs, hashes)[w.text]


def count_hashes(docs: DataFrame, how: Pass, p: PhraseParams) -> DataFrame:
    """`h`, `n` of every phrase that `how` counts, by its hash (of language and words). A
    hash may stand for several phrases, so `n` is an upper bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w, lang in _chunks(batches, p):
            for _, _, count, h, _ in count_chunk(w, lang, how, p.longest):
                yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "n": pa.array(count.astype(np.int64))})

    return map_batches(docs.select("lang", "text"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def count_phrases(docs: DataFrame, how: Pass, wanted, p: PhraseParams) -> DataFrame:
    """`lang`, `k`, `phrase`, `n`, `h`, `proposed` of every phrase that `how` counts and whose
    hash the filter `wanted` has. With level 0 also the number of words, as k = 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, w, lang in _chunks(batches, p):
            if 0 in how.levels:
                names = sorted(set(langs))
                at = np.array([names.index(x) for x in langs])[w.text]
                yield _rows(pa.array(names), 0, pa.array([""] * len(names)), np.bincount(at, ~w.old, len(names)),
                            np.zeros(len(names), np.uint64), np.ones(len(names), bool))
            names = pa.array(langs, pa.string())
            for k, first, count, h, hit in count_chunk(w, lang, how, p.longest):
                i = np.flatnonzero(wanted.value.has(h))
                if len(i):
                    yield _rows(names.take(pa.array(w.text[first[i]])), k, phrase_bytes(w, first[i], k), count[i], h[i], hit[i])

    got = map_batches(docs.select("lang", "text"), run,
                      "lang string, k int, phrase string, n long, h long, proposed boolean")
    return got.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"), F.max("h").alias("h"),
                                                  F.max("proposed").alias("proposed"))


def _rows(lang, k: int, phrase, n: np.ndarray, h: np.ndarray, proposed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "lang": lang, "k": pa.array(np.full(len(n), k, np.int32)), "phrase": phrase, "n": pa.array(n.astype(np.int64)),
        "h": pa.array(h.view(np.int64)), "proposed": pa.array(proposed)})


def exact_counts(docs: DataFrame, how: Pass, p: PhraseParams, name: str) -> DataFrame:
    """The frequent ones of the phrases that `how` counts, exactly. Almost all phrases of the
    border are rare, so they are first counted by their hashes, 16 bytes a row; only
    phrases whose hash reaches `least` are then counted by their text."""
    often = written(count_hashes(docs, how, p).where(F.col("n") >= p.least).select("h"), f"{name}-hashes")
    counted = count_phrases(docs, how, bloom_of(often, p), p)
    return written(counted.where((F.col("n") >= p.least) | (F.col("k") == 0)), name)


def bloom_of(phrases: DataFrame, p: PhraseParams):
    """A broadcast filter over the hashes `h` of `phrases`. Its words come from a grouped
    aggregate; one task packs them, at most `max_bits` / 64 rows, into one value."""
    bits = 1 << 13
    n = phrases.count()
    while bits < p.bits_each * n and bits < p.max_bits:
        bits *= 2
    spots = [F.col("h"), F.shiftrightunsigned("h", 32).bitwiseOR(F.shiftleft("h", 32))]
    at = phrases.select(F.explode(F.array(*[s.bitwiseAND(F.lit(bits - 1)) for s in spots])).alias("p"))
    words = (at.groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("mask")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(bits // 64, np.int64)
        for b in batches:
            out[b.column("w").to_numpy()] = b.column("mask").to_numpy()
        yield pa.RecordBatch.from_pydict({"f": pa.array([out.tobytes()], pa.binary())})

    got = words.repartition(1).mapInArrow(pack, "f binary").collect()
    data = np.frombuffer(bytes(got[0]["f"]), np.uint64) if got else np.zeros(bits // 64, np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(Bloom(data))


# ------------------------------------------------------------------- mining

def propose(docs: DataFrame, p: PhraseParams):
    """The sample's proposal as a filter: a level a step, the phrases of k words whose
    parts were proposed and that reach the lowered count in the sample."""
    scale = 1 << 20
    sample = written(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(p.share * scale))
                     .select("lang", "text"), "phrase-sample")
    found = proposed = None
    for k in range(1, p.longest):                # phrases of `longest` words have no extensions
        got = count_hashes(sample, Pass(proposed, (k,)), p).where(F.col("n") >= p.sample_least)
        got = written(got.select("h"), f"phrase-proposal-{k}")
        found = got if found is None else found.unionByName(got)
        proposed = bloom_of(found, p)
    return proposed


def frequent_phrases(docs: DataFrame, params: PhraseParams = PhraseParams()) -> tuple[DataFrame, DataFrame, int]:
    """(phrases, totals, passes): `lang`, `k`, `phrase`, `n` of every frequent phrase with
    its exact count, the number of words `n` of every `lang`, and how many full passes
    there were. A null language counts as `und`, a null text as empty."""
    prepare(docs.sparkSession)
    p = params
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    proposed = propose(docs, p)
    every = tuple(range(p.longest + 1))
    counted = exact_counts(docs, Pass(proposed, every), p, "phrase-counts")
    totals = counted.where((F.col("k") == 0) & (F.col("n") > 0)).select("lang", "n")
    found, passes = counted.where("k > 0"), 1
    if not found.where(~F.col("proposed") & (F.col("k") < p.longest)).isEmpty():
        more = exact_counts(docs, Pass(proposed, (), bloom_of(found, p)), p, "phrase-expansion")
        found, passes = found.unionByName(more), 2
    return found.select("lang", "k", "phrase", "n"), totals, passes


def _joined(words: Column, begin, size) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def collocations(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score` of each language's first `top`
    phrases of two words or more.

    A candidate with a occurrences is cut after its first words into two parts with l and
    r occurrences; score = floor(1000 a n / (l r)) of the cut with the lowest score, then
    the shortest first part. Candidates go that lie in a longer candidate with as many
    occurrences (they need be sought one word longer only: what lies between has the same
    count). Order: score, a, descending, then the phrase's bytes. Arithmetic is exact, in
    decimals of 38 digits. Texts without words, and an empty table, give no rows."""
    p = params
    found, totals, _ = frequent_phrases(docs, p)
    counts = found.select("lang", "phrase", "n")
    cand = found.where("k > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
    k = F.size("_w")
    shorter = (cand.where(k > 2)
               .select("lang", "a", F.explode(F.array(_joined(F.col("_w"), F.lit(1), k - 1),
                                                      _joined(F.col("_w"), F.lit(2), k - 1))).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("a").alias("_longer")))
    kept = cand.join(shorter.hint("merge"), ["lang", "phrase"], "left").where("_longer IS NULL OR _longer < a")
    kept = written(kept.drop("_longer"), "phrase-candidates")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("_size")).join(totals, "lang")
    kept = attach_by_key(kept, sizes, "lang", "_size", kept.count())
    cuts = kept.select("lang", "phrase", "a", "n", "_w", F.explode(F.sequence(F.lit(1), k - 1)).alias("_k"))
    cuts = cuts.select("lang", "phrase", "a", "n", "_k", _joined(F.col("_w"), F.lit(1), F.col("_k")).alias("_left"),
                       _joined(F.col("_w"), F.col("_k") + 1, k - F.col("_k")).alias("_right"))
    for part, out in (("_left", "l"), ("_right", "r")):
        side = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(out))
        cuts = cuts.join(side.hint("merge"), ["lang", part])
    big = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * big["a"] * big["n"], big["l"] * big["r"])
    best = (cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "_k", "l", "r")).alias("_c")).select("lang", "phrase", "a", "n", "_c.*"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language may hold most phrases: its bins are ranked apart, and only their best meet
    best = best.withColumn("_bin", F.pmod(F.xxhash64("phrase"), F.lit(p.bins)))
    for by in (["lang", "_bin"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
            F.col("rank") <= p.top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

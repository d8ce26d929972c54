"""Document quality from attention-based multiple-instance learning.

A document is a bag of passages of `words` words. Every passage x_k (hashed words
and word shapes, and a few figures on repetition) is encoded as

    h_k = tanh(W x_k + b)

and has a gated attention weight, learned from document labels alone:

    a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))

The document is the weighted passage representation z = sum_k a_k h_k, scored
sigmoid(c . z + d). So a document of many plain passages and one bad stretch is told
apart by that stretch, which the attention finds.

Fitting reads a bounded sample of the labelled rows (`max_rows`, chosen by a hash of
the id) in one task; the model has a fixed size and is broadcast. Scoring is a map
over all documents: no shuffle, every passage of whole texts, in blocks of bounded
size however long a text is (the softmax is accumulated over blocks).
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_CHARS, docs_of, map_batches, splitmix64

_CACHE_WORDS = 200_000
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class MILParams:
    max_rows: int = 6_000       # labelled rows read for the fit, at most
    words: int = 64             # words of a passage
    term_bits: int = 8          # 2**bits slots of words, signed
    shape_bits: int = 7         # 2**bits slots of word shapes
    hidden: int = 24            # length of an encoded passage
    gate: int = 12              # length of the attention's inner vector
    epochs: int = 12
    batch: int = 32             # documents of a step
    rate: float = 3e-3          # Adam step
    l2: float = 1e-4
    threshold: float = 0.7      # predicted 1 from this score on
    seed: int = 11


#: Figures besides the slots: repeats of the word before, distinct words, word length,
#: capitals only, words without a letter, and how full the passage is.
N_FIGURES = 6


def _code(word: str, tails: dict[str, int]) -> int:
    """A word packed in one number: 16 bits for its term slot, 16 for its shape slot,
    one each for a capital word and one without letters, 6 for the length, the sign,
    and 22 that tell words of a passage apart. The shape is the letters' case and the
    first signs after the last letter or digit (`tails`: their slots)."""
    crc = zlib.crc32(word.lower().encode("utf-8", "replace"))
    size, caps, bare = len(word), False, False
    if word.islower() and word.isalpha():
        shape = "a"
    else:
        core = word.rstrip(_SIGNS)
        caps = size > 1 and word.isupper()
        kind = ("a" if core.islower() else "T" if core.istitle() else "A" if caps else "9" if core.isdigit() else "m")
        bare = not caps and not word.islower() and not any(map(str.isalpha, word))
        shape = kind + ("" if core.isalnum() else "-") + word[len(core):][:3]
    slot = tails.get(shape)
    if slot is None:
        slot = tails[shape] = zlib.crc32(shape.encode("utf-8", "replace"), 5) & 0xFFFF
    return ((crc & 0xFFFF) | slot << 16 | caps << 32 | bare << 33 | (size if size < 63 else 63) << 34
            | (crc >> 16 & 1) << 40 | (crc >> 10) << 41)


class _Words(dict):
    """word -> its number, kept for the words met last."""

    def __init__(self):
        self.tails: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        out = _code(word, self.tails)
        if len(self) >= _CACHE_WORDS:
            self.clear()
            self.tails.clear()
        if len(word) < 100:
            self[word] = out
        return out


def features(codes: np.ndarray, starts: np.ndarray, p: MILParams) -> np.ndarray:
    """A row per passage: `codes` of all words, `starts` where each passage begins."""
    n, nt, ns = len(starts), 1 << p.term_bits, 1 << p.shape_bits
    out = np.zeros((n, nt + ns + N_FIGURES), np.float32)
    if not len(codes):
        return out
    size = np.diff(np.append(starts, len(codes)))
    row = np.repeat(np.arange(n), size)
    terms = np.bincount(row * nt + (codes & (nt - 1)), 1.0 - 2.0 * (codes >> 40 & 1), n * nt).reshape(n, nt)
    shapes = np.bincount(row * ns + (codes >> 16 & (ns - 1)), minlength=n * ns).reshape(n, ns)
    each = np.maximum(size, 1)[:, None]
    out[:, :nt] = terms / np.sqrt(each)
    out[:, nt:nt + ns] = np.sqrt(shapes / each)
    again = np.zeros(len(codes))
    again[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    ranked = codes[np.lexsort((codes, row))]                 # sorted within each passage
    new = np.ones(len(codes))
    new[1:] = (ranked[1:] != ranked[:-1]) | (row[1:] != row[:-1])
    for j, f in enumerate([again, new, (codes >> 34 & 63) / 10, codes >> 32 & 1, codes >> 33 & 1]):
        out[:, nt + ns + j] = np.bincount(row, f, n) / each[:, 0]
    out[:, -1] = size / p.words
    return out


_BREAK = re.compile(r"\s")


def blocks(text: str, limit: int = CHUNK_CHARS) -> Iterator[str]:
    """The text in pieces of about `limit` code points that no word spans."""
    at = 0
    while len(text) - at > limit:
        m = _BREAK.search(text, at + limit)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:] if at else text


def passages(texts: list[str], p: MILParams, words: _Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, starts, doc): words of consecutive passages and each passage's index in
    `texts`, in blocks of about CHUNK_CHARS code points. Passages of a text follow
    each other without gaps; a text without words has one empty passage."""
    codes, lens, docs, chars = [], [], [], 0

    def flush():
        at = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        return np.concatenate(codes) if codes else np.zeros(0, np.int64), at, np.array(docs)

    for i, text in enumerate(texts):
        left = np.zeros(0, np.int64)         # words of an unfinished passage
        seen = False
        for block in blocks(text):
            got = block.split()
            mine = np.concatenate([left, np.fromiter(map(words.__getitem__, got), np.int64, len(got))])
            full = len(mine) // p.words
            codes.append(mine[:full * p.words])
            lens += [p.words] * full
            docs += [i] * full
            left, seen = mine[full * p.words:], seen or full > 0
            chars += len(block)
            if chars >= CHUNK_CHARS and lens:
                yield flush()
                codes, lens, docs, chars = [], [], [], 0
        if len(left) or not seen:
            codes.append(left)
            lens.append(len(left))
            docs.append(i)
    if lens:
        yield flush()


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class MILModel:
    """The encoder (W, b), the gated attention (V, U, w) and the scorer (c, d)."""
    params: MILParams
    weights: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention logits."""
        q = self.weights
        h = np.tanh(x @ q["W"] + q["b"])
        return h, (np.tanh(h @ q["V"]) * _sigmoid(h @ q["U"])) @ q["w"]

    def score(self, texts: list[str], words: _Words) -> np.ndarray:
        """A running softmax over blocks: per text the largest logit so far, the sum of
        weights and the weighted sum of passages, both relative to it."""
        n, q = len(texts), self.weights
        top, total, z = np.full(n, -np.inf), np.zeros(n), np.zeros((n, self.params.hidden))
        for codes, starts, doc in passages(texts, self.params, words):
            h, e = self.encode(features(codes, starts, self.params))
            first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            mine = doc[first]
            most = np.maximum(np.maximum.reduceat(e, first), top[mine])
            old = np.exp(top[mine] - most)
            top[mine] = most
            a = np.exp(e - top[doc])
            total[mine] = total[mine] * old + np.add.reduceat(a, first)
            z[mine] = z[mine] * old[:, None] + np.add.reduceat(a[:, None] * h, first)
        return _sigmoid((z / total[:, None]) @ q["c"] + q["d"])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.weights)
        return out.getvalue()

    @staticmethod
    def from_bytes(params: MILParams, data: bytes) -> MILModel:
        return MILModel(params, dict(np.load(io.BytesIO(data))))


def initial(p: MILParams, rate: float) -> MILModel:
    """Random small weights; the scorer starts at the share of label 1."""
    rng = np.random.Generator(np.random.PCG64(splitmix64(1, p.seed)[0]))
    f = (1 << p.term_bits) + (1 << p.shape_bits) + N_FIGURES

    def some(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return MILModel(p, {"W": some(f, p.hidden), "b": np.zeros(p.hidden), "V": some(p.hidden, p.gate),
                        "U": some(p.hidden, p.gate), "w": some(p.gate), "c": some(p.hidden) * 0.1,
                        "d": np.array(np.log((rate + 1e-3) / (1 - rate + 1e-3)))})


def gradient(m: MILModel, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of bags and its gradient. `x`: passages, `first`: where each bag begins."""
    q, n = m.weights, len(first)
    size = np.diff(np.append(first, len(x)))
    bag = np.repeat(np.arange(n), size)
    h = np.tanh(x @ q["W"] + q["b"])
    t, s = np.tanh(h @ q["V"]), _sigmoid(h @ q["U"])
    e = (t * s) @ q["w"]
    a = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    p = _sigmoid(z @ q["c"] + q["d"])
    loss = -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))
    dz = (p - y)[:, None] / n * q["c"]                       # of the bag representation
    da = np.einsum("ij,ij->i", dz[bag], h)
    de = a * (da - np.add.reduceat(a * da, first)[bag])      # through the softmax
    dt, ds = de[:, None] * q["w"] * s * (1 - t * t), de[:, None] * q["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ q["V"].T + ds @ q["U"].T) * (1 - h * h)
    return loss, {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
                  "c": z.T @ (p - y) / n, "d": np.array(np.mean(p - y))}


def _fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, p: MILParams) -> MILModel:
    """Adam over the bags (codes, passage starts), in an order fixed by the seed."""
    m = initial(p, float(y.mean()) if len(y) else 0.5)
    if len(np.unique(y)) < 2:
        m.weights["c"][:] = 0
        return m
    rng = np.random.Generator(np.random.PCG64(splitmix64(2, p.seed)[1]))
    mean = {k: np.zeros_like(v) for k, v in m.weights.items()}
    var = {k: np.zeros_like(v) for k, v in m.weights.items()}
    step = 0
    for _ in range(p.epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), p.batch):
            mine = [bags[k] for k in order[lo:lo + p.batch]]
            words = np.cumsum([0] + [len(c) for c, _ in mine])
            starts = np.concatenate([s + o for (_, s), o in zip(mine, words)])
            first = np.cumsum([0] + [len(s) for _, s in mine])[:-1]
            x = features(np.concatenate([c for c, _ in mine]), starts, p)
            _, g = gradient(m, x, first, y[order[lo:lo + p.batch]])
            step += 1
            for k, w in m.weights.items():
                d = g[k] + p.l2 * w * (k != "d")
                mean[k] = 0.9 * mean[k] + 0.1 * d
                var[k] = 0.999 * var[k] + 0.001 * d * d
                m.weights[k] = w - p.rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.999 ** step)) + 1e-8)
    return m


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column | None = None,
                params: MILParams = MILParams()) -> MILModel:
    """Fit on labelled documents for which `train` (over `doc_id`) holds.

    `labels` has `doc_id` and `quality` (1: good; null rows are skipped). At most
    `params.max_rows` label rows are used, those with the smallest hash of the id, in
    one task that holds 8 bytes a word of their texts. Without usable labels, or with
    one class, the model is a constant.
    """
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    lab = lab.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if train is not None:
        lab = lab.where(train)
    lab = (lab.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id", "quality")
           .limit(params.max_rows).select("doc_id", "quality"))
    rows = docs_of(docs).join(F.broadcast(lab), "doc_id")    # max_rows ids: bounded

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            for i, t in enumerate(b.column("text").to_pylist()):
                codes = [c for c, _, _ in passages([t], params, words)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(i, 1), "quality": b.column("quality").slice(i, 1),
                    "codes": pa.array([np.concatenate(codes).tobytes()], pa.binary())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            got += zip(*(b.column(c).to_pylist() for c in ("doc_id", "quality", "codes")))
        got.sort()
        bags = [(c, np.arange(0, max(len(c), 1), params.words)) for c in (np.frombuffer(x, np.int64) for _, _, x in got)]
        model = _fit(bags, np.array([float(q) for _, q, _ in got]), params)
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.to_bytes()], pa.binary())})

    feats = map_batches(rows, featurise, "doc_id long, quality int, codes binary")
    got = feats.repartition(1).mapInArrow(fit, "model binary").collect()
    return MILModel.from_bytes(params, bytes(got[0]["model"])) if got else _fit([], np.zeros(0), params)


def score_quality(docs: DataFrame, model: MILModel) -> DataFrame:
    """`doc_id`, `score` (0 to 1, higher: label 1 likelier), `predicted` (1 from
    `params.threshold` on) of every row. A null, empty or white text is one empty
    passage. Repeated rows are each scored; extra columns are dropped."""
    df = docs_of(docs)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, words = shared.value, _Words()
        for b in batches:
            s = m.score(b.column("text").to_pylist(), words) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "score": pa.array(s, pa.float64()),
                "predicted": pa.array((s >= m.params.threshold).astype(np.int32), pa.int32())})

    return map_batches(df, run, "doc_id long, score double, predicted int")

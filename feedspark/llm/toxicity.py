"""Toxicity scores from a factorization machine over hashed terms.

A document is a set of terms (words, word beginnings and stems), each hashed to one of
2**bits slots. The score is

    sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)

so that besides the linear weights, pairs of terms (an insult near a group's
name, two mild words that are hostile together) have a weight of their own,
factorised as the product of two short vectors. The pair sum is evaluated in
linear time as half of |sum v_i|^2 - sum |v_i|^2.

Every slot that enough sampled documents hold has a weight and a vector, also one
that shows no association with the label by itself: it may do so in a pair. Such a
quiet slot enters with a small value x_i in place of 1 (w_i x_i, v_i x_i), which
shrinks what it learns from noise and leaves what many documents agree on.

Fitting reads a bounded sample of the labelled rows (`max_rows`, chosen by a
hash of the id), in one task; the model has a fixed size (2**bits x (2 + rank)
numbers at most) and is broadcast. Scoring is a map over all documents: no
shuffle, whole texts.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, docs_of, give_back, map_batches, splitmix64

_WORD = re.compile(r"[^\W\d_]+")
#: Besides the word, its beginnings of these lengths are terms, and what is left
#: of it without an ending of these lengths. They tie the forms of a stem together.
_STEMS = (4, 5, 6, 8)
_ENDINGS = (2, 3, 4)
_CACHE_WORDS = 100_000


@dataclass(frozen=True)
class FMParams:
    max_rows: int = 16_000      # labelled rows read for the fit, at most
    bits: int = 20              # 2**bits hash slots
    rank: int = 8               # length of a slot's pair vector
    min_docs: int = 3           # sampled documents that hold a slot, at least
    min_z: float = 3.3          # association with the label below which a slot is quiet
    quiet: float = 0.1          # value of a quiet slot (others: 1)
    updates: int = 60_000       # stochastic steps over the sample
    rate: float = 0.1           # AdaGrad step
    l2: float = 1e-4
    seed: int = 7


def _slots(word: str, mask: int) -> tuple[int, ...]:
    crc, size = zlib.crc32, len(word)
    out = [crc(word.encode("utf-8", "replace")) & mask]
    out += [crc(word[:n].encode("utf-8", "replace"), n) & mask for n in _STEMS if size > n]
    out += [crc(word[:-n].encode("utf-8", "replace"), 100 + n) & mask
            for n in _ENDINGS if size > n + 3]
    return tuple(out)


class _Terms(dict):
    """word -> its slots, kept for the words met last."""

    def __init__(self, mask: int, seen: np.ndarray | None = None):
        self.mask = mask
        self.limit = _CACHE_WORDS if seen is not None else _CACHE_WORDS * 2 // 5    # rare slots are kept too
        self.seen = None if seen is None else seen.tobytes()

    def __missing__(self, word: str) -> tuple[int, ...]:
        out = _slots(word, self.mask)
        if self.seen is not None:
            out = tuple(s for s in out if self.seen[s])
        if len(self) >= self.limit:
            self.clear()
        self[word] = out
        return out

    def of(self, text: str) -> np.ndarray:
        words = set(_WORD.findall(text.lower()))
        return np.unique(np.fromiter(chain.from_iterable(map(self.__getitem__, words)), np.int64))


def _values(docs: list[np.ndarray], y: np.ndarray, n: int, p: FMParams) -> tuple[np.ndarray, np.ndarray]:
    """The slots that `min_docs` documents hold at least, and the value of each of
    them: 1 if its presence alone goes with the label (a signed root of chi-square
    of `min_z` or more either way), else `quiet`."""
    both = np.zeros((2, n))
    for d, t in zip(docs, y):
        both[int(t), d] += 1
    df, total, n1 = both.sum(0), max(len(y), 1), y.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        expect = df * n1 / total
        z = (both[1] - expect) / np.sqrt(expect * (1 - n1 / total) * (1 - df / total))
    seen = df >= p.min_docs
    return seen, np.where(np.abs(np.nan_to_num(z[seen])) >= p.min_z, 1.0, p.quiet)


def _fit(docs: list[np.ndarray], y: np.ndarray, p: FMParams):
    """AdaGrad on the logistic loss. Slots never seen keep weight and vector 0.
    The pair term is scaled by 1/sqrt(sum of squared values), so that the length of
    a document does not blow it up. Returns weights and vectors times the values."""
    n = 1 << p.bits
    rng = np.random.Generator(np.random.PCG64(splitmix64(1, p.seed)[0]))
    seen, x = _values(docs, y, n, p)
    slot = np.cumsum(seen) - 1              # dense rows for the kept slots only
    m = int(seen.sum())
    w, v = np.zeros(m), rng.normal(0, 0.05, (m, p.rank))
    gw, gv = np.full(m, 1e-1), np.full((m, p.rank), 1e-1)
    rate = y.mean() if len(y) else 0.0
    w0 = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    g0 = 1.0
    own = [slot[d[seen[d]]] for d in docs]
    pos = 0.5 / max(rate, 1e-3)             # balanced classes
    neg = 0.5 / max(1 - rate, 1e-3)
    left, order = (p.updates if 0 < rate < 1 else 0), []
    while left > 0:
        order = rng.permutation(len(own))[:left]
        left -= len(order)
        for k in order:
            i = own[k]
            xi = x[i]
            s = 1 / np.sqrt(max(xi @ xi, 1))
            vi = v[i] * xi[:, None]
            sv = vi.sum(0)
            z = w0 + w[i] @ xi + 0.5 * s * (sv @ sv - np.einsum("ij,ij->", vi, vi))
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[k]) * (pos if y[k] else neg)
            g0 += e * e
            w0 -= p.rate * e / np.sqrt(g0)
            d = e * xi + p.l2 * w[i]
            gw[i] += d * d
            w[i] -= p.rate * d / np.sqrt(gw[i])
            d = e * s * xi[:, None] * (sv - vi) + p.l2 * v[i]
            gv[i] += d * d
            v[i] -= p.rate * d / np.sqrt(gv[i])
    return float(w0), seen, *(a.astype(np.float32) for a in (w * x, v * x[:, None], x))


@dataclass
class FMModel:
    """w0, which slots were seen, and for those the weights, pair vectors and values."""
    params: FMParams
    w0: float
    seen: np.ndarray
    w: np.ndarray
    v: np.ndarray
    x: np.ndarray

    def score(self, slots: np.ndarray) -> float:
        if not len(slots):
            z = self.w0
        else:
            i = self.row[slots]
            vi = self.v[i].astype(np.float64)
            sv = vi.sum(0)
            z = (self.w0 + float(self.w[i].sum(dtype=np.float64))
                 + 0.5 / np.sqrt(max(np.square(self.x[i], dtype=np.float64).sum(), 1)) * float(sv @ sv - np.einsum("ij,ij->", vi, vi)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    @property
    def row(self) -> np.ndarray:
        if not hasattr(self, "_row"):
            self._row = np.cumsum(self.seen, dtype=np.int32) - 1
        return self._row

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, w0=self.w0, seen=self.seen, w=self.w, v=self.v, x=self.x)
        return out.getvalue()

    @staticmethod
    def from_bytes(params: FMParams, data: bytes) -> FMModel:
        z = np.load(io.BytesIO(data))
        return FMModel(params, float(z["w0"]), z["seen"], z["w"], z["v"], z["x"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None,
                 params: FMParams = FMParams()) -> FMModel:
    """Fit on labelled documents for which `train` (over `doc_id`) holds.

    `labels` has `doc_id` and `toxic` (1: toxic; null rows are skipped). At most
    `params.max_rows` label rows are used, those with the smallest hash of the
    id. With no usable label or only one class the model is a constant.
    """
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("toxic").cast("int").alias("toxic"))
    lab = lab.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if train is not None:
        lab = lab.where(train)
    lab = (lab.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id", "toxic")
           .limit(params.max_rows).select("doc_id", "toxic"))
    rows = docs_of(docs).join(F.broadcast(lab), "doc_id")    # max_rows ids: bounded
    mask = (1 << params.bits) - 1

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(mask)
        for b in batches:
            ids, texts, y = (b.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))
            for lo, hi in chunks(texts):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[lo:hi], pa.int64()),
                    "toxic": pa.array(y[lo:hi], pa.int32()),
                    "slots": pa.array([terms.of(t).astype(np.int32).tobytes() for t in texts[lo:hi]],
                                      pa.binary())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fitted(batches)      # its arrays are free by now
        give_back()

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            got += zip(*(b.column(c).to_pylist() for c in ("doc_id", "toxic", "slots")))
        got.sort()
        xs = [np.frombuffer(s, np.int32).astype(np.int64) for _, _, s in got]
        y = np.array([float(t) for _, t, _ in got])
        data = FMModel(params, *_fit(xs, y, params)).to_bytes()
        yield pa.RecordBatch.from_pydict({"model": pa.array([data], pa.binary())})

    feats = map_batches(rows, featurise, "doc_id long, toxic int, slots binary")
    got = feats.repartition(1).mapInArrow(fit, "model binary").collect()
    if not got:                                  # no rows at all: Spark runs no batch
        return FMModel(params, float(np.log(1e-3 / 1.001)), np.zeros(mask + 1, bool),
                       np.zeros(0, np.float32), np.zeros((0, params.rank), np.float32),
                       np.zeros(0, np.float32))
    return FMModel.from_bytes(params, bytes(got[0]["model"]))


def score_toxicity(docs: DataFrame, model: FMModel) -> DataFrame:
    """`doc_id`, `score` (0 to 1), `predicted` (1 if score >= 0.5) of every row.

    Null and empty texts have no terms and get the model's base rate. Repeated
    rows are each scored. Extra columns are dropped.
    """
    df = docs_of(docs)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        terms = _Terms((1 << m.params.bits) - 1, m.seen)
        for b in batches:
            s = [m.score(terms.of(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "score": pa.array(s, pa.float64()),
                "predicted": pa.array([int(x >= 0.5) for x in s], pa.int32())})

    return map_batches(df, run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: FMModel) -> DataFrame:
    """The rows of `docs`, with all their columns, that the model does not reject
    (score below 0.5). Null and empty texts are scored as in `score_toxicity`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        terms = _Terms((1 << m.params.bits) - 1, m.seen)
        for b in batches:
            keep = [m.score(terms.of(t or "")) < 0.5 for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, docs.schema)

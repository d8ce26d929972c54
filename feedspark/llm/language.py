"""Language prediction with bit-sliced Bloom filters over character n-grams.

One Bloom filter per language, stored bit-sliced: slot i of the table is a mask
whose bit l is slot i of language l's filter. The AND of an n-gram's k slots is
the set of all languages that may contain the n-gram, found with k reads however
many languages there are. Per text, the hits of each language are counted
(popcount by bit), and corrected for the filter's false positives:

    share_l = (hits_l / n - fp_l) / (1 - fp_l),  fp_l = (filled share of slots)**k

The language with the largest share wins; `score` is its part of all shares.

The filters hold the n-grams that are common enough in a bounded sample of the
training documents (`docs_per_lang` by rate); their size is fixed by `bits`.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import docs_of, map_batches, splitmix64

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangParams:
    docs_per_lang: int = 800    # training documents a language, as expected from a hash of the id
    n: int = 4                  # length of an n-gram
    bits: int = 20              # 2**bits slots
    hashes: int = 2
    min_share: float = 0.01     # of a language's sampled documents that hold the n-gram


_MIX = [np.uint64(x | 1) for x in splitmix64(16, 21)]
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def grams(text: str, n: int) -> np.ndarray:
    """64-bit hashes of the letter n-grams of a text, in order and with repeats:
    lower case, each run of other characters is one space, and so are the ends.
    Empty if the text has no letter."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[code]
    if not letter.any():
        return np.empty(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                  # a space is kept after a letter only
    first = int(np.argmax(letter))
    if first:
        keep[first - 1] = True               # and before the first one
    code = np.where(letter, code, 32)[keep].astype(np.uint64)
    if len(code) < n:
        code = np.concatenate([code, np.full(n - len(code), 32, np.uint64)])
    m = len(code) - n + 1
    with np.errstate(over="ignore"):
        h = code[:m] * _MIX[0]
        for i in range(1, n):
            h += code[i:i + m] * _MIX[i]
        h ^= h >> np.uint64(32)
        h *= _MIX[15]
        h ^= h >> np.uint64(29)
    return h


def slots(h: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    step = (h >> np.uint64(33)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((h + np.uint64(k) * step) & np.uint64((1 << bits) - 1)).astype(np.int64)
                for k in range(hashes)]


@dataclass
class LangModel:
    """`filters`: slots x words of 8 languages each, as bytes."""
    params: LangParams
    langs: list[str]
    prior: np.ndarray           # sampled documents of each language
    filters: np.ndarray

    @property
    def false_positive(self) -> np.ndarray:
        if not hasattr(self, "_fp"):
            fill = [((self.filters[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(self.langs))]
            self._fp = np.array(fill) ** self.params.hashes
        return self._fp

    def shares(self, text: str) -> np.ndarray | None:
        """Corrected share of each language; None if the text has no letter."""
        h = grams(text, self.params.n)
        if not len(h):
            return None
        at = slots(h, self.params.bits, self.params.hashes)
        mask = self.filters[at[0]]
        for a in at[1:]:
            mask = mask & self.filters[a]
        hits = np.zeros(len(self.langs))
        for word in range(mask.shape[1]):
            count = np.bincount(mask[:, word], minlength=256)
            for bit in range(min(8, len(self.langs) - 8 * word)):
                hits[8 * word + bit] = count[(np.arange(256) >> bit) & 1 == 1].sum()
        fp = self.false_positive
        return np.clip((hits / len(h) - fp) / np.maximum(1 - fp, 1e-9), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        share = self.shares(text) if text else None
        if share is None or not self.langs:
            return UNDETERMINED, 0.0
        # Equal shares: the language with more documents, then the first by name.
        best = max(range(len(share)), key=lambda i: (share[i], self.prior[i], -i))
        total = share.sum()
        return self.langs[best], float(share[best] / total) if total > 0 else 0.0

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, langs=np.array(self.langs, dtype=object).astype(str),
                            prior=self.prior, filters=self.filters)
        return out.getvalue()

    @staticmethod
    def from_bytes(params: LangParams, data: bytes) -> LangModel:
        z = np.load(io.BytesIO(data))
        return LangModel(params, [str(x) for x in z["langs"]], z["prior"], z["filters"])


def _build(rows: list[tuple[str, bytes]], p: LangParams) -> LangModel:
    langs = sorted({lang for lang, _ in rows})
    filters = np.zeros((1 << p.bits, max(1, -(-len(langs) // 8))), np.uint8)
    prior = np.zeros(len(langs))
    for i, lang in enumerate(langs):
        mine = [np.frombuffer(g, np.uint64) for x, g in rows if x == lang]
        prior[i] = len(mine)
        found, df = np.unique(np.concatenate(mine), return_counts=True)
        common = found[df >= max(1, p.min_share * len(mine))]
        for at in slots(common, p.bits, p.hashes):
            filters[at, i // 8] |= np.uint8(1 << (i % 8))
    return LangModel(p, langs, prior, filters)


def fit_languages(docs: DataFrame, train: Column | None = None,
                  params: LangParams = LangParams()) -> LangModel:
    """Fit on documents with a `lang` for which `train` (over `doc_id`) holds.

    Each language's sample is drawn by a hash of the id at the rate that gives
    `docs_per_lang` documents; languages are as many as the column has. Rows with
    a null text, language or id are not used.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                      & F.col("doc_id").isNotNull())
    if train is not None:
        rows = rows.where(train)
    scale = 1 << 30
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LangModel(params, [], np.zeros(0), np.zeros((1 << params.bits, 1), np.uint8))
    rates = docs.sparkSession.createDataFrame(
        [(k, min(scale, -(-params.docs_per_lang * scale // n))) for k, n in sorted(counts.items())],
        "lang string, rate long")
    sample = (rows.join(F.broadcast(rates), "lang")
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.col("rate")).select("lang", "text"))
    n = params.n

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [np.unique(grams(t, n)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": b.column("lang"), "grams": pa.array(data, pa.binary())})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            got += zip(b.column("lang").to_pylist(), b.column("grams").to_pylist())
        yield pa.RecordBatch.from_pydict({"model": pa.array([_build(got, params).to_bytes()], pa.binary())})

    feats = map_batches(sample, featurise, "lang string, grams binary")
    got = feats.repartition(1).mapInArrow(build, "model binary").collect()
    if not got:
        return LangModel(params, [], np.zeros(0), np.zeros((1 << params.bits, 1), np.uint8))
    return LangModel.from_bytes(params, bytes(got[0]["model"]))


def predict_languages(docs: DataFrame, model: LangModel) -> DataFrame:
    """`doc_id`, `lang_pred`, `score` of every whole text. `und` with score 0 if
    the text is null or has no letter (or the model knows no language)."""
    df = docs_of(docs, empty_null=False)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "lang_pred": pa.array([g[0] for g in got], pa.string()),
                "score": pa.array([g[1] for g in got], pa.float64())})

    return map_batches(df, run, "doc_id long, lang_pred string, score double")

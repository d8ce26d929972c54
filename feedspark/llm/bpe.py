"""Byte-pair encoding and decoding with a pair occurrence index.

Encoding works on all distinct new words of a batch at once. An index maps each
adjacent pair that has a merge rank to all its positions; a heap holds the
active ranks. The lowest rank is applied to all its positions, from left to
right, and the pairs on either side of each merge are entered under their own
ranks. Words are separate chains, so no merge crosses a word.

The tokenizer file (its path is a parameter, read on each executor) gives the
vocabulary, merges, normaliser and word pattern. Texts of plain Latin letters,
digits, signs and white space are normalised and split by a regular expression
that states the same rule; any other text goes through the file's own normaliser
and pre-tokenizer. Either way the merges run here.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, docs_of, map_batches

#: Words whose ids a worker keeps (some 200 bytes each). Beyond it the cache starts anew.
CACHE_WORDS = 300_000
#: Code points of text whose new words are indexed together.
CHUNK = 1_000_000

# Characters for which the regular expression below states the same rule as the
# tokenizer's normaliser and word pattern.
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa1-\xac\xae-\xff]")
_WORDS = re.compile(r"[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]"
                    r"|[^\s0-9a-zªµºß-öø-ÿ²³¹¼½¾]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes
    stand for themselves, the others are numbered from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairIndexBPE:
    """Vocabulary and merges of one tokenizer file, and the merge procedure."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError(f"not a BPE vocabulary: {path}")
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.merge: dict[int, int] = {}                 # pair -> rank
        self.pair: list[tuple[int, int, int]] = []      # rank -> the pair's parts, the merged id
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge[self.vocab[a] << 32 | self.vocab[b]] = rank
            self.pair.append((self.vocab[a], self.vocab[b], self.vocab[a + b]))
        letters = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner = np.array([self.vocab[c] for c in letters])             # byte -> id
        self.last = np.array([self.vocab[c + self.end] for c in letters])   # as a word's last byte
        keys = np.array(list(self.merge), np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[by], by
        self.cache: dict[str, bytes] = {}
        self.split_special = (re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
                              if self.special else None)
        self.path, self._library = path, None

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        return self._library

    def raw(self, word: str) -> bytes:
        """The bytes of a word, as `words` gives it."""
        if word[0] == "\0":
            return bytes(map(self.byte_of.__getitem__, word[1:]))
        return word.encode("utf-8")

    def words(self, text: str) -> list[str]:
        """The words of a text. A word that begins with NUL is spelt in the byte
        alphabet already; one with two NULs is a special token."""
        if self.split_special and any(s in text for s in self.special):
            out = []
            for part in self.split_special.split(text):
                out += ["\0\0" + part] if part in self.special else self.words(part)
            return out
        if _OTHER.search(text) is None:
            return _WORDS.findall(text.lower())
        lib = self.library
        norm = lib.normalizer.normalize_str(text) if lib.normalizer else text
        return ["\0" + w for w, _ in lib.pre_tokenizer.pre_tokenize_str(norm)]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in a row, and how many each word has, by the
        pair occurrence index."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size)
        data = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[data]
        ids[stop - 1] = self.last[data[stop - 1]]
        n = len(ids)
        # The index at first: positions of each active rank, from left to right.
        pair = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        found = self.pair_keys[at] == pair
        found[stop[:-1] - 1] = False                    # across two words
        place = np.flatnonzero(found)
        rank = self.pair_ranks[at[place]]
        by = np.argsort(rank, kind="stable")
        place, rank = place[by], rank[by]
        cut = np.flatnonzero(np.diff(rank)) + 1
        where: list[list[int] | None] = [None] * len(self.pair)
        heap = rank[np.concatenate([[0], cut])].tolist() if len(rank) else []      # ascending: a heap
        for r, p in zip(heap, np.split(place, cut)):
            where[r] = p.tolist()
        sym = ids.tolist()
        nxt = np.arange(1, n + 1)
        nxt[stop - 1] = n
        prv = np.arange(-1, n - 1)
        prv[stop[:-1]] = n
        prv[0] = n
        nxt, prv = nxt.tolist(), prv.tolist()
        sym.append(-1)                                  # n: beyond a word's ends
        prv.append(n)
        push, pop, get, pairs = heapq.heappush, heapq.heappop, self.merge.get, self.pair
        while heap:
            now = pop(heap)
            a, b, new = pairs[now]
            todo, where[now] = where[now], None
            todo.sort()
            new32 = new << 32
            for i in todo:
                j = nxt[i]
                if sym[i] != a or sym[j] != b:
                    continue                            # changed by an earlier merge
                nxt[i] = k = nxt[j]
                sym[i], sym[j], prv[k] = new, -1, i
                if k != n and (m := get(new32 | sym[k])) is not None:
                    if (w := where[m]) is None:
                        where[m] = [i]
                        push(heap, m)
                    else:
                        w.append(i)
                h = prv[i]
                if h != n and (m := get(sym[h] << 32 | new)) is not None:
                    if (w := where[m]) is None:
                        where[m] = [h]
                        push(heap, m)
                    else:
                        w.append(h)
        out = np.array(sym[:n])
        kept = out >= 0
        return out[kept], np.add.reduceat(kept, stop - size)

    def learn(self, words: set[str]) -> None:
        """Encode the words that the cache does not hold."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(words)
        plain = []
        for w in new:
            if w.startswith("\0\0"):
                self.cache[w] = np.array([self.special[w[2:]]], "<i4").tobytes()
            else:
                plain.append(w)
        if plain:
            ids, size = self.merge_words(list(map(self.raw, plain)))
            data, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(size)).tolist()
            self.cache.update(zip(plain, (data[lo:hi] for lo, hi in zip([0, *ends], ends))))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        get = self.cache.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space: the file names no decoder."""
        return " ".join(map(self.token.__getitem__, ids))


_OPEN: dict[str, PairIndexBPE] = {}     # one vocabulary and word cache per worker and file


def vocabulary(path: str) -> PairIndexBPE:
    if path not in _OPEN:
        _OPEN[path] = PairIndexBPE(path)
    return _OPEN[path]


def _id_array(data: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, data)], dtype=np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32()))


def _decoded(bpe: PairIndexBPE, ids: pa.ListArray) -> pa.Array:
    flat = ids.flatten().to_numpy().tolist()
    ends = np.cumsum([0, *ids.value_lengths().to_pylist()]).tolist()
    return pa.array([bpe.decode(flat[lo:hi]) for lo, hi in zip(ends, ends[1:])], pa.string())


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id` and `ids` (array of int) of every whole text.

    Null and empty texts have an empty array. Special tokens' strings in a text
    become their ids; none are added. Repeated rows are each encoded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in chunks(texts, CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), _id_array(bpe.encode_batch(texts[lo:hi]))],
                    ["doc_id", "ids"])

    return map_batches(docs_of(docs), run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` (as `encode_documents`) and `decoded` (the text that the ids
    stand for) of every whole text, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in chunks(texts, CHUNK):
                ids = _id_array(bpe.encode_batch(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), ids, _decoded(bpe, ids)],
                    ["doc_id", "ids", "decoded"])

    return map_batches(docs_of(docs), run, "doc_id long, ids array<int>, decoded string")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` and `decoded` (text) of rows with an array `ids`; a null
    array counts as empty and decodes to the empty text."""
    from pyspark.sql import functions as F

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            ids = b.column("ids")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, _decoded(bpe, ids)],
                                             ["doc_id", "ids", "decoded"])

    return map_batches(rows, run, "doc_id long, ids array<int>, decoded string")

"""Pack tokenised documents into sequences, best fit decreasing.

A document's ids are cut into full windows first; what is left over (shorter
than a window) is packed by best fit decreasing: the longest piece first, each
into the open window with the least room that still takes it. A segment tree
over the remaining room (0 .. window) finds that window in logarithmic time.

Packing runs where the texts are read: each task packs its own pieces, nothing
is shuffled, and what a task holds is bounded (`BLOCK_TOKENS`; beyond it the
pieces so far are packed and a new block begins). Sequence ids carry the
partition in their upper bits, so a task that runs again makes the same ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import docs_of, map_batches

WINDOW = 2048
END_ID = 1
#: Left-over tokens that a task holds before it packs them.
BLOCK_TOKENS = 32 << 20

_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa1-\xac\xae-\xff]")


class RoomTree:
    """Open windows by remaining room; `take(n)` gives the tightest that has
    room for n (-1: none). A node of the tree counts the windows below it."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        k = self.size + room
        while k:
            self.count[k] += by
            k >>= 1

    def put(self, seq: int, room: int) -> None:
        if room:
            self.open[room].append(seq)
            self._add(room, 1)

    def take(self, n: int) -> tuple[int, int]:
        """(window, its room), the window removed from the tree."""
        k, count = self.size + n, self.count
        while not count[k]:
            while k & 1:                    # a right child: go up
                k >>= 1
                if k <= 1:
                    return -1, 0
            if k <= 1:
                return -1, 0
            k += 1                          # the sibling to the right
        while k < self.size:                # its leftmost leaf with a window
            k = 2 * k if count[2 * k] else 2 * k + 1
        room = k - self.size
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; every length is 1 .. window."""
    tree, out, made = RoomTree(window), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        seq, room = tree.take(lengths[i])
        if seq < 0:
            seq, room, made = made, window, made + 1
        out[i] = (seq, window - room)
        tree.put(seq, room - lengths[i])
    return out


class Encoder:
    """Ids by a byte-level BPE file of the tokenizers library. Plain Latin texts
    are encoded by the same vocabulary's rank file, which gives the same ids
    sooner; other texts, and texts with a special token's string, by the file."""

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer
        self.file = Tokenizer.from_file(path)
        self.special = [t.content for t in self.file.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                          special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and _OTHER.search(text) is None and not any(s in text for s in self.special):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        return np.array(self.file.encode(text, add_special_tokens=False).ids, "<u4")


_OPEN: dict[tuple, Encoder] = {}


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None,
                   pattern: str | None = None, window: int = WINDOW, end_id: int = END_ID,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of the tokenised documents, each placed in a sequence.

    Returns a row per piece: `doc_id`, `start` (the document's ids before it),
    `length`, `ids` (binary: little-endian unsigned 32-bit), `doc_tokens` (with
    the closing `end_id`), `sequence_id`, `offset`. Null and empty texts have the
    closing id alone. Repeated rows are separate documents. Each id lies in
    exactly one piece; a sequence has at most `window` ids, without gaps.
    """
    if window < 1:
        raise ValueError("window must be positive")
    schema = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
              "sequence_id long, offset long")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, ranks) not in _OPEN:
            _OPEN[path, ranks] = Encoder(path, ranks, pattern)
        encode = _OPEN[path, ranks]
        base, made = TaskContext.get().partitionId() << 36, 0
        left: list[tuple] = []
        held = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal left, held, made
            at = best_fit_decreasing([p[2] for p in left], window)
            rows = [(*p, base + made + s, o) for p, (s, o) in zip(left, at)]
            made += 1 + max((s for s, _ in at), default=-1)
            left, held = [], 0
            for lo in range(0, len(rows), 4096):
                yield batch(rows[lo:lo + 4096])

        for b in batches:
            full = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                n = len(ids)
                for at in range(0, n, window):
                    part = ids[at:at + window]
                    piece = (doc_id, at, len(part), part.tobytes(), n)
                    if len(part) == window:
                        full.append((*piece, base + made, 0))
                        made += 1
                    else:
                        left.append(piece)
                        held += len(part)
                if held >= block_tokens:
                    yield from flush()
                if len(full) >= 1024:
                    yield batch(full)
                    full = []
            if full:
                yield batch(full)
        yield from flush()

    return map_batches(docs_of(docs), run, schema)

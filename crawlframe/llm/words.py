"""Words, word hashes and word shingles of whole texts, vectorised over Arrow batches.

Words are maximal runs of bytes other than space and 0x09-0x0D, after A-Z is lower-cased. Hashes are
64 bits wide and depend on the bytes alone, so every task of every run computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at a time (a longer single text makes its own slice).
SLICE_BYTES = 1 << 20
#: Bytes of text that are hashed at a time.
HASH_BYTES = 1 << 19
U64 = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
_BYTE[_SPACE] = 0
_LANE = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(U64) | U64(1)
_POWERS = 1 << 16
_POW = np.multiply.accumulate(np.full(_POWERS, 0x9E3779B97F4A7C15, U64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordSlice:
    """The words of a run of documents.

    ``raw``: the texts' bytes; ``data``: lower-cased; ``starts`` / ``ends``: byte span of each word; ``first``: index of
    each document's first word, one more entry at the end; ``rows``: the documents' place in the batch.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, rows: range):
        self.rows = rows
        self.raw = raw
        self.data = _LOWER[raw]
        n = len(self.data)
        space = _SPACE[self.data]
        before = np.empty(n, bool)
        if n:
            before[0] = True
            before[1:] = space[:-1]
            inner = offsets[:-1][offsets[:-1] < n]
            before[inner] = True
        self.starts = np.flatnonzero(before & ~space)
        after = np.empty(n, bool)
        if n:
            after[-1] = True
            after[:-1] = before[1:] | space[1:]
        self.ends = np.flatnonzero(after & ~space) + 1
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word."""
        if not len(self.starts):
            return np.empty(0, U64)
        out = np.empty(len(self.starts), U64)
        i = 0
        while i < len(out):  # a stretch at a time: the arrays here take many bytes for each of the text
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + HASH_BYTES)))
            first, end = self.starts[i], self.ends[j - 1]
            starts = self.starts[i:j] - first
            pos = np.arange(end - first) - np.repeat(starts, np.diff(starts, append=end - first))
            out[i:j] = mix(np.add.reduceat(_BYTE[self.data[first:end]] * _POW[pos & (_POWERS - 1)], starts))
            i = j
        return out

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all word n-grams, and the first one of each document (one more at the end).

        A document of fewer words has its whole sequence as its only one; one without words has none.
        """
        h = self.hashes()
        counts = np.diff(self.first)
        per_doc = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        first = np.concatenate([[0], np.cumsum(per_doc)])
        if not first[-1]:
            return np.empty(0, U64), first
        doc = np.repeat(np.arange(len(counts)), per_doc)
        at = np.arange(first[-1]) - first[doc] + self.first[doc]
        padded = np.concatenate([h, np.zeros(size, U64)])
        short = counts[doc] < size
        out = np.zeros(len(at), U64)
        for j in range(size):
            lane = padded[at + j] * _LANE[j]
            if short.any():
                lane[short & (counts[doc] <= j)] = 0
            out += lane
        return mix(out), first


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[WordSlice]:
    """Slices of a string column in order; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    raw = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + max_bytes, "right")) - 1)
        yield WordSlice(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], range(a, b))
        a = b

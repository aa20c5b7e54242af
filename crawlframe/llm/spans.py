"""Finding documents that can match at all in whole Arrow batches, and digests of spans."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a string column without nulls as one run of bytes, and where each begins and the last ends."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data is not None else b""), offsets - offsets[0]


def holders(data: bytes, offsets: np.ndarray, needles: Iterable[bytes]) -> set[int]:
    """Rows whose text holds one of the needles; the search goes on at the next row after each find."""
    found: set[int] = set()
    for needle in needles:
        at = data.find(needle)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(needle) <= offsets[row + 1]:
                found.add(row)
                at = data.find(needle, int(offsets[row + 1]))
            else:  # across two texts
                at = data.find(needle, at + 1)
    return found


def joined(spans: Iterable[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``kinds``."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def digest(spans: Iterable[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()

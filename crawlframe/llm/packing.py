"""Bounded-space online packing of documents into training sequences.

Each task keeps a fixed number of open windows. The full windows of a document are closed at once; its
rest goes to the open window it fits best, that is with least room left. When none fits, the rest is
cut: its head fills the fullest window, which is emitted, and its tail opens another or goes on the
same way. What is still open when a task ends, at most that many windows, is merged by the same rule.

Cases: null or empty text packs its end id alone; repeated rows are packed each; an empty table gives
no piece. Pieces carry places and checksums, and the ids themselves where asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import store, text_of
from crawlframe.llm.tokens import PieceEncoder

CAPACITY = 2048
OPEN_WINDOWS = 32
#: Tasks whose leftover windows are merged together.
MERGE_TASKS = 16
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, seq long, offset long, ids binary, left_open boolean"
)
_MERGED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]
_ARROW = pa.schema(list(zip(_NAMES, [*[pa.int64()] * 8, pa.binary(), pa.bool_()], strict=True)))


class OpenWindows:
    """At most ``limit`` windows of ``capacity``: place best-fit, cut into the fullest when none fits."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.fill: dict[int, int] = {}
        self.next = 0

    def _open(self) -> int:
        self.next += 1
        self.fill[self.next - 1] = 0
        return self.next - 1

    def place(self, start: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(window, start, length, offset) of each piece of ``n`` ids."""
        while n >= self.capacity:
            window, self.next = self.next, self.next + 1
            yield window, start, self.capacity, 0
            start, n = start + self.capacity, n - self.capacity
        while n:
            fits = [w for w, used in self.fill.items() if used + n <= self.capacity]
            if fits:
                window = max(fits, key=lambda w: (self.fill[w], -w))
            elif len(self.fill) < self.limit:
                window = self._open()
            else:
                window = max(self.fill, key=lambda w: (self.fill[w], -w))
            used = self.fill[window]
            size = min(n, self.capacity - used)
            self.fill[window] = used + size
            if self.fill[window] == self.capacity:
                del self.fill[window]
            yield window, start, size, used
            start, n = start + size, n - size


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    byte_level: bool = False,
    end_id: int = 1,
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
    merge_tasks: int = MERGE_TASKS,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``keep_ids``, the piece's ids as little-endian unsigned 32-bit bytes.

    The packing itself needs no shuffle. Only the leftover windows of the tasks move, by whole groups
    of ``merge_tasks`` tasks, so a group holds ``merge_tasks * open_windows`` windows at most.
    Sequences are full but for the last few of such a group.
    """
    end = np.uint32(end_id).astype("<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, byte_level)
        windows = OpenWindows(capacity, open_windows)
        waiting: dict[int, list[tuple]] = {}

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), _ARROW, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                task = part.column(0)[0].as_py()
                done: list[tuple] = []
                for doc_id, ids in zip(part.column(1).to_pylist(), encoder.encode(part.column(2).to_pylist()), strict=True):
                    raw = ids + end
                    total = len(raw) // 4
                    for window, start, length, offset in windows.place(0, total):
                        own = raw[4 * start : 4 * (start + length)]
                        piece = (doc_id, start, length, zlib.crc32(own), total, task, window, offset, own)
                        if window in windows.fill:
                            waiting.setdefault(window, []).append(piece)
                        else:
                            for p in (*waiting.pop(window, ()), piece):
                                done.append((*p[:8], p[8] if keep_ids else None, False))
                if done:
                    yield rows(done)
        if waiting:
            yield rows([(*p, True) for pieces in waiting.values() for p in pieces])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        windows = OpenWindows(capacity, open_windows)
        out: list[tuple] = []
        size = group.groupby(["task", "seq"])["length"].transform("sum")
        group = group.assign(size=size).sort_values(["size", "task", "seq", "offset"], ascending=[False, True, True, True])
        for p in group.itertuples(index=False):
            for window, start, length, offset in windows.place(0, p.length):
                own = p.ids[4 * start : 4 * (start + length)]
                number = ((p.merged_in << 32) + window) * 2 + 1
                out.append((p.doc_id, p.start + start, length, zlib.crc32(own), p.doc_tokens, number, offset, own if keep_ids else None))
        made = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    rows = docs.select(F.spark_partition_id().cast("long").alias("task"), F.col("doc_id").cast("long"), text_of().alias("text"))
    pieces = store(rows.mapInArrow(pack, _PIECES), "pieces")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    closed = pieces.filter(~F.col("left_open")).withColumn("sequence_id", (F.col("task") * F.lit(1 << 32) + F.col("seq")) * 2)
    left = pieces.filter("left_open").withColumn("merged_in", F.expr(f"task div {merge_tasks}"))
    merged = left.groupBy("merged_in").applyInPandas(merge, _MERGED)
    out = closed.select(*kept).unionByName(merged)
    return out if keep_ids else out.drop("ids")

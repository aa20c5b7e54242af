"""Token ids packed at the least fixed width the vocabulary needs, in blocks that decode on their own.

A packed set is a folder of two tables. ``blocks``: one row per block with its shard, number, place of
its first id in the shard, bit width, document ids, document lengths and payload. ``shards``: one row
per shard with the number of ids in it and before it. 64 ids fill exactly ``bits`` 64-bit words, so
packing and unpacking are 64 shifts of whole numpy columns, and id ``i`` of a block is found in word
``i // 64 * bits + i % 64 * bits // 64`` without reading the rest. Documents never straddle blocks, so a
lost task or a single look-up touches one row.

Cases: null text counts as empty and yields the end id alone; repeated doc_ids are separate documents
in a fixed order (by text); null doc_ids come first; an empty table gives an empty set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlframe.llm.shared import text_of
from crawlframe.llm.tokens import vocabulary_size, worker_encoder

#: Ids in a block before the next document starts a new one.
BLOCK_IDS = 1 << 16
_BLOCKS = (
    "shard int, block int, first_id long, n_ids long, bits int, doc_ids array<long>, lengths array<long>, payload binary"
)
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("bits", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def bits_for(vocabulary: int) -> int:
    """Least number of bits that tell ``vocabulary`` ids apart."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids below ``2 ** bits`` as a little-endian bit stream, padded to a multiple of 64 ids."""
    rows = -(-len(ids) // 64)
    lanes = np.zeros((rows, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((rows, bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_ids(payload: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """Ids ``start`` to ``n`` of a payload; only the 64-id rows that hold them are unpacked."""
    first = start // 64
    words = np.frombuffer(payload, "<u8").reshape(-1, bits)[first : -(-n // 64)]
    lanes = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, k] = value & mask
    return lanes.reshape(-1)[start - 64 * first : n - 64 * first].astype(np.uint32)


def write_packed(
    docs: DataFrame, path: str, tokenizer: str, byte_level: bool = True, end_id: int = 2, block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write them as a packed set.

    One range shuffle puts neighbouring ids together; each task then writes its own shard.
    """
    spark = docs.sparkSession
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    end = np.uint32(end_id).astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, byte_level)
        shard, block, first, held = 0, 0, 0, 0
        doc_ids: list = []
        parts: list[bytes] = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [[shard], [block], [first], [len(ids)], [bits], [doc_ids], [lengths], [pack_ids(ids, bits)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                shard = part.column(0)[0].as_py()
                for doc_id, ids in zip(part.column(1).to_pylist(), encoder.encode(part.column(2).to_pylist()), strict=True):
                    doc_ids.append(doc_id)
                    parts.append(ids + end)
                    lengths.append(len(ids) // 4 + 1)
                    held += lengths[-1]
                    if held >= block_ids:
                        yield flush()
                        block, first, held = block + 1, first + held, 0
                        doc_ids, parts, lengths = [], [], []
        if doc_ids:
            yield flush()

    # the text's head splits rows without doc_id over ranges
    keyed = docs.select("doc_id", text_of().alias("text"))
    head = F.when(F.col("doc_id").isNull(), F.substring("text", 1, 24))
    ordered = keyed.repartitionByRange("doc_id", head).sortWithinPartitions("doc_id", "text")
    rows = ordered.select(F.spark_partition_id().alias("shard"), F.col("doc_id").cast("long"), "text")
    rows.mapInArrow(encode, _BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    totals = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # one row per shard, so one task can run the sum
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals.withColumn("first_id", before).coalesce(1).write.parquet(f"{path}/shards")


def read_packed(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document of a packed set: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = unpack_ids(row["payload"], row["bits"], row["n_ids"])
                lengths = np.array(row["lengths"], np.int64)
                cuts = np.cumsum(lengths)
                starts = cuts - lengths
                raw = memoryview(tokens.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, cuts, strict=True)]
                out = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["base"] + row["first_id"]),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    out.append(pa.array([tokens[a:b].astype(np.int64) for a, b in zip(starts, cuts, strict=True)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("first_id").alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    return blocks.join(shards, "shard").mapInArrow(decode, schema)

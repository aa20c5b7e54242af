"""Languages of whole texts from bit-sliced Bloom filters of n-grams, one bit a language.

A text becomes its words (runs of letters A-Z, lower-cased, and bytes beyond ASCII) with one space between and around
them; its n-grams are all windows of 3 and of 5 bytes. Learning counts them for each language over all
training texts. A language's filter holds an n-gram that makes up ``MIN_SHARE`` of its n-grams of that size, unless
another language has it ``RIVAL`` times as often, by share. A share bounds a filter at 1 / MIN_SHARE n-grams a
size, whatever the input. All filters lie side by side: a slot has one bit for each language, so the AND of an n-gram's two
slots is the set of all languages that hold it. Adding up those bits over a text gives a count for each
language; with n n-grams and a filter that passes a share e by mistake, (count - n e) / (1 - e) of them are
truly there. The greatest such number decides, ties go to the least name; the score is its share in the sum over languages.

Counting is map-side with partial sums behind it; slots are put together by an aggregate, and only they
(2 ** 21 slots of one bit a language: 2 MB for up to eight, 16 MB for each further 64) reach the driver and the
tasks. Texts are never shuffled.

Cases: null text or one without a letter is ``und`` with score 0; a text with letters, none of whose n-grams is known,
gets the language with most n-grams learned and score 0; rows without lang are not learned from, yet get a
prediction; without anything learned all is ``und``; rows without doc_id are held in; repeated rows each count and each get a
row; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import lean_batches, store
from crawlframe.llm.words import U64, mix

SIZES = (3, 5)
SLOT_BITS = 21
MIN_SHARE = 1e-5
RIVAL = 10.0
UNKNOWN = "und"
#: Bytes of text turned into windows at a time, and distinct n-grams held by a counting task.
SLICE_BYTES = 1 << 20
LIMIT = 1 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, size int, gram long, n long"
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def normal(text: bytes) -> bytes:
    """The words of a text, one space around each; nothing if it has none."""
    words = text.translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def windows(data: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window's bytes as one number, and which windows lie within one text."""
    n = max(0, len(data) - size + 1)
    codes = np.zeros(n, U64)
    for j in range(size):
        codes = (codes << U64(8)) | data[j : n + j]
    inside = np.ones(len(data), bool)
    cut = (ends[:, None] - np.arange(1, size)).ravel()
    inside[cut[cut >= 0]] = False
    return codes, inside[:n]


def _slices(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, end of each text) of normalised texts, some megabytes at a time."""
    i = 0
    while i < len(texts):
        first, length = i, 0
        while i < len(texts) and (length == 0 or length + len(texts[i]) <= SLICE_BYTES):
            length += len(texts[i])
            i += 1
        yield first, np.frombuffer(b"".join(texts[first:i]), np.uint8), np.cumsum([len(t) for t in texts[first:i]])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, size, gram, n) of one task's (lang, text) rows, handed on when they grow many."""
    held: dict[tuple[str, int], list] = defaultdict(list)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, size), parts in held.items():
            codes, n = _merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(np.full(len(codes), size, np.int32)), pa.array(codes.astype(np.int64)), pa.array(n)],
                names=["lang", "size", "gram", "n"],
            )
        held.clear()

    entries = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        of_lang = defaultdict(list)
        for i, lang in enumerate(batch.column(0).to_pylist()):
            of_lang[lang].append(normal(texts[i].as_py()))
        for lang, own in of_lang.items():
            for _, data, ends in _slices(own):
                for size in SIZES:
                    codes, inside = windows(data, ends, size)
                    u, n = np.unique(codes[inside], return_counts=True)
                    parts = held[lang, size]
                    parts.append((u, n))
                    entries += len(u)
                    if len(parts) == 8:
                        entries -= sum(len(c) for c, _ in parts)
                        parts[:] = [_merged(parts)]
                        entries += len(parts[0][0])
                if entries > LIMIT:
                    yield from flush()
                    entries = 0
    yield from flush()


def gram_counts(docs: DataFrame, learn: Column) -> DataFrame:
    """(lang, size, gram, n) over all rows to learn from."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = lean_batches(rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    return rows.mapInArrow(count_grams, _COUNTS).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def slots_of(codes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The two slots of every n-gram."""
    for seed in _SEEDS:
        yield (mix(codes * U64(2) + U64(size * seed % 2**64)) >> U64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class Filters:
    """``table``: bits of all languages for each slot, ``wrong``: the share of n-grams each filter passes by mistake."""

    langs: list[str]
    table: np.ndarray
    wrong: np.ndarray
    fallback: str

    def members(self, codes: np.ndarray, size: int) -> np.ndarray:
        """The set of languages that hold each n-gram, as bits (one column for each 64 languages)."""
        first, second = slots_of(codes, size)
        return self.table[first] & self.table[second]

    def decide(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(language number or -1, score) of normalised texts."""
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        for first, data, ends in _slices(texts):
            starts = np.concatenate([[0], ends[:-1]])
            true = np.zeros((len(ends), len(self.langs)))
            for size in SIZES:
                codes, _ = windows(data, ends, size)
                bits = self.members(codes, size)
                stop = np.maximum(ends - size + 1, starts)
                for k in range(len(self.langs)):
                    column = bits[:, k // self.width]
                    has = (column >> column.dtype.type(k % self.width)) & column.dtype.type(1)
                    total = np.concatenate([[0], np.cumsum(has, dtype=np.int64)])
                    seen = total[np.minimum(stop, len(codes))] - total[np.minimum(starts, len(codes))]
                    true[:, k] += np.maximum(0, (seen - (stop - starts) * self.wrong[k]) / (1 - self.wrong[k]))
            top, whole = true.argmax(1), true.sum(1)
            at = slice(first, first + len(ends))
            known = whole > 0
            best[at] = np.where(known, top, -1)
            score[at] = np.where(known, true.max(1) / np.where(known, whole, 1), 0)
        return best, score

    @property
    def width(self) -> int:
        return self.table.dtype.itemsize * 8


def learn_filters(docs: DataFrame, learn: Column, min_share: float = MIN_SHARE, rival: float = RIVAL) -> Filters:
    """Filters of all languages among the rows of ``docs`` where ``learn`` holds."""
    spark = docs.sparkSession
    counts = store(gram_counts(docs, learn), "grams")
    sums = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    totals = sums.groupBy("lang").agg(F.sum("total").alias("total")).collect()  # one row a language
    langs = sorted((r["lang"] for r in totals), key=str.encode)
    if not langs:
        return Filters([], np.zeros((1 << SLOT_BITS, 1), np.uint8), np.zeros(0), UNKNOWN)
    shares = counts.join(F.broadcast(sums), ["lang", "size"]).select("lang", "size", "gram", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.filter(F.col("share") >= min_share)
    most = shares.groupBy("size", "gram").agg(F.max("share").alias("most"))
    held = shares.join(most, ["size", "gram"]).filter(F.col("share") * rival >= F.col("most"))
    numbers = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if len(langs) <= 8 * t().itemsize), np.uint64)
    width = 8 * kind().itemsize

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gram, lang = (batch.column(i).to_numpy() for i in range(3))
            for s in SIZES:
                own = size == s
                for slots in slots_of(gram[own].astype(U64), s):
                    bit = (U64(1) << (lang[own] % width).astype(U64)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array((lang[own] // width).astype(np.int32)), pa.array(bit)], names=["slot", "part", "bits"])

    placed = held.select("size", "gram", numbers.cast("long").alias("lang")).mapInArrow(place, "slot long, part int, bits long")
    rows = placed.groupBy("slot", "part").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros((1 << SLOT_BITS, -(-len(langs) // width)), kind)
    table[rows["slot"].to_numpy(), rows["part"].to_numpy()] = rows["bits"].to_numpy().astype(U64).astype(kind)
    filled = [np.count_nonzero((table[:, k // width] >> kind(k % width)) & kind(1)) for k in range(len(langs))]
    fallback = max(totals, key=lambda r: (r["total"], [-b for b in r["lang"].encode()]))["lang"]
    return Filters(langs, table, (np.array(filled) / (1 << SLOT_BITS)) ** 2, fallback)


def predict_languages(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            plain = [normal(raw[i].as_py() or b"") for i in range(len(raw))]
            best, score = model.decide(plain) if model.langs else (np.full(len(plain), -1), np.zeros(len(plain)))
            names = []
            for i, k in enumerate(best):
                # ASCII letters leave words of a-z; beyond ASCII the text itself tells
                letters = bool(plain[i]) and (any(97 <= b <= 122 for b in plain[i][:64]) or has_letter(raw[i].as_py().decode()))
                names.append(UNKNOWN if not letters else model.langs[k] if k >= 0 else model.fallback)
                if not letters:
                    score[i] = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = lean_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")

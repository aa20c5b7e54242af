"""Benchmark decontamination: rare n-gram seeds find where to look, local alignment decides.

1. The n-grams of all items set bits in a filter sized by their number. A pass over all texts counts, per item
   n-gram, the documents that have it; the rarest share of each item's n-grams are its seeds. The share is
   relative to the item, so an item that leaked into a third of all documents keeps its seeds.
2. A second pass cuts, around seeds, the stretches of words an item could fill. Items are told apart by length, to a power of two: each
   such class has a filter and a reach of its own, so a long item makes long stretches around its own seeds alone. Stretches
   join the items of their class whose seeds they hold.
3. Smith-Waterman aligns the words of a stretch and an item. The score is the alignment's as a part of
   the item's score against itself, so a verbatim copy has 1 and each changed, added or lost word takes off.

The number of items isn't bounded: nothing of theirs is broadcast but the filters (128 MB each at most).

Cases: null or empty texts and items match nothing; an item of fewer words than a seed is too short to
tell and matches nothing; a doc_id is reported once for an item with its best place (none counts as an id), a
repeated item id once (the best); empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.jaccard_join import bit_filter, keep_by_text, passes, text_key
from crawlframe.llm.shared import lean_batches, store, text_of
from crawlframe.llm.words import U64, text_slices

SEED_WORDS = 3
#: Bits of a filter for each n-gram: few stretches are cut in vain.
FILTER_EACH = 4096
#: Share of an item's n-grams, rarest first, that are seeds.
SEED_SHARE = 0.75
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least part of an item's own score that counts as a leak.
LEAST = 0.4


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, first and behind-last word of ``doc``.

    A row of the table at a time: the gaps along a row are a running maximum.
    """

    def best(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
        n = len(doc)
        step = -GAP * np.arange(1, n + 1)
        row, top, end = np.zeros(n + 1, np.int64), 0, 0
        for word in item:
            new = np.maximum(row[:-1] + np.where(doc == word, MATCH, MISMATCH), row[1:] + GAP)
            np.maximum(new, 0, out=new)
            new = np.maximum.accumulate(new + step) - step
            row[1:] = new
            at = int(new.argmax())
            if new[at] > top:
                top, end = int(new[at]), at + 1
        return top, end

    score, end = best(doc, item) if len(doc) else (0, 0)
    if not score:
        return 0, 0, 0
    _, length = best(doc[:end][::-1], item[::-1])
    return score, end - length, end


def _longs(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.view(np.int64)))


def _item_words(items: DataFrame, size: int) -> DataFrame:
    """item_id, words, grams (distinct) of items that have a seed's words at least."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                h = part.hashes()
                g, first = part.shingles(size)
                grams = [np.unique(g[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                ids = batch.column(0).slice(part.rows.start, len(part.rows))
                columns = [ids, _longs(h, np.diff(part.first)), _longs(np.concatenate([g[:0], *grams]), np.array([len(x) for x in grams]))]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "grams"])

    found = items.select(F.col("item_id").cast("long"), text_of().alias("text")).mapInArrow(rows, "item_id long, words array<long>, grams array<long>")
    return found.filter(F.size("words") >= size)


def _gram_counts(docs: DataFrame, size: int, wanted) -> DataFrame:
    """gram, n: documents that hold each n-gram passing the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = wanted.value
        for batch in batches:
            for part in text_slices(batch.column(0)):
                g, first = part.shingles(size)
                hit = np.flatnonzero(passes(g, words))
                doc = np.searchsorted(first, hit, "right")
                by = np.lexsort((doc, g[hit]))
                g, doc = g[hit][by], doc[by]
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
                g, n = np.unique(g[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return docs.select(text_of()).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _class_of(words: Column) -> Column:
    """Items of up to 2 ** class words."""
    return F.ceil(F.log2(F.size(words))).cast("int")


def _stretches(docs: DataFrame, size: int, wanted: dict) -> DataFrame:
    """doc_id, text_key, row, class (of items), first (word), words, grams: the surroundings of seeds, overlapping ones as one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in text_slices(batch.column(2)):
                h = part.hashes()
                g, first = part.shingles(size)
                for kind, filter_words in wanted.items():
                    yield from around(part, h, g, first, kind, np.flatnonzero(passes(g, filter_words.value)), ids, keys)

    def around(part, h, g, first, kind: int, hit: np.ndarray, ids: list, keys: list) -> Iterator[pa.RecordBatch]:
        if not len(hit):
            return
        reach = 3 * (1 << kind) // 2
        doc = np.searchsorted(first, hit, "right") - 1
        at = hit - first[doc] + part.first[doc]
        new = np.ones(len(hit), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * reach)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(hit)) - 1
        lo = np.maximum(at[heads] - reach, part.first[doc[heads]])
        hi = np.minimum(at[tails] + size + reach, part.first[doc[heads] + 1])
        rows = {"doc_id": [], "text_key": [], "class": [], "first": [], "words": [], "grams": []}
        for a, b, x, y, d in zip(heads, tails, lo, hi, doc[heads], strict=True):
            rows["doc_id"].append(ids[part.rows.start + d])
            rows["text_key"].append(keys[part.rows.start + d])
            rows["class"].append(kind)
            rows["first"].append(int(x - part.first[d]))
            rows["words"].append(h[x:y].view(np.int64))
            rows["grams"].append(np.unique(g[hit[a : b + 1]]).view(np.int64))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))

    found = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), text_of().alias("text"))
    schema = "doc_id long, text_key long, class int, first long, words array<long>, grams array<long>"
    return found.mapInArrow(cut, schema).withColumn("row", F.monotonically_increasing_id())


def _leaks(docs: DataFrame, items: DataFrame, size: int = SEED_WORDS, share: float = SEED_SHARE, least: float = LEAST) -> DataFrame:
    """doc_id, text_key, item_id, score, first_word, end_word of every stretch that holds an item."""
    spark = lean_batches(docs).sparkSession
    known = store(_item_words(items, size).withColumn("class", _class_of(F.col("words"))), "items")
    grams = known.select("item_id", "class", F.explode("grams").alias("gram"))
    all_grams = spark.sparkContext.broadcast(bit_filter(grams, "gram", grams.count(), FILTER_EACH))
    counted = grams.join(_gram_counts(docs, size, all_grams), "gram", "left").fillna(0, ["n"])
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "gram"))).withColumn(
        "of", F.count("*").over(Window.partitionBy("item_id"))
    )
    seeds = store(ranked.filter(F.col("rank") <= F.ceil(F.col("of") * share)).select("gram", "class", "item_id"), "seeds")
    sizes = {r["class"]: r["n"] for r in seeds.groupBy("class").agg(F.count("*").alias("n")).collect()}  # a row for a power of two
    wanted = {k: spark.sparkContext.broadcast(bit_filter(seeds.filter(F.col("class") == k), "gram", n, FILTER_EACH)) for k, n in sorted(sizes.items())}
    stretches = store(_stretches(docs, size, wanted), "stretches")
    pairs = stretches.select("row", "class", F.explode("grams").alias("gram")).join(seeds, ["gram", "class"]).select("row", "item_id").distinct()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "item_id", "score", "first_word", "end_word"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, key, first, words, item_id, item in zip(*(c for c in batch.columns), strict=True):
                item = item.values.to_numpy()
                points, a, b = align(words.values.to_numpy(), item)
                value = points / (MATCH * len(item))
                if value >= least:
                    out.append((doc_id.as_py(), key.as_py(), item_id.as_py(), value, first.as_py() + a, first.as_py() + b))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=names)

    # the words of a stretch follow its pairs, not its seeds
    joined = pairs.join(stretches.drop("class", "grams"), "row").join(known.select("item_id", F.col("words").alias("item")), "item_id")
    return joined.select("doc_id", "text_key", "first", "words", "item_id", "item").mapInArrow(
        score, "doc_id long, text_key long, item_id long, score double, first_word long, end_word long"
    )


def leaked_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word: each item found in each document, best place only."""
    best = F.max(F.struct("score", F.negative("first_word").alias("a"), F.negative("end_word").alias("b"))).alias("m")
    return (
        _leaks(docs, items, **options)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "m.score", F.negative("m.a").alias("first_word"), F.negative("m.b").alias("end_word"))
    )


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all their columns. Other texts of the same doc_id stay."""
    return keep_by_text(docs, store(_leaks(docs, items, **options).select("doc_id", "text_key").distinct(), "leaks"))

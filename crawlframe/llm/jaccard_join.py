"""Exact near-duplicate classes by a grouped prefix join on word shingles.

1. A pass over all texts counts shingles that documents of a stretch share, added up over all stretches. Their order of magnitude
   fills a table of fixed size (a slot per hash); with the hash it orders all shingles, common ones last.
2. A second pass keeps, per document, the size of its shingle set, a 128-bit key of the set, and the
   prefix of that order which any set of enough overlap must meet. Equal sets become one class;
   classes of equal prefix and size one group.
3. Groups that share a prefix shingle are candidates. First every group meets one partner per shingle
   (the most central one there, so a large family is linked without its pairs). Size and
   position bounds drop pairs that can't reach the threshold. Pairs that are left expand to classes,
   and only classes in candidates have their sets built again and intersected.
4. What that has not joined yet meets in full: all group pairs of a shingle whose classes still lie in
   different components, under the same bounds. So each pair that shares a prefix shingle is either
   verified or known to be connected, and components are exact.

Any fixed order of shingles gives the same result; the counts only keep candidates few. Documents meet as classes and
groups; a shingle of more than ``BLOCK`` groups still unconnected is dealt to cells of two blocks each, and joins on
components meet a stored table of one row a component, so that Spark splits large ones.

Cases: null or empty text, or none but white space: no shingle, no link, its own component. Fewer words
than a shingle: the whole sequence is the one shingle. Repeated rows have equal sets and so one
component. A row without doc_id keeps its row and links others; its component is the least doc_id it is linked to, or
null. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.graph import components
from crawlframe.llm.shared import lean_batches, store, text_of
from crawlframe.llm.words import U64, WordSlice, mix, text_slices

SHINGLE_WORDS = 5
#: Likeness in per cent.
THRESHOLD = 75
#: Slots of the table that orders shingles, of fixed size, and the most bits of a filter in front of a join: 128 MB; with more
#: than a quarter as many values it lets more by, which costs time alone.
ORDER_SLOTS = 22
FILTER_BITS = 30
#: A shingle counts as common from this many documents on.
COMMON = 8
#: Groups of a shingle that meet in one cell, twice.
BLOCK = 2000
#: Ids up to this many (8 bytes each) are sent to all tasks.
BROADCAST_IDS = 1_000_000
_SLICE = 4 << 20


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def order_table(docs: DataFrame, size: int) -> np.ndarray:
    """Per slot, the order of magnitude of its most shared shingle's count.

    A task counts the documents that hold a shingle within stretches of some megabytes, and reports shingles that two of a
    stretch share; the sums run over all stretches of all tasks. Counting every shingle in so small a table was tried: the slots' noise hid
    the common ones, and the last round met 24 times the pairs on five times the input.
    """

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(0), _SLICE):
                h, first = part.shingles(size)
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
                by = np.argsort(h, kind="stable")
                h, doc = h[by], doc[by]
                new = np.empty(len(h), bool)
                new[:1] = True
                new[1:] = h[1:] != h[:-1]
                other = new.copy()
                other[1:] |= doc[1:] != doc[:-1]
                at = np.flatnonzero(new)
                docs_of = np.add.reduceat(other.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
                keep = docs_of > 1
                yield pa.RecordBatch.from_arrays([_long(h[at[keep]]), pa.array(docs_of[keep])], names=["h", "n"])

    counts = docs.select(text_of()).mapInArrow(shared, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    slots = (
        counts.filter(F.col("n") >= COMMON)
        .groupBy(F.shiftrightunsigned("h", 64 - ORDER_SLOTS).alias("slot"))
        .agg(F.max(F.least(F.log2("n").cast("int"), F.lit(31))).alias("level"))
        .toArrow()
    )
    table = np.zeros(1 << ORDER_SLOTS, np.uint8)
    table[slots["slot"].to_numpy()] = slots["level"].to_numpy()
    return table


def ordered(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Shingle ids that sort common ones last: the slot's level, then 59 bits of the hash."""
    return (table[h >> U64(64 - ORDER_SLOTS)].astype(U64) << U64(59)) | (h >> U64(5))


def _sets(part: WordSlice, size: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle ids of the documents one after another, and their counts."""
    h, first = part.shingles(size)
    h = ordered(h, table)
    sets = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return np.concatenate(sets) if sets else h, np.array([len(s) for s in sets], np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run, wrapped to 64 bits; 0 for an empty run."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def text_key() -> Column:
    """Tells apart the texts of one doc_id."""
    return F.xxhash64(text_of())


def known_by(doc_id: Column, key: Column) -> Column:
    """What finds a row's text again: its id, or else its text's key."""
    return F.coalesce(doc_id, key)


def set_rows(docs: DataFrame, size: int, threshold: int, table) -> DataFrame:
    """doc_id, text_key, n, k1, k2 (the set's key), pk (its prefix and size), prefix."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = table.value
        for batch in batches:
            for part in text_slices(batch.column(2)):
                ids, n = _sets(part, size, levels)
                k1, k2 = _sums(mix(ids), n), _sums(mix(ids ^ U64(0xA5A5A5A5A5A5A5A5)), n)
                length = np.where(n > 0, n - -(-threshold * n // 100) + 1, 0)
                start = np.cumsum(n) - n
                at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
                prefix = ids[at]
                pk = mix(_sums(mix(prefix ^ U64(0x5DEECE66D)), length) + mix(n.astype(U64)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), _long(prefix))
                doc_ids, texts = (batch.column(i).slice(part.rows.start, len(part.rows)) for i in range(2))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, texts, pa.array(n), _long(k1), _long(k2), _long(pk), lists], names=["doc_id", "text_key", "n", "k1", "k2", "pk", "prefix"]
                )

    schema = "doc_id long, text_key long, n long, k1 long, k2 long, pk long, prefix array<long>"
    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), text_of().alias("text")).mapInArrow(rows, schema)


def bit_filter(df: DataFrame, column: str, values: int, each: int = 4) -> np.ndarray:
    """A bit for the low bits of every value: ``each`` bits or up to twice as many for each of ``values``, up to ``2 ** FILTER_BITS``."""
    size = min(FILTER_BITS, max(20, (each * values).bit_length()))
    low = F.col(column).bitwiseAND((1 << size) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(63).cast("int"))
    bits = df.groupBy(F.shiftrightunsigned(low, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    per_row = 1 << 12

    def dense(group: pa.Table) -> pa.Table:
        words = np.zeros(per_row, U64)
        words[group["word"].to_numpy() % per_row] = group["bits"].to_numpy().view(U64)
        return pa.table({"part": [group["word"][0].as_py() // per_row], "words": pa.array([words.tobytes()], pa.binary())})

    # the driver gets whole stretches of bits
    rows = bits.groupBy(F.expr(f"word div {per_row}")).applyInArrow(dense, "part long, words binary").collect()
    words = np.zeros(1 << (size - 6), U64)
    for row in rows:
        words[row["part"] * per_row : (row["part"] + 1) * per_row] = np.frombuffer(row["words"], U64)
    return words


def passes(values: np.ndarray, words: np.ndarray) -> np.ndarray:
    low = values.view(U64) & U64(64 * len(words) - 1)
    return (words[low >> U64(6)] >> (low & U64(63))) & U64(1) > 0


def _may_link(n1: Column, p1: Column, n2: Column, p2: Column, threshold: int) -> Column:
    """Whether sets of these sizes whose first common shingle is at these places can reach the threshold."""
    most = F.least(n1 - p1, n2 - p2)
    return (100 * F.least(n1, n2) >= threshold * F.greatest(n1, n2)) & ((100 + threshold) * most >= threshold * (n1 + n2))


def short_codes(ids: np.ndarray) -> bytes:
    """A set in about a byte per shingle: how many, the width of its codes, and the gaps of the sorted distinct codes.

    A code is the high end of a remixed id, five bits wider than the set's size. Gaps are bytes; 255 goes on.
    """
    width = 5 + int(len(ids)).bit_length()
    codes = np.unique(mix(ids ^ U64(0x3C6EF372FE94F82B)) >> U64(64 - width))
    gaps = np.diff(codes, prepend=U64(0)).astype(np.int64)
    ends = np.cumsum(gaps // 255 + 1)
    out = np.full(ends[-1], 255, np.uint8)
    out[ends - 1] = gaps % 255
    return np.array([len(ids), width], "<i8").tobytes() + out.tobytes()


def most_common(x: bytes, y: bytes) -> tuple[int, int, int]:
    """Sizes of two sets of ``short_codes``, and what their intersection can't exceed."""

    def read(raw: bytes) -> tuple[int, int, np.ndarray]:
        n, width = np.frombuffer(raw, "<i8", 2)
        steps = np.frombuffer(raw, np.uint8, offset=16)
        return int(n), int(width), np.cumsum(steps, dtype=np.int64)[steps != 255]

    (n, width, a), (m, other, b) = read(x), read(y)
    if width > other:
        a = np.unique(a >> (width - other))
    elif other > width:
        b = np.unique(b >> (other - width))
    # every common shingle has a common code; those that share a code are counted by what each set has over its codes
    both = int(np.isin(a, b, assume_unique=True).sum())
    return n, m, both + min(n - len(a), m - len(b))


def _sets_of(docs: DataFrame, needed: DataFrame, size: int, table, encode) -> DataFrame:
    """cid and ``encode`` of the set of each needed class (cid, known_by), built from the texts of the rows it is known by."""
    wanted = docs.sparkSession.sparkContext.broadcast(bit_filter(needed.select("known_by"), "known_by", needed.count()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, words = table.value, wanted.value
        done: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(passes(batch.column(0).to_numpy(zero_copy_only=False), words)))
            for part in text_slices(batch.column(1)):
                ids, n = _sets(part, size, levels)
                ends, cids = np.cumsum(n), _sums(mix(ids), n)
                # copies of a row are built once a task
                keep = [i for i, c in enumerate(cids.tolist()) if n[i] and not (c in done or done.add(c))]
                sets = [encode(ids[ends[i] - n[i] : ends[i]]) for i in keep]
                yield pa.RecordBatch.from_arrays([_long(cids[keep]), pa.array(sets, pa.binary())], names=["cid", "ids"])

    found = docs.select(known_by(F.col("doc_id").cast("long"), text_key()).alias("known_by"), text_of().alias("text"))
    sets = found.mapInArrow(build, "cid long, ids binary")
    return store(sets.join(needed.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "sets", "none")


def _checked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, table, encode, check) -> DataFrame:
    """The pairs (a, b) of classes whose encoded sets pass ``check``."""
    members = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    needed = store(members.join(classes.select("cid", "known_by"), "cid"), "needed")
    sets = _sets_of(docs, needed, size, table, encode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [check(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return store(joined.mapInArrow(run, "a long, b long"), "checked")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, threshold: int, table) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the threshold.

    Short codes bound each intersection first, so whole sets move only for pairs that link or nearly do.
    """

    def may(x, y) -> bool:
        n, m, both = most_common(x, y)
        return (100 + threshold) * both >= threshold * (n + m)

    def do(x, y) -> bool:
        a, b = np.frombuffer(x, U64), np.frombuffer(y, U64)
        at = np.searchsorted(a, b)
        both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
        return (100 + threshold) * both >= threshold * (len(a) + len(b))

    left = _checked(docs, pairs, classes, size, table, short_codes, may)
    return _checked(docs, left, classes, size, table, lambda ids: ids.tobytes(), do)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _candidates(rows: DataFrame, docs_filter) -> DataFrame:
    """(s, pk, n, pos) of the prefix entries whose shingle passes the filter, once per group."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = docs_filter.value
        for batch in batches:
            lists = batch.column(2)
            length = lists.value_lengths().to_numpy(zero_copy_only=False)
            s = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(length)), length)
            pos = np.arange(len(s)) - np.repeat(np.cumsum(length) - length, length)
            keep = passes(s, words)
            row = pa.array(row[keep])
            columns = [pa.array(s[keep]), batch.column(0).take(row), batch.column(1).take(row), pa.array(pos[keep].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["s", "pk", "n", "pos"])

    kept = rows.filter("n > 0").select("pk", "n", "prefix")
    return kept.mapInArrow(entries, "s long, pk long, n long, pos long").distinct()


def _open_pairs(entries: DataFrame, threshold: int) -> DataFrame:
    """(x_pk, y_pk) of groups that share a shingle and may link, but are not known to be connected.

    The groups of a shingle lie in blocks; each two blocks meet in a cell of their own, each pair in one cell.
    """
    names = [c for c in entries.columns if c not in ("s", "blocks", "block")]
    x = entries.select("s", *[F.col(c).alias(f"x_{c}") for c in names], F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    y = entries.select("s", *[F.col(c).alias(f"y_{c}") for c in names], F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    may = _may_link(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"), threshold)
    apart = ~((F.col("x_lo") == F.col("x_hi")) & (F.col("y_lo") == F.col("y_hi")) & (F.col("x_lo") == F.col("y_lo")))
    once = (F.col("i") < F.col("j")) | (F.col("x_pk") < F.col("y_pk"))
    met = x.join(y, ["s", "i", "j"]).filter((F.col("x_pk") != F.col("y_pk")) & once & apart & may)
    return met.select(F.least("x_pk", "y_pk").alias("x_pk"), F.greatest("x_pk", "y_pk").alias("y_pk"))


def _classified(docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """doc_id, text_key, n_shingles, label (of the component, null without words), component_id, class_id of every row of ``docs`` (doc_id, text)."""
    spark = lean_batches(docs).sparkSession
    table = spark.sparkContext.broadcast(order_table(docs, size))
    rows = store(set_rows(docs, size, threshold, table), "sets")
    own = rows.filter("n > 0").groupBy(F.col("k1").alias("cid"), "k2", "n", "pk")
    reps = own.agg(F.min("doc_id").alias("rep"), F.min("text_key").alias("text_key"))
    classes = store(reps.withColumn("known_by", known_by(F.col("rep"), F.col("text_key"))).drop("text_key"), "classes")

    # prefix entries of shingles that occur more than once, and per shingle the group that is most central
    often = rows.filter("n > 0").select(F.explode("prefix").alias("s")).groupBy("s").agg(F.count("*").alias("times")).filter("times > 1")
    most = rows.agg(F.sum(F.size("prefix"))).first()[0] or 0
    words = spark.sparkContext.broadcast(bit_filter(often, "s", most))
    entries = store(_candidates(rows, words), "entries")
    # the fewest rare shingles ahead of it make a group central; ties are broken anew for each shingle
    mixed = F.col("pk").bitwiseXOR(F.col("s"))
    rank = F.least(F.col("pos"), F.lit((1 << 20) - 1)) * F.lit(1 << 43) + F.shiftrightunsigned(mixed, 21)
    shared = entries.groupBy("s").agg(F.min(rank).alias("least"), F.min("pk").alias("lo"), F.max("pk").alias("hi"))
    shared = shared.filter("lo <> hi").select("s", "least")
    entries = store(entries.join(shared, "s").withColumn("leads", rank == F.col("least")).drop("least"), "entries")

    leads = entries.filter("leads").select("s", F.col("pk").alias("lead"), F.col("n").alias("ln"), F.col("pos").alias("lpos"))
    may = _may_link(F.col("n"), F.col("pos"), F.col("ln"), F.col("lpos"), threshold)
    group_pairs = entries.join(leads, "s").filter((F.col("pk") != F.col("lead")) & may).select("pk", "lead").distinct()
    first_of = classes.groupBy("pk").agg(F.min("cid").alias("first"), F.count("*").alias("m"))
    across = group_pairs.join(classes.select("pk", "cid"), "pk").join(first_of.select(F.col("pk").alias("lead"), "first"), "lead")
    within = classes.join(first_of.filter("m > 1"), "pk").filter(F.col("cid") != F.col("first"))
    tried = store(across.select(*_pair("cid", "first")).unionByName(within.select(*_pair("cid", "first"))).distinct(), "pairs")
    links = _verified(docs, tried, classes, size, threshold, table)

    # what is not joined by now
    known = components(links)
    label = F.coalesce("component", "cid")
    at = store(classes.join(known, classes["cid"] == known["node"], "left").select("cid", "pk", "n", label.alias("label")), "labels")
    groups = at.groupBy("pk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    open_entries = entries.drop("leads").join(groups, "pk")
    open_s = open_entries.groupBy("s").agg(F.min("lo").alias("a"), F.max("hi").alias("b"), F.count("*").alias("groups"))
    open_s = open_s.filter("a <> b").select("s", F.expr(f"1 + groups div {BLOCK}").cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("pk"), F.col("blocks")).cast("int")
    open_entries = store(open_entries.join(open_s, "s").withColumn("block", block), "open")
    group_pairs = store(_open_pairs(open_entries, threshold).distinct(), "open_pairs")
    one, two = at.select(F.col("pk").alias("x_pk"), F.col("cid").alias("c1"), F.col("label").alias("l1")), at.select(
        F.col("pk").alias("y_pk"), F.col("cid").alias("c2"), F.col("label").alias("l2")
    )
    across = group_pairs.join(one, "x_pk").join(two, "y_pk").filter("l1 <> l2")
    mixed_groups = at.join(groups.filter("lo <> hi").select("pk"), "pk", "left_semi")
    one, two = mixed_groups.select("pk", F.col("cid").alias("c1"), F.col("label").alias("l1")), mixed_groups.select(
        "pk", F.col("cid").alias("c2"), F.col("label").alias("l2")
    )
    within = one.join(two, "pk").filter("c1 < c2 and l1 <> l2")
    rest = across.select(*_pair("c1", "c2")).unionByName(within.select(*_pair("c1", "c2"))).distinct().join(tried, ["a", "b"], "left_anti")
    rest = store(rest, "pairs")
    if rest.first() is not None:
        known = components(links.unionByName(_verified(docs, rest, classes, size, threshold, table)))

    found = store(classes.join(known, classes["cid"] == known["node"], "left").select("cid", "k2", "rep", label.alias("label")), "found")
    least = store(found.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    found = found.join(least, "label").select(F.col("cid").alias("k1"), "k2", "label", F.col("rep").alias("class_id"), "component_id")
    own = rows.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "k1", "k2")
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    classed = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    return own.join(found, ["k1", "k2"], "left").select(
        "doc_id", "text_key", "n_shingles", "label", linked.alias("component_id"), classed.alias("class_id")
    )


def jaccard_classes(docs: DataFrame, size: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (documents of equal sets share it) of every row of ``docs`` (doc_id, text)."""
    return _classified(docs, size, threshold).select("doc_id", "n_shingles", "component_id", "class_id")


def keep_by_text(docs: DataFrame, gone: DataFrame, how: str = "left_anti") -> DataFrame:
    """``docs`` without (or, ``left_semi``, with only) the rows whose doc_id and text are those of ``gone`` (doc_id, text_key).

    The pairs are sent to all tasks where they fit ``BROADCAST_IDS``.
    """
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["__id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone["__key"]), how)


def without_near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id (none counts as greatest); all their columns.

    Among rows of that doc_id the one of the least text key stays, among equal rows any. Rows without words stay. A decision holds for
    a doc_id with its text, so other texts of the same doc_id are left alone.
    """
    found = _classified(docs, size, threshold).filter("label is not null").select("label", "doc_id", "text_key")
    found = store(found.groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("rows")), "found")
    first = found.groupBy("label").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key")).alias("first"))
    first = store(first.select("label", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key")), "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    marked = store(found.join(first, "label").select("doc_id", "text_key", "rows", stays.alias("stays")), "marked")
    kept = keep_by_text(docs, marked.filter("not stays"))
    again = marked.filter("stays and rows > 1")
    if again.first() is None:
        return kept
    # equal rows of a document that stays: one of them
    once = keep_by_text(kept, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return keep_by_text(kept, again).unionByName(once)

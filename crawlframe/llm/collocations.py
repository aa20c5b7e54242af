"""Word phrases that stand together more often than their parts let expect, by vertically partitioned suffix trees.

A text is lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and 0x0A-0x0D, and pieces into words at spaces and tabs. Every word
occurrence starts a suffix: the words from there to the piece's end, five at most. The suffixes of a language make
a tree whose node at depth k is a phrase of k words and whose leaf totals add up to its count.

The tree is never held whole. Word prefixes are dealt to groups by a memory budget: a word that starts more suffixes
than ``budget`` is extended by the next word, and so on (one scan of the texts a step, for these prefixes alone); prefixes
within the budget are laid out by their hash and cut wherever the running count reaches the budget, so a
group holds at most twice the budget (or equal suffixes only). A task merges the equal suffixes of some
megabytes of text, and sends each group its own as one packed row: the distinct words, five columns of numbers, counts.
Each group sorts its suffixes and reads all phrase counts from sums over runs (prefixes that span groups are added up afterwards).

Counts of phrases, then, are a table; cuts are joins with it. A phrase of k + 1 words inside a longer one is at least
as frequent, so a candidate is dropped when one of the phrases one word longer that hold it is as frequent.
Languages are part of the word hashes (64 bits); the words themselves come back for what is ranked first (ties at
the rank included). Scores are decimals of 38 digits. The driver holds the running counts (two cells a group, some 2 ** 21 at most: the
budget grows where a fixed one would make more groups) and the extended prefixes.

Cases: null text has no words; null lang is ``und``; a text without words, or a piece, adds nothing; a language without
candidates has no rows; repeated rows count as often as they occur; an empty table gives an empty result; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.shared import lean_batches, store, text_of
from crawlframe.llm.words import U64, mix

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
#: Suffixes a group may hold by its prefixes' counts.
BUDGET = 1 << 20
#: Bytes of text whose suffixes are merged and packed at a time.
CHUNK_BYTES = 6 << 20
#: Distinct words a counting task holds before it hands them on.
LIMIT = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 2
_rng = np.random.default_rng(20260111)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
_POWERS = 1 << 16
_POW = np.multiply.accumulate(np.full(_POWERS, 0xD6E8FEB86659FD93, U64))
_NEXT = U64(0xA0761D6478BD642F)


def _hash_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span of ``data``; 0 is kept for 'no word'. Some hundred kilobytes at a time."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + (1 << 19))))
        first = starts[i]
        lengths = ends[i:j] - starts[i:j]
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        pos = np.arange(lengths.sum()) - np.repeat(at, lengths)
        value = _BYTE[data[np.repeat(starts[i:j], lengths) + pos]] * _POW[pos & (_POWERS - 1)]
        out[i:j] = mix(np.add.reduceat(value, at))
        i = j
    return np.maximum(out, U64(1))


@dataclass
class Words:
    """The words of some texts of one language, in order: bytes, spans, hashes and the piece each stands in."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray

    def suffixes(self, values: np.ndarray, at: np.ndarray | None = None, depth: int = DEPTH) -> np.ndarray:
        """The words' ``values`` for the up to ``depth`` words from each word (or those ``at`` places) on, 0 behind the piece's end."""
        n = len(values)
        at = np.arange(n) if at is None else at
        out = np.zeros((depth, len(at)), values.dtype)
        out[0] = values[at]
        for k in range(1, depth):
            later = np.minimum(at + k, n - 1)
            inside = (at + k < n) & (self.piece[later] == self.piece[at])
            out[k, inside] = values[later[inside]]
        return out


def words_of(texts: list[bytes], lang: str) -> Words:
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[data]
    word = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    breaks = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int64)])
    own = lang.encode()
    of_lang = U64(0)
    if own:
        raw = np.frombuffer(own, np.uint8)
        of_lang = _hash_bytes(raw, np.array([0]), np.array([len(raw)]))[0]
    hashes = np.maximum(mix(_hash_bytes(data, starts, ends) ^ of_lang), U64(1)) if len(starts) else np.empty(0, U64)
    return Words(data, starts, ends, hashes, breaks[starts])


def _chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[str, Words]]:
    """(lang, words) of a task's (lang, text) rows, so many bytes of one language at a time."""
    held: dict[str, list[bytes]] = defaultdict(list)
    length: dict[str, int] = defaultdict(int)
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for i, lang in enumerate(batch.column(0).to_pylist()):
            text = texts[i].as_py()
            held[lang].append(text)
            length[lang] += len(text)
            if length[lang] > size:
                yield lang, words_of(held.pop(lang), lang)
                del length[lang]
        if sum(length.values()) > 2 * size:
            for lang in list(held):
                yield lang, words_of(held.pop(lang), lang)
            length.clear()
    for lang, texts in held.items():
        yield lang, words_of(texts, lang)


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, hash, n) of one task, handed on when they grow many."""
    counts: dict[tuple[str, int], list] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        if counts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.string()),
                    pa.array([v[0] for v in counts.values()], pa.binary()).cast(pa.string()),
                    pa.array(np.fromiter((k[1] for k in counts), np.uint64, len(counts)).view(np.int64)),
                    pa.array([v[1] for v in counts.values()], pa.int64()),
                ],
                names=["lang", "word", "hash", "n"],
            )
        counts.clear()

    for lang, words in _chunks(batches):
        if not len(words.hashes):
            continue
        u, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
        data = words.data.tobytes()
        spans = zip(u.tolist(), words.starts[first].tolist(), words.ends[first].tolist(), n.tolist(), strict=True)
        for h, a, b, k in spans:
            entry = counts.get((lang, h))
            if entry is None:
                counts[lang, h] = [data[a:b], k]
            else:
                entry[1] += k
        if len(counts) > LIMIT:
            yield from flush()
    yield from flush()


def prefix_codes(suffixes: np.ndarray) -> np.ndarray:
    """A hash of the first 1, 2, .. DEPTH words of each suffix (ends count as words)."""
    codes = np.empty_like(suffixes)
    codes[0] = suffixes[0]
    for k in range(1, len(suffixes)):
        codes[k] = mix(codes[k - 1] * _NEXT + suffixes[k])
    return codes


@dataclass
class Layout:
    """``heavy[k]``: codes of the prefixes of k + 1 words beyond the budget, sorted; ``cuts``: codes where a group begins."""

    heavy: list[np.ndarray] = field(default_factory=list)
    cuts: np.ndarray = field(default_factory=lambda: np.empty(0, U64))

    def is_heavy(self, codes: np.ndarray, k: int) -> np.ndarray:
        if k >= len(self.heavy) or not len(self.heavy[k]):
            return np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self.heavy[k], codes), len(self.heavy[k]) - 1)
        return self.heavy[k][at] == codes

    def prefixes(self, words: Words) -> np.ndarray:
        """The code of the prefix that deals each word's suffix."""
        own = words.hashes.copy()
        at = np.flatnonzero(self.is_heavy(own, 0))
        codes = prefix_codes(words.suffixes(words.hashes, at))
        for k in range(1, DEPTH):
            if not len(at):
                break
            own[at] = codes[k]
            more = self.is_heavy(codes[k], k)
            at, codes = at[more], codes[:, more]
        return own

    def groups(self, codes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, codes, "right").astype(np.int32)


def _extended(layout: Layout):
    """Counts of the prefixes one word longer than the layout's deepest heavy ones."""
    k = len(layout.heavy)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []

        def flush() -> Iterator[pa.RecordBatch]:
            codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in parts]), len(codes)).astype(np.int64)
            parts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], names=["code", "n"])

        for _, words in _chunks(batches):
            at = np.flatnonzero(layout.is_heavy(words.hashes, 0))
            if not len(at):
                continue
            codes = prefix_codes(words.suffixes(words.hashes, at, k + 1))
            for d in range(1, k):
                codes = codes[:, layout.is_heavy(codes[d], d)]
            parts.append(np.unique(codes[k], return_counts=True))
            if sum(len(c) for c, _ in parts) > LIMIT:
                yield from flush()
        if parts:
            yield from flush()

    return count


def _cell(code: Column, bits: int) -> Column:
    """The top bits of a code taken as unsigned."""
    return F.shiftrightunsigned(code, 64 - bits) if bits else F.lit(0).cast("long")


def lay_out(texts: DataFrame, words: DataFrame, total: int, budget: int) -> Layout:
    """Which prefixes are extended, and where groups are cut."""
    budget = max(budget, total >> 19)
    bits = max(0, int(2 * total / budget).bit_length())
    layout = Layout()
    cells = np.zeros(1 << bits, np.int64)
    counts = words.select(F.col("hash").alias("code"), "n")
    while True:
        last = len(layout.heavy) == DEPTH - 1
        light = counts if last else counts.filter(F.col("n") <= budget)
        for r in light.groupBy(_cell(F.col("code"), bits).alias("cell")).agg(F.sum("n").alias("n")).toArrow().to_pylist():
            cells[r["cell"]] += r["n"]
        if last:
            break
        heavy = counts.filter(F.col("n") > budget).select("code").toArrow()["code"].to_numpy()
        if not len(heavy):
            break
        layout.heavy.append(np.sort(heavy.astype(np.int64).view(U64)))
        longer = texts.mapInArrow(_extended(layout), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        counts = store(longer, "prefixes")
    cuts, held = [], 0
    for cell in np.flatnonzero(cells):
        if held and held + cells[cell] > budget:
            cuts.append(int(cell) << (64 - bits))
            held = 0
        held += int(cells[cell])
    layout.cuts = np.array(cuts, U64)
    return layout


def pack_suffixes(layout: Layout):
    """Rows (part, words, columns, counts): the merged suffixes of a chunk of text that belong to one group."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _chunks(batches):
            if not len(words.hashes):
                continue
            group = layout.groups(layout.prefixes(words))
            distinct, number = np.unique(words.hashes, return_inverse=True)
            distinct = np.concatenate([np.zeros(1, U64), distinct])
            ids = words.suffixes((number + 1).astype(np.uint32))
            del words, number
            # two numbers make a key; equal suffixes lie together
            a, b = ids[0].astype(np.uint64) << U64(32) | ids[1], ids[2].astype(np.uint64) << U64(32) | ids[3]
            order = np.lexsort((ids[4], b, a, group))
            del a, b
            ids, group = ids[:, order], group[order]
            del order
            new = np.ones(len(group), bool)
            new[1:] = (ids[:, 1:] != ids[:, :-1]).any(0) | (group[1:] != group[:-1])
            first = np.flatnonzero(new)
            n = np.diff(first, append=len(group)).astype(np.uint32)
            ids, group = ids[:, first], group[first]
            edges = np.concatenate([np.flatnonzero(np.diff(group, prepend=-1)), [len(group)]])
            rows: list[tuple] = []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = ids[:, i:j]
                used = np.zeros(len(distinct), bool)
                used[own] = True
                used = np.flatnonzero(used)
                place = np.zeros(len(distinct), np.uint32)
                place[used] = np.arange(len(used))
                local = place[own]
                if len(used) <= 1 << 16:
                    local = local.astype(np.uint16)
                counts = n[i:j]
                counts = counts.astype(np.uint8) if counts.max() < 256 else counts
                rows.append((int(group[i]), distinct[used].tobytes(), local.tobytes(), counts.tobytes(), j - i))
                if len(rows) == 64 or j == len(group):
                    yield pa.RecordBatch.from_pylist([dict(zip(_PACKED.names, r, strict=True)) for r in rows], schema=_PACKED)
                    rows = []

    return pack


_PACKED = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("columns", pa.binary()), ("counts", pa.binary()), ("n", pa.int32())])
_NODES = "w1 long, w2 long, w3 long, w4 long, w5 long, n long"


def read_leaves(layout: Layout, min_count: int):
    """One group's subtree: every phrase of two words and more with ``min_count`` leaves, or that spans groups."""

    def read(table: pa.Table) -> pa.Table:
        columns, counts = [], []
        for words, ids, n, size in zip(*(table[c] for c in ("words", "columns", "counts", "n")), strict=True):
            k, size = np.frombuffer(words.as_buffer(), U64), size.as_py()
            ids = np.frombuffer(ids.as_buffer(), np.uint16 if len(ids.as_buffer()) == 2 * DEPTH * size else np.uint32)
            columns.append(k[ids.reshape(DEPTH, size)])
            counts.append(np.frombuffer(n.as_buffer(), np.uint8 if len(n.as_buffer()) == size else np.uint32).astype(np.int64))
        leaves, n = np.concatenate(columns, axis=1), np.concatenate(counts)
        columns.clear()
        order = np.lexsort(leaves[::-1])
        leaves, n = leaves[:, order], n[order]
        found: list[np.ndarray] = []
        totals: list[np.ndarray] = []
        changed = np.zeros(leaves.shape[1], bool)
        changed[:1] = True
        changed[1:] = leaves[0, 1:] != leaves[0, :-1]
        for depth in range(1, DEPTH):
            changed[1:] |= leaves[depth, 1:] != leaves[depth, :-1]
            starts = np.flatnonzero(changed)
            total = np.add.reduceat(n, starts)
            wanted = total >= min_count
            if depth < len(layout.heavy):
                wanted |= layout.is_heavy(prefix_codes(leaves[: depth + 1, starts])[depth], depth)
            wanted &= leaves[depth, starts] != 0
            nodes = np.zeros((DEPTH, int(wanted.sum())), U64)
            nodes[: depth + 1] = leaves[: depth + 1, starts[wanted]]
            found.append(nodes)
            totals.append(total[wanted])
        nodes, total = np.concatenate(found, axis=1), np.concatenate(totals)
        return pa.table({**{f"w{k + 1}": nodes[k].view(np.int64) for k in range(DEPTH)}, "n": total})

    return read


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, hash, n), all of them, and phrases (words: array of hashes, n) with at least so many occurrences."""
    texts = lean_batches(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text")), 1000)
    words = texts.mapInArrow(count_words, "lang string, word string, hash long, n long")
    words = store(words.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    layout = lay_out(texts, words, total, budget)
    packed = texts.mapInArrow(pack_suffixes(layout), "part int, words binary, columns binary, counts binary, n int")
    nodes = packed.groupBy("part").applyInArrow(read_leaves(layout, min_count), _NODES)
    sums = nodes.groupBy("w1", "w2", "w3", "w4", "w5").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    phrase = F.filter(F.array("w1", "w2", "w3", "w4", "w5"), lambda w: w != 0)
    return words, store(sums.select(phrase.alias("words"), "n"), "phrases")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    words, phrases = phrase_counts(docs, min_count, budget)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("size"))
    common = words.filter(F.col("n") >= min_count)
    known = phrases.unionByName(common.select(F.array("hash").alias("words"), "n"))
    longest = phrases.filter(F.size("words") > 2)
    n_words = F.size("words")
    inner = F.explode(F.array(F.slice("words", F.lit(1), n_words - 1), F.slice("words", F.lit(2), n_words - 1)))
    inside = longest.select(inner.alias("words"), "n").groupBy("words").agg(F.max("n").alias("longer"))
    kept = phrases.join(inside, "words", "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("n"))).drop("longer")
    cuts = kept.select("words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), n_words - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("head"), F.expr("slice(words, k + 1, size(words) - k)").alias("tail"))
    cuts = cuts.join(known.select(F.col("words").alias("head"), F.col("n").alias("l")), "head")
    cuts = cuts.join(known.select(F.col("words").alias("tail"), F.col("n").alias("r")), "tail")
    cuts = cuts.join(common.select(F.array("hash").alias("first"), "lang"), F.slice("words", 1, 1) == F.col("first"))
    cuts = cuts.join(F.broadcast(sizes), "lang")  # one row a language
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * whole("a") * whole("size"), whole("l") * whole("r"))
    least = cuts.groupBy("lang", "words", "a", "size").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = least.select("lang", "words", "a", "cut.l", "cut.r", F.col("size").alias("n"), "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = best.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top)
    spelled = first.select("*", F.posexplode("words").alias("at", "hash")).join(common.select("hash", "lang", "word"), ["hash", "lang"])
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    named = spelled.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(phrase.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT d.id, d.lang, unnest(regexp_split_to_array(d.text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
t AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
f AS (
  SELECT lang, w[i:i + k - 1] AS ph, k, count(*)::HUGEINT AS f
  FROM t, (VALUES (1), (2), (3), (4), (5)) AS s(k) WHERE i + k - 1 <= len(w)
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY 1),
inner_parts AS (
  SELECT lang, ph[j:j + m - 1] AS ph, max(f) AS f
  FROM f, (VALUES (2), (3), (4)) AS x(m), (VALUES (1), (2), (3), (4)) AS y(j)
  WHERE m < k AND j + m - 1 <= k GROUP BY 1, 2),
kept AS (SELECT f.* FROM f LEFT JOIN inner_parts i ON i.lang = f.lang AND i.ph = f.ph WHERE f.k >= 2 AND (i.f IS NULL OR 100 * i.f < 100 * f.f)),
cuts AS (
  SELECT c.lang, c.ph, c.f AS a, l.f AS l, r.f AS r, n.n, q.k, (1000 * c.f * n.n) // (l.f * r.f) AS score
  FROM kept c JOIN (VALUES (1), (2), (3), (4)) AS q(k) ON q.k < c.k
  JOIN f l ON l.lang = c.lang AND l.ph = c.ph[1:q.k] JOIN f r ON r.lang = c.lang AND r.ph = c.ph[q.k + 1:c.k]
  JOIN n ON n.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS place FROM cuts),
ranked AS (
  SELECT *, array_to_string(ph, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank
  FROM best WHERE place = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

"""Document scores by prediction by partial matching over the bytes of whole texts, and by word counts.

The model is a trie of byte contexts up to ``order`` bytes deep, learned from all training texts. A document is one
line: its words (A-Z lower-cased) with a space behind each, and a line feed. Contexts reach back over spaces into the words
before; ahead of a line there are spaces. A byte that follows its longest known context gets its count
there, less one half, over the context's count; the halves make up the escape (method D). On an escape
the next shorter context decides, with the followers already ruled out left out of its counts. A byte
counts in a shorter context once for each longer one that had it (update exclusion). Behind the empty
context all bytes not seen yet are alike. Probabilities of all continuations sum to one; a byte's log10 is
rounded to 2 ** -24, so that a text's sum is the same in any order of adding.

Neither the trie nor the word counts are bounded, and the order is the same at every size. Codes (a byte
and its context) are counted over all training texts with Spark; those of other texts count 0. A code is dealt to a
bucket by the two bytes before it; two bytes with more codes than a bucket should hold are extended by the byte before
them, and so on. Each bucket builds its part of the trie and prices its codes; the nodes that buckets share are
broadcast: the two lowest levels (65,792 nodes at most), and the followers of the extended contexts (256 each). Documents in a row make
chunks of some megabytes, stored with their lines packed; each chunk asks every bucket once for its distinct words and codes, packed to one
row, and gets counts and costs back by a cogroup. A bucket that is asked for much answers in several tasks.

Cases: null or empty text is its end alone; repeated rows are each scored (and each learned from); an
empty training set makes all bytes alike and base scores 0; rows without doc_id are held in; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import lean_batches, same_partition_count, store, text_of
from crawlframe.llm.words import U64, WordSlice, mix

ORDER = 5
CHUNK_BYTES = 8 << 20
#: Bytes whose codes are held at a time.
_STRETCH = 1 << 20
#: Levels of the trie that every task has, and about how many words and codes a bucket holds.
_LOW = 2
BUCKET_KEYS = 200_000
#: Packed bytes of one bucket's questions that a task takes.
ASK_BYTES = 64 << 20
_WALK = 1 << 18
#: Set in the keys of words; byte codes have at most 56 bits.
_WORD = U64(1 << 63)
#: Costs are whole multiples of this.
_UNIT = 2.0**-24


def line_of(text: bytes) -> bytes:
    """The words with a space behind each, and the end."""
    words = text.lower().split()
    return b" ".join(words) + b" \n" if words else b"\n"


def each_once(values: np.ndarray) -> np.ndarray:
    """Each value once, ascending, by a sort: np.unique without counts goes by a hash table, which is several times slower here."""
    values = np.sort(values)
    return values[np.diff(values, prepend=~values[:1]) != 0]


class Lines:
    """Some documents' lines: ``first`` is the first one's place in its batch."""

    def __init__(self, lines: list[bytes], first: int = 0):
        self.first, self.lines = first, lines
        self.lengths = np.array([len(x) for x in lines], np.int64)

    @classmethod
    def cut(cls, column: pa.Array, max_bytes: int) -> Iterator[Lines]:
        """The lines of a string column in order, so many bytes at a time (one longer line is a cut of its own); null counts as empty."""
        raw = column.cast(pa.large_binary())
        held, size, first = [], 0, 0
        for i in range(len(raw)):
            line = line_of(raw[i].as_py() or b"")
            if held and size + len(line) > max_bytes:
                yield cls(held, first)
                held, size, first = [], 0, i
            held.append(line)
            size += len(line)
        if held:
            yield cls(held, first)

    def __len__(self) -> int:
        return len(self.lines)

    def words(self) -> WordSlice:
        offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        return WordSlice(np.frombuffer(b"".join(self.lines), np.uint8), offsets, range(len(self)))

    def codes(self, order: int, stretch: int = _STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, code) of every byte: the byte and the ``order`` bytes before it as one number, some at a time."""
        pad = b" " * order
        whole = b"".join([pad + x for x in self.lines])
        edges = np.concatenate([[0], np.cumsum(self.lengths + order)])
        # eight bytes from every place on as one number, of which the first ones are the code
        eight = np.ndarray((len(whole),), ">u8", whole + bytes(8), strides=(1,))
        pads = (edges[:-1, None] + np.arange(order)).reshape(-1)
        for i in range(order, len(whole), stretch):
            j = min(i + stretch, len(whole))
            code = eight[i - order : j - order].astype(U64)
            code >>= U64(8 * (7 - order))
            a, b = np.searchsorted(edges, [i, j - 1], "right") - 1
            inside = np.ones(j - i, bool)
            p, q = np.searchsorted(pads, [i, j])
            inside[pads[p:q] - i] = False
            starts, ends = edges[a : b + 1] + order, edges[a + 1 : b + 2]
            own = np.repeat(np.arange(a, b + 1), np.clip(ends, i, j) - np.clip(starts, i, j))
            yield own, code[inside]

    def keys(self, order: int) -> np.ndarray:
        """All distinct codes, ascending."""
        parts = [each_once(codes) for _, codes in self.codes(order)]
        return each_once(np.concatenate(parts)) if parts else np.empty(0, U64)

    def pack(self) -> bytes:
        import zstandard

        return zstandard.ZstdCompressor(level=3).compress(b"".join(self.lines))

    @classmethod
    def unpack(cls, packed: bytes) -> Lines:
        import zstandard

        return cls(zstandard.ZstdDecompressor().decompress(packed).splitlines(keepends=True))


class Lookup:
    """Values of distinct codes, in tables of some slots a code; a code whose slot is taken goes to the next, smaller table."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []
        while len(codes):
            bits = max(6, int(2 * len(codes)).bit_length())
            slot = self._slots(codes, len(self.tables), bits)
            owner = np.full(1 << bits, -1, np.int64)
            owner[slot] = np.arange(len(codes))
            placed = owner[slot] == np.arange(len(codes))
            own, at = np.full(1 << bits, ~U64(0)), np.zeros(1 << bits, values.dtype)  # no code is all ones
            own[slot[placed]], at[slot[placed]] = codes[placed], values[placed]
            self.tables.append((bits, own, at))
            codes, values = codes[~placed], values[~placed]

    @staticmethod
    def _slots(codes: np.ndarray, level: int, bits: int) -> np.ndarray:
        spread = (codes + U64(level)) * U64(0x9E3779B97F4A7C15)
        return ((spread ^ (spread >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(64 - bits)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """The values of codes, all of which are known."""
        out, rest = None, None
        for level, (bits, own, values) in enumerate(self.tables):
            slot = self._slots(codes, level, bits)
            hit = own[slot] == codes
            if out is None:
                out = values[slot]
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] = values[slot[hit]]
                rest = rest[~hit]
            if not len(rest):
                break
            codes = codes[~hit]
        return out


def _mask(level: int) -> np.uint64:
    return U64((1 << 8 * (level + 1)) - 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Trie:
    """Per level: sorted codes and counts; contexts with their sum, followers, and the followers' sum one level lower."""

    order: int
    codes: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    kinds: list[np.ndarray] = field(default_factory=list)
    lower: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, codes: np.ndarray, counts: np.ndarray, order: int, low: Shared | None = None) -> Trie:
        """From the distinct codes of the deepest level and their counts; nodes that buckets share are those of ``low`` where given."""
        trie = cls(order)
        by = np.argsort(codes)
        nodes = [(codes[by], counts[by])]
        for level in range(order - 1, low.trie.order if low else -1, -1):
            # a byte counts in a shorter context once for each longer one it was new in
            own, n = np.unique(nodes[0][0] & _mask(level), return_counts=True)
            if low and level in low.heavy:
                alone = ~_find(low.heavy[level], own >> U64(8))[1]
                own, n = np.concatenate([own[alone], low.codes[level]]), np.concatenate([n[alone], low.counts[level]])
                by = np.argsort(own)
                own, n = own[by], n[by]
            nodes.insert(0, (own, n.astype(np.int64)))
        if low:
            nodes[:0] = zip(low.trie.codes, low.trie.counts, strict=True)
        for level, (own, n) in enumerate(nodes):
            first = np.flatnonzero(np.diff(own >> U64(8), prepend=~U64(0)) != 0) if len(own) else np.empty(0, np.int64)
            trie.codes.append(own)
            trie.counts.append(n)
            trie.contexts.append(own[first] >> U64(8))
            trie.sums.append(np.add.reduceat(n, first) if len(first) else n)
            trie.kinds.append(np.diff(first, append=len(own)))
            if level:
                at, _ = _find(trie.codes[level - 1], own & _mask(level - 1))
                trie.lower.append(np.add.reduceat(trie.counts[level - 1][at], first) if len(first) else n)
            else:
                trie.lower.append(np.zeros(len(first), np.int64))
        return trie

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """log10 of each byte's probability behind its context, level by level."""
        cost = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        out_sum, out_kinds = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for level in range(self.order, -1, -1):
            code = codes[open_] & _mask(level)
            at, known = _find(self.contexts[level], code >> U64(8))
            total = np.where(known, self.sums[level][at] - out_sum[open_], 0) if len(self.sums[level]) else np.zeros(len(code))
            kinds = np.where(known, self.kinds[level][at] - out_kinds[open_], 0) if len(self.sums[level]) else np.zeros(len(code))
            place, there = _find(self.codes[level], code)
            there &= kinds > 0
            whole = np.maximum(2 * total, 1)
            some = open_[there]
            cost[some] += np.log10((2 * self.counts[level][place[there]] - 1) / whole[there]) if len(some) else 0
            rest = ~there
            paid = rest & (kinds > 0)
            cost[open_[paid]] += np.log10(kinds[paid] / whole[paid])
            left = open_[rest & known]
            out_sum[left], out_kinds[left] = self.lower[level][at[rest & known]], self.kinds[level][at[rest & known]]
            open_ = open_[rest]
        cost[open_] -= np.log10(256 - out_kinds[open_])
        return cost


@dataclass
class Shared:
    """What all buckets have: the lowest levels, and by depth the extended contexts with the nodes behind them."""

    trie: Trie
    heavy: dict[int, np.ndarray] = field(default_factory=dict)
    codes: dict[int, np.ndarray] = field(default_factory=dict)
    counts: dict[int, np.ndarray] = field(default_factory=dict)

    def bucket_of(self, keys: np.ndarray, buckets: int) -> np.ndarray:
        """Codes go by the two bytes before the last, or more where these are extended, words by their hash."""
        before = keys >> U64(8)
        part = np.where(keys >= _WORD, keys, before & _mask(_LOW - 1))
        more = keys < _WORD
        for depth in sorted(self.heavy):
            more &= _find(self.heavy[depth], before & _mask(depth - 1))[1]
            part[more] = (before[more] & _mask(depth)) + (U64(depth) << U64(56))
        return ((mix(part) >> U64(33)) % U64(buckets)).astype(np.int32)


def _counts(rows: DataFrame, order: int, chunk_bytes: int) -> DataFrame:
    """key, n over the training texts of ``rows`` (held_out, text): words have the top bit of their hash set, byte codes don't.

    Codes that only other texts have are there with 0.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learned = ~batch.column(0).fill_null(True).to_numpy(zero_copy_only=False)
            for lines in Lines.cut(batch.column(1), chunk_bytes):
                own = learned[lines.first : lines.first + len(lines)]
                part = lines.words()
                words, n = np.unique(part.hashes()[np.repeat(own, np.diff(part.first))] | _WORD, return_counts=True)
                del part
                keys, numbers = [words], [n]
                for doc, codes in lines.codes(order):
                    train = own[doc]
                    grams, n = np.unique(codes[train], return_counts=True)
                    other = each_once(codes[~train])
                    keys += [grams, other]
                    numbers += [n, np.zeros(len(other), np.int64)]
                every, at = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(at, np.concatenate(numbers), len(every)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(n)], names=["key", "n"])

    return rows.select("held_out", "text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _planes(values: np.ndarray, width: int) -> bytes:
    """Numbers with all their first bytes first, then all second ones, so that they compress."""
    return np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _from_planes(raw: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def _press(values: np.ndarray, width: int) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(_planes(values, width))


def _unpress(packed: bytes, width: int) -> np.ndarray:
    import zstandard

    return _from_planes(zstandard.ZstdDecompressor().decompress(packed), width)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending numbers as the gaps between them."""
    return _press(np.diff(keys, prepend=U64(0)), 8)


def unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpress(packed, 8).view(U64))


def _masked(level: int) -> Column:
    return F.col("key").bitwiseAND(int(_mask(level)))


def _followers(grams: DataFrame, level: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a level: a byte counts in a context once for each longer one it was new in."""
    if level < order:
        grams = grams.select(_masked(level + 1).alias("key")).distinct().groupBy(_masked(level).alias("key")).agg(F.count("*").alias("n"))
    rows = grams.select("key", "n").toArrow()
    codes, n = rows["key"].to_numpy().view(U64), rows["n"].to_numpy()
    by = np.argsort(codes)
    return codes[by], n[by]


def _shared(counted: DataFrame, order: int, bucket_keys: int) -> Shared:
    """Extended contexts have more codes than a bucket should; there are fewer than codes / ``bucket_keys`` a level."""
    grams = counted.filter("key >= 0")
    known = grams.filter("n > 0")
    low = min(order, _LOW - 1)
    shared = Shared(Trie.of(*_followers(known, low, order), low))
    for depth in range(_LOW, order):
        context = F.shiftrightunsigned("key", 8).bitwiseAND(int(_mask(depth - 1)))
        many = grams.groupBy(context.alias("context")).agg(F.count("*").alias("codes")).filter(F.col("codes") > bucket_keys)
        heavy = sorted(r["context"] for r in many.collect())
        if not heavy:
            break
        grams, known = grams.filter(context.isin(heavy)), known.filter(context.isin(heavy))
        shared.heavy[depth] = np.array(heavy, U64)
        shared.codes[depth], shared.counts[depth] = _followers(known, depth, order)
    return shared


def _answers(asked: DataFrame, counted: DataFrame, shared, order: int, buckets: int, ask_bytes: int) -> DataFrame:
    """own, bucket, costs, counts of every row of ``asked`` (own, bucket, keys): counts of words, and costs of codes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = shared.value.bucket_of(batch.column(0).to_numpy().view(U64), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns], names=["bucket", "key", "n"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, n = right["key"].to_numpy().view(U64), right["n"].to_numpy()
        by = np.argsort(keys)
        keys, n = keys[by], n[by]
        codes = int(np.searchsorted(keys, _WORD))
        cost = np.zeros(codes, np.int64)
        if codes:
            some = n[:codes] > 0
            model = Trie.of(keys[:codes][some], n[:codes][some], order, shared.value) if order >= _LOW else shared.value.trie
            for a in range(0, codes, _WALK):
                b = min(a + _WALK, codes)
                cost[a:b] = np.rint(model.walk(keys[a:b]) / -_UNIT)
        costs, counts = [], []
        for packed in left["keys"]:
            own = unpack_keys(packed.as_py())
            first = int(np.searchsorted(own, _WORD))
            costs.append(_press(cost[_find(keys[:codes], own[:first])[0]], 4))
            at, known = _find(keys[codes:], own[first:])
            counts.append(_press(np.where(known, n[codes:][at], 0) if codes < len(keys) else np.zeros(len(at), np.int64), 8))
        return pa.table([left["own"], left["bucket"], pa.array(costs, pa.binary()), pa.array(counts, pa.binary())], names=["own", "bucket", "costs", "counts"])

    most = asked.groupBy("bucket").agg(F.sum(F.length("keys")).alias("bytes")).agg(F.max("bytes")).first()[0] or 0
    tasks = 1 + most // ask_bytes
    known = counted.select("key", "n").mapInArrow(deal, "bucket int, key long, n long")
    known = known.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1).cast("int"))))
    asked = asked.withColumn("task", F.pmod("own", F.lit(tasks)).cast("int"))
    return asked.groupBy("bucket", "task").cogroup(known.groupBy("bucket", "task")).applyInArrow(answer, "own long, bucket int, costs binary, counts binary")


_CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, asks array<struct<bucket:int,keys:binary>>, lines binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORES_ARROW = pa.schema(
    list(zip([c.split()[0] for c in _SCORES.split(", ")], [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2], strict=True))
)


def _chunks(rows: DataFrame, shared, order: int, buckets: int, chunk_bytes: int) -> DataFrame:
    """Documents of some megabytes in a row: their lines, and what they ask of each bucket."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lines in Lines.cut(batch.column(2), chunk_bytes):
                keys = np.concatenate([lines.keys(order), each_once(lines.words().hashes() | _WORD)])
                bucket = shared.value.bucket_of(keys, buckets)
                by = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
                asks = [{"bucket": bucket[by[a]], "keys": pack_keys(keys[by[a:b]])} for a, b in zip(cuts, [*cuts[1:], len(by)], strict=True)]
                row = {
                    "chunk": pa.array([number]),
                    "doc_ids": pa.array([batch.column(0).slice(lines.first, len(lines)).to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([batch.column(1).slice(lines.first, len(lines)).to_pylist()], pa.list_(pa.bool_())),
                    "asks": pa.array([asks], pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary())]))),
                    "lines": pa.array([lines.pack()], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(row)
                number += 1

    return rows.select("doc_id", "held_out", "text").mapInArrow(cut, _CHUNK)


def score_documents(
    docs: DataFrame, held_out: Column, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS, ask_bytes: int = ASK_BYTES
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Learns from the rows that don't meet ``held_out``. Scores are log10 probabilities of the whole text:
    ``base_score`` by smoothed word counts, ``score`` by the trie.
    """
    lean_batches(docs, 1000)
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), text_of().alias("text"))
    counted = store(_counts(rows, order, chunk_bytes), "counts")
    total, distinct = counted.filter("key < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = rows.filter(~F.col("held_out")).count()
    tokens, kinds = total + ends, distinct + (ends > 0)
    buckets = max(same_partition_count(docs), counted.count() // bucket_keys)
    shared = docs.sparkSession.sparkContext.broadcast(_shared(counted, order, bucket_keys))
    chunks = store(_chunks(rows, shared, order, buckets, chunk_bytes), "chunks")
    asked = chunks.select(F.col("chunk").alias("own"), F.explode("asks").alias("ask")).select("own", "ask.bucket", "ask.keys")
    answers = _answers(asked, counted, shared, order, buckets, ask_bytes)
    whole = tokens + 0.5 * (kinds + 1)

    def score(left: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        told = {b: (c.as_py(), n.as_py()) for b, c, n in zip(known["bucket"].to_pylist(), known["costs"], known["counts"], strict=True)}
        for row in left.to_pylist():
            lines = Lines.unpack(row["lines"])
            part = lines.words()
            hashes, per_doc = part.hashes() | _WORD, np.diff(part.first)
            del part
            codes, words = lines.keys(order), each_once(hashes)
            cost, count = np.zeros(len(codes), np.int64), np.zeros(len(words), np.int64)
            for keys, value, at, width in ((codes, cost, 0, 4), (words, count, 1, 8)):
                bucket = shared.value.bucket_of(keys, buckets)
                value[np.argsort(bucket, kind="stable")] = np.concatenate([_unpress(told[b][at], width) for b in sorted(told)])
            n = len(lines)
            trie, look = np.zeros(n), Lookup(codes, cost)
            for doc, own in lines.codes(order):
                trie += np.bincount(doc, look(own), n)
            doc = np.repeat(np.arange(n), per_doc)
            own = count[np.searchsorted(words, hashes)] if len(words) else np.empty(0, np.int64)
            base = np.bincount(doc, np.log10((own + 0.5) / whole), n) + np.log10((ends + 0.5) / whole)
            seen = np.bincount(doc, own > 0, n).astype(np.int64) + int(ends > 0)
            columns = [row["doc_ids"], row["held"], per_doc + 1, seen, np.full(n, tokens), base, -_UNIT * trie]
            out.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, _SCORES_ARROW, strict=True)], schema=_SCORES_ARROW))
        return pa.concat_tables(out) if out else _SCORES_ARROW.empty_table()

    texts = chunks.drop("asks")
    return texts.groupBy("chunk").cogroup(answers.groupBy("own")).applyInArrow(score, _SCORES)

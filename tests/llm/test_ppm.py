"""Language-model scores: word counts against plain counting, the trie against a dictionary form of the same rules."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlframe.llm.ppm import Lines, Lookup, Trie, line_of, pack_keys, score_documents, unpack_keys
from crawlframe.llm.words import U64

SCHEMA = "doc_id long, text string, n long, block long, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def steps(words, order):
    """(context, byte) of every byte of a document's line, spaces ahead of it."""
    raw = b" " * order + "".join(w + " " for w in words).encode() + b"\n"
    for i in range(order, len(raw)):
        yield raw[i - order : i], raw[i]


class Plain:
    def __init__(self, docs, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for words in docs:
            self.counts[order].update(steps(words, order))
        for level in range(order - 1, -1, -1):
            self.counts[level].update((c[1:], x) for c, x in self.counts[level + 1])

    def probability(self, context, byte):
        p, out = 1.0, set()
        for level in range(self.order, -1, -1):
            own = {x: n for (c, x), n in self.counts[level].items() if c == context[self.order - level :]}
            new = {x: n for x, n in own.items() if x not in out}
            if new:
                whole = 2 * sum(new.values())
                if byte in new:
                    return p * (2 * new[byte] - 1) / whole
                p *= len(new) / whole
            out |= set(own)
        return p / (256 - len(out))


def brute(rows, order):
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for i, (d, _) in enumerate(rows)}
    words = [WORD.findall(lower(t)) for _, t in rows]
    train = [w for i, w in enumerate(words) if not held[i]]
    counts = Counter(w for ws in train for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    plain = Plain(train, order)
    out = []
    for i, (d, _) in enumerate(rows):
        tokens = [*words[i], None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        score = sum(math.log10(plain.probability(c, x)) for c, x in steps(words[i], order))
        out.append((d, held[i], len(tokens), sum(counts[t] > 0 for t in tokens), n, base, score))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    syllables = ["ba", "né", "to", "ß", "ri", "K"]
    texts = [None, "", " ", "x" * 300, "A a A", "ends here\n"]
    texts += [" ".join("".join(rnd.choices(syllables, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(1, 30))) for _ in range(40)]
    return [(None if i == 8 else i * 3, t) for i, t in enumerate(texts)] + [(0, None), (21, texts[7]), (21, texts[7])]


@pytest.mark.parametrize("order,blocks,keys,asks", [(1, 200, 1 << 20, 1 << 20), (3, 400, 40, 50), (5, 300, 5, 100), (5, 1 << 20, 1 << 20, 1 << 20)])
def test_scores(spark, order, blocks, keys, asks):
    rows = corpus(order)
    docs = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], SCHEMA).repartition(3)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    scored = score_documents(docs, held, order, chunk_bytes=blocks, bucket_keys=keys, ask_bytes=asks)
    got = sorted((tuple(r) for r in scored.collect()), key=str)
    expected = sorted(brute(rows, order), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5] for g in got], [e[5] for e in expected], rtol=1e-9)
    # a byte's cost is rounded to 2 ** -24; no line is longer than 1000 bytes
    assert np.allclose([g[6] for g in got], [e[6] for e in expected], rtol=0, atol=1000 * 2.0**-25)


def test_word_order_counts(spark):
    rnd = random.Random(3)
    phrase = "the quick brown fox jumps over the lazy dog near a quiet river bank".split()
    shuffled = phrase[:]
    while shuffled == phrase:
        rnd.shuffle(shuffled)
    rows = [(i, " ".join(phrase)) for i in range(20)] + [(100, " ".join(phrase)), (101, " ".join(shuffled))]
    docs = spark.createDataFrame([(d, t, 0, 0, "") for d, t in rows], SCHEMA)
    got = {r.doc_id: r for r in score_documents(docs, F.col("doc_id") >= 100).collect()}
    assert got[101].score < got[100].score - 1 and abs(got[101].base_score - got[100].base_score) < 1e-9


def test_order_stays_beyond_a_million_leaves(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=10)) for _ in range(150_000)]
    held = " ".join([*words[:200], *(w[:5] + w[::-1] for w in words[:200])])
    texts = [(i, " ".join(words[i * 1500 : i * 1500 + 1500])) for i in range(100)] + [(-1, held)]
    train = np.concatenate([c for _, c in Lines([line_of(t.encode()) for i, t in texts if i >= 0]).codes(5)])
    own, n = np.unique(train, return_counts=True)
    assert len(own) > 1_000_000
    expected = Trie.of(own, n, 5).walk(np.concatenate([c for _, c in Lines([line_of(held.encode())]).codes(5)])).sum()
    docs = spark.createDataFrame([(d, t, 0, 0, "") for d, t in texts], SCHEMA).repartition(4)
    got = {r.doc_id: r.score for r in score_documents(docs, F.col("doc_id") < 0).collect()}
    assert abs(got[-1] - expected) < 1e-6 * len(held)


def test_probabilities_sum_to_one():
    codes = np.concatenate([c for _, c in Lines([line_of(b"abra cadabra abba"), line_of(b"bra bar")]).codes(3)])
    own, n = np.unique(codes, return_counts=True)
    trie = Trie.of(own, n, 3)
    for context in (b"   ", b"abr", b"zzz", b"  a", b"xab", b"ra "):
        every = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], U64)
        assert abs((10 ** trie.walk(every)).sum() - 1) < 1e-9


def test_lines_and_keys_round_trip():
    texts = ["", " A\x0bb\x1c ", "é" * 50, "x"]
    lines = Lines([line_of(t.encode()) for t in texts])
    assert Lines.unpack(lines.pack()).lines == lines.lines == [b"\n", b"a b\x1c \n", "é".encode() * 50 + b" \n", b"x \n"]
    expected = [(d, int.from_bytes((b" " * 4 + x)[i : i + 5], "big")) for d, x in enumerate(lines.lines) for i in range(len(x))]
    for stretch in (1, 3, 7, 1 << 20):
        got = [(int(d), int(c)) for doc, codes in lines.codes(4, stretch) for d, c in zip(doc, codes, strict=True)]
        assert got == expected
    keys = np.array([0, 3, 1 << 40, (1 << 64) - 1], U64)
    assert (unpack_keys(pack_keys(keys)) == keys).all() and not len(unpack_keys(pack_keys(keys[:0])))


def test_lookup():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 30_000):
        codes = np.unique(rng.integers(0, 2**48, n, dtype=np.int64).astype(U64))
        values = rng.integers(0, 2**31, len(codes))
        at = rng.integers(0, len(codes), 4 * n)
        assert (Lookup(codes, values)(codes[at]) == values[at]).all()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", 0, 0, ""), (2, None, 0, 0, "")], SCHEMA)
    rows = {r.doc_id: r for r in score_documents(docs, F.lit(True)).collect()}
    assert rows[1].base_score == 0 and rows[1].n_known == 0 and rows[1].train_tokens == 0
    assert abs(rows[1].score - 5 * math.log10(1 / 256)) < 1e-5
    assert score_documents(docs.limit(0), F.lit(False)).count() == 0


def test_codes_of_lines_by_hand():
    """Every byte with the bytes before it, whatever the stretch; each distinct value once, also the greatest."""
    from crawlframe.llm.ppm import Lines, each_once

    rows = [b"ab a \n", b"\n", b"abc \n"]
    for order in (0, 1, 5):
        want = [(d, int.from_bytes((b" " * order + x)[i : i + order + 1], "big")) for d, x in enumerate(rows) for i in range(len(x))]
        for stretch in (1, 4, 1 << 20):
            got = [(int(d), int(c)) for own, codes in Lines(rows).codes(order, stretch) for d, c in zip(own, codes, strict=True)]
            assert got == want
        assert Lines(rows).keys(order).tolist() == sorted({c for _, c in want})
    top = np.iinfo(np.uint64).max
    assert each_once(np.array([top, 3, 0, top, 3], np.uint64)).tolist() == [0, 3, top] and len(each_once(np.empty(0, np.uint64))) == 0

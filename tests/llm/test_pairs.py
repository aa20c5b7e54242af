"""Similarity join and decontamination against brute force on small fixtures."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from crawlframe.llm.decontaminate import GAP, MATCH, MISMATCH, align, leaked_items, without_leaks
from crawlframe.llm.graph import components
from crawlframe.llm.jaccard_join import jaccard_classes, most_common, short_codes, without_near_duplicates
from crawlframe.llm.words import text_slices

SCHEMA = "doc_id long, text string, k1 long, n string, label string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_components(rows, size=5, threshold=75):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((d for d in m if d is not None), default=None) for g, m in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited(words, share, rnd, vocabulary):
    out = []
    for w in words:
        x = rnd.random()
        if x < share:
            out.append(rnd.choice(vocabulary))
        elif x > share / 4:
            out.append(w)
    return out


def corpus(seed, families=12, copies=14):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "Ab", "aB"]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    texts = [None, "", " \n\t", "one", "One", "one two three", "ONE two  three", "one two three", "a b c d e", "a b c d e f", "İ i̇ ß SS"]
    for f in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(8, 120))] + (passage if f % 3 == 0 else [])
        for c in range(copies):
            texts.append(rnd.choice([" ", "\n", "  "]).join(edited(base, 0.012 * (c % 7), rnd, vocabulary)))
    texts += ["same text with six plain words"] * 20 + ["long " + "v" * 70000 + " word of some length here"] * 2
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(30)) for _ in range(20)]
    rnd.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1, "x", "y", "z") for d, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(df, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute_components(rows)


def test_other_sizes(spark):
    rows = corpus(3, families=5, copies=8)
    assert found(spark, rows, size=2, threshold=40) == brute_components(rows, 2, 40)


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b c d e f g"), (5, "a b c d e f g"), (5, "a b c d e f g"), (5, ""), (None, None), (None, "q r s"), (3, "A b c d e f g")]
    got = found(spark, rows)
    assert got == sorted([(None, 3, 3), (5, 3, 3), (5, 3, 3), (5, 0, 5), (None, 0, None), (None, 1, None), (3, 3, 3)], key=str)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_classes(empty).count() == 0
    assert leaked_items(empty, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d", 0, "", "", "")], SCHEMA)
    assert leaked_items(some, items).count() == 0
    assert without_leaks(some, items).collect() == some.collect()


def test_documents_of_the_smallest_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(docs).collect()), key=str) == brute_components(rows)


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 999), (999, 1000)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(301)} | {(999, 999), (1000, 999)}


def test_words_of_slices():
    texts = [None, "", "A b", " x\n", "é É", "a" * 100, "b c d e f g"]
    for size in (1, 10, 1000):
        slices = list(text_slices(pa.array(texts), size))
        assert [i for s in slices for i in s.rows] == list(range(len(texts)))
        counts = [n for s in slices for n in np.diff(s.first)]
        assert counts == [len(WORD.findall(t or "")) for t in texts]
        words = [bytes(s.data[a:b]).decode() for s in slices for a, b in zip(s.starts, s.ends, strict=True)]
        assert words == [w for t in texts for w in WORD.findall(lower(t))]
        if size == 10:
            one = np.concatenate([s.hashes() for s in slices])
        if size == 1000:
            assert np.array_equal(one, np.concatenate([s.hashes() for s in slices]))


def brute_align(doc, item):
    rows, top = [[0] * (len(doc) + 1)], 0
    for word in item:
        row = [0]
        for j, d in enumerate(doc):
            row.append(max(0, rows[-1][j] + (MATCH if d == word else MISMATCH), rows[-1][j + 1] + GAP, row[j] + GAP))
        rows.append(row)
        top = max(top, *row)
    return top


def test_alignment():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        doc, item = rnd.integers(0, 6, rnd.integers(1, 40)), rnd.integers(0, 6, rnd.integers(1, 12))
        score, a, b = align(doc, item)
        assert score == brute_align(doc, item)
        assert brute_align(doc[a:b], item) == score or score == 0


def test_leaks(spark):
    rnd = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of"] * 60
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(12, 45))] for _ in range(12)]
    rows, planted = [], set()
    for d in range(160):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 200))]
        if d % 4 == 0:
            k = rnd.randrange(len(items)) if d % 8 else 0
            at = rnd.randrange(len(words) + 1)
            words[at:at] = edited(items[k], rnd.choice([0, 0, 0.1, 0.2]), rnd, vocabulary)
            planted.add((d, k))
        rows.append((d, " ".join(words).upper() if d % 3 else "\n".join(words), 0, "", "", ""))
    rows += [(500, None, 0, "", "", ""), (501, "", 0, "", "", ""), (None, " ".join(items[0]), 0, "", "", ""), (0, rows[0][1], 0, "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, "too short"), (0, " ".join(items[0]))], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id): r for r in leaked_items(docs, table).collect()}
    expected = set()
    for d, text, *_ in rows:
        words = WORD.findall(lower(text))
        for k, item in enumerate(items):
            if words and brute_align(words, item) >= 0.4 * MATCH * len(item):
                expected.add((d, k))
    assert planted <= expected and set(got) == expected
    texts = {d: text for d, text, *_ in rows}
    for (d, k), r in got.items():
        words = WORD.findall(lower(texts[d]))
        assert r.score == brute_align(words, items[k]) / (MATCH * len(items[k])) == brute_align(words[r.first_word : r.end_word], items[k]) / (MATCH * len(items[k]))
    left = without_leaks(docs, table)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, *_ in rows if d not in {x for x, _ in expected})


def test_a_long_item_leaves_other_stretches_short(spark, monkeypatch):
    from crawlframe.llm import decontaminate

    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    short, long, text = ([word() for _ in range(n)] for n in (20, 20_000, 30_000))
    text[9000:9000] = short
    docs = spark.createDataFrame([(1, " ".join(text), 0, "", "", ""), (1, " ".join(long[500:16_000]), 0, "", "", "")], SCHEMA)
    items = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(long))], "item_id long, text string")
    kept = []
    whole = decontaminate._stretches
    monkeypatch.setattr(decontaminate, "_stretches", lambda *a: kept.append(whole(*a)) or kept[-1])
    assert {(r.item_id, r.first_word) for r in decontaminate.leaked_items(docs, items).collect()} == {(1, 9000), (2, 0)}
    assert max(len(r.words) for r in kept[0].filter("class = 5").collect()) <= 2 * (20 + 3 * 32)


def test_decisions_hold_for_an_id_with_its_text(spark):
    one, two, three = "a b c d e f g h", "q r s t u v w x", "k l m n o p q r"
    rows = [(1, one), (2, one), (2, two), (3, two[:-2] + " y"), (3, three), (None, three), (None, "z z"), (3, three), (None, None), (2, "")]
    docs = spark.createDataFrame([(d, t, 1, "x", "y", "z") for d, t in rows], SCHEMA).repartition(3)
    left = sorted(((r.doc_id, r.text) for r in without_near_duplicates(docs).collect()), key=str)
    assert left == sorted([(1, one), (2, two), (3, two[:-2] + " y"), (3, three), (None, "z z"), (None, None), (2, "")], key=str)
    items = spark.createDataFrame([(1, one)], "item_id long, text string")
    more = spark.createDataFrame([(7, one, 1, "x", "y", "z"), (7, two, 1, "x", "y", "z"), (None, "so " + one, 1, "", "", ""), (None, two, 1, "", "", "")], SCHEMA)
    assert sorted(((r.doc_id, r.text) for r in without_leaks(more, items).collect()), key=str) == sorted([(7, two), (None, two)], key=str)


def test_links_run_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(40)]
    ends = (" ".join(words[:-5]), " ".join(words), " ".join(words[5:]))
    rows = [(1, ends[0]), (None, ends[1]), (2, ends[2]), (None, "other " + ends[2] + " x y z"), (None, "lone one")]
    assert brute_components([(1, ends[0]), (2, ends[2])]) == [(1, 31, 1), (2, 31, 2)]
    assert found(spark, rows) == brute_components(rows)


def test_blocks_of_a_shingle_meet_once(spark, monkeypatch):
    from crawlframe.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rows = corpus(8, families=4, copies=20)
    assert found(spark, rows) == brute_components(rows)


def test_short_codes_bound_the_intersection():
    rng = np.random.default_rng(11)
    for n, m, both in [(1, 1, 1), (1, 3, 0), (40, 50, 30), (600, 700, 500), (3000, 2000, 1500), (9, 9, 9)]:
        ids = rng.integers(0, 2**63, n + m - both, dtype=np.int64).astype(np.uint64)
        got = most_common(short_codes(np.sort(ids[:n])), short_codes(np.sort(ids[n - both :])))
        assert got[:2] == (n, m) and both <= got[2] <= min(both + 2 + 0.1 * min(n, m), min(n, m))

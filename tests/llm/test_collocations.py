"""Collocations, languages and sources against plain forms of the same definitions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from crawlframe.llm import collocations, divergence, language_filters
from crawlframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n long, hash long, words string, term string, value long"


def frame(spark, rows):
    """(doc_id, text, lang, source) rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, "w", "t", 3) for r in rows], SCHEMA).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_suffix_collocations", "op13_source_divergence"])
def test_against_sql(spark, name):
    fn, sql = QUERIES[name]
    assert compare(spark, connect(SF), name, fn, sql, SF) is None


def plain_collocations(rows, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        often = {p: n for p, n in own.items() if n >= least}
        inside = Counter()
        for p, n in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], n)
        found = []
        for p, a in often.items():
            if len(p) > 1 and inside[p] < a:
                cuts = [(1000 * a * sizes[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((" ".join(p), a, own[p[:k]], own[p[k:]], sizes[lang], score))
        found.sort(key=lambda f: (-f[5], -f[1], f[0].encode()))
        out += [(lang, i, *f) for i, f in enumerate(found[:top], 1)]
    return sorted(out)


def phrases(seed):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "é", "new", "york", "time\xa0s", "und", "x" * 300, "a\x1cb"]
    texts = []
    for _ in range(120):
        out = []
        for _ in range(rnd.randrange(0, 40)):
            out.append(rnd.choice(["new york times", "the of the of the", "a a a a", rnd.choice(words), rnd.choice(words)]))
        texts.append("".join(w + rnd.choice([" ", " ", " ", "\t", ", ", ".", "\n", " \n ", "  "]) for w in out))
    rows = [(i % 9 or None, t, rnd.choice(["en", "en", "fr", None, "und", ""]), None) for i, t in enumerate(texts)]
    return rows + [(1, None, "en", "s"), (1, "", None, None), (2, texts[0], "en", "s"), (2, texts[0], "en", "s"), (3, ".,;", "leer", "s"), (4, "the " * 3000, "long", "")]


@pytest.mark.parametrize("seed,least,top,budget,chunk", [(1, 3, 2000, 1 << 20, 1 << 20), (2, 2, 7, 40, 400), (3, 5, 2000, 3, 50), (4, 1, 30, 1, 5000)])
def test_collocations(spark, monkeypatch, seed, least, top, budget, chunk):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = phrases(seed)
    monkeypatch.setattr(collocations._chunks, "__defaults__", (chunk,))
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least, top, budget).collect())
    assert got == plain_collocations(rows, least, top)


def test_products_beyond_64_bits():
    # 1000 * a * n of a trillion occurrences each
    assert 1000 * 10**12 * 10**13 > 2**63


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).count() == 0
    assert divergence.source_divergence(empty).count() == 0
    assert language_filters.predict_languages(empty, language_filters.learn_filters(empty, F.lit(True))).count() == 0


def plain_divergence(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= least)
        sources = sorted({s for _, s, _ in own})
        counts = {s: Counter(t for _, x, terms in own if x == s for t in terms if df[t] >= least) for s in sources}
        whole = sum(counts.values(), Counter())

        def share(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def sourced(seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "of", "née", "naïve", "x9y", "日本", "Ω", "o'clock", "a-b"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 25))), rnd.choice(["en", "fr", None, "", "x"]), rnd.choice(["s1", "s2", "é", None, "", "z"])) for i in range(90)]
    rows += [(1, rows[0][1], "en", s) for s in ("s1", "s1", "s2", None)] + [(None, None, "en", "alone"), (None, "12 34", "digits", "a"), (5, "once only", "digits", "b"), (6, "x", "one", "s")]
    return rows + [(7, "é " * 500, "en", "s1")] * 3


@pytest.mark.parametrize("seed,least,top,limit", [(1, 3, 200, 400_000), (2, 1, 2, 5), (3, 4, 5, 60)])
def test_divergence(spark, monkeypatch, seed, least, top, limit):
    monkeypatch.setattr(divergence, "LIMIT", limit)
    rows = sourced(seed)
    got = sorted(tuple(r) for r in divergence.source_divergence(frame(spark, rows), least, top).collect())
    assert got == plain_divergence(rows, least, top)


def test_sums_beyond_64_bits(spark):
    values = [2**62, 2**62, 2**62, -(2**62) + 5, 2**62 + 1, -7, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert int(df.agg(divergence._exact_sum(F.col("v")).alias("s")).first().s) == sum(values)


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_languages_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op12_language_filters"][0](spark, "/root/testdata/sf0.01").collect()
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert {r.doc_id: r.held_out for r in got} == {i: held_out(i) for i in langs}
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


LANGS = {"de": "der die das und nicht ist eine wird auch auf für können", "en": "the and of that this with would have not from they", "ru": "это что как его она они был для мы"}


def test_odd_texts(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices(LANGS[lang].split(), k=30)), lang, "s") for i in range(60) for lang in LANGS]
    rows += [(10_000 + i, " ".join(rnd.choices(LANGS[lang].split(), k=30)), None, None) for i, lang in enumerate(LANGS)]
    odd = [None, "", "12 34 !", "€ — …", "ß", "日本語", "zzqxzzqx", "THE END OF THAT", "x " * 50_000]
    rows += [(20_000 + i, t, None if i % 2 else "und", "s") for i, t in enumerate(odd)] + [(None, "the and of that", "en", "s")] * 2
    df = frame(spark, rows)
    learn = ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)) & (F.coalesce("doc_id", F.lit(0)) < 20_000)
    filters = language_filters.learn_filters(df, learn)
    assert filters.langs == sorted(LANGS)
    got = language_filters.predict_languages(df, filters).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[10_000 + i].lang_pred for i in range(3)] == list(LANGS)
    assert [by_id[20_000 + i].lang_pred for i in range(4)] == ["und"] * 4 and by_id[20_001].score == 0
    assert all(by_id[20_000 + i].lang_pred in LANGS for i in range(4, 9)) and by_id[20_007].lang_pred == "en"
    assert [r.lang_pred for r in got if r.doc_id is None] == ["en", "en"]


@pytest.mark.parametrize("number", [2, 9, 70])
def test_filters_hold_what_was_learned(spark, number):
    """Every n-gram's set of languages has all that hold it, and counts corrected for mistakes come near the true ones."""
    rnd = random.Random(number)
    words = {f"l{i:02}": ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(40)] for i in range(number)}
    rows = [(i, " ".join(w), lang, "s") for i, (lang, w) in enumerate(words.items())]
    filters = language_filters.learn_filters(frame(spark, rows), F.lit(True), rival=1e9)
    assert filters.langs == sorted(words)
    for lang in list(words)[:5]:
        line = language_filters.normal(" ".join(words[lang]).encode())
        for size in language_filters.SIZES:
            codes, inside = language_filters.windows(np.frombuffer(line, np.uint8), np.array([len(line)]), size)
            assert inside.all()
            k = filters.langs.index(lang)
            assert ((filters.members(codes, size)[:, k // filters.width] >> filters.table.dtype.type(k % filters.width)) & filters.table.dtype.type(1)).all()
        best, score = filters.decide([line, b""])
        assert filters.langs[best[0]] == lang and best[1] == -1 and score[1] == 0


def test_windows_stay_within_texts():
    texts = [b" ab ", b"", b" c ", b" defgh "]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    for size in (3, 5):
        codes, inside = language_filters.windows(data, ends, size)
        expected = [int.from_bytes(t[i : i + size], "big") for t in texts for i in range(len(t) - size + 1)]
        assert codes[inside].tolist() == expected

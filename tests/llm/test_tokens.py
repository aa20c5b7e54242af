"""Token ids: pieces against whole texts, bit packing as an exact round trip, packing as a partition of all ids."""

from __future__ import annotations

import random
import time
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlframe.llm.bitpack import bits_for, pack_ids, read_packed, unpack_ids, write_packed
from crawlframe.llm.packing import OpenWindows, pack_documents
from crawlframe.llm.shared import new_path
from crawlframe.llm.tokens import PieceEncoder

FILES = {True: "byte_bpe_50k.json", False: "word_bpe_49k.json"}
SCHEMA = "doc_id long, text string, source string, task int"
TEXTS = [
    "", " ", "\n", "a", "  two  spaces ", "line\nend.\n\nnext\t tab", "It's the user's, they'll go!", "ΟΔΥΣΣΕΥΣ ΣΑΣ İstanbul",
    "é ́x", "<|endoftext|> in <|endoftext|>text", "12.5% of 1,000 EUR wide", "日本語 テスト。", "x" * 3000, "word, word. word; Word! 'tis\r\nend",
]


@pytest.mark.parametrize("byte_level", [True, False])
def test_pieces_equal_whole_texts(byte_level):
    path = public_tokenizers.path(FILES[byte_level])
    whole = Tokenizer.from_file(path)
    encoder = PieceEncoder(path, byte_level)
    alphabet = st.sampled_from(list("abzAZ09 .,'!?\n\t\r\x1c\u0085 éÉßΣσñ́日|<>")) | st.characters(codec="utf-8")

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.text(alphabet, max_size=40), max_size=4))
    def check(texts):
        expected = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
        assert encoder.encode(texts) == expected

    check()
    words = st.text(st.sampled_from("abcdEÉéßñΣσς日́ŉǆ") | st.characters(categories=["L"]), min_size=1, max_size=12)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(words.flatmap(lambda w: st.sampled_from([w, w + ".", w + "'s", "x" + w + ","])), max_size=8))
    def check_words(found):
        text = " ".join(found)
        assert encoder.encode([text]) == [np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]

    check_words()
    expected = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(TEXTS, add_special_tokens=False)]
    assert encoder.encode(TEXTS) == expected


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.randoms())
def test_round_trip(bits, n, rnd):
    ids = np.array([rnd.randrange(1 << bits) for _ in range(n)], np.uint32)
    payload = pack_ids(ids, bits)
    assert len(payload) == -(-n // 64) * bits * 8
    start = rnd.randint(0, n)
    assert unpack_ids(payload, bits, n).tolist() == ids.tolist()
    assert unpack_ids(payload, bits, n, start).tolist() == ids[start:].tolist()


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def rows():
    return [(i * 3 if i else None, t, "s", i) for i, t in enumerate([None, *TEXTS, *TEXTS[:4]])] + [(6, TEXTS[3], "s", 1)]


def test_packed_set(spark):
    path = new_path(spark, "test")
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    tokenizer = public_tokenizers.path(FILES[True])
    write_packed(docs, path, tokenizer, block_ids=50)
    found = sorted(read_packed(spark, path, ids=True).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(tokenizer)
    expected, start = [], 0
    for doc_id, text in sorted(((d, t or "") for d, t, *_ in rows()), key=lambda x: (x[0] is not None, x[0], x[1])):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert [tuple(r) for r in found] == expected


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    path = new_path(spark, "test")
    write_packed(empty, path, public_tokenizers.path(FILES[True]))
    assert read_packed(spark, path).count() == 0
    assert pack_documents(empty, public_tokenizers.path(FILES[False])).count() == 0


def test_windows_are_bounded():
    windows = OpenWindows(64, 3)
    rnd = np.random.default_rng(3)
    fill: dict[int, int] = {}
    for _ in range(500):
        n, at = int(rnd.integers(1, 200)), 0
        for window, start, length, offset in windows.place(0, n):
            assert start == at and offset == fill.get(window, 0) and length > 0
            fill[window], at = offset + length, at + length
        assert at == n and len(windows.fill) <= 3
    assert sum(v < 64 for v in fill.values()) <= 3 and max(fill.values()) == 64


def test_best_fit():
    windows = OpenWindows(10, 3)
    for n in (6, 8, 5):
        list(windows.place(0, n))
    assert windows.fill == {0: 6, 1: 8, 2: 5}
    assert list(windows.place(0, 4)) == [(0, 0, 4, 6)]  # exact fit
    assert list(windows.place(0, 2)) == [(1, 0, 2, 8)]


def check_pieces(spark, docs, **options):
    tokenizer = public_tokenizers.path(FILES[False])
    found = pack_documents(docs, tokenizer, keep_ids=True, **options).collect()
    whole = Tokenizer.from_file(tokenizer)
    ids_of: dict = {}
    for r in docs.collect():
        ids_of.setdefault(r.doc_id, []).append([*whole.encode(r.text or "", add_special_tokens=False).ids, 1])
    got: dict = {}
    windows: dict = {}
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length > 0
        got.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got.keys() == ids_of.keys()
    for doc_id, texts in ids_of.items():
        assert sum(len(i) for _, i, _ in got[doc_id]) == sum(map(len, texts))
        if len(texts) == 1:
            assert [x for _, i, _ in sorted(got[doc_id]) for x in i] == texts[0]
            assert {t for _, _, t in got[doc_id]} == {len(texts[0])}
    sizes = []
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    return sizes


def test_packing(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    sizes = check_pieces(spark, docs, capacity=16, open_windows=2, merge_tasks=2)
    assert max(sizes) == 16 and sum(s < 16 for s in sizes) <= 2 * 2


def test_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    sizes = check_pieces(spark, docs)
    assert sum(sizes) > 0.95 * 2048 * len(sizes)


def test_signs_behind_letters_that_change():
    """Texts that aren't NFC keep their case until the tokenizer; a sign behind such a word goes with it."""
    rnd = random.Random(12)
    pieces = ["é", "é", "İ", "I", "i", "Σ", "σ", "a", "B", "̇", "ß", "ſ", " ", " ", ".", ",", "!", "?", ";", ":", "\n", "x"]
    texts = ["é İ.", "İ!"] + ["".join(rnd.choices(pieces, k=rnd.randrange(1, 9))) for _ in range(30_000)]
    assert any(not unicodedata.is_normalized("NFC", t) for t in texts)
    for name, byte_level in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        whole = Tokenizer.from_file(path)
        expected = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(ids, "<u4").tolist() for ids in PieceEncoder(path, byte_level).encode(texts)]
        assert got == expected


def test_empty_texts_fill_a_block_in_linear_time(spark, tmp_path):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).coalesce(1)
    path = str(tmp_path / "packed")
    began = time.time()
    write_packed(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    assert time.time() - began < 30
    rows = read_packed(spark, path).orderBy("doc_id").collect()
    assert [r.start for r in rows] == list(range(40_000)) and {r.n_tokens for r in rows} == {1}


def test_rows_without_an_id_are_split(spark, tmp_path):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_packed(docs, str(tmp_path / "packed"), public_tokenizers.path("byte_bpe_50k.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(str(tmp_path / "packed/shards")).count() > 1
    rows = read_packed(spark, str(tmp_path / "packed")).collect()
    assert len(rows) == 3000 and len({r.start for r in rows}) == 3000


def test_an_encoder_lives_on_in_its_worker():
    """The second task of a worker finds the vocabulary and the pieces of the first, and gives what a new encoder gives."""
    from crawlframe.llm.tokens import worker_encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["one two", "", "two\nthree  four", "one"]
    first = worker_encoder(path, True)
    got = first.encode(texts)
    again = worker_encoder(path, True)
    assert again is first and again.encode(texts) == got == PieceEncoder(path, True).encode(texts)

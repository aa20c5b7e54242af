"""The pipeline: every stage against plain code over what its predecessor kept, and odd rows through all of it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_pairs import brute_align, brute_components, lower
from test_pairs import WORD as WORDS
from test_text import PERSONAL, plain
from test_tokens import check_pieces

import corpus_pipeline
from crawlframe.llm.shared import store

SF = "/root/testdata/sf0.001"


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def kept(spark):
    """Rows behind each stage but the last, the first entry being the input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out.append(store(stage(spark, out[-1], SF), f"test-{name}"))
        assert out[-1].columns == docs.columns
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(spark, kept):
    docs, good = rows(kept[0]), rows(kept[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(docs[i] == r for i, r in good.items())
    right = [(i in good) == (q == 1) for i, q in labels.items() if i in docs]
    assert sum(right) > 0.95 * len(right)


def test_near_duplicates(kept):
    before, after = rows(kept[1]), rows(kept[2])
    expected = {d for d, _, c in brute_components([(i, r.text) for i, r in before.items()]) if d == c}
    assert set(after) == expected and all(before[i] == r for i, r in after.items())


def test_decontamination(spark, kept):
    before, after = rows(kept[2]), rows(kept[3])
    items = [WORDS.findall(lower(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = set(before) - set(after)
    assert gone and all(before[i] == r for i, r in after.items())
    for i in gone:
        words = WORDS.findall(lower(before[i].text))
        assert max(brute_align(words, w) / (2 * len(w)) for w in items) >= 0.4
    for i, r in after.items():
        text = " ".join(WORDS.findall(lower(r.text)))
        assert not any(" ".join(w) in text for w in items)


def test_personal_data(kept):
    before, after = rows(kept[3]), rows(kept[4])
    assert set(before) == set(after)
    for i, r in before.items():
        found = plain(PERSONAL, r.text)
        new = after[i]
        assert new.n_chars == len(new.text) and (new.lang, new.source) == (r.lang, r.source)
        assert not plain(PERSONAL, new.text)
        if not found and "[FOUND]" not in new.text:
            assert new.text == r.text


def test_packing(spark, kept):
    sizes = check_pieces(spark, kept[4])
    assert sum(sizes) > 0.95 * 2048 * len(sizes)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(rows(kept[4]))


def test_odd_rows(spark, tmp_path):
    odd = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, None, "en", "s", 0), (1, "one two", None, "s", 7), (1, "one two", None, "s", 7),
           (2, "one two", "en", None, 7), (3, "long " * 30_000, "en", "s", 150_000), (4, "mail a@b.cd now", "en", "s", 15)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", odd), ("empty", [])):
        path = str(tmp_path / name)
        spark.createDataFrame(data, schema).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, None, None), (None, 1, 0)][: len(data)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([(None, None), (1, "")][: len(data)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        out = corpus_pipeline.run(spark, path)
        got = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("of")).collect()
        # without labels nothing is rejected; 1 and 2 hold the same words; rows without doc_id or words stay
        assert {r.doc_id for r in got} == ({None, 1, 3, 4} if data else set())
        assert all(r.n >= r.of for r in got)

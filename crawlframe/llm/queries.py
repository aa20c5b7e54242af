"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from crawlframe.llm.shared import new_path


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bitpack_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written bit-packed and read back."""
    from crawlframe.llm.bitpack import read_packed, write_packed

    path = new_path(spark, "packed")
    write_packed(_documents(spark, sf_dir), path, _tokenizer("byte_bpe_50k.json"), byte_level=True, end_id=2)
    return read_packed(spark, path)


def op2_mincut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from crawlframe.llm.mincut_html import extract_main_text

    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five words, 75 per cent."""
    from crawlframe.llm.jaccard_join import jaccard_classes

    return jaccard_classes(_documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document."""
    from crawlframe.llm.decontaminate import leaked_items

    return leaked_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank(s).alias("rank"), s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _span_columns(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the fixed kinds (all but the last), the digest of their spans, and all spans as text."""
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in kinds[:-1]]
    base = _span_text(F.filter(spans, lambda s: s["kind"] != kinds[-1]), kinds)
    return found.select("doc_id", *counts, F.sha2(F.encode(base, "utf-8"), 256).alias("base_sha256"), _span_text(spans, kinds).alias("spans"))


def op4_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, fixed forms and incompressible strings."""
    from crawlframe.llm.secrets_novelty import KINDS, secret_spans

    return _span_columns(secret_spans(_documents(spark, sf_dir)), KINDS)


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document; a fifth of the ids are held out of the model."""
    from crawlframe.llm.ppm import score_documents

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return score_documents(_documents(spark, sf_dir), held_out)


def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, fixed forms and what their contexts discover."""
    from crawlframe.llm.pii_bootstrap import KINDS, personal_spans

    return _span_columns(personal_spans(_documents(spark, sf_dir)), KINDS)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; every hundredth id searches all for its neighbours."""
    from crawlframe.llm.shared import store
    from crawlframe.llm.simhash import edited_fingerprints, near_counts

    prints = store(edited_fingerprints(_documents(spark, sf_dir)), "prints")
    return near_counts(prints, F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False)))


def op8_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of a third of the ids are held out of the fit."""
    from crawlframe.llm.mil_quality import fit_on_labels, quality_scores

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scored = quality_scores(docs, fit_on_labels(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op9_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids."""
    from crawlframe.llm.packing import pack_documents

    return pack_documents(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), byte_level=False, end_id=1)


def op11_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's strongest phrases of two to five words."""
    from crawlframe.llm.collocations import collocations

    return collocations(_documents(spark, sf_dir))


def op12_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of the ids is held out of the filters."""
    from crawlframe.llm.language_filters import learn_filters, predict_languages

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = _documents(spark, sf_dir)
    found = predict_languages(docs, learn_filters(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two sources of each language compared, and what lifts each source above its language."""
    from crawlframe.llm.divergence import source_divergence

    return source_divergence(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


def _sql(module: str) -> str:
    return import_module(f"crawlframe.llm.{module}").ORACLE_SQL


QUERIES = {
    "op1_bitpack_ids": (op1_bitpack_ids, None),
    "op2_mincut_html": (op2_mincut_html, None),
    "op3_grouped_prefix_join": (op3_grouped_prefix_join, None),
    "op4_secret_novelty": (op4_secret_novelty, None),
    "op5_ppm": (op5_ppm, None),
    "op6_pii_bootstrap": (op6_pii_bootstrap, None),
    "op7_simhash": (op7_simhash, None),
    "op8_mil_quality": (op8_mil_quality, None),
    "op10_decontaminate": (op10_decontaminate, None),
    "op9_bounded_space_packing": (op9_bounded_space_packing, None),
    "op11_suffix_collocations": (op11_suffix_collocations, _sql("collocations")),
    "op12_language_filters": (op12_language_filters, None),
    "op13_source_divergence": (op13_source_divergence, _sql("divergence")),
    "pipeline": (pipeline, corpus_pipeline.ORACLE_SQL),
}

"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.llm.decontaminate import without_leaks
from crawlframe.llm.jaccard_join import without_near_duplicates
from crawlframe.llm.mil_quality import fit_on_labels, without_low_quality
from crawlframe.llm.packing import pack_documents
from crawlframe.llm.pii_bootstrap import redact
from crawlframe.llm.shared import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return without_low_quality(docs, fit_on_labels(docs, labels, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one of the least id."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), byte_level=False, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: No stage but the reading of words can be said in SQL; tests/llm/test_pipeline.py holds it against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's result stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Counts over the status table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.metadata import meta_is_true_text, meta_values

DEFAULT_SIZE = 100_000


def aggregate(df: DataFrame, field: str, size: int = DEFAULT_SIZE) -> DataFrame:
    """Rows per value of a field, largest first: ``value, n``. A metadata field counts each of its values."""
    if field.startswith("metadata."):
        values = meta_values(F.col("metadata"), field.removeprefix("metadata."))
        cells = df.select(F.explode(F.array_distinct(values)).alias("value"))
    else:
        cells = df.select(F.col(field).alias("value")).filter(F.col("value").isNotNull())
    return cells.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(size)


def aggregate_status(df: DataFrame, size: int = DEFAULT_SIZE) -> DataFrame:
    return aggregate(df, "status", size)


def aggregate_by(df: DataFrame, field: str, cond: Column | str, size: int = DEFAULT_SIZE) -> DataFrame:
    return aggregate(df.filter(cond), field, size)


def aggregate_by_metadata(df: DataFrame, field: str, meta: str, size: int = DEFAULT_SIZE) -> DataFrame:
    return aggregate_by(df, field, meta_is_true_text(F.col("metadata"), meta), size)


def aggregate_hostname(df: DataFrame, cond: Column | str, size: int = DEFAULT_SIZE) -> DataFrame:
    return aggregate_by(df, "key", cond, size)


def aggregate_hostname_by_status(df: DataFrame, status: str, size: int = DEFAULT_SIZE) -> DataFrame:
    return aggregate_by(df, "key", F.col("status") == status, size)


def index_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def top_hosts(df: DataFrame, size: int = 50) -> DataFrame:
    return aggregate(df, "key", size)

"""Seed lists and fetched records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.functions.metadata import empty_meta
from crawlframe.schemas import FETCHED, META


def _metadata_of(words: Column) -> Column:
    """``key=value`` words as a multimap; a repeated key gathers its values in order."""
    pairs = F.filter(words, lambda w: w.contains("="))
    keys = F.array_distinct(F.transform(pairs, lambda p: F.substring_index(p, "=", 1)))

    def values(key: Column) -> Column:
        mine = F.filter(pairs, lambda p: F.substring_index(p, "=", 1) == key)
        return F.transform(mine, lambda p: F.substring(p, F.length(key) + 2, F.length(p)))

    return F.map_from_arrays(keys, F.transform(keys, values)).cast(META)


def parse_seeds(lines: DataFrame, column: str = "value") -> DataFrame:
    """One URL per line, tab-separated ``key=value`` metadata behind it; blanks and ``#`` lines dropped."""
    line = F.trim(F.col(column))
    words = F.split(line, "\t", -1)
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    meta = F.when(F.size(words) > 1, _metadata_of(rest)).otherwise(empty_meta())
    return lines.filter((line != "") & ~line.startswith("#")).select(
        F.trim(words[0]).alias("url"), F.lit("DISCOVERED").alias("status"), meta.alias("metadata")
    )


def read_seeds(spark: SparkSession, directory: str, pattern: str = "*", stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return parse_seeds(reader.format("text").option("pathGlobFilter", pattern).load(directory))


def read_fetched(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Table or stream of fetched records in the canonical schema."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(FETCHED).parquet(path)


def read_fetched_files(spark: SparkSession, path: str) -> DataFrame:
    """Bodies stored as plain files: url = file path, content = bytes."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("url"), F.col("modificationTime").alias("fetch_time"), "content"
    )

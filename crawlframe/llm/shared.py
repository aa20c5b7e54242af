"""Tables kept in the cluster's shared folder, and small helpers all operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once and read back: later uses neither recompute it nor depend on its executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """``df``, whose session hands at most so many rows at a time to Python: texts are large, tasks have little memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return df


def text_of(column: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def same_partition_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

"""Session helpers: settings for large runs, the clock, and size-checked broadcasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only after an aggregate over it proved both bounds.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def build_session(app: str = "crawlframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # collecting a Python stack for every expression costs more than planning it
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def as_ts(value: Column | str | dt.datetime) -> Column:
    """The explicit clock: a Column, an ISO text (session zone) or a datetime."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value).cast("timestamp")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")

"""Roll-ups of the metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _agg(kind: str) -> Column:
    return {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[kind]("value")


def _bucket(bucket: str) -> Column:
    return F.window("ts", bucket)["start"].alias("bucket")


def metric_histogram(
    metrics: DataFrame, name: str, agg: str = "avg", bucket: str = "1 hour", split_by: str | None = None, k: int = 5
) -> DataFrame:
    """Value per time bucket, or the ``k`` largest members of ``split_by`` in each bucket.

    The data is aggregated before it is ranked: the window sees one row per bucket and member.
    """
    rows = metrics.filter(F.col("name") == name)
    if split_by is None:
        return rows.groupBy(_bucket(bucket)).agg(_agg(agg).alias("value"))
    per_member = rows.groupBy(_bucket(bucket), split_by).agg(_agg(agg).alias("value"))
    nth = F.row_number().over(W.partitionBy("bucket").orderBy(F.desc("value"), split_by))
    return per_member.withColumn("rank", nth).filter(F.col("rank") <= k)


# The dashboard panels as (metric, aggregate, bucket, split, k).
PANELS: dict[str, tuple[str, str, str, str | None, int]] = {
    "active_threads": ("activethreads", "avg", "1 hour", "src_task", 5),
    "queue_count": ("num_queues", "avg", "1 hour", "src_task", 5),
    "pages_fetched": ("fetcher_counter.fetched", "sum", "1 hour", "src_task", 5),
    "urls_in_queues": ("in_queues", "avg", "1 hour", "src_task", 5),
    "bytes_per_second": ("fetcher_average_persec.bytes_fetched_perSec", "avg", "1 hour", None, 5),
    "pages_per_second": ("fetcher_average_persec.fetched_perSec", "avg", "1 hour", None, 5),
    "bytes_total": ("fetcher_counter.bytes_fetched", "sum", "1 minute", None, 5),
}
QUEUE_POPULATION = "__receive.population"
SYSTEM_COMPONENT = "__system"
HEAP_PREFIX = "memory/heap"
PARSE_TIME = "news_sitemap_average_processing_time"


def panel(metrics: DataFrame, name: str, bucket: str | None = None) -> DataFrame:
    metric, agg, default_bucket, split, k = PANELS[name]
    return metric_histogram(metrics, metric, agg, bucket or default_bucket, split, k)


def metric_top_table(
    metrics: DataFrame,
    name: str = QUEUE_POPULATION,
    g1: str = "src_task",
    k1: int = 10,
    g2: str = "src_component",
    k2: int = 5,
) -> DataFrame:
    """The ``k1`` members of ``g1`` with the largest average, and in each the ``k2`` largest of ``g2``."""
    pairs = (
        metrics.filter(F.col("name") == name)
        .groupBy(g1, g2)
        .agg(F.sum("value").alias("s"), F.count("value").alias("c"))
    )
    outer = W.partitionBy(g1)
    scored = pairs.select(
        g1,
        g2,
        (F.sum("s").over(outer) / F.sum("c").over(outer)).alias("avg_1"),
        (F.col("s") / F.col("c")).alias("avg_2"),
        F.row_number().over(outer.orderBy(F.desc(F.col("s") / F.col("c")), g2)).alias("rank_2"),
    ).filter(F.col("rank_2") <= k2)
    first = scored.filter("rank_2 = 1").select(g1, "avg_1").orderBy(F.desc("avg_1"), g1).limit(k1).select(g1)
    return scored.join(F.broadcast(first), g1)


def metric_heap_histogram(
    metrics: DataFrame,
    prefix: str = HEAP_PREFIX,
    bucket: str = "1 hour",
    k_names: int = 10,
    k_hosts: int = 5,
    component: str | None = SYSTEM_COMPONENT,
) -> DataFrame:
    """Per time bucket the largest metric names with the prefix, and in each the largest hosts."""
    rows = metrics.filter(F.col("name").startswith(prefix))
    if component is not None:
        rows = rows.filter(F.col("src_component") == component)
    cells = rows.groupBy(_bucket(bucket), "name", "src_host").agg(F.sum("value").alias("s"), F.count("value").alias("c"))
    # one row per (bucket, name) in the window below: the host level is ranked first, the names after it
    per_name = W.partitionBy("bucket", "name")
    hosts = cells.select(
        "bucket",
        "name",
        "src_host",
        (F.sum("s").over(per_name) / F.sum("c").over(per_name)).alias("name_value"),
        (F.col("s") / F.col("c")).alias("value"),
        F.row_number().over(per_name.orderBy(F.desc(F.col("s") / F.col("c")), "src_host")).alias("host_rank"),
    )
    name_rank = F.dense_rank().over(W.partitionBy("bucket").orderBy(F.desc("name_value"), "name"))
    return hosts.withColumn("name_rank", name_rank).filter(
        (F.col("name_rank") <= k_names) & (F.col("host_rank") <= k_hosts)
    )


def sitemap_parse_time(metrics: DataFrame, name: str = PARSE_TIME) -> DataFrame:
    """Mean sitemap processing time per 30 seconds."""
    return metric_histogram(metrics, name, "avg", "30 seconds")

"""Registered roll-ups of the metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.catalog.fixtures import derived, metrics_table, sql_ts, ts_text, with_ctes
from crawlframe.operators import metrics as ME

D = with_ctes("d_metrics")


def _value(c: str = "value"):
    return F.round(F.col(c), 8).alias(c)


def _panel(name: str, metric: str, agg: str, bucket: str, split: bool, k: int = 5):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = ME.metric_histogram(metrics_table(spark, sf), metric, agg, bucket, "src_task" if split else None, k)
        cols = [ts_text("bucket").alias("bucket"), _value()]
        if split:
            cols += [F.col("src_task").cast("bigint").alias("src_task"), F.col("rank").cast("bigint").alias("rank")]
        return out.select(*cols)

    unit, n = bucket.split(" ")[1].rstrip("s"), int(bucket.split(" ")[0])
    step = {"hour": 3600, "minute": 60, "second": 1, "day": 86400}[unit] * n
    at = f"make_timestamp(CAST(floor(epoch(ts) / {step}) * {step} * 1000000 AS BIGINT))"
    if split:
        sql = f"""{D}, g AS (SELECT {at} AS b, src_task, {agg}(value) AS v FROM d_metrics WHERE name = '{metric}' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY v DESC, src_task) AS rank FROM g)
SELECT {sql_ts('b')} AS bucket, round(v, 8) AS value, CAST(src_task AS BIGINT) AS src_task, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= {k}"""
    else:
        sql = f"{D}, g AS (SELECT {at} AS b, {agg}(value) AS v FROM d_metrics WHERE name = '{metric}' GROUP BY 1) SELECT {sql_ts('b')} AS bucket, round(v, 8) AS value FROM g"
    return {f"metric_{name}": (run, sql)}


def q_top_table(spark: SparkSession, sf: str) -> DataFrame:
    out = ME.metric_top_table(metrics_table(spark, sf), "num_queues", "src_task", 6, "src_component", 5)
    return out.select(
        F.col("src_task").cast("bigint").alias("src_task"), "src_component", _value("avg_1"), _value("avg_2"), F.col("rank_2").cast("bigint").alias("rank_2")
    )


SQL_TOP = f"""{D}, m AS (SELECT * FROM d_metrics WHERE name = 'num_queues'),
o AS (SELECT src_task, avg(value) AS avg_1 FROM m GROUP BY 1 ORDER BY avg_1 DESC, src_task LIMIT 6),
i AS (SELECT src_task, src_component, avg(value) AS avg_2, row_number() OVER (PARTITION BY src_task ORDER BY avg(value) DESC, src_component) AS rank_2 FROM m GROUP BY 1, 2)
SELECT CAST(o.src_task AS BIGINT) AS src_task, src_component, round(avg_1, 8) AS avg_1, round(avg_2, 8) AS avg_2, CAST(rank_2 AS BIGINT) AS rank_2
FROM o JOIN i ON i.src_task = o.src_task WHERE rank_2 <= 5"""


def q_heap(spark: SparkSession, sf: str) -> DataFrame:
    """Heap gauges named after the component: more names than the panel shows."""
    m = metrics_table(spark, sf).withColumns(
        {"name": F.concat(F.lit("memory/heap."), "name", F.lit("."), F.col("src_task").cast("string")), "src_component": F.lit("__system")}
    )
    out = ME.metric_heap_histogram(m, bucket="1 day", k_names=10, k_hosts=2)
    return out.select(
        ts_text("bucket").alias("bucket"), "name", "src_host", _value(), _value("name_value"),
        F.col("name_rank").cast("bigint").alias("name_rank"), F.col("host_rank").cast("bigint").alias("host_rank"),
    )


SQL_HEAP = f"""{D}, m AS (SELECT date_trunc('day', ts) AS b, concat('memory/heap.', name, '.', src_task) AS name, src_host, value FROM d_metrics),
n AS (SELECT b, name, avg(value) AS nv FROM m GROUP BY 1, 2),
nr AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY nv DESC, name) AS name_rank FROM n),
h AS (SELECT b, name, src_host, avg(value) AS v FROM m GROUP BY 1, 2, 3),
hr AS (SELECT *, row_number() OVER (PARTITION BY b, name ORDER BY v DESC, src_host) AS host_rank FROM h)
SELECT {sql_ts('hr.b')} AS bucket, hr.name, src_host, round(v, 8) AS value, round(nv, 8) AS name_value, CAST(name_rank AS BIGINT) AS name_rank, CAST(host_rank AS BIGINT) AS host_rank
FROM hr JOIN nr ON nr.b = hr.b AND nr.name = hr.name WHERE name_rank <= 10 AND host_rank <= 2"""


def q_parse_time(spark: SparkSession, sf: str) -> DataFrame:
    m = derived(spark, sf, "d_metrics").withColumns({"ts": F.col("ts").cast("timestamp"), "name": F.lit(ME.PARSE_TIME)})
    return ME.sitemap_parse_time(m).select(ts_text("bucket").alias("bucket"), _value())


SQL_PARSE_TIME = f"""{D}, g AS (SELECT make_timestamp(CAST(floor(epoch(ts) / 30) * 30000000 AS BIGINT)) AS b, avg(value) AS v FROM d_metrics GROUP BY 1)
SELECT {sql_ts('b')} AS bucket, round(v, 8) AS value FROM g"""


QUERIES: dict[str, tuple] = {
    **_panel("active_threads", "activethreads", "avg", "1 hour", True),
    **_panel("queue_count", "num_queues", "avg", "1 hour", True),
    **_panel("pages_fetched", "fetcher_counter.fetched", "sum", "1 hour", True),
    **_panel("urls_in_queues", "in_queues", "avg", "1 hour", True),
    **_panel("bytes_per_second", "fetcher_counter.bytes_fetched", "avg", "1 hour", False),
    **_panel("pages_per_second", "fetcher_counter.fetched", "avg", "1 hour", False),
    **_panel("bytes_total", "fetcher_counter.bytes_fetched", "sum", "1 minute", False),
    "metric_top_table": (q_top_table, SQL_TOP),
    "metric_heap_histogram": (q_heap, SQL_HEAP),
    "sitemap_parse_time": (q_parse_time, SQL_PARSE_TIME),
}

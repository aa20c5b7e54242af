"""What to hand out next: due URLs per key, recently handed out URLs, politeness slots, WARC files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlframe.session import as_ts

Clock = Column | str | dt.datetime


def due_urls(status: DataFrame, now: Clock, per_bucket: int = 5, max_buckets: int = 200) -> DataFrame:
    """The ``per_bucket`` earliest due URLs of the ``max_buckets`` keys that are due first.

    The rank filter is pushed below the shuffle (at most ``per_bucket`` rows per key leave a task, so
    a hot key costs nothing), the per-key list reuses that partitioning, and the key limit is a top-k.
    """
    due = status.select("url", "key", "next_fetch").filter(F.col("next_fetch") <= as_ts(now))
    nth = F.row_number().over(W.partitionBy("key").orderBy("next_fetch", "url"))
    top = due.withColumn("rank", nth).filter(F.col("rank") <= per_bucket)
    buckets = (
        top.groupBy("key")
        .agg(F.min("next_fetch").alias("first"), F.collect_list(F.struct("url", "next_fetch", "rank")).alias("rows"))
        .orderBy("first", "key")
        .limit(max_buckets)
    )
    return buckets.select("key", F.inline("rows"))


def purgatory_filter(due: DataFrame, inflight: DataFrame, now: Clock, ttl_seconds: int = 1200) -> DataFrame:
    """Drop URLs handed out less than ``ttl_seconds`` ago."""
    recent = inflight.filter(F.col("emitted_at") > as_ts(now) - F.make_dt_interval(secs=F.lit(ttl_seconds))).select("url")
    return due.join(recent, "url", "left_anti")


def politeness_plan(
    due: DataFrame,
    now: Clock,
    robots_delays: DataFrame | None = None,
    server_delay: float = 9.0,
    max_delay: float = 120.0,
    per_queue: int = 10,
    max_total: int = 6000,
) -> DataFrame:
    """Slot of each due URL in its key's queue: ``url, key, position, delay, slot, over_cap``.

    ``robots_delays`` has ``key, crawl_delay``. A shorter robots delay never lowers the server delay; a
    longer one than ``max_delay`` flags the row.
    """
    nth = F.row_number().over(W.partitionBy("key").orderBy("next_fetch", "url"))
    queued = due.select("url", "key", "next_fetch").withColumn("rank", nth).filter(F.col("rank") <= per_queue)
    if robots_delays is not None:
        per_key = robots_delays.groupBy("key").agg(F.max("crawl_delay").alias("crawl_delay"))
        queued = queued.join(per_key, "key", "left")
    else:
        queued = queued.withColumn("crawl_delay", F.lit(None).cast("double"))
    top = queued.orderBy("rank", "next_fetch", "url").limit(max_total)
    delay = F.greatest(F.lit(server_delay), F.coalesce("crawl_delay", F.lit(0.0)))
    position = F.col("rank") - 1
    return top.select(
        "url",
        "key",
        position.alias("position"),
        delay.alias("delay"),
        (as_ts(now) + F.make_dt_interval(secs=(position * delay).cast("decimal(18,6)"))).alias("slot"),
        (delay > max_delay).alias("over_cap"),
    )


def warc_file_assign(
    records: DataFrame,
    max_mb: int = 1023,
    max_minutes: int = 1440,
    writer: str = "writer",
    ts: str = "fetch_time",
    size: str = "size",
    order: str = "url",
) -> DataFrame:
    """Add ``file_no``: a new file per ``max_mb`` of running size and per ``max_minutes`` of age.

    Only sizes and times go through the window; join the bodies back on the file number. Writers are
    a spread chosen by the caller, so their number grows with the data.
    """
    running = W.partitionBy(writer).orderBy(ts, order).rowsBetween(W.unboundedPreceding, 0)
    before = F.sum(size).over(running) - F.col(size)
    age = (F.unix_seconds(ts) - F.min(F.unix_seconds(ts)).over(running)) / F.lit(60 * max_minutes)
    staged = records.withColumns(
        {"_s": F.floor(before / F.lit(max_mb * 1024 * 1024)), "_a": F.floor(age)}
    )
    # both quotients only grow along the order, so their sum numbers the files
    return staged.withColumn("file_no", (F.col("_s") + F.col("_a")).cast("bigint")).drop("_s", "_a")


def newest_excluded(files: DataFrame, name: str = "name") -> DataFrame:
    """All files but the last by name: the newest may still be written to."""
    newest = files.agg(F.max(name)).scalar()
    return files.filter(F.col(name) < newest)


def warc_publish_manifest(files: DataFrame, target: str, prefix: str, name: str = "name") -> DataFrame:
    """Finished files with their target ``target/YYYY/MM/file``; the date is cut from the name."""
    mine = files.filter(F.col(name).startswith(f"{prefix}-") & F.col(name).endswith(".warc.gz"))
    date = F.regexp_extract(F.expr(f"substring({name}, {len(prefix) + 2})"), "^([^-]*)-", 1)
    parts = [F.lit(target.rstrip("/")), F.substring(date, 1, 4), F.substring(date, 5, 2), F.col(name)]
    return newest_excluded(mine, name).withColumn("target", F.concat_ws("/", *parts))

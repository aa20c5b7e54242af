"""Status updates: union, collapse, upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.metadata import empty_meta, persist_metadata
from crawlframe.functions.urls import url_id
from crawlframe.schemas import ERROR_COUNT, PERSISTED_KEYS

#: Persisted keys, the count of failures, and the tracking keys links carry.
STORED_KEYS = (*PERSISTED_KEYS, ERROR_COUNT, "url.path", "depth")


def union_status(*dfs: DataFrame) -> DataFrame:
    """Merge status streams; a column only some of them have is NULL in the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_discovered(updates: DataFrame) -> DataFrame:
    """One row per url, the same one whatever the partitioning."""
    rest = [c for c in updates.columns if c != "url"]
    order = F.to_json(F.struct(*rest))
    picked = updates.groupBy("url").agg(F.min_by(F.struct(*rest), order).alias("r"))
    return picked.select("url", *[F.col(f"r.{c}").alias(c) for c in rest]).select(*updates.columns)


def split_branches(df: DataFrame, column: str, values: list[str]) -> dict[str, DataFrame]:
    """One output per branch value."""
    return {v: df.filter(F.col(column) == v) for v in values}


def _rank(batch: Column, time: Column) -> Column:
    """The update that wins for a url: any fetch result before a discovery; the last result, the first discovery.

    Of results of one moment the one that is due latest wins, never due counts least.
    """
    result = F.col("status") != "DISCOVERED"
    t = F.coalesce(F.unix_micros(time), F.lit(0))
    return F.struct(
        result.alias("result"),
        F.when(result, batch).otherwise(-batch).alias("batch"),
        F.when(result, t).otherwise(-t).alias("time"),
        F.coalesce(F.unix_micros("next_fetch"), F.lit(0)).alias("next"),
        F.col("status"),
        F.xxhash64(F.col("key"), F.map_entries("metadata")).alias("tie"),
    )


def collapse_updates(updates: DataFrame, batch_col: str | None = None) -> DataFrame:
    """At most one update per url: ``url, key, status, next_fetch, metadata``.

    A plain aggregate, so copies of a url shrink to one row per task before the shuffle.
    """
    batch = F.col(batch_col).cast("bigint") if batch_col else F.lit(0).cast("bigint")
    time = F.col("event_time") if "event_time" in updates.columns else F.lit(None).cast("timestamp")
    row = F.struct("key", "status", "next_fetch", "metadata")
    picked = updates.groupBy("url").agg(F.max_by(row, _rank(batch, time)).alias("r"))
    return picked.select("url", "r.key", "r.status", "r.next_fetch", "r.metadata")


def _new_rows(updates: DataFrame, batch_col: str | None) -> DataFrame:
    return collapse_updates(updates, batch_col).select(
        F.col("url").alias("u_url"),
        F.col("key").alias("u_key"),
        F.col("status").alias("u_status"),
        F.col("next_fetch").alias("u_next"),
        persist_metadata(F.col("metadata"), STORED_KEYS).alias("u_meta"),
    )


def _merged(joined: DataFrame, url: Column) -> DataFrame:
    """The row an update leaves of each (old, new) pair."""
    absent = F.col("url").isNull()
    take = F.col("u_url").isNotNull() & (absent | (F.col("u_status") != "DISCOVERED"))
    return joined.select(
        url.alias("url"),
        F.coalesce(F.col("url_id"), url_id(url)).alias("url_id"),
        F.coalesce(F.col("key"), F.col("u_key")).alias("key"),
        F.when(take, F.col("u_status")).otherwise(F.col("status")).alias("status"),
        F.when(take, F.col("u_next")).otherwise(F.col("next_fetch")).alias("next_fetch"),
        F.when(take, F.coalesce("u_meta", empty_meta())).otherwise(F.col("metadata")).alias("metadata"),
    )


def touched_rows(current: DataFrame, updates: DataFrame, batch_col: str | None = None) -> DataFrame:
    """The rows of the urls that have updates, after the upsert. A condition on the url reaches both scans."""
    new = _new_rows(updates, batch_col)
    return _merged(new.join(current, F.col("url") == F.col("u_url"), "left"), F.col("u_url"))


def status_upsert(current: DataFrame, updates: DataFrame, batch_col: str | None = None) -> DataFrame:
    """DISCOVERED only inserts; every other status replaces status, next_fetch and metadata of its url.

    One full outer join on url. A ``current`` that is bucketed by url (see ``sources.tables``) stays
    where it is and only the updates are shuffled.
    """
    joined = current.join(_new_rows(updates, batch_col), F.col("url") == F.col("u_url"), "full_outer")
    return _merged(joined, F.coalesce("url", "u_url"))


def signature_change(fetched: DataFrame, status: DataFrame) -> DataFrame:
    """Compare the body's signature with the stored one: ``url, signature, signature_old, changed``."""
    from crawlframe.functions.metadata import meta_first

    new = fetched.select("url", F.md5("content").alias("signature"))
    old = status.select("url", meta_first(F.col("metadata"), "signature").alias("signature_old"))
    return new.join(old, "url", "left").withColumn(
        "changed", ~F.col("signature").eqNullSafe(F.col("signature_old"))
    )

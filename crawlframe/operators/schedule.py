"""When to visit next: fixed and adaptive intervals, retirement of dead sitemaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.functions.dates import iso_instant, parse_instant, plus_minutes
from crawlframe.functions.metadata import meta_first, meta_true, meta_update, outlink_metadata
from crawlframe.functions.stage import compute_once
from crawlframe.schemas import (
    FETCH_INTERVAL,
    FETCH_INTERVALS,
    IS_FEED,
    IS_INDEX,
    IS_NEWS,
    IS_SITEMAP,
    IS_VERIFIED,
    LAST_MODIFIED,
    NUM_LINKS,
    SIGNATURE,
    SIGNATURE_CHANGE,
    SIGNATURE_OLD,
    SITEMAP_FLAGS,
    STATUSES,
)
from crawlframe.session import as_ts

Clock = Column | str | dt.datetime

# Revisit intervals in minutes, first match wins; -1 means never.
INTERVAL_RULES: tuple[tuple[str, str, int], ...] = (
    ("FETCH_ERROR", IS_FEED, 4320),
    ("FETCH_ERROR", IS_NEWS, 4320),
    ("FETCH_ERROR", IS_INDEX, 4320),
    ("ERROR", IS_FEED, 86400),
    ("ERROR", IS_NEWS, 86400),
    ("ERROR", IS_INDEX, 86400),
    ("REDIRECTION", IS_FEED, 20160),
    ("REDIRECTION", IS_NEWS, 20160),
    ("REDIRECTION", IS_INDEX, 20160),
    ("FETCHED", IS_FEED, 720),
    ("FETCHED", IS_NEWS, 1440),
    ("FETCHED", IS_VERIFIED, 1440),
    ("FETCHED", IS_INDEX, 10080),
    ("FETCHED", IS_SITEMAP, 259200),
    ("REDIRECTION", IS_SITEMAP, 259200),
    ("FETCH_ERROR", IS_SITEMAP, 259200),
    ("ERROR", IS_SITEMAP, 259200),
    ("DISCOVERED", IS_FEED, 0),
    ("DISCOVERED", IS_NEWS, 0),
    ("DISCOVERED", IS_INDEX, 0),
    ("DISCOVERED", IS_SITEMAP, 300),
)
DEFAULT_MINUTES: Mapping[str, int] = {
    "FETCHED": -1,
    "REDIRECTION": -1,
    "FETCH_ERROR": 2880,
    "ERROR": -1,
    "DISCOVERED": 0,
}
STALE_MINUTES = 180 * 24 * 60
ADAPTIVE_MIN, ADAPTIVE_MAX, ADAPTIVE_INC, ADAPTIVE_DEC = 90, 129600, 0.5, 0.2
MAX_FETCH_ERRORS = 3


def default_intervals(spark: SparkSession) -> DataFrame:
    rows = [(i, status, key, "true", minutes) for i, (status, key, minutes) in enumerate(INTERVAL_RULES)]
    return spark.createDataFrame(rows, FETCH_INTERVALS)


def classify_fetch(http_status: Column, error_count: Column | None = None, max_errors: int = MAX_FETCH_ERRORS) -> Column:
    """Status of a finished fetch; 304 counts as success, the ``max_errors``-th transient error in a row is ERROR.

    ``error_count`` counts the failures in a row, this one included.
    """
    tries = F.lit(0) if error_count is None else F.coalesce(error_count, F.lit(0))
    return (
        F.when(http_status.isin(200, 304), "FETCHED")
        .when(http_status.isin(301, 302, 303, 307, 308), "REDIRECTION")
        .when(http_status.isin(404, 410), "ERROR")
        .when(tries >= max_errors, "ERROR")
        .otherwise("FETCH_ERROR")
    )


def redirect_updates(fetched: DataFrame, transfer: Sequence[str] = ()) -> DataFrame:
    """A redirecting row becomes REDIRECTION, its target a DISCOVERED row. Needs ``_redirTo`` in the metadata.

    The target gets the path and what ``transfer`` names, nothing else.
    """
    target = meta_first(F.col("metadata"), "_redirTo")
    source_row = F.struct(F.col("url").alias("url"), F.lit("REDIRECTION").alias("status"), F.col("metadata").alias("metadata"))
    target_row = F.struct(
        target.alias("url"),
        F.lit("DISCOVERED").alias("status"),
        outlink_metadata(F.col("url"), F.col("metadata"), transfer=transfer).alias("metadata"),
    )
    rows = F.when(target.isNotNull() & (target != F.col("url")), F.array(source_row, target_row)).otherwise(F.array(source_row))
    return fetched.select(F.inline(rows))


def assign_interval(
    rows: DataFrame, fetch_intervals: DataFrame, defaults: Mapping[str, int] = DEFAULT_MINUTES
) -> DataFrame:
    """Add ``minutes``: the first rule whose status and flag match, else the default of the status.

    The rule table is folded to one row per status, so the broadcast holds at most five rows.
    """
    every = F.array(*[F.lit(s) for s in STATUSES])
    per_status = (
        fetch_intervals.withColumn("status", F.explode(F.when(F.col("status").isNull(), every).otherwise(F.array("status"))))
        .filter(F.col("status").isin(*STATUSES))
        .groupBy(F.col("status").alias("_status"))
        .agg(F.array_sort(F.collect_list(F.struct("seq", "meta_key", "meta_value", "minutes"))).alias("_rules"))
    )
    joined = rows.join(F.broadcast(per_status), F.col("status") == F.col("_status"), "left")
    matching = F.filter(
        "_rules",
        lambda r: F.coalesce(
            F.lower(F.get(F.try_element_at(F.col("metadata"), r["meta_key"]), F.lit(0))) == r["meta_value"], F.lit(False)
        ),
    )
    default = F.lit(None).cast("int")
    for status, minutes in defaults.items():
        default = F.when(F.col("status") == status, F.lit(minutes)).otherwise(default)
    return joined.withColumn("minutes", F.coalesce(F.get(matching, F.lit(0))["minutes"], default)).drop("_status", "_rules")


def _at(now: Clock, minutes: Column) -> Column:
    return F.when(minutes >= 0, plus_minutes(as_ts(now), minutes))


def next_fetch_default(
    rows: DataFrame, now: Clock, fetch_intervals: DataFrame, defaults: Mapping[str, int] = DEFAULT_MINUTES
) -> DataFrame:
    """Set ``next_fetch`` by fixed intervals; NULL = never again."""
    out = assign_interval(rows, fetch_intervals, defaults)
    return out.withColumn("next_fetch", _at(now, F.col("minutes"))).drop("minutes")


def next_fetch_adaptive(
    rows: DataFrame,
    now: Clock,
    fetch_intervals: DataFrame,
    defaults: Mapping[str, int] = DEFAULT_MINUTES,
    min_minutes: int = ADAPTIVE_MIN,
    max_minutes: int = ADAPTIVE_MAX,
    inc: float = ADAPTIVE_INC,
    dec: float = ADAPTIVE_DEC,
) -> DataFrame:
    """Set ``next_fetch`` by how often the content changes; anything but FETCHED goes by fixed intervals.

    Expects the new ``signature`` and the previous ``signatureOld`` in the metadata.
    """
    now = as_ts(now)
    out = assign_interval(rows, fetch_intervals, defaults)
    meta = F.col("metadata")
    new, old = meta_first(meta, SIGNATURE), meta_first(meta, SIGNATURE_OLD)
    first_seen = old.isNull() | meta_first(meta, SIGNATURE_CHANGE).isNull()
    changed = old.isNotNull() & ~new.eqNullSafe(old)
    previous = F.coalesce(meta_first(meta, FETCH_INTERVAL).try_cast("int"), F.col("minutes"))
    factor = F.when(old.isNull(), F.lit(1.0)).when(changed, F.lit(1.0 - dec)).otherwise(F.lit(1.0 + inc))
    grown = F.floor(F.round(previous * factor, 6)).cast("int")
    adaptive = F.greatest(F.lit(min_minutes), F.least(F.lit(max_minutes), grown))
    applies = (F.col("status") == "FETCHED") & (previous >= 0)
    staged = compute_once(out, "_adaptive", F.when(applies, adaptive))
    stamp = F.when(F.col("_adaptive").isNotNull() & (changed | first_seen), iso_instant(now))
    return staged.withColumns(
        {
            "next_fetch": F.when(F.col("_adaptive").isNotNull(), plus_minutes(now, F.col("_adaptive"))).otherwise(
                _at(now, F.col("minutes"))
            ),
            # most rows are articles and failures, whose metadata stays as it is
            "metadata": F.when(
                F.col("_adaptive").isNotNull(),
                meta_update(
                    meta, {SIGNATURE_CHANGE: stamp, LAST_MODIFIED: stamp, FETCH_INTERVAL: F.col("_adaptive").cast("string")}
                ),
            ).otherwise(meta),
        }
    ).drop("_adaptive", "minutes")


def is_dead_sitemap(status: Column, metadata: Column, now: Clock, stale_minutes: int = STALE_MINUTES) -> Column:
    """A fetched sitemap that has not changed for long and gave no recent link on its last parse."""
    flagged = meta_true(metadata, SITEMAP_FLAGS[0])
    for flag in SITEMAP_FLAGS[1:]:
        flagged = flagged | meta_true(metadata, flag)
    changed = parse_instant(meta_first(metadata, SIGNATURE_CHANGE))
    stale = changed < as_ts(now) - F.make_dt_interval(mins=F.lit(stale_minutes))
    no_news = meta_first(metadata, NUM_LINKS) == "0"
    return F.coalesce((status == "FETCHED") & flagged & stale & no_news, F.lit(False))


def next_fetch_news(
    rows: DataFrame, now: Clock, fetch_intervals: DataFrame, stale_minutes: int = STALE_MINUTES, **adaptive
) -> DataFrame:
    """Dead sitemaps are never fetched again, everything else goes by the adaptive rule."""
    flagged = rows.withColumn("_dead", is_dead_sitemap(F.col("status"), F.col("metadata"), now, stale_minutes))
    out = next_fetch_adaptive(flagged, now, fetch_intervals, **adaptive)
    return out.withColumn("next_fetch", F.when(~F.col("_dead"), F.col("next_fetch"))).drop("_dead")


def sitemap_delay(rows: DataFrame, delay_col: str = "delay") -> DataFrame:
    """Push the first visit of a discovered sub-sitemap back by its delay."""
    delay = F.coalesce(F.col(delay_col), F.lit(0))
    discovered = F.col("status") == "DISCOVERED"
    return rows.withColumn(
        "next_fetch", F.when(discovered, plus_minutes(F.col("next_fetch"), delay)).otherwise(F.col("next_fetch"))
    )

"""Queries and bulk updates of the status table. All are ``DataFrame -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.dates import status_ts
from crawlframe.functions.metadata import meta_is_true_text, meta_of, meta_set, meta_set_values, meta_values
from crawlframe.functions.urls import url_id
from crawlframe.session import as_ts

Clock = Column | str | dt.datetime
Condition = Column | str


def _cond(cond: Condition) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond


def field_equals(df: DataFrame, field: str, value: str) -> Column:
    """Exact match of a field; a metadata field (``metadata.x``) matches when any of its values does."""
    if field.startswith("metadata."):
        key = field.removeprefix("metadata.")
        return F.coalesce(F.array_contains(meta_values(F.col("metadata"), key), value), F.lit(False))
    return F.col(field) == value


def page(df: DataFrame, page: int = 0, size: int = 1000) -> DataFrame:
    """One page in url order."""
    return df.orderBy("url").offset(page * size).limit(size)


def list_rows(df: DataFrame, size: int = 10) -> DataFrame:
    return df.orderBy("url").limit(size)


def _run(df: DataFrame, mode: str, page_no: int, size: int | None) -> DataFrame:
    if mode == "count":
        return df.agg(F.count("*").alias("n"))
    if mode != "search":
        raise ValueError(f"unknown mode {mode!r}")
    return df if size is None else page(df, page_no, size)


def query(df: DataFrame, mode: str, cond: Condition, page: int = 0, size: int | None = 1000) -> DataFrame:
    """``search`` gives a page of rows, ``count`` their number; ``size=None`` gives all rows."""
    return _run(df.filter(_cond(cond)), mode, page, size)


def query_routed(
    df: DataFrame, mode: str, key: str, cond: Condition, page: int = 0, size: int | None = 1000
) -> DataFrame:
    """The same within one key; the key predicate reaches the scan."""
    return _run(df.filter((F.col("key") == key) & _cond(cond)), mode, page, size)


def match_field(df: DataFrame, mode: str, field: str, value: str, page: int = 0, size: int | None = 1000) -> DataFrame:
    return _run(df.filter(field_equals(df, field, value)), mode, page, size)


def match(df: DataFrame, mode: str, cond: Mapping[str, str], page: int = 0, size: int | None = 1000) -> DataFrame:
    """Exact match given as ``{field: value}``."""
    ((field, value),) = cond.items()
    return match_field(df, mode, field, value, page, size)


def lookup_url(df: DataFrame, url: str) -> DataFrame:
    return df.filter(F.col("url") == url)


def lookup_id(df: DataFrame, id: str, key: str) -> DataFrame:
    return df.filter((F.col("key") == key) & (F.col("url_id") == id))


def match_by_metadata(
    df: DataFrame, mode: str, field: str, value: str, meta: str, page: int = 0, size: int | None = 1000
) -> DataFrame:
    cond = field_equals(df, field, value) & meta_is_true_text(F.col("metadata"), meta)
    return _run(df.filter(cond), mode, page, size)


def next_fetch(df: DataFrame, mode: str, now: Clock, page: int = 0, size: int | None = 1000) -> DataFrame:
    """Rows due strictly before ``now``."""
    return _run(df.filter(F.col("next_fetch") < as_ts(now)), mode, page, size)


def next_fetch_for_date(
    df: DataFrame, mode: str, date: str, now: Clock, page: int = 0, size: int | None = 1000
) -> DataFrame:
    return _run(df.filter(F.col("next_fetch") < status_ts(F.lit(date), now)), mode, page, size)


def next_fetch_for_date_and_host(
    df: DataFrame, mode: str, date: str, key: str, now: Clock, page: int = 0, size: int | None = 1000
) -> DataFrame:
    cond = (F.col("key") == key) & (F.col("next_fetch") < status_ts(F.lit(date), now))
    return _run(df.filter(cond), mode, page, size)


def failed_condition(meta: str) -> Column:
    return meta_is_true_text(F.col("metadata"), meta) & (F.col("status") != "FETCHED")


def failed_by_metadata(df: DataFrame, mode: str, meta: str, page: int = 0, size: int | None = 1000) -> DataFrame:
    """Flagged rows whose status is anything but FETCHED."""
    return _run(df.filter(failed_condition(meta)), mode, page, size)


def status_by_metadata(
    df: DataFrame, mode: str, status: str, meta: str, page: int = 0, size: int | None = 1000
) -> DataFrame:
    return match_by_metadata(df, mode, "status", status, meta, page, size)


# --- updates ----------------------------------------------------------------------------------


def update_by_query(df: DataFrame, assignments: Mapping[str, Column], cond: Condition) -> DataFrame:
    """Assign columns on the rows that match, leave the others as they are."""
    hit = F.coalesce(_cond(cond), F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def inject_url(df: DataFrame, url: str, key: str, now: Clock, **meta: str) -> DataFrame:
    """Add a DISCOVERED row due now, unless the url is already there."""
    row = df.sparkSession.range(1).select(
        F.lit(url).alias("url"),
        url_id(F.lit(url)).alias("url_id"),
        F.lit(key).alias("key"),
        F.lit("DISCOVERED").alias("status"),
        as_ts(now).alias("next_fetch"),
        meta_of(**meta).alias("metadata"),
    )
    # the look-up is a filtered scan, not a join of the table
    known = df.filter(F.col("url") == url).agg(F.count("*")).scalar()
    return df.unionByName(row.filter(known == 0), allowMissingColumns=True)


def _keep_unless(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(~F.coalesce(cond, F.lit(False)))


def delete_url(df: DataFrame, url: str) -> DataFrame:
    return _keep_unless(df, F.col("url") == url)


def delete_id(df: DataFrame, id: str, key: str) -> DataFrame:
    return _keep_unless(df, (F.col("key") == key) & (F.col("url_id") == id))


def delete_url_with_routing(df: DataFrame, url: str, key: str) -> DataFrame:
    return _keep_unless(df, (F.col("key") == key) & (F.col("url") == url))


# Metadata a reset empties.
RESET_KEYS = ("signatureChangeDate", "error%2Esource", "last-modified")


def reset_by_query(df: DataFrame, mode: str, cond: Condition, now: Clock) -> DataFrame:
    """``reset`` makes the matching rows DISCOVERED and due now; ``search`` / ``count`` show them first."""
    if mode != "reset":
        return query(df, mode, cond)
    none = F.array().cast("array<string>")
    meta = F.col("metadata")
    for key in RESET_KEYS:
        meta = meta_set_values(meta, key, none)
    return update_by_query(df, {"status": F.lit("DISCOVERED"), "next_fetch": as_ts(now), "metadata": meta}, cond)


def reset_url(df: DataFrame, url: str, now: Clock) -> DataFrame:
    return reset_by_query(df, "reset", F.col("url") == url, now)


def reset_failed_by_metadata(df: DataFrame, mode: str, meta: str, now: Clock) -> DataFrame:
    return reset_by_query(df, mode, failed_condition(meta), now)


def fetch_at_url(df: DataFrame, url: str, date: str, now: Clock) -> DataFrame:
    return update_by_query(df, {"next_fetch": status_ts(F.lit(date), now)}, F.col("url") == url)


def fetch_now_url(df: DataFrame, url: str, now: Clock) -> DataFrame:
    return update_by_query(df, {"next_fetch": as_ts(now)}, F.col("url") == url)


def fetch_at(df: DataFrame, mode: str, date: str, field: str, value: str, meta: str, now: Clock) -> DataFrame:
    """``update`` sets the next fetch of rows matching a field and a flag; ``search`` / ``count`` show them."""
    cond = field_equals(df, field, value) & meta_is_true_text(F.col("metadata"), meta)
    if mode != "update":
        return query(df, mode, cond)
    return update_by_query(df, {"next_fetch": status_ts(F.lit(date), now)}, cond)


def set_metadata_url(df: DataFrame, url: str, key: str, value: str) -> DataFrame:
    return update_by_query(df, {"metadata": meta_set(F.col("metadata"), key, value)}, F.col("url") == url)

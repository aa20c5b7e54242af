"""Lenient date parsing and the recency window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.session import as_ts

# Date shapes beyond what a plain cast understands.
_W3C_MINUTES = "yyyy-MM-dd'T'HH:mmXXX"
_RFC822_SHAPES = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z")


def parse_date_lenient(text: Column) -> Column:
    """W3C dates (year to fraction of a second) and RFC 822 dates; NULL for anything else."""
    text = F.trim(text)
    no_weekday = F.regexp_replace(text, r"^[A-Za-z]{3,9},?\s+", "")
    shaped = [F.try_to_timestamp(no_weekday, F.lit(shape)) for shape in _RFC822_SHAPES]
    is_w3c = text.rlike(r"^[0-9]{4}(?:$|-)")
    return F.when(
        is_w3c, F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit(_W3C_MINUTES)))
    ).otherwise(F.coalesce(*shaped))


def parse_instant(text: Column) -> Column:
    """A full ISO instant (date, time with seconds, zone); NULL for anything else."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$"
    return F.when(text.rlike(shape), F.upper(text).try_cast("timestamp"))


def iso_instant(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def hours_before(now: Column | str | dt.datetime, hours: int) -> Column:
    return as_ts(now) - F.make_dt_interval(hours=F.lit(hours))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes)


def recently_modified(ts: Column, now: Column | str | dt.datetime, hours: int) -> Column:
    """False only for a known date before the window; the window edge itself is kept."""
    if hours == -1:
        return F.lit(True)
    return F.coalesce(ts >= hours_before(now, hours), F.lit(True))


def status_ts(text: Column, now: Column | str | dt.datetime) -> Column:
    """Point in time meant by a date text; relative words count from ``now``."""
    now = as_ts(now)
    word = F.lower(F.trim(text))
    count = F.regexp_extract(word, r"^([+-]?[0-9]+)\s*(day|hour|minute|week)s?(\s+ago)?$", 1)
    unit = F.regexp_extract(word, r"^([+-]?[0-9]+)\s*(day|hour|minute|week)s?(\s+ago)?$", 2)
    sign = F.when(word.endswith("ago"), -1).otherwise(1)
    per_unit = (
        F.when(unit == "week", 7 * 24 * 60).when(unit == "day", 24 * 60).when(unit == "hour", 60).when(unit == "minute", 1)
    )
    minutes = (sign * count.try_cast("int") * per_unit).cast("int")
    return (
        F.when(word.isin("now", "today"), now)
        .when(word == "tomorrow", plus_minutes(now, F.lit(24 * 60)))
        .when(word == "yesterday", plus_minutes(now, F.lit(-24 * 60)))
        .when(unit != "", plus_minutes(now, minutes))
        .otherwise(parse_date_lenient(text))
    )


def status_date(text: Column, now: Column | str | dt.datetime) -> Column:
    """The store's date text: UTC, whole seconds, literal ``.000Z``."""
    utc = F.to_utc_timestamp(status_ts(text, now), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'.000Z'")

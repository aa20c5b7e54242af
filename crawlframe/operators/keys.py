"""Registered domains from a public-suffix table, and the routing key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.stage import with_parts
from crawlframe.functions.urls import label_count, last_labels
from crawlframe.operators.spread import spread_join
from crawlframe.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS


def domain_join(
    urls: DataFrame,
    suffixes: DataFrame,
    host_col: str = "host",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Add ``suffix`` and ``domain`` (suffix plus one label) for each host.

    One look-up per label count found in the suffix table; the table is broadcast when its measured
    size is within both bounds, so the rows of ``urls`` stay where they are. Otherwise each distinct host is resolved
    once, through joins that deal out the hosts of frequent last labels, and comes back through one that deals out the rows
    of frequent hosts.
    """
    # the levels are a handful at any size of the table
    prof = suffixes.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("suffix") + 32), F.lit(0)).alias("b"),
        F.array_sort(F.collect_set(label_count(F.col("suffix")))).alias("levels"),
    ).first()
    by_suffix = suffixes.groupBy("suffix").agg(F.collect_set("kind").alias("kinds"))
    if prof["n"] <= max_rows and prof["b"] <= max_bytes:
        return _resolved(urls, by_suffix, prof["levels"], host_col, True)
    hosts = urls.select(F.lower(F.col(host_col)).alias("_host_key")).filter("_host_key is not null").distinct()
    known = _resolved(hosts, by_suffix, prof["levels"], "_host_key", False)
    # rows without a host are spread over keys that find nothing
    tie = F.xxhash64(*[c for c, t in urls.dtypes if not t.startswith(("map", "array", "struct"))])
    nowhere = F.concat(F.lit("\x01"), F.pmod(tie, F.lit(1 << 20)).cast("string"))
    staged = urls.withColumns({"_tie": tie, "_host_key": F.coalesce(F.lower(F.col(host_col)), nowhere)})
    return spread_join(staged, known, ["_host_key"], "_tie").drop("_host_key", "_tie").select(*urls.columns, "suffix", "domain")


def _resolved(urls: DataFrame, by_suffix: DataFrame, levels: list[int], host_col: str, small: bool) -> DataFrame:
    host = F.lower(F.col(host_col))
    out = urls
    names = []
    for level in levels:
        mine = by_suffix.filter(label_count(F.col("suffix")) == level)
        side = mine.select(F.col("suffix").alias(f"_s{level}"), F.col("kinds").alias(f"_k{level}"))
        if small:
            out = out.join(F.broadcast(side), last_labels(host, level) == F.col(f"_s{level}"), "left").drop(f"_s{level}")
        else:
            asked = out.withColumn(f"_s{level}", last_labels(host, level))
            out = spread_join(asked, side, [f"_s{level}"], host_col).drop(f"_s{level}")
        names.append((level, f"_k{level}"))

    n = label_count(host)

    def has(name: str, kind: str) -> Column:
        return F.coalesce(F.array_contains(F.col(name), kind), F.lit(False))

    lengths = [F.lit(1)]
    exceptions = []
    for level, name in names:
        lengths.append(F.when(has(name, "normal"), level))
        lengths.append(F.when(has(name, "wildcard") & (n > level), level + 1))
        exceptions.append(F.when(has(name, "exception"), level - 1))
    longest = reduce(lambda a, b: F.greatest(a, b), lengths)
    size = F.coalesce(*exceptions, longest) if exceptions else longest

    def tail(k: Column) -> Column:
        labels = F.split(host, "[.]", -1)
        k = F.least(k, F.size(labels))
        return F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".")

    is_address = host.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") | host.startswith("[")
    return out.select(
        *urls.columns,
        F.when(~is_address, tail(size)).alias("suffix"),
        F.when(is_address, host).otherwise(tail(size + 1)).alias("domain"),
    )


def partition_key(urls: DataFrame, mode: str = "byDomain", suffixes: DataFrame | None = None) -> DataFrame:
    """Add ``key``: the lower-cased host, or its registered domain."""
    staged = with_parts(urls).withColumn("_host", F.lower("_p.host")).drop("_p")
    if mode == "byHost":
        return staged.withColumn("key", F.col("_host")).drop("_host")
    if mode != "byDomain":
        raise ValueError(f"unknown key mode {mode!r}")
    if suffixes is None:
        raise ValueError("byDomain needs a suffix table")
    return domain_join(staged, suffixes, "_host").withColumn("key", F.col("domain")).drop("_host", "suffix", "domain")

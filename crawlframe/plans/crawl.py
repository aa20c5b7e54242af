"""Whole steps of the crawl over a table of fetched records. One set of functions for batch and stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlframe.functions.content import (
    SITEMAP_WINDOW,
    detect_feed,
    detect_sitemap_bootstrap,
    detect_sitemap_type,
    inflate,
    namespace_guard,
    root_name,
    resolve_sitemap_flags,
    with_signature,
)
from crawlframe.functions.dates import parse_date_lenient, recently_modified
from crawlframe.functions.metadata import (
    empty_meta,
    meta_add,
    meta_first,
    meta_set,
    meta_true,
    meta_update,
    outlink_metadata,
)
from crawlframe.functions.stage import compute_once, with_parts
from crawlframe.functions.urls import resolve_url
from crawlframe.operators.extract import (
    FEED_ROOTS,
    _is_recent_entry,
    body_text,
    canonical_href,
    extract_alternates,
    feed_urls_of,
    parse_feed,
    parse_sitemap,
)
from crawlframe.operators.filtering import apply_url_filters, deny_flag
from crawlframe.operators.keys import partition_key
from crawlframe.operators.schedule import classify_fetch, next_fetch_news, sitemap_delay
from crawlframe.schemas import (
    ERROR_CAUSE,
    ERROR_COUNT,
    ERROR_MESSAGE,
    ERROR_SOURCE,
    IS_FEED,
    IS_INDEX,
    IS_NEWS,
    IS_SITEMAP,
    IS_VERIFIED,
    NUM_LINKS,
    REDIR_TO,
    SIGNATURE,
    SIGNATURE_OLD,
)
from crawlframe.session import as_ts

Clock = Column | str | dt.datetime
Chain = Sequence[dict | Callable]

_LINK = "array<struct<url:string,url_pos:int,link_pos:int>>"


def apply_parse_filters(docs: DataFrame, chain: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Run parse filters in order; each adds to the metadata of ``url, content, metadata`` rows.

    A filter that can't deal with a document names the reason in the column ``filter_error``: the document then turns
    ERROR behind its parser, and its links are dropped. See :func:`failing`.
    """
    for step in chain:
        docs = step(docs)
    return docs


def signature_filter(docs: DataFrame) -> DataFrame:
    return docs.withColumn("metadata", with_signature(F.col("metadata"), F.col("content")))


def canonical_filter(docs: DataFrame) -> DataFrame:
    staged = compute_once(docs, "_href", canonical_href(F.col("content")))
    found = meta_set(F.col("metadata"), "canonical", F.col("_href"))
    return staged.withColumn("metadata", F.when(F.col("_href").isNotNull(), found).otherwise(F.col("metadata"))).drop("_href")


def failing(docs: DataFrame, error: Column) -> DataFrame:
    """Mark rows whose ``error`` is not NULL; the first error of a row stays."""
    known = F.col("filter_error") if "filter_error" in docs.columns else F.lit(None).cast("string")
    return docs.withColumn("filter_error", F.coalesce(known, error))


#: Parse filters of the two set-ups; the feed links of the second are rows, see ``bootstrap_step``.
PARSE_FILTERS = {"production": (signature_filter,), "bootstrap": (signature_filter, canonical_filter)}


def _content_type(docs: DataFrame) -> Column:
    from_meta = F.coalesce(meta_first(F.col("metadata"), "content-type"), meta_first(F.col("metadata"), "Content-Type"))
    return F.coalesce(from_meta, F.col("content_type")) if "content_type" in docs.columns else from_meta


def route_fetched(fetched: DataFrame, sniff: bool = True, window: int = SITEMAP_WINDOW) -> DataFrame:
    """Add ``branch`` and set the flags in the metadata.

    Branches: ``sitemap`` (to parse), ``plain_sitemap`` (fetched, not parsed), ``feed``, ``article``.
    """
    detected = detect_sitemap_type(F.col("content"), window) if sniff else F.lit(None).cast("string")
    staged = compute_once(fetched, "_type", detected)
    staged = compute_once(staged, "_f", resolve_sitemap_flags(F.col("metadata"), F.col("_type"))).drop("_type")
    is_feed = detect_feed(_content_type(fetched), F.col("content"), meta_true(F.col("metadata"), IS_FEED))
    branch = (
        F.when(F.col("_f.action") == "parse", "sitemap")
        .when(F.col("_f.action") == "fetched", "plain_sitemap")
        .when(is_feed, "feed")
        .otherwise("article")
    )
    routed = compute_once(staged, "branch", branch)
    meta = F.when(F.col("branch") == "feed", meta_set(F.col("_f.metadata"), IS_FEED, "true")).otherwise(F.col("_f.metadata"))
    return routed.withColumn("metadata", meta).drop("_f")


def _sitemap_link_array(now: Clock, hours: int) -> Column:
    """Links of a parsed sitemap or index in order, old ones left out, with their positions."""
    indexed = F.transform("entries", lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    wanted = F.filter(
        indexed,
        lambda x: F.coalesce(F.trim(x["e"]["loc"]) != "", F.lit(False)) & _is_recent_entry(x["e"], now, hours),
    )

    def targets(x: Column) -> Column:
        urls = F.concat(extract_alternates(x["e"]), F.array(F.trim(x["e"]["loc"])))
        return F.transform(urls, lambda u, j: F.struct(u.alias("url"), x["i"].alias("url_pos"), j.alias("link_pos")))

    from_entries = F.flatten(F.transform(wanted, targets)).cast(_LINK)
    children = F.filter(
        F.transform("children", lambda c, i: F.struct(c.alias("c"), i.alias("i"))),
        lambda x: F.coalesce(F.trim(x["c"]["loc"]) != "", F.lit(False))
        & recently_modified(parse_date_lenient(x["c"]["lastmod"]), now, hours),
    )
    from_children = F.transform(
        children, lambda x: F.struct(F.trim(x["c"]["loc"]).alias("url"), x["i"].alias("url_pos"), F.lit(0).alias("link_pos"))
    ).cast(_LINK)
    return F.when(F.col("is_index"), from_children).otherwise(from_entries)


def _feed_link_array(now: Clock, hours: int) -> Column:
    """Recent links of a parsed feed in order, relative ones resolved against the feed."""
    indexed = F.transform("items", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    wanted = F.filter(
        indexed,
        lambda y: F.coalesce(y["x"]["link"] != "", F.lit(False))
        & recently_modified(parse_date_lenient(y["x"]["published"]), now, hours),
    )
    return F.transform(
        wanted,
        lambda y: F.struct(
            resolve_url(F.col("url"), y["x"]["link"], F.col("_base")).alias("url"), y["i"].alias("url_pos"), F.lit(0).alias("link_pos")
        ),
    ).cast(_LINK)


def document_updates(
    docs: DataFrame,
    now: Clock,
    hours: int = 720,
    delay: int = 15,
    chain: Chain = (),
    track_path: bool = True,
    track_depth: bool = False,
    strict_namespace: bool = True,
) -> DataFrame:
    """Status updates of fetched documents: ``url, status, metadata, delay, parent_url``.

    ``docs`` has ``url, content, metadata, kind, state``: documents of kind ``sitemap`` and ``feed`` are
    parsed, those of kind ``redirect`` hand on their target, all others keep ``state`` as their status. What the
    parse filters said against a document may stand in ``filter_error``.

    Every body is read once. Parsing is narrow and leaves one row with a link array per document. One
    shuffle by document (without bodies) folds copies of the same record, map-side first, so a record
    that was delivered a million times weighs no more than one. Behind it each document becomes a
    marker row plus one row per link, the filters run, and the links that survived are counted and
    staggered where they are. A document is bounded by the body limit, so no group is large.
    """
    kind = F.col("kind")
    refused = F.col("filter_error") if "filter_error" in docs.columns else F.lit(None).cast("string")
    staged = docs.select(
        "url",
        "metadata",
        "kind",
        "state",
        F.when(kind.isin("sitemap", "feed"), refused).alias("_refused"),
        F.when(kind == "sitemap", F.col("content")).alias("content"),
        F.when(kind == "feed", F.col("content")).alias("_feed"),
    )
    staged = compute_once(staged, "content", inflate(F.col("content")))
    # a feed under a sitemap's flag is read as one, whatever its namespace
    is_sitemap_feed = root_name(body_text(F.substring("content", 1, 4096))).isin(*FEED_ROOTS)
    guard = namespace_guard(F.col("content")) | is_sitemap_feed if strict_namespace else F.lit(True)
    staged = compute_once(staged, "_ns", F.coalesce(guard, F.lit(False)))
    identity = F.md5(
        F.concat_ws("\x01", "url", "kind", "state", F.xxhash64("content", "_feed").cast("string"), "_refused", F.to_json("metadata"))
    )
    staged = compute_once(staged, "_doc_id", identity)
    media_type = F.coalesce(meta_first(F.col("metadata"), "content-type"), meta_first(F.col("metadata"), "Content-Type"))
    read = parse_sitemap(staged, content_type=media_type, inflated=True)
    parsed = read.withColumn("_map_ok", F.col("ok") & F.col("_ns")).drop("ok")
    parsed = with_parts(parse_feed(parsed, "_feed"), "url", "_base")
    ok = F.when(kind == "sitemap", F.col("_map_ok")).when(kind == "feed", F.col("ok")).otherwise(True)
    parsed = parsed.withColumns({"_read": ok, "_ok": ok & F.col("_refused").isNull()})
    target = meta_first(F.col("metadata"), REDIR_TO)
    hop = F.array(F.struct(target.alias("url"), F.lit(0).alias("url_pos"), F.lit(0).alias("link_pos"))).cast(_LINK)
    links = (
        F.when((kind == "sitemap") & F.col("_ok"), _sitemap_link_array(now, hours))
        .when((kind == "feed") & F.col("_ok"), _feed_link_array(now, hours))
        .when((kind == "redirect") & target.isNotNull() & (target != F.col("url")), hop)
    )
    parsed = compute_once(parsed, "_links", links).select(
        "_doc_id", "url", "metadata", "kind", "state", "_ok", "is_index", "_links", F.when(F.col("_read"), F.col("_refused")).alias("_refused")
    )
    parsed = parsed.dropDuplicates(["_doc_id"])

    parent = F.col("metadata")
    tracked = outlink_metadata(F.col("url"), parent, track_path, track_depth)
    below_map = {
        IS_SITEMAP: F.when(kind == "sitemap", F.col("is_index").cast("string")),
        IS_NEWS: F.when(kind == "sitemap", "false"),
        IS_VERIFIED: F.when((kind == "sitemap") & F.col("is_index") & meta_true(parent, IS_VERIFIED), "true"),
    }
    child = meta_update(tracked, below_map)
    marker = F.array(F.struct(F.lit(None).cast("string").alias("url"), F.lit(-1).alias("url_pos"), F.lit(-1).alias("link_pos")))
    rows = F.concat(marker.cast(_LINK), F.coalesce("_links", F.array().cast(_LINK)))
    is_link = F.col("url_pos") >= 0
    flat = compute_once(parsed, "_child", F.when(F.size("_links") > 0, child)).select(
        "_doc_id", F.col("url").alias("parent_url"), "metadata", "_child", "_ok", "is_index", "kind", "state", "_refused", F.inline(rows).alias("url", "url_pos", "link_pos")
    ).select(
        "_doc_id",
        "parent_url",
        F.when(is_link, F.col("_child")).otherwise(F.col("metadata")).alias("metadata"),
        "_ok",
        "is_index",
        "kind",
        "state",
        "_refused",
        "url",
        "url_pos",
        "link_pos",
        (~is_link).alias("is_doc"),
    )
    kept = apply_url_filters(flat, chain, bypass="is_doc")

    # one order for both, so the rows of a document are sorted once
    per_doc = W.partitionBy("_doc_id").orderBy("url_pos", "link_pos")
    whole_doc = per_doc.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # the marker row sorts first, so the k-th kept link has number k + 2
    counted = kept.withColumns(
        {"_n": F.count_if(~F.col("is_doc")).over(whole_doc), "_nth": F.row_number().over(per_doc) - 2}
    )

    is_map, is_feed = F.col("kind") == "sitemap", F.col("kind") == "feed"
    bad = ~F.col("_ok")
    source = F.when(F.col("_refused").isNotNull(), "content filtering").when(is_map, "sitemap parsing").otherwise("feed parsing")
    message = F.coalesce("_refused", F.concat(F.lit("Not a readable document: "), F.col("parent_url")))
    changed = meta_update(
        parent,
        {
            ERROR_SOURCE: F.when(bad, source),
            ERROR_MESSAGE: F.when(bad, message),
            NUM_LINKS: F.when(is_map & ~bad, F.col("_n").cast("string")),
            IS_INDEX: F.when(is_map & ~bad & F.col("is_index"), "true"),
            IS_FEED: F.when(is_feed, "true"),
            # a document that can't be read keeps the signature it had
            SIGNATURE: F.when(bad, meta_first(parent, SIGNATURE_OLD)),
        },
        remove={
            NUM_LINKS: bad,
            IS_INDEX: is_map & ~bad & ~F.col("is_index"),
            SIGNATURE: bad & meta_first(parent, SIGNATURE_OLD).isNull(),
            SIGNATURE_OLD: bad,
        },
    )
    own = F.when(is_map | is_feed, changed).otherwise(parent)
    staggered = ~F.col("is_doc") & is_map & F.col("is_index") & (F.col("_nth") > 0)
    wait = F.when(staggered, F.col("_nth") * delay) if delay > 0 else F.lit(None)
    return counted.select(
        F.coalesce("url", "parent_url").alias("url"),
        F.when(~F.col("is_doc"), "DISCOVERED").when(~F.col("_ok"), "ERROR").otherwise(F.col("state")).alias("status"),
        F.when(F.col("is_doc"), own).otherwise(parent).alias("metadata"),
        wait.cast("int").alias("delay"),
        "parent_url",
    )


def _as_kind(fetched: DataFrame, kind: str) -> DataFrame:
    more = ["filter_error"] if "filter_error" in fetched.columns else []
    return fetched.select("url", "content", "metadata", F.lit(kind).alias("kind"), F.lit("FETCHED").alias("state"), *more)


def process_sitemaps(fetched: DataFrame, now: Clock, hours: int = 720, delay: int = 15, chain: Chain = (), **kw) -> DataFrame:
    """The sitemap step on its own (``url, content, metadata``, flags set as by :func:`route_fetched`).

    Documents that cannot be parsed turn ERROR; the others turn FETCHED with the number of links that
    survived the filters, and their links become DISCOVERED.
    """
    return document_updates(_as_kind(fetched, "sitemap"), now, hours, delay, chain, **kw)


def process_feeds(fetched: DataFrame, now: Clock, hours: int = 720, chain: Chain = (), **kw) -> DataFrame:
    """The feed step on its own: the feed FETCHED (or ERROR), its recent links DISCOVERED."""
    return document_updates(_as_kind(fetched, "feed"), now, hours, 0, chain, **kw)


def with_known_metadata(fetched: DataFrame, status: DataFrame) -> DataFrame:
    """Fill the metadata of fetched rows from the status table, for fetchers that do not carry it along."""
    known = status.select("url", F.col("metadata").alias("_known"))
    missing = F.map_filter("_known", lambda k, _v: ~F.map_contains_key(F.col("metadata"), k))
    joined = fetched.join(known, "url", "left")
    merged = F.map_concat(F.coalesce(missing, empty_meta()), F.col("metadata"))
    return joined.withColumn("metadata", merged).drop("_known").select(*fetched.columns)


def judged_records(fetched: DataFrame, deny_rules: DataFrame | None = None) -> DataFrame:
    """Fetched records with their ``state`` and ``branch``: what the articles and the updates of a round both ask of them.

    ``metadata`` is the one the updates go on with, ``_kept`` the one that came. Denied rows turn ERROR; a row with ``state`` already set
    keeps it. Bodies of failed and denied fetches are dropped.
    """
    staged = fetched.withColumn("_kept", F.col("metadata"))
    if "state" not in fetched.columns:
        staged = staged.withColumn("state", F.lit(None).cast("string"))
    # bodies of failed fetches are not looked at, nor carried past the rules
    fetched_well = F.coalesce("state", classify_fetch(F.col("http_status"))) == "FETCHED"
    staged = staged.withColumn("content", F.when(fetched_well, F.col("content")))
    if deny_rules is not None:
        meta = F.col("metadata")
        staged = deny_flag(staged, deny_rules).withColumns(
            {
                "state": F.when(F.col("denied"), "ERROR").otherwise(F.col("state")),
                "metadata": F.when(F.col("denied"), meta_add(meta, ERROR_CAUSE, "Filtered")).otherwise(meta),
            }
        ).drop("denied")
    failures = F.coalesce(meta_first(F.col("metadata"), ERROR_COUNT).try_cast("int"), F.lit(0)) + 1
    classified = compute_once(staged, "state", F.coalesce("state", classify_fetch(F.col("http_status"), failures)))
    good = F.col("state") == "FETCHED"
    failed = F.col("state") == "FETCH_ERROR"
    counted = meta_update(F.col("metadata"), {ERROR_COUNT: F.when(failed, failures.cast("string"))}, remove={ERROR_COUNT: good})
    has_count = F.map_contains_key("metadata", F.lit(ERROR_COUNT))
    classified = classified.withColumn("metadata", F.when(failed | (good & has_count), counted).otherwise(F.col("metadata")))
    return route_fetched(classified.withColumn("content", F.when(good, F.col("content"))))


def crawl_updates(
    fetched: DataFrame,
    now: Clock,
    hours: int = 720,
    delay: int = 15,
    chain: Chain = (),
    scheduler: Callable[[DataFrame], DataFrame] | None = None,
    key_mode: str = "byHost",
    suffixes: DataFrame | None = None,
    parse_filters: Sequence[Callable[[DataFrame], DataFrame]] = PARSE_FILTERS["production"],
) -> DataFrame:
    """All status updates of a batch of fetched records: ``url, key, status, next_fetch, metadata, event_time``.

    The records carry the stored metadata of their url, as the frontier handed it out. A row with
    ``state`` already set is stored as it is, and rows of :func:`judged_records` are not judged again. ``scheduler`` sets
    ``next_fetch`` on rows with ``url, status, metadata``. One pass over the bodies.
    """
    routed = fetched if "_kept" in fetched.columns else judged_records(fetched)
    good = F.col("state") == "FETCHED"
    # only documents that are parsed pass the parse filters
    parsed = good & F.col("branch").isin("sitemap", "feed")
    filtered = apply_parse_filters(routed.withColumn("_before", F.col("metadata")), parse_filters)
    signed = filtered.select(
        *(["filter_error"] if "filter_error" in filtered.columns else []),
        "url",
        "content",
        "state",
        F.when(parsed, F.col("metadata")).otherwise(F.col("_before")).alias("metadata"),
        F.when(good & F.col("branch").isin("sitemap", "feed"), F.col("branch"))
        .when(F.col("state") == "REDIRECTION", "redirect")
        .otherwise("plain")
        .alias("kind"),
    )
    updates = document_updates(signed, now, hours, delay, chain)
    if scheduler is not None:
        updates = sitemap_delay(scheduler(updates))
    else:
        updates = updates.withColumn("next_fetch", F.lit(None).cast("timestamp"))
    keyed = partition_key(updates, key_mode, suffixes)
    return keyed.select("url", "key", "status", "next_fetch", "metadata", as_ts(now).alias("event_time"))


def production_scheduler(now: Clock, fetch_intervals: DataFrame, **kw) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: next_fetch_news(rows, now, fetch_intervals, **kw)


def crawl_step(
    fetched: DataFrame,
    now: Clock,
    fetch_intervals: DataFrame,
    deny_rules: DataFrame | None = None,
    status: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """Updates of one round: pre-filter, route, extract, filter links, schedule. Feed to ``status_upsert``.

    Denied rows turn ERROR without their body being looked at. ``status`` is only needed when the
    records do not carry the stored metadata themselves. Rows of :func:`judged_records` have met their rules already.
    """
    if status is not None:
        fetched = with_known_metadata(fetched, status)
    if "_kept" not in fetched.columns:
        fetched = judged_records(fetched, deny_rules)
    return crawl_updates(fetched, now, scheduler=production_scheduler(now, fetch_intervals), **kw)


def article_records(fetched: DataFrame, deny_rules: DataFrame | None = None) -> DataFrame:
    """Fetched records that neither the sitemap nor the feed step takes: what an archive of articles keeps.

    All columns stay as they are. Failed and redirected fetches and denied URLs are left out. Rows of :func:`judged_records` are not judged again.
    """
    columns = [c for c in fetched.columns if c not in ("state", "branch", "_kept")]
    if "_kept" not in fetched.columns:
        fetched = judged_records(fetched.filter(classify_fetch(F.col("http_status")) == "FETCHED"), deny_rules)
    articles = fetched.filter("state = 'FETCHED' AND branch = 'article'")
    return articles.withColumn("metadata", F.col("_kept")).select(*columns)


def bootstrap_flags(fetched: DataFrame) -> DataFrame:
    """Classify candidate pages: add ``branch`` (sitemap, feed, page) and set flags; no links are followed."""
    meta = F.col("metadata")
    staged = compute_once(
        fetched, "_f", detect_sitemap_bootstrap(F.col("content"), meta_true(meta, IS_SITEMAP), meta_true(meta, IS_NEWS))
    )
    is_feed = detect_feed(_content_type(fetched), F.col("content"), meta_true(meta, IS_FEED))
    staged = compute_once(
        staged, "branch", F.when(F.col("_f.is_sitemap"), "sitemap").when(is_feed, "feed").otherwise("page")
    )
    out = F.when(F.col("_f.is_sitemap"), meta_set(meta, IS_SITEMAP, "true")).otherwise(meta)
    out = F.when(F.col("_f.is_news"), meta_set(out, IS_NEWS, "true")).otherwise(out)
    out = F.when(F.col("branch") == "feed", meta_set(out, IS_FEED, "true")).otherwise(out)
    return staged.withColumn("metadata", out).drop("_f")


def bootstrap_step(
    fetched: DataFrame, chain: Chain = (), scheduler: Callable[[DataFrame], DataFrame] | None = None, key_mode: str = "byHost", suffixes: DataFrame | None = None
) -> DataFrame:
    """Status updates of the site classifier: ``url, key, status, next_fetch, metadata``.

    Every document that was fetched is FETCHED, pages give the feeds they announce, with their path and depth. Where records carry
    ``http_status``, failed and redirected fetches keep their own status, and their bodies are not looked at. One narrow pass: a
    document turns into its own row and one row per feed. ``scheduler`` sets ``next_fetch``.
    """
    state = classify_fetch(F.col("http_status")) if "http_status" in fetched.columns else F.lit("FETCHED")
    staged = compute_once(fetched, "_state", state)
    staged = staged.withColumn("content", F.when(F.col("_state") == "FETCHED", F.col("content")))
    flagged = with_parts(apply_parse_filters(bootstrap_flags(staged), PARSE_FILTERS["bootstrap"]), "url", "_base")
    found = F.when(
        (F.col("branch") == "page") & (F.col("_state") == "FETCHED"), feed_urls_of(F.col("content").cast("string"), F.col("url"), F.col("_base"))
    )
    row_type = "array<struct<target:string,is_doc:boolean>>"
    own = F.array(F.struct(F.lit(None).cast("string").alias("target"), F.lit(True).alias("is_doc"))).cast(row_type)
    feeds = F.coalesce(
        F.transform(found, lambda u: F.struct(u.alias("target"), F.lit(False).alias("is_doc"))).cast(row_type),
        F.array().cast(row_type),
    )
    rows = compute_once(flagged, "_rows", F.concat(own, feeds)).select(
        F.col("url").alias("parent_url"), "metadata", "_state", F.inline("_rows").alias("url", "is_doc")
    )
    child = meta_set(outlink_metadata(F.col("parent_url"), F.col("metadata"), True, True), IS_FEED, "true")
    links = rows.withColumn("metadata", F.when(F.col("is_doc"), F.col("metadata")).otherwise(child))
    kept = apply_url_filters(links, chain, bypass="is_doc")
    updates = kept.select(
        F.coalesce("url", "parent_url").alias("url"),
        F.when(F.col("is_doc"), F.col("_state")).otherwise("DISCOVERED").alias("status"),
        "metadata",
    )
    updates = scheduler(updates) if scheduler is not None else updates.withColumn("next_fetch", F.lit(None).cast("timestamp"))
    return partition_key(updates, key_mode, suffixes).select("url", "key", "status", "next_fetch", "metadata")

"""Table schemas. Metadata is a multimap: every key holds an array, flags are the text "true"."""

from __future__ import annotations

META = "MAP<STRING,ARRAY<STRING>>"

SEEDS = f"url STRING, metadata {META}"
STATUS = f"url STRING, url_id STRING, key STRING, status STRING, next_fetch TIMESTAMP, metadata {META}"
UPDATES = f"url STRING, key STRING, status STRING, next_fetch TIMESTAMP, metadata {META}, event_time TIMESTAMP"
FETCHED = (
    "url STRING, fetch_time TIMESTAMP, http_status INT, content_type STRING, content BINARY, "
    f"trimmed STRING, metadata {META}, request_headers STRING, response_headers STRING"
)
CONTENT = (
    "url STRING, host STRING, domain STRING, format STRING, keywords STRING, "
    "title STRING, content STRING, description STRING"
)
METRICS = (
    "ts TIMESTAMP, name STRING, storm_id STRING, src_component STRING, src_task SMALLINT, "
    "src_host STRING, src_port INT, value DOUBLE"
)
DENY_RULES = "seq BIGINT, scope STRING, key STRING, kind STRING, pattern STRING"
REGEX_RULES = "seq INT, accept BOOLEAN, pattern STRING"
FETCH_INTERVALS = "seq INT, status STRING, meta_key STRING, meta_value STRING, minutes INT"
SUFFIXES = "suffix STRING, kind STRING"
ROBOTS_RULES = "key STRING, agent STRING, allow BOOLEAN, pattern STRING, crawl_delay DOUBLE"

STATUSES = ("DISCOVERED", "FETCHED", "FETCH_ERROR", "REDIRECTION", "ERROR")

# Metadata keys.
IS_SITEMAP = "isSitemap"
IS_NEWS = "isSitemapNews"
IS_INDEX = "isSitemapIndex"
IS_VERIFIED = "isSitemapVerified"
IS_FEED = "isFeed"
NUM_LINKS = "numLinks"
SIGNATURE = "signature"
SIGNATURE_OLD = "signatureOld"
SIGNATURE_CHANGE = "signatureChangeDate"
FETCH_INTERVAL = "fetchInterval"
LAST_MODIFIED = "last-modified"
ERROR_CAUSE = "error.cause"
ERROR_SOURCE = "error.source"
ERROR_MESSAGE = "error.message"
REDIR_TO = "_redirTo"
SITEMAP_FLAGS = (IS_SITEMAP, IS_NEWS, IS_INDEX, IS_VERIFIED)

# The metadata kept when a row is stored.
#: Failed fetches in a row.
ERROR_COUNT = "error.count"

PERSISTED_KEYS = (
    "_redirTo",
    "fetch.statusCode",
    "error.cause",
    "error.source",
    "isSitemap",
    "isSitemapNews",
    "isSitemapIndex",
    "isSitemapVerified",
    "isFeed",
    "numLinks",
    "last-modified",
    "signature",
    "signatureChangeDate",
    "fetchInterval",
    "protocol.etag",
    "protocol._request.time_",
)

"""Registered queries and updates of the status table."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from crawlframe.catalog.fixtures import NOW, derived, metrics_table, sql_ts, status_table, table, ts_text, with_ctes
from crawlframe.functions import metadata as M
from crawlframe.functions.dates import status_date
from crawlframe.operators import aggregates as A
from crawlframe.operators import filtering
from crawlframe.operators import frontier as FR
from crawlframe.operators import schedule as SC
from crawlframe.operators import status as S
from crawlframe.operators import upsert as UP
from crawlframe.schemas import PERSISTED_KEYS
from crawlframe.session import shared_dir
from crawlframe.sources import tables
from crawlframe.sources.tables import index_size_gb

DUE = "2024-01-05 00:00:00"
KEY = "h3.example.org"
# one known row, whatever the scale of the data: the row of the first event
URL_SQL = "(SELECT url FROM d_status WHERE event_id = 0)"
KEY_SQL = "(SELECT key FROM d_status WHERE event_id = 0)"

D = with_ctes("d_status")
_FLAT = f"url, key, status, {sql_ts('next_fetch')} AS next_fetch, coalesce(is_feed, '-') AS is_feed, coalesce(is_sitemap, '-') AS is_sitemap"


def _known(spark: SparkSession, sf: str):
    """(url, key) of the row of the first event."""
    return derived(spark, sf, "d_status").filter("event_id = 0").select("url", "key").first()


_STORED: dict[tuple[str, str], str] = {}


def stored_status(spark: SparkSession, sf: str) -> DataFrame:
    """The status table read through its stored form, with updates pending.

    The snapshot lacks every third row or has it outdated. One batch inserts and replaces them (some wrongly), and
    discovers rows anew that are known; a second puts the wrong ones right.
    """
    place = (spark.sparkContext.applicationId, sf)
    if place not in _STORED or not tables.path_exists(spark, _STORED[place]):
        rows = status_table(spark, sf).withColumn("n", F.substring_index("url", "/", -1).cast("bigint"))
        late, wrong, found = F.col("n") % 3 == 0, F.col("n") % 6 == 0, F.col("status") == "DISCOVERED"
        old = {"status": F.lit("DISCOVERED"), "next_fetch": F.lit(None).cast("timestamp"), "metadata": M.empty_meta()}
        base = rows.filter(~(late & found)).withColumns({c: F.when(late, v).otherwise(F.col(c)) for c, v in old.items()})
        when = F.lit(NOW).cast("timestamp").alias("event_time")
        right = rows.filter(late).select("url", "key", "status", "next_fetch", "metadata", when, "n")
        first = right.withColumn("status", F.when(wrong & ~found, "REDIRECTION").otherwise(F.col("status")))
        again = rows.filter("n % 3 = 1").select("url", "key", F.lit("DISCOVERED").alias("status"), when.alias("next_fetch"), M.meta_of(isFeed="maybe").alias("metadata"), when)
        root = f"{shared_dir(spark)}/status-{uuid.uuid4().hex}"
        tables.write_snapshot(base, root)
        tables.write_status(first.drop("n").unionByName(again), root, 1)
        tables.write_status(right.filter(wrong).drop("n"), root, 2)
        _STORED[place] = root
    return tables.read_status(spark, _STORED[place])


def _first(key: str):
    return F.coalesce(M.meta_first(F.col("metadata"), key), F.lit("-"))


def flat(df: DataFrame) -> DataFrame:
    return df.select(
        "url", "key", "status", ts_text("next_fetch").alias("next_fetch"), _first("isFeed").alias("is_feed"), _first("isSitemap").alias("is_sitemap")
    )


def _search(cond: str, size: int | None = None, page: int = 0) -> str:
    """SQL rows of a condition, all of them or one page in url order."""
    tail = "" if size is None else f" ORDER BY url LIMIT {size} OFFSET {page * size}"
    return f"{D} SELECT {_FLAT} FROM d_status WHERE {cond}{tail}"


def _count(cond: str) -> str:
    return f"{D} SELECT count(*) AS n FROM d_status WHERE {cond}"


def _pair(name: str, run, cond: str) -> dict[str, tuple]:
    """The count form and the search form (all rows) of one operator."""
    return {
        f"{name}_count": (lambda df, known: run(df, "count", None), _count(cond)),
        f"{name}_search": (lambda df, known: flat(run(df, "search", None)), _search(cond)),
    }


def _agg(cond: str, field: str = "key", size: int | None = None) -> str:
    limit = "" if size is None else f" ORDER BY n DESC, value LIMIT {size}"
    return f"{D} SELECT {field} AS value, count(*) AS n FROM d_status WHERE {cond} AND {field} IS NOT NULL GROUP BY 1{limit}"


SEARCHES: dict[str, tuple] = {
    **_pair(
        "query",
        lambda df, mode, size: S.query(df, mode, "status = 'ERROR' AND key LIKE 'h1%'", size=size),
        "status = 'ERROR' AND key LIKE 'h1%'",
    ),
    **_pair(
        "query_routed",
        lambda df, mode, size: S.query_routed(df, mode, KEY, "status <> 'ERROR'", size=size),
        f"key = '{KEY}' AND status <> 'ERROR'",
    ),
    **_pair("match", lambda df, mode, size: S.match(df, mode, {"status": "REDIRECTION"}, size=size), "status = 'REDIRECTION'"),
    **_pair(
        "match_field", lambda df, mode, size: S.match_field(df, mode, "metadata.isSitemap", "false", size=size), "is_sitemap = 'false'"
    ),
    **_pair(
        "match_by_metadata",
        lambda df, mode, size: S.match_by_metadata(df, mode, "key", KEY, "isFeed", size=size),
        f"key = '{KEY}' AND is_feed = 'true'",
    ),
    **_pair("next_fetch", lambda df, mode, size: S.next_fetch(df, mode, DUE, size=size), f"next_fetch < TIMESTAMP '{DUE}'"),
    **_pair(
        "next_fetch_for_date",
        lambda df, mode, size: S.next_fetch_for_date(df, mode, "tomorrow", DUE, size=size),
        f"next_fetch < TIMESTAMP '{DUE}' + INTERVAL 1 DAY",
    ),
    **_pair(
        "next_fetch_for_date_and_host",
        lambda df, mode, size: S.next_fetch_for_date_and_host(df, mode, "2024-01-20", KEY, DUE, size=size),
        f"key = '{KEY}' AND next_fetch < TIMESTAMP '2024-01-20 00:00:00'",
    ),
    **_pair(
        "failed_by_metadata",
        lambda df, mode, size: S.failed_by_metadata(df, mode, "isFeed", size=size),
        "is_feed = 'true' AND status <> 'FETCHED'",
    ),
    **_pair(
        "status_by_metadata",
        lambda df, mode, size: S.status_by_metadata(df, mode, "DISCOVERED", "isSitemap", size=size),
        "status = 'DISCOVERED' AND is_sitemap = 'true'",
    ),
}


def q_lookup_url(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.lookup_url(df, known.url))


def q_lookup_id(df: DataFrame, known: Row) -> DataFrame:
    """The id of a known url, looked up within its key."""
    url, key = known
    return flat(S.lookup_id(df, hashlib.sha256(url.encode()).hexdigest(), key))


def q_page(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.query(df, "search", "status = 'FETCHED'", page=2, size=25))


def q_list(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.list_rows(df, 10))


def q_inject_new(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.inject_url(df, "https://new.example/feed", "new.example", NOW, isFeed="true"))


def q_inject_known(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.inject_url(df, *known, NOW))


SQL_INJECT = f"{D} SELECT {_FLAT} FROM d_status UNION ALL SELECT 'https://new.example/feed', 'new.example', 'DISCOVERED', '{NOW}', 'true', '-'"


def q_delete_url(df: DataFrame, known: Row) -> DataFrame:
    return flat(S.delete_url(df, known.url))


def q_delete_id(df: DataFrame, known: Row) -> DataFrame:
    url, key = known
    return flat(S.delete_id(df, hashlib.sha256(url.encode()).hexdigest(), key))


def q_delete_routed(df: DataFrame, known: Row) -> DataFrame:
    """A wrong key deletes nothing, the right one does."""
    url, key = known
    df = S.delete_url_with_routing(df, url, "wrong.example")
    return flat(S.delete_url_with_routing(df, url, key))


def _reset_flat(df: DataFrame) -> DataFrame:
    """Also show that the history is an empty list after a reset."""
    change = F.coalesce(F.size(M.meta_values(F.col("metadata"), "signatureChangeDate")), F.lit(-1))
    modified = F.coalesce(F.size(M.meta_values(F.col("metadata"), "last-modified")), F.lit(-1))
    return flat(df).select("url", "status", "next_fetch").join(
        df.select("url", change.cast("bigint").alias("n_change"), modified.cast("bigint").alias("n_modified")), "url"
    )


def _reset_sql(cond: str) -> str:
    return f"""{D} SELECT url, CASE WHEN {cond} THEN 'DISCOVERED' ELSE status END AS status,
  CASE WHEN {cond} THEN '{NOW}' ELSE {sql_ts('next_fetch')} END AS next_fetch,
  CAST(CASE WHEN {cond} THEN 0 WHEN signature_change IS NULL THEN -1 ELSE 1 END AS BIGINT) AS n_change,
  CAST(CASE WHEN {cond} THEN 0 ELSE -1 END AS BIGINT) AS n_modified FROM d_status"""


def q_reset_url(df: DataFrame, known: Row) -> DataFrame:
    return _reset_flat(S.reset_url(df, known.url, NOW))


def q_reset_by_query(df: DataFrame, known: Row) -> DataFrame:
    return _reset_flat(S.reset_by_query(df, "reset", f"key = '{KEY}'", NOW))


def q_reset_failed(df: DataFrame, known: Row) -> DataFrame:
    return _reset_flat(S.reset_failed_by_metadata(df, "reset", "isFeed", NOW))


def _fetch_sql(cond: str, when: str) -> str:
    return f"{D} SELECT url, CASE WHEN {cond} THEN '{when}' ELSE {sql_ts('next_fetch')} END AS next_fetch FROM d_status"


def _next(df: DataFrame) -> DataFrame:
    return df.select("url", ts_text("next_fetch").alias("next_fetch"))


def q_fetch_now_url(df: DataFrame, known: Row) -> DataFrame:
    return _next(S.fetch_now_url(df, known.url, NOW))


def q_fetch_at_url(df: DataFrame, known: Row) -> DataFrame:
    return _next(S.fetch_at_url(df, known.url, "yesterday", NOW))


def q_fetch_at(df: DataFrame, known: Row) -> DataFrame:
    return _next(S.fetch_at(df, "update", "2024-02-01T10:00:00Z", "status", "ERROR", "isFeed", NOW))


def q_set_metadata(df: DataFrame, known: Row) -> DataFrame:
    df = S.set_metadata_url(df, known.url, "isFeed", "maybe")
    return df.select("url", _first("isFeed").alias("is_feed"))


def q_update_by_query(df: DataFrame, known: Row) -> DataFrame:
    df = S.update_by_query(df, {"status": F.lit("ERROR")}, "next_fetch IS NULL")
    return df.select("url", "status")


# --- aggregates -------------------------------------------------------------------------------


def q_index_size_gb(spark: SparkSession, sf: str) -> DataFrame:
    return index_size_gb(table(spark, sf, "events"))


def q_status_query_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = filtering.status_query_filter(
        status_table(spark, sf), positive=["status <> 'ERROR'"], negative=[f"key = '{KEY}'", "next_fetch > TIMESTAMP '2024-01-20'"]
    )
    return flat(df)


# --- metadata ---------------------------------------------------------------------------------


def q_meta_accessors(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("metadata")
    df = status_table(spark, sf)
    return df.select(
        "url",
        _first("numLinks").alias("num_links"),
        M.meta_true(m, "isSitemap").alias("is_sitemap"),
        M.meta_first(M.meta_set(m, "numLinks", "9"), "numLinks").alias("set_value"),
        F.size(M.meta_values(M.meta_add(m, "isFeed", "x"), "isFeed")).cast("bigint").alias("n_added"),
        F.size(M.meta_remove(m, "isFeed", "isSitemap")).cast("bigint").alias("n_left"),
    )


SQL_META = f"""{D} SELECT url, coalesce(num_links, '-') AS num_links, coalesce(is_sitemap = 'true', FALSE) AS is_sitemap, '9' AS set_value,
  CAST(CASE WHEN is_feed IS NULL THEN 1 ELSE 2 END AS BIGINT) AS n_added,
  CAST((num_links IS NOT NULL)::INT + (signature_change IS NOT NULL)::INT AS BIGINT) AS n_left FROM d_status"""


def q_persist_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Flags stay, request details and tracking go."""
    extra = M.meta_set(M.meta_set(F.col("metadata"), "protocol.request.headers", "x"), "url.path", F.col("url"))
    kept = M.persist_metadata(M.meta_set(extra, "protocol.etag", "e"), PERSISTED_KEYS)
    keys = F.array_join(F.array_sort(F.map_keys(kept)), ",")
    return status_table(spark, sf).select("url", keys.alias("keys"))


SQL_PERSIST = f"""{D} SELECT url, concat_ws(',', CASE WHEN is_feed IS NOT NULL THEN 'isFeed' END, CASE WHEN is_sitemap IS NOT NULL THEN 'isSitemap' END,
  CASE WHEN num_links IS NOT NULL THEN 'numLinks' END, 'protocol.etag', CASE WHEN signature_change IS NOT NULL THEN 'signatureChangeDate' END) AS keys FROM d_status"""


def q_outlink_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Children of rows that have a depth and a path themselves on some rows."""
    d = derived(spark, sf, "d_status")
    deep = F.col("event_id") % 3 == 0
    meta = F.when(
        deep, M.meta_set(M.meta_set(M.meta_of(isFeed="true", token="t"), "url.path", F.col("key")), "depth", (F.col("event_id") % 5).cast("string"))
    ).otherwise(M.meta_of(isFeed="true"))
    child = M.outlink_metadata(F.col("url"), meta, track_path=True, track_depth=True, transfer=("token",))
    return d.select("url", child.alias("c")).select(
        "url",
        F.array_join(F.col("c")["url.path"], " ").alias("path"),
        F.col("c")["depth"][0].alias("depth"),
        F.coalesce(F.try_element_at("c", F.lit("token"))[0], F.lit("-")).alias("token"),
        F.map_contains_key("c", F.lit("isFeed")).alias("has_feed"),
    )


SQL_OUTLINK_META = f"""{D} SELECT url, CASE WHEN event_id % 3 = 0 THEN concat(key, ' ', url) ELSE url END AS path,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 5 + 1 AS VARCHAR) ELSE '1' END AS depth, CASE WHEN event_id % 3 = 0 THEN 't' ELSE '-' END AS token,
  FALSE AS has_feed FROM d_status"""


def q_status_date(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id") % 4
    text = F.when(n == 0, F.date_format("ts", "yyyy-MM-dd")).when(n == 1, "tomorrow").when(n == 2, "3 days ago").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    )
    return table(spark, sf, "events").select("event_id", status_date(text, NOW).alias("date"))


SQL_STATUS_DATE = """SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT00:00:00.000Z') WHEN 1 THEN '2024-02-01T00:00:00.000Z'
  WHEN 2 THEN '2024-01-28T00:00:00.000Z' ELSE strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') END AS date FROM events"""


# --- frontier ---------------------------------------------------------------------------------


def q_due_urls(spark: SparkSession, sf: str) -> DataFrame:
    due = FR.due_urls(status_table(spark, sf), DUE, 5, 100)
    return due.select("key", "url", ts_text("next_fetch").alias("next_fetch"), F.col("rank").cast("bigint").alias("rank"))


def q_due_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the due index of the stored table and its pending updates."""
    stored_status(spark, sf)
    due = FR.due_urls(tables.read_due(spark, _STORED[spark.sparkContext.applicationId, sf], DUE), DUE, 5, 100)
    return due.select("key", "url", ts_text("next_fetch").alias("next_fetch"), F.col("rank").cast("bigint").alias("rank"))


SQL_DUE = f"""{D}, r AS (SELECT key, url, next_fetch, row_number() OVER (PARTITION BY key ORDER BY next_fetch, url) AS rank
  FROM d_status WHERE next_fetch <= TIMESTAMP '{DUE}'),
b AS (SELECT key, min(next_fetch) AS f FROM r GROUP BY key ORDER BY f, key LIMIT 100)
SELECT r.key, r.url, {sql_ts('r.next_fetch')} AS next_fetch, CAST(rank AS BIGINT) AS rank FROM r JOIN b ON b.key = r.key WHERE rank <= 5"""


def q_purgatory(spark: SparkSession, sf: str) -> DataFrame:
    """Due rows without those handed out in the last 20 minutes; every third row was handed out at its time."""
    d = derived(spark, sf, "d_status")
    inflight = d.filter("event_id % 3 = 0").select("url", (F.lit(DUE).cast("timestamp") - F.make_dt_interval(secs=(F.col("user_id") * 20))).alias("emitted_at"))
    due = status_table(spark, sf).filter(F.col("next_fetch") <= F.lit(DUE).cast("timestamp"))
    return FR.purgatory_filter(due, inflight, DUE, 1200).select("url")


SQL_PURGATORY = f"{D} SELECT url FROM d_status WHERE next_fetch <= TIMESTAMP '{DUE}' AND NOT (event_id % 3 = 0 AND user_id * 20 < 1200)"


def q_politeness(spark: SparkSession, sf: str) -> DataFrame:
    d = derived(spark, sf, "d_status")
    delays = d.select("key", F.when(F.col("user_id") % 2 == 0, (F.col("user_id") * 3).cast("double")).alias("crawl_delay"))
    due = status_table(spark, sf).filter(F.col("next_fetch") <= F.lit(NOW).cast("timestamp"))
    plan = FR.politeness_plan(due, NOW, delays, per_queue=10, max_total=700)
    return plan.select(
        "url", "key", F.col("position").cast("bigint").alias("position"), "delay", ts_text("slot").alias("slot"), "over_cap"
    )


SQL_POLITENESS = f"""{D}, r AS (SELECT url, key, next_fetch, user_id, row_number() OVER (PARTITION BY key ORDER BY next_fetch, url) AS rank
  FROM d_status WHERE next_fetch <= TIMESTAMP '{NOW}'),
t AS (SELECT * FROM r WHERE rank <= 10 ORDER BY rank, next_fetch, url LIMIT 700),
e AS (SELECT *, greatest(9.0, CASE WHEN user_id % 2 = 0 THEN user_id * 3.0 ELSE 0.0 END)::DOUBLE AS delay FROM t)
SELECT url, key, CAST(rank - 1 AS BIGINT) AS position, delay,
  strftime(TIMESTAMP '{NOW}' + to_seconds((rank - 1) * delay), '%Y-%m-%d %H:%M:%S') AS slot, delay > 120 AS over_cap FROM e"""


def q_warc_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched records spread over writers; sizes up to 10 MB, files of 40 MB or 12 hours."""
    d = derived(spark, sf, "d_status").join(table(spark, sf, "events").select("event_id", "ts"), "event_id")
    records = d.select(
        "url", F.col("ts").cast("timestamp").alias("fetch_time"), (F.col("event_id") * 7919 % 10000000).alias("size"),
        F.pmod(F.col("user_id"), F.lit(16)).alias("writer"),
    )
    return FR.warc_file_assign(records, max_mb=40, max_minutes=720).select("url", "writer", "file_no")


SQL_WARC_ASSIGN = f"""{D}, r AS (SELECT d.url, e.ts AS t, d.event_id * 7919 % 10000000 AS size, d.user_id % 16 AS writer FROM d_status d JOIN events e ON e.event_id = d.event_id),
w AS (SELECT url, writer, sum(size) OVER (PARTITION BY writer ORDER BY t, url ROWS UNBOUNDED PRECEDING) - size AS before,
  CAST(epoch(date_trunc('second', t)) - epoch(date_trunc('second', min(t) OVER (PARTITION BY writer))) AS BIGINT) AS age FROM r)
SELECT url, writer, CAST(floor(before / (40 * 1024 * 1024)) + floor(age / (60 * 720)) AS BIGINT) AS file_no FROM w"""


# --- upsert -----------------------------------------------------------------------------------


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    """Updates for known rows, repeated rows and new urls."""
    d = derived(spark, sf, "d_status")
    base = d.select(
        F.when(F.col("event_id") % 10 == 0, F.concat(F.col("url"), F.lit("/new"))).otherwise(F.col("url")).alias("url"),
        "key",
        F.when(F.col("event_id") % 4 == 0, "DISCOVERED").otherwise("FETCHED").alias("status"),
        F.lit("2024-02-02 00:00:00").cast("timestamp").alias("next_fetch"),
        M.meta_of(isFeed="true", other="dropped").alias("metadata"),
        F.lit(NOW).cast("timestamp").alias("event_time"),
    )
    # a later error for some of the same urls
    again = base.filter(F.col("url").endswith("7")).withColumns(
        {"status": F.lit("ERROR"), "event_time": F.col("event_time") + F.make_dt_interval(hours=F.lit(1))}
    )
    return base.unionByName(again)


_UPDATES_SQL = f"""{D}, u0 AS (SELECT CASE WHEN event_id % 10 = 0 THEN concat(url, '/new') ELSE url END AS url, key,
  CASE WHEN event_id % 4 = 0 THEN 'DISCOVERED' ELSE 'FETCHED' END AS status FROM d_status),
u AS (SELECT url, key, CASE WHEN ends_with(url, '7') THEN 'ERROR' ELSE status END AS status FROM u0)
"""


def q_status_upsert(spark: SparkSession, sf: str) -> DataFrame:
    out = UP.status_upsert(status_table(spark, sf), _updates(spark, sf))
    return out.select(
        "url", "url_id", "key", "status", ts_text("next_fetch").alias("next_fetch"), _first("isFeed").alias("is_feed"),
        F.map_contains_key("metadata", F.lit("other")).alias("has_other"),
    )


SQL_UPSERT = f"""{_UPDATES_SQL}
SELECT coalesce(s.url, u.url) AS url, sha256(coalesce(s.url, u.url)) AS url_id, coalesce(s.key, u.key) AS key,
  CASE WHEN u.url IS NOT NULL AND (s.url IS NULL OR u.status <> 'DISCOVERED') THEN u.status ELSE s.status END AS status,
  CASE WHEN u.url IS NOT NULL AND (s.url IS NULL OR u.status <> 'DISCOVERED') THEN '2024-02-02 00:00:00' ELSE {sql_ts('s.next_fetch')} END AS next_fetch,
  CASE WHEN u.url IS NOT NULL AND (s.url IS NULL OR u.status <> 'DISCOVERED') THEN 'true' ELSE coalesce(s.is_feed, '-') END AS is_feed,
  FALSE AS has_other
FROM d_status s FULL OUTER JOIN u ON u.url = s.url"""


def q_write_status(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert through the stored table: snapshot, one batch of updates written twice, compaction."""
    root = f"{shared_dir(spark)}/status-{uuid.uuid4().hex}"
    tables.write_snapshot(status_table(spark, sf), root)
    for _ in range(2):
        tables.write_status(_updates(spark, sf), root, batch_id=7)
    tables.compact_status(spark, root)
    out = tables.read_status(spark, root)
    return out.select(
        "url", "url_id", "key", "status", ts_text("next_fetch").alias("next_fetch"), _first("isFeed").alias("is_feed"),
        F.map_contains_key("metadata", F.lit("other")).alias("has_other"),
    )


def q_write_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows appended day by day and read back, counted per day."""
    path = f"{shared_dir(spark)}/metrics-{uuid.uuid4().hex}"
    rows = metrics_table(spark, sf).select(
        "ts", "name", F.lit("s").alias("storm_id"), "src_component", "src_task", "src_host", F.lit(6700).alias("src_port"), "value"
    )
    tables.write_metrics(rows, path)
    tables.write_metrics(rows.filter("name = 'in_queues'"), path)
    return tables.read_metrics(spark, path).groupBy(F.col("date").cast("string").alias("day"), "name").agg(F.count("*").alias("n"))


SQL_WRITE_METRICS = with_ctes("d_metrics") + """SELECT strftime(ts, '%Y-%m-%d') AS day, name,
  CAST(count(*) * CASE WHEN name = 'in_queues' THEN 2 ELSE 1 END AS BIGINT) AS n FROM d_metrics GROUP BY 1, 2"""


def q_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return UP.collapse_updates(_updates(spark, sf)).select("url", "key", "status")


def q_union_status(spark: SparkSession, sf: str) -> DataFrame:
    st = status_table(spark, sf)
    parts = [
        st.filter("status = 'FETCHED'").select("url", "status"),
        st.filter("status = 'ERROR'").select("status", "url", F.lit("x").alias("cause")),
        _updates(spark, sf).select("url", "status"),
    ]
    return UP.union_status(*parts).select("url", "status", F.coalesce("cause", F.lit("-")).alias("cause"))


SQL_UNION = f"""{_UPDATES_SQL} SELECT url, status, '-' AS cause FROM d_status WHERE status = 'FETCHED'
UNION ALL SELECT url, status, 'x' FROM d_status WHERE status = 'ERROR' UNION ALL SELECT url, status, '-' FROM u0
UNION ALL SELECT url, 'ERROR', '-' FROM u0 WHERE ends_with(url, '7')"""


def q_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Discovered links, each reported by up to 40 parents."""
    d = derived(spark, sf, "d_status")
    links = d.select(
        F.concat(F.lit("https://"), "key", F.lit("/l/"), (F.col("event_id") % 25).cast("string")).alias("url"),
        F.lit("DISCOVERED").alias("status"),
        F.lpad(F.col("event_id").cast("string"), 9, "0").alias("parent"),
    )
    return UP.dedup_discovered(links)


SQL_DEDUP = f"""{D} SELECT concat('https://', key, '/l/', event_id % 25) AS url, 'DISCOVERED' AS status,
  min(lpad(CAST(event_id AS VARCHAR), 9, '0')) AS parent FROM d_status GROUP BY 1, 2"""


def q_split_branches(spark: SparkSession, sf: str) -> DataFrame:
    out = UP.split_branches(status_table(spark, sf), "status", ["FETCHED", "ERROR"])
    return out["FETCHED"].agg(F.count("*").alias("n"), F.lit("FETCHED").alias("branch")).unionByName(
        out["ERROR"].agg(F.count("*").alias("n"), F.lit("ERROR").alias("branch"))
    )


# --- scheduling -------------------------------------------------------------------------------


def _intervals(spark: SparkSession) -> DataFrame:
    return SC.default_intervals(spark)


_MINUTES_SQL = """CASE status
  WHEN 'FETCH_ERROR' THEN CASE WHEN is_feed = 'true' THEN 4320 WHEN is_sitemap = 'true' THEN 259200 ELSE 2880 END
  WHEN 'ERROR' THEN CASE WHEN is_feed = 'true' THEN 86400 WHEN is_sitemap = 'true' THEN 259200 ELSE -1 END
  WHEN 'REDIRECTION' THEN CASE WHEN is_feed = 'true' THEN 20160 WHEN is_sitemap = 'true' THEN 259200 ELSE -1 END
  WHEN 'FETCHED' THEN CASE WHEN is_feed = 'true' THEN 720 WHEN is_sitemap = 'true' THEN 259200 ELSE -1 END
  ELSE CASE WHEN is_feed = 'true' THEN 0 WHEN is_sitemap = 'true' THEN 300 ELSE 0 END END"""


def q_assign_interval(spark: SparkSession, sf: str) -> DataFrame:
    out = SC.assign_interval(status_table(spark, sf), _intervals(spark))
    return out.select("url", F.col("minutes").cast("bigint").alias("minutes"))


def q_next_fetch_default(spark: SparkSession, sf: str) -> DataFrame:
    return _next(SC.next_fetch_default(status_table(spark, sf), NOW, _intervals(spark)))


def _default_next(minutes: str) -> str:
    return f"CASE WHEN {minutes} >= 0 THEN strftime(TIMESTAMP '{NOW}' + to_minutes(CAST({minutes} AS BIGINT)), '%Y-%m-%d %H:%M:%S') ELSE '' END"


def q_is_dead(spark: SparkSession, sf: str) -> DataFrame:
    st = status_table(spark, sf)
    return st.select("url", SC.is_dead_sitemap(F.col("status"), F.col("metadata"), NOW, 14400).alias("dead"))


_DEAD_SQL = f"coalesce(status = 'FETCHED' AND is_sitemap = 'true' AND date_trunc('millisecond', signature_change) < TIMESTAMP '{NOW}' - INTERVAL 14400 MINUTE AND num_links = '0', FALSE)"


def _signed(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows with a previous and a new signature and, on some rows, a stored interval."""
    d = derived(spark, sf, "d_status").select(
        F.col("url").alias("u"),
        F.when(F.col("event_id") % 3 != 0, F.lit("old")).alias("old"),
        F.when(F.col("event_id") % 2 == 0, F.lit("old")).otherwise("new").alias("new"),
        F.when(F.col("event_id") % 13 < 6, (F.col("event_id") % 1000 * 200).cast("string")).alias("interval"),
    )
    st = status_table(spark, sf).join(d, F.col("url") == F.col("u")).drop("u")
    m = M.meta_set(F.col("metadata"), "signature", F.col("new"))
    m = F.when(F.col("old").isNotNull(), M.meta_set(m, "signatureOld", F.col("old"))).otherwise(m)
    m = F.when(F.col("interval").isNotNull(), M.meta_set(m, "fetchInterval", F.col("interval"))).otherwise(m)
    return st.withColumn("metadata", m).drop("old", "new", "interval")


def _adaptive_flat(df: DataFrame) -> DataFrame:
    return df.select(
        "url", ts_text("next_fetch").alias("next_fetch"), _first("fetchInterval").alias("interval"),
        F.coalesce(M.meta_first(F.col("metadata"), "signatureChangeDate") == "2024-01-31T00:00:00.000Z", F.lit(False)).alias("restamped"),
    )


def q_next_fetch_adaptive(spark: SparkSession, sf: str) -> DataFrame:
    return _adaptive_flat(SC.next_fetch_adaptive(_signed(spark, sf), NOW, _intervals(spark)))


def q_next_fetch_news(spark: SparkSession, sf: str) -> DataFrame:
    return _adaptive_flat(SC.next_fetch_news(_signed(spark, sf), NOW, _intervals(spark), stale_minutes=14400))


def _adaptive_sql(dead: str) -> str:
    return f"""{D}, m AS (SELECT *, {_MINUTES_SQL} AS minutes, CASE WHEN event_id % 13 < 6 THEN event_id % 1000 * 200 END AS stored,
   CASE WHEN event_id % 3 <> 0 THEN 'old' END AS old, CASE WHEN event_id % 2 = 0 THEN 'old' ELSE 'new' END AS new FROM d_status),
p AS (SELECT *, coalesce(stored, minutes) AS prev, status = 'FETCHED' AND coalesce(stored, minutes) >= 0 AS applies FROM m),
a AS (SELECT *, CASE WHEN applies THEN greatest(90, least(129600, CAST(floor(round(prev * CASE WHEN old IS NULL THEN 1.0 WHEN old <> new THEN 0.8 ELSE 1.5 END, 6)) AS BIGINT))) END AS ad FROM p)
SELECT url, CASE WHEN {dead} THEN '' WHEN applies THEN strftime(TIMESTAMP '{NOW}' + to_minutes(ad), '%Y-%m-%d %H:%M:%S') ELSE {_default_next('minutes')} END AS next_fetch,
  CASE WHEN applies THEN CAST(ad AS VARCHAR) WHEN stored IS NOT NULL THEN CAST(stored AS VARCHAR) ELSE '-' END AS interval,
  applies AND (old IS NULL OR old <> new OR signature_change IS NULL) AS restamped FROM a"""


def q_classify_fetch(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in (200, 304, 301, 308, 404, 410, 500, 503, 403, 429)])
    d = derived(spark, sf, "d_status")
    code = F.element_at(codes, (F.col("event_id") % 10 + 1).cast("int"))
    return d.select("url", SC.classify_fetch(code, (F.col("user_id") % 5).cast("int")).alias("status"))


SQL_CLASSIFY = f"""{D} SELECT url, CASE WHEN event_id % 10 IN (0, 1) THEN 'FETCHED' WHEN event_id % 10 IN (2, 3) THEN 'REDIRECTION'
  WHEN event_id % 10 IN (4, 5) THEN 'ERROR' WHEN user_id % 5 >= 3 THEN 'ERROR' ELSE 'FETCH_ERROR' END AS status FROM d_status"""


def q_redirect_updates(spark: SparkSession, sf: str) -> DataFrame:
    d = derived(spark, sf, "d_status").filter("status = 'REDIRECTION'")
    rows = d.select(
        "url", F.when(F.col("event_id") % 5 != 0, M.meta_of(_redirTo=F.concat("url", F.lit("/to")))).otherwise(M.meta_of(x="y")).alias("metadata")
    )
    return SC.redirect_updates(rows).select("url", "status", _first("_redirTo").alias("target"))


SQL_REDIRECT = f"""{D} SELECT url, 'REDIRECTION' AS status, CASE WHEN event_id % 5 <> 0 THEN concat(url, '/to') ELSE '-' END AS target FROM d_status WHERE status = 'REDIRECTION'
UNION ALL SELECT concat(url, '/to'), 'DISCOVERED', '-' FROM d_status WHERE status = 'REDIRECTION' AND event_id % 5 <> 0"""


def q_sitemap_delay(spark: SparkSession, sf: str) -> DataFrame:
    d = derived(spark, sf, "d_status")
    rows = d.select("url", "status", F.col("next_fetch").cast("timestamp").alias("next_fetch"), F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 9 * 15).cast("int")).alias("delay"))
    return _next(SC.sitemap_delay(rows))


SQL_SITEMAP_DELAY = f"""{D} SELECT url, {sql_ts("CASE WHEN status = 'DISCOVERED' AND event_id % 2 = 0 THEN next_fetch + to_minutes(event_id % 9 * 15) ELSE next_fetch END")} AS next_fetch FROM d_status"""


#: Queries and bulk updates of the status table, over any table: (table, known row) -> result.
STATUS_OPERATORS: dict[str, tuple] = {
    **SEARCHES,
    "lookup_url": (q_lookup_url, _search(f"url = {URL_SQL}")),
    "lookup_id": (q_lookup_id, _search(f"url = {URL_SQL} AND key = {KEY_SQL}")),
    "page": (q_page, _search("status = 'FETCHED'", 25, 2)),
    "list_rows": (q_list, _search("TRUE", 10)),
    "inject_url_new": (q_inject_new, SQL_INJECT),
    "inject_url_known": (q_inject_known, f"{D} SELECT {_FLAT} FROM d_status"),
    "delete_url": (q_delete_url, _search(f"url <> {URL_SQL}")),
    "delete_id": (q_delete_id, _search(f"url <> {URL_SQL}")),
    "delete_url_with_routing": (q_delete_routed, _search(f"url <> {URL_SQL}")),
    "reset_url": (q_reset_url, _reset_sql(f"url = {URL_SQL}")),
    "reset_by_query": (q_reset_by_query, _reset_sql(f"key = '{KEY}'")),
    "reset_failed_by_metadata": (q_reset_failed, _reset_sql("coalesce(is_feed = 'true' AND status <> 'FETCHED', FALSE)")),
    "fetch_now_url": (q_fetch_now_url, _fetch_sql(f"url = {URL_SQL}", NOW)),
    "fetch_at_url": (q_fetch_at_url, _fetch_sql(f"url = {URL_SQL}", "2024-01-30 00:00:00")),
    "fetch_at": (q_fetch_at, _fetch_sql("status = 'ERROR' AND is_feed = 'true'", "2024-02-01 10:00:00")),
    "set_metadata_url": (q_set_metadata, f"{D} SELECT url, CASE WHEN url = {URL_SQL} THEN 'maybe' ELSE coalesce(is_feed, '-') END AS is_feed FROM d_status"),
    "update_by_query": (q_update_by_query, f"{D} SELECT url, CASE WHEN next_fetch IS NULL THEN 'ERROR' ELSE status END AS status FROM d_status"),
    "reset_by_query_count": (lambda df, known: S.reset_by_query(df, "count", f"key = '{KEY}'", NOW), _count(f"key = '{KEY}'")),
    "reset_failed_by_metadata_count": (
        lambda df, known: S.reset_failed_by_metadata(df, "count", "isFeed", NOW),
        _count("is_feed = 'true' AND status <> 'FETCHED'"),
    ),
    "fetch_at_count": (
        lambda df, known: S.fetch_at(df, "count", "tomorrow", "status", "ERROR", "isFeed", NOW),
        _count("status = 'ERROR' AND is_feed = 'true'"),
    ),
}


def _over_rows(run):
    return lambda spark, sf: run(status_table(spark, sf), _known(spark, sf))


def _over_store(run):
    return lambda spark, sf: run(stored_status(spark, sf), _known(spark, sf))


QUERIES: dict[str, tuple] = {
    **{name: (_over_rows(run), sql) for name, (run, sql) in STATUS_OPERATORS.items()},
    # the same through the stored table, whose last state is spread over a snapshot and two batches of updates
    **{f"stored_{name}": (_over_store(run), sql) for name, (run, sql) in STATUS_OPERATORS.items()},
    "aggregate": (lambda s, d: A.aggregate(status_table(s, d), "key", 30), _agg("TRUE", "key", 30)),
    "aggregate_metadata_field": (lambda s, d: A.aggregate(status_table(s, d), "metadata.numLinks"), _agg("TRUE", "num_links")),
    "aggregate_status": (lambda s, d: A.aggregate_status(status_table(s, d)), _agg("TRUE", "status")),
    "aggregate_by": (lambda s, d: A.aggregate_by(status_table(s, d), "status", f"key = '{KEY}'"), _agg(f"key = '{KEY}'", "status")),
    "aggregate_by_metadata": (lambda s, d: A.aggregate_by_metadata(status_table(s, d), "status", "isSitemap"), _agg("is_sitemap = 'true'", "status")),
    "aggregate_hostname": (lambda s, d: A.aggregate_hostname(status_table(s, d), "status = 'FETCHED'"), _agg("status = 'FETCHED'")),
    "aggregate_hostname_by_status": (lambda s, d: A.aggregate_hostname_by_status(status_table(s, d), "ERROR"), _agg("status = 'ERROR'")),
    "top_hosts": (lambda s, d: A.top_hosts(status_table(s, d)), _agg("TRUE", "key", 50)),
    "index_size": (lambda s, d: A.index_size(status_table(s, d)), _count("TRUE")),
    "index_size_gb": (q_index_size_gb, None),
    "status_query_filter": (q_status_query_filter, _search(f"status <> 'ERROR' AND key <> '{KEY}' AND (next_fetch IS NULL OR next_fetch <= TIMESTAMP '2024-01-20')")),
    "meta_accessors": (q_meta_accessors, SQL_META),
    "persist_metadata": (q_persist_metadata, SQL_PERSIST),
    "outlink_metadata": (q_outlink_metadata, SQL_OUTLINK_META),
    "status_date": (q_status_date, SQL_STATUS_DATE),
    "due_urls": (q_due_urls, SQL_DUE),
    "due_urls_stored": (q_due_stored, SQL_DUE),
    "purgatory_filter": (q_purgatory, SQL_PURGATORY),
    "politeness_plan": (q_politeness, SQL_POLITENESS),
    "warc_file_assign": (q_warc_assign, SQL_WARC_ASSIGN),
    "status_upsert": (q_status_upsert, SQL_UPSERT),
    "write_status": (q_write_status, SQL_UPSERT),
    "write_metrics": (q_write_metrics, SQL_WRITE_METRICS),
    "collapse_updates": (q_collapse, f"{_UPDATES_SQL} SELECT url, key, status FROM u"),
    "union_status": (q_union_status, SQL_UNION),
    "dedup_discovered": (q_dedup, SQL_DEDUP),
    "split_branches": (q_split_branches, f"{D} SELECT count(*) AS n, status AS branch FROM d_status WHERE status IN ('FETCHED', 'ERROR') GROUP BY status"),
    "assign_interval": (q_assign_interval, f"{D} SELECT url, CAST({_MINUTES_SQL} AS BIGINT) AS minutes FROM d_status"),
    "next_fetch_default": (q_next_fetch_default, f"{D} SELECT url, {_default_next('(' + _MINUTES_SQL + ')')} AS next_fetch FROM d_status"),
    "is_dead_sitemap": (q_is_dead, f"{D} SELECT url, {_DEAD_SQL} AS dead FROM d_status"),
    "next_fetch_adaptive": (q_next_fetch_adaptive, _adaptive_sql("FALSE")),
    "next_fetch_news": (q_next_fetch_news, _adaptive_sql(_DEAD_SQL)),
    "classify_fetch": (q_classify_fetch, SQL_CLASSIFY),
    "redirect_updates": (q_redirect_updates, SQL_REDIRECT),
    "sitemap_delay": (q_sitemap_delay, SQL_SITEMAP_DELAY),
}

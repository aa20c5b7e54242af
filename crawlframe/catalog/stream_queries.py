"""Registered forms of the streams, sinks and readers: each runs over files derived from the supplied tables until they are used up."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.catalog import content_queries as CQ
from crawlframe.catalog import status_queries as SQ
from crawlframe.catalog.fixtures import NOW, metrics_table, rule_texts, sql_ts, status_table, table, ts_text, with_ctes
from crawlframe.catalog.url_queries import _RULE_SQL, _URLS_SQL, RULE_ROWS, RULES_SQL
from crawlframe.functions import metadata as M
from crawlframe.operators import schedule as SC
from crawlframe.schemas import FETCHED, STATUS
from crawlframe.session import shared_dir
from crawlframe.sources import rules as R
from crawlframe.sources import tables
from crawlframe.sources.seeds import read_fetched, read_seeds
from crawlframe.sources.warc import read_warc, write_warc
from crawlframe.streaming import stream as ST

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _new(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _drain(spark: SparkSession, df: DataFrame, mode: str = "append") -> DataFrame:
    """All rows a stream gives until its input is used up (in complete mode, the last result)."""
    out = _new(spark, "stream")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKS)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={batch_id}")

    try:
        writer = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", _new(spark, "checkpoint"))
        _run(writer.trigger(availableNow=True).start())
    finally:
        spark.conf.set(_PROVIDER, before)
    return spark.read.schema(df.schema).parquet(out)


def _stored(spark: SparkSession, df: DataFrame, name: str, files: int | None = 2, *by: str) -> str:
    """The rows as files, dealt in turn or by columns; without a number a file for each partition."""
    path = _new(spark, name)
    (df.repartition(files, *by) if files else df).write.parquet(path)
    return path


def _source(spark: SparkSession, df: DataFrame, name: str, files: int | None = 2) -> DataFrame:
    return spark.readStream.schema(df.schema).parquet(_stored(spark, df, name, files))


def _rule_texts(spark: SparkSession) -> str:
    """The rule table as a text file."""
    lines = []
    for _, scope, key, kind, pattern in RULE_ROWS:
        lines.append(f"{scope.title()} {key}")
        lines.append("  DenyPath .*" if kind == "all" else f"  {'DenyPath' if kind == 'path' else 'DenyPathQuery'} {pattern}")
    path = _new(spark, "rules")
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.text(path)
    return path


# --- schedule and purgatory -------------------------------------------------------------------

STALE = 14400


def _history(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "FETCH_ERROR").otherwise("FETCHED")
    minutes = F.when(F.col("event_type") == "error", 2880).when(F.col("user_id") % 4 == 0, -1).when(F.col("user_id") % 4 == 1, 720).otherwise(1440)
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("fetch_time"),
        status.alias("status"),
        F.when(status == "FETCHED", F.when(F.col("event_id") % 5 < 4, "a").otherwise("b")).alias("signature"),
        minutes.cast("int").alias("minutes"),
        (F.col("user_id") % 2 == 0).alias("is_sitemap"),
        F.when(F.col("event_id") % 3 == 0, "0").otherwise("5").alias("num_links"),
    )


def _known_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows of every third url: a signature, changed long ago, an interval, one failure."""
    urls = table(spark, sf, "events").filter("user_id % 3 = 0").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url")).distinct()
    cells = {"signature": "a", "signatureChangeDate": "2023-12-20T00:00:00.000Z", "fetchInterval": "1000", "error.count": "1"}
    return urls.withColumn("metadata", M.meta_of(**cells))


def q_scheduler(spark: SparkSession, sf: str) -> DataFrame:
    stream = _source(spark, _history(spark, sf), "history", None)
    out = _drain(spark, ST.scheduler_state_stream(stream, stale_minutes=STALE, status=_known_schedule(spark, sf)))
    return out.select(
        "url", F.coalesce("signature", F.lit("-")).alias("signature"), "changed", ts_text("signature_change").alias("signature_change"),
        F.coalesce(F.col("interval").cast("bigint"), F.lit(-1)).alias("interval"), F.col("error_count").cast("bigint").alias("error_count"),
        ts_text("next_fetch").alias("next_fetch"), "retired",
    )


SQL_SCHEDULER = f"""WITH RECURSIVE h AS (SELECT concat('u', user_id) AS url, user_id, ts, CASE event_type WHEN 'error' THEN 'FETCH_ERROR' ELSE 'FETCHED' END AS status,
   CASE WHEN event_type <> 'error' THEN CASE WHEN event_id % 5 < 4 THEN 'a' ELSE 'b' END END AS signature,
   CASE WHEN event_type = 'error' THEN 2880 WHEN user_id % 4 = 0 THEN -1 WHEN user_id % 4 = 1 THEN 720 ELSE 1440 END AS minutes,
   user_id % 2 = 0 AND event_id % 3 = 0 AS empty_map, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (
  SELECT DISTINCT url, 0::BIGINT AS n, CASE WHEN user_id % 3 = 0 THEN 'a' END AS sig, CASE WHEN user_id % 3 = 0 THEN TIMESTAMP '2023-12-20 00:00:00' END AS since,
    CASE WHEN user_id % 3 = 0 THEN 1000 END::BIGINT AS ival, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS errors,
    FALSE AS changed, FALSE AS retired, NULL::TIMESTAMP AS due FROM h
  UNION ALL
  SELECT x.url, x.n, x.sig2, x.since2, x.ival2, x.errors2, x.changed2, x.retired2,
    CASE WHEN x.ok THEN CASE WHEN x.retired2 OR x.base < 0 THEN NULL ELSE x.ts + to_minutes(x.ival2) END
         WHEN x.errors2 < 3 THEN x.ts + to_minutes(x.minutes) END
  FROM (SELECT y.*, CASE WHEN ok THEN 0 ELSE errors + 1 END AS errors2, CASE WHEN ok THEN signature ELSE sig END AS sig2,
      CASE WHEN ok AND base >= 0 THEN greatest(90, least(129600, CAST(trunc(round(base * CASE WHEN sig IS NULL THEN 1.0 WHEN chg THEN 0.8 ELSE 1.5 END, 6)) AS BIGINT))) ELSE ival END AS ival2,
      CASE WHEN ok AND base >= 0 AND (sig IS NULL OR chg OR since IS NULL) THEN date_trunc('millisecond', ts) ELSE since END AS since2,
      ok AND coalesce(chg, FALSE) AS changed2, ok AND empty_map AND coalesce(since < ts - INTERVAL {STALE} MINUTE, FALSE) AS retired2
    FROM (SELECT h.url, h.n, h.ts, h.signature, h.minutes, h.empty_map, h.status = 'FETCHED' AS ok, r.sig, r.since, r.ival, r.errors,
        coalesce(r.ival, h.minutes) AS base, r.sig IS NOT NULL AND r.sig <> h.signature AS chg
      FROM r JOIN h ON h.url = r.url AND h.n = r.n + 1) y) x)
SELECT url, coalesce(sig, '-') AS signature, changed, {sql_ts('since')} AS signature_change, CAST(coalesce(ival, -1) AS BIGINT) AS interval, CAST(errors AS BIGINT) AS error_count,
  {sql_ts('due')} AS next_fetch, retired FROM r WHERE n > 0"""

TTL = 6 * 3600


def q_purgatory_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-outs of every user's url; one passes when the last that passed is six hours ago."""
    handed = table(spark, sf, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), "event_id", F.col("ts").cast("timestamp").alias("emitted_at")
    )
    return _drain(spark, ST.purgatory_stream(_source(spark, handed, "handed", None), TTL)).select("url", "event_id")


SQL_PURGATORY_STREAM = f"""WITH RECURSIVE h AS (SELECT concat('u', user_id) AS url, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT url, n, event_id, ts AS last, TRUE AS passes FROM h WHERE n = 1
  UNION ALL SELECT h.url, h.n, h.event_id, CASE WHEN h.ts - r.last >= INTERVAL {TTL} SECOND THEN h.ts ELSE r.last END, h.ts - r.last >= INTERVAL {TTL} SECOND
  FROM r JOIN h ON h.url = r.url AND h.n = r.n + 1)
SELECT url, event_id FROM r WHERE passes"""


# --- the crawl step ---------------------------------------------------------------------------


def _crawl_stream(spark: SparkSession, sf: str, tries: int, warc: str | None = None) -> str:
    """The root of a status table that the crawl stream wrote; each further try replays all batches from a lost checkpoint."""
    root, rules = _new(spark, "status"), _rule_texts(spark)
    tables.write_snapshot(spark.createDataFrame([], STATUS), root)
    # two batches, each with a file for every task of a stage; records of one url meet in one file, so in one batch
    per_batch = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = _stored(spark, CQ._fetched(spark, sf), "fetched", 2 * per_batch, "url")
    for _ in range(tries):
        stream = spark.readStream.schema(FETCHED).option("maxFilesPerTrigger", per_batch).parquet(records)
        options = {"warc": {"path": warc, "prefix": "NEWS"}} if warc else {}
        _run(ST.crawl_step_stream(stream, root, _new(spark, "checkpoint"), ST.fixed_clock(NOW), SC.default_intervals(spark), rules, hours=CQ.HOURS, **options))
    return root


def _crawled(spark: SparkSession, root: str) -> DataFrame:
    done = F.col("status") != "DISCOVERED"
    return tables.read_status(spark, root).select(
        "url", "key", "status", F.when(done, ts_text("next_fetch")).otherwise("").alias("next_fetch"), F.when(done, CQ._flag("numLinks")).otherwise("-").alias("num_links")
    )


def q_crawl_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _crawled(spark, _crawl_stream(spark, sf, 1))


def q_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """All batches delivered twice leave what one delivery leaves."""
    return _crawled(spark, _crawl_stream(spark, sf, 2))


SQL_CRAWLED = f"""SELECT url, key, status, CASE WHEN status = 'DISCOVERED' THEN '' ELSE next_fetch END AS next_fetch,
  CASE WHEN status = 'DISCOVERED' THEN '-' ELSE num_links END AS num_links FROM ({CQ.SQL_CRAWL_STEP}) x"""


def q_articles_to_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of all batches, each batch delivered twice, read back from the files."""
    files = _new(spark, "warc")
    _crawl_stream(spark, sf, 2, files)
    out = read_warc(spark, files).filter("type = 'response'")
    return out.select("url", F.octet_length("content").cast("bigint").alias("n"), F.md5("content").alias("md5"))


SQL_ARTICLES = f"""WITH {RULES_SQL},{_URLS_SQL} SELECT url, octet_length(encode(html)) AS n, md5(html) AS md5 FROM pages
WHERE page_id % 5 IN (0, 1) AND url NOT IN (SELECT url FROM d_hits)"""


def q_write_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in many small files, one record a page, read back: size, digest and head."""
    files = _new(spark, "warc")
    pages = table(spark, sf, "pages").select("url", F.col("html").cast("binary").alias("content"), F.col("page_id"))
    none = F.lit(None).cast("string")
    rows = pages.select(
        "url", F.lit(NOW).cast("timestamp").alias("fetch_time"), F.lit(200).alias("http_status"), "content", none.alias("trimmed"), none.alias("request_headers"),
        F.concat(F.lit("HTTP/1.1 200 OK\nX-Page: "), F.col("page_id").cast("string")).alias("response_headers"),
    )
    write_warc(rows.repartition(3), files, "NEWS", "20240131000000", max_mb=0.1)
    out = read_warc(spark, files).filter("type = 'response'")
    return out.select(
        "url", F.octet_length("content").cast("bigint").alias("n"), F.md5("content").alias("md5"), F.regexp_extract("head", "X-Page: ([0-9]+)", 1).cast("bigint").alias("page_id"),
        (F.col("digest").startswith("sha1:") & (F.length("digest") == 37)).alias("digested"), F.col("date").alias("written"),
    )


SQL_WRITE_WARC = """SELECT url, octet_length(encode(html)) AS n, md5(html) AS md5, page_id, TRUE AS digested, '2024-01-31T00:00:00Z' AS written FROM pages"""


# --- other streams, readers, tables -----------------------------------------------------------


def q_metric_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics_table(spark, sf)
    out = _drain(spark, ST.metric_windows_stream(_source(spark, rows, "metrics"), "activethreads", "1 hour"), "complete")
    return out.select(ts_text("bucket").alias("bucket"), F.round("value", 8).alias("value"))


SQL_METRIC_STREAM = with_ctes("d_metrics") + f"""SELECT {sql_ts("date_trunc('hour', ts)")} AS bucket, round(avg(value), 8) AS value FROM d_metrics
WHERE name = 'activethreads' GROUP BY date_trunc('hour', ts)"""


def q_frontier_stream(spark: SparkSession, sf: str) -> DataFrame:
    """One tick asks the stored table what is due."""
    root, out = _new(spark, "status"), _new(spark, "due")
    tables.write_snapshot(status_table(spark, sf), root)
    ticks = _source(spark, spark.range(1), "ticks", 1)
    sink: Callable[[DataFrame, int], None] = lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")
    _run(ST.frontier_poll_stream(ticks, root, _new(spark, "checkpoint"), ST.fixed_clock(SQ.DUE), sink, every=None, per_bucket=5, max_buckets=100))
    due = spark.read.parquet(out)
    return due.select("key", "url", ts_text("next_fetch").alias("next_fetch"), F.col("rank").cast("bigint").alias("rank"))


def _seed_lines(spark: SparkSession, sf: str) -> str:
    n = F.col("page_id")
    line = F.concat("url", F.when(n % 3 == 0, "\tisFeed=true").otherwise(""), F.when(n % 4 == 0, "\ttag=a\ttag=b").otherwise(""))
    path = _new(spark, "seeds")
    table(spark, sf, "pages").select(F.when(n % 7 == 0, F.concat(F.lit("# "), line)).otherwise(line).alias("value")).repartition(2).write.text(path)
    return path


def _seeds_flat(df: DataFrame) -> DataFrame:
    return df.select("url", "status", CQ._flag("isFeed").alias("is_feed"), F.coalesce(F.array_join(F.try_element_at("metadata", F.lit("tag")), ","), F.lit("-")).alias("tags"))


def q_seed_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _seeds_flat(_drain(spark, ST.seed_stream(spark, _seed_lines(spark, sf), "*.txt")))


def q_read_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return _seeds_flat(read_seeds(spark, _seed_lines(spark, sf), "*.txt"))


SQL_SEEDS = """SELECT url, 'DISCOVERED' AS status, CASE WHEN page_id % 3 = 0 THEN 'true' ELSE '-' END AS is_feed,
  CASE WHEN page_id % 4 = 0 THEN 'a,b' ELSE '-' END AS tags FROM pages WHERE page_id % 7 <> 0"""


def _urls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url")


def q_rules_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = _new(spark, "kept")
    sink: Callable[[DataFrame, int], None] = lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")
    _run(ST.rules_stream_static_join(_source(spark, _urls(spark, sf), "urls"), _rule_texts(spark), _new(spark, "checkpoint"), sink))
    return spark.read.parquet(out).select("page_id", "url")


def q_refreshing_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rule texts of which half arrive between two batches: rules that each batch met, and meets again when another reader replays both."""
    path, versions = _new(spark, "rules"), _new(spark, "versions")
    texts = rule_texts(spark, sf)
    texts.filter("doc % 2 = 0").write.partitionBy("doc").text(path)
    first = R.RefreshingRules(spark, path, versions)
    seen = [("1", first.get(1).count())]
    texts.filter("doc % 2 = 1").write.mode("append").partitionBy("doc").text(path)
    seen.append(("2", first.get(2).count()))
    again = R.RefreshingRules(spark, path, versions)
    seen += [("1 again", again.get(1).count()), ("2 again", again.get(2).count())]
    return spark.createDataFrame(seen, "batch STRING, n BIGINT")


SQL_REFRESHING = _RULE_SQL + """SELECT batch, count(*) FILTER (every OR doc % 2 = 0) AS n
FROM d_parsed, (VALUES ('1', FALSE), ('2', TRUE), ('1 again', FALSE), ('2 again', TRUE)) AS v(batch, every) GROUP BY 1"""


def q_read_fetched(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched records written and read in their schema."""
    rows = read_fetched(spark, _stored(spark, CQ._fetched(spark, sf), "fetched"))
    assert rows.schema == spark.createDataFrame([], FETCHED).schema
    return rows.groupBy(F.col("http_status").cast("bigint").alias("http_status")).agg(F.count("*").alias("n"), F.sum(F.octet_length("content")).alias("bytes")).select("http_status", "n")


def q_init_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables used, then begun anew: what is in them behind that, and behind one more batch."""
    root = _new(spark, "tables")
    tables.init_tables(spark, root)
    rows = SQ._updates(spark, sf)
    tables.write_status(rows, f"{root}/status", 1)
    tables.init_tables(spark, root)
    empty = tables.read_status(spark, f"{root}/status").select("url")
    tables.write_status(rows.filter("status = 'FETCHED'"), f"{root}/status", 2)
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    return count(empty, "empty").unionByName(count(tables.read_status(spark, f"{root}/status"), "batch")).unionByName(count(tables.read_metrics(spark, f"{root}/metrics"), "metrics"))


SQL_INIT = f"""{SQ._UPDATES_SQL} SELECT 'empty' AS part, 0::BIGINT AS n UNION ALL SELECT 'batch', count(DISTINCT url) FROM u0 WHERE status = 'FETCHED'
UNION ALL SELECT 'metrics', 0"""


QUERIES: dict[str, tuple] = {
    "scheduler_state_stream": (q_scheduler, SQL_SCHEDULER),
    "purgatory_stream": (q_purgatory_stream, SQL_PURGATORY_STREAM),
    "crawl_step_stream": (q_crawl_stream, SQL_CRAWLED),
    "stream_delivery": (q_delivery, SQL_CRAWLED),
    "write_warc": (q_write_warc, SQL_WRITE_WARC),
    "articles_to_warc": (q_articles_to_warc, SQL_ARTICLES),
    "metric_windows_stream": (q_metric_stream, SQL_METRIC_STREAM),
    "frontier_poll_stream": (q_frontier_stream, SQ.SQL_DUE),
    "seed_stream": (q_seed_stream, SQL_SEEDS),
    "read_seeds_files": (q_read_seeds, SQL_SEEDS),
    "rules_stream_static_join": (q_rules_stream, f"WITH {RULES_SQL},{_URLS_SQL} SELECT page_id, url FROM d_u WHERE url NOT IN (SELECT url FROM d_hits)"),
    "refreshing_rules": (q_refreshing_rules, SQL_REFRESHING),
    "read_fetched_files": (q_read_fetched, CQ.SQL_READ_FETCHED),
    "init_tables": (q_init_tables, SQL_INIT),
}

"""Derived inputs of the registered queries.

The SELECT texts run unchanged on Spark and on the checking engine; documents built from them
(sitemaps, indexes, feeds) exist on the Spark side only, and the rows they were built from are what an
extractor has to give back. Documents are cut into chunks of bounded size, as the protocols demand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.schemas import META
from crawlframe.functions.urls import url_id

NOW = "2024-01-31 00:00:00"

NEWS_NS = "http://www.google.com/schemas/sitemap-news/0.9"
MAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
ATOM_NS = "http://www.w3.org/2005/Atom"

D_STATUS = """
SELECT concat('https://h', CAST(user_id AS STRING), '.example.', CASE WHEN user_id % 3 = 0 THEN 'org' ELSE 'com' END,
              '/a/', CAST(event_id AS STRING)) AS url,
       concat('h', CAST(user_id AS STRING), '.example.', CASE WHEN user_id % 3 = 0 THEN 'org' ELSE 'com' END) AS key,
       CASE event_type WHEN 'view' THEN 'FETCHED' WHEN 'click' THEN 'DISCOVERED'
            WHEN 'purchase' THEN 'REDIRECTION' WHEN 'error' THEN 'FETCH_ERROR' ELSE 'ERROR' END AS status,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS next_fetch,
       CASE WHEN event_id % 5 = 0 THEN 'true' END AS is_feed,
       CASE WHEN event_id % 7 = 0 THEN 'true' WHEN event_id % 7 = 1 THEN 'false' END AS is_sitemap,
       CASE WHEN event_id % 14 = 0 THEN '0' WHEN event_id % 7 = 0 THEN '5' END AS num_links,
       CASE WHEN event_id % 4 <> 3 THEN ts END AS signature_change,
       event_id, user_id, value
FROM events
"""

D_METRICS = """
SELECT ts, CASE event_type WHEN 'view' THEN 'activethreads' WHEN 'click' THEN 'num_queues'
            WHEN 'purchase' THEN 'fetcher_counter.fetched' WHEN 'error' THEN 'in_queues'
            ELSE 'fetcher_counter.bytes_fetched' END AS name,
       CAST(user_id % 8 AS SMALLINT) AS src_task, concat('w', CAST(user_id % 3 AS STRING)) AS src_host,
       CASE WHEN event_id % 4 = 0 THEN '__system' ELSE concat('c', CAST(event_id % 9 AS STRING)) END AS src_component,
       value
FROM events
"""

D_HOST_PAGES = """
SELECT page_id, url, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 2) AS host,
       regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 3) AS path, html
FROM pages
"""

# 40 pages of a host make one sitemap, 800 one index: bounded whatever the size of the host
D_SITEMAP_ROWS = f"""
SELECT concat('https://', host, '/sitemap-', CAST(CAST(floor(page_id / 40) AS BIGINT) AS STRING), '.xml') AS parent_url,
       concat('https://', host, '/index-', CAST(CAST(floor(page_id / 800) AS BIGINT) AS STRING), '.xml') AS index_url,
       page_id AS pos, replace(url, '&', '&amp;') AS loc_xml, url AS loc,
       concat('2024-01-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0')) AS lastmod,
       CASE WHEN page_id % 3 = 0 THEN concat('2024-01-', lpad(CAST(1 + (page_id * 7) % 28 AS STRING), 2, '0')) END AS news_date,
       CASE WHEN page_id % 4 = 0 THEN concat('https://', host, '/alt/', CAST(page_id AS STRING))
            WHEN page_id % 4 = 1 THEN url END AS alt
FROM ({D_HOST_PAGES}) hp
"""

D_FEED_ROWS = """
SELECT concat('https://', source, '.example.com/feed-', CAST(CAST(floor(doc_id / 50) AS BIGINT) AS STRING), '.xml') AS parent_url,
       doc_id AS pos,
       concat('https://', source, '.example.com/d/', CAST(doc_id AS STRING)) AS link,
       concat(lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'), ' Jan 2024 ', lpad(CAST(doc_id % 24 AS STRING), 2, '0'), ':00:00 +0000') AS rfc822,
       concat('2024-01-', lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'), ' ', lpad(CAST(doc_id % 24 AS STRING), 2, '0'), ':00:00') AS published
FROM documents
"""

D_HEADS = """
SELECT page_id, url, replace(html, '<head>', concat('<head>',
         CASE WHEN page_id % 2 = 0 THEN concat('<link rel="alternate" type="application/rss+xml" href="/feed/', CAST(page_id AS STRING), '.xml">') ELSE '' END,
         CASE WHEN page_id % 5 = 0 THEN concat('<link rel="canonical" href="https://c.example.com/', CAST(page_id AS STRING), '">') ELSE '' END)) AS html
FROM pages
"""

# pages behind a marker of every document kind, pushed back by padding of one- and two-byte letters
D_BODIES = f"""
SELECT page_id, url,
       concat(repeat(CASE WHEN page_id % 2 = 0 THEN ' ' ELSE 'é' END, CAST((page_id * 37) % 1300 AS INT)),
              CASE page_id % 9
                WHEN 0 THEN '<urlset xmlns="{MAP_NS}" xmlns:news="{NEWS_NS}">'
                WHEN 1 THEN '<sitemapindex xmlns="{MAP_NS}">'
                WHEN 2 THEN '<urlset xmlns="{MAP_NS}">'
                WHEN 3 THEN '<rss version="2.0" xmlns:sitemap="{MAP_NS}">'
                WHEN 4 THEN '<feed xmlns="{ATOM_NS}">'
                WHEN 5 THEN '<sitemapindex xmlns:news="{NEWS_NS}">'
                WHEN 6 THEN '<urlset xmlns="http://www.google.com/schemas/sitemap/0.84">'
                ELSE '' END, html) AS body,
       CASE page_id % 6 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/rss+xml; charset=utf-8' WHEN 2 THEN ''
                        WHEN 3 THEN 'application/octet-stream' WHEN 4 THEN 'text/xml' END AS content_type,
       CASE WHEN page_id % 4 = 0 THEN 'true' WHEN page_id % 4 = 1 THEN 'false' END AS was_news,
       CASE WHEN page_id % 5 = 0 THEN 'TRUE' END AS was_index,
       CASE WHEN page_id % 7 = 0 THEN 'true' END AS was_verified,
       CASE WHEN page_id % 3 = 0 THEN 'true' END AS was_sitemap
FROM pages
"""

# spellings of page URLs: user-info, ports, upper case, blanks, mangled queries, repeated elements, bad schemes
D_URL_FORMS = f"""
SELECT page_id,
       CASE page_id % 12
         WHEN 0 THEN url
         WHEN 1 THEN concat('HTTP://', upper(host), ':80', path)
         WHEN 2 THEN concat('https://user:pw@', host, ':8443', path, '?q=', CAST(page_id AS STRING), '#f')
         WHEN 3 THEN concat('https://', host, ':443', path, '&a=1&b=2')
         WHEN 4 THEN concat('http://', host)
         WHEN 5 THEN concat('http://', host, '/a/a/a', path, '/a')
         WHEN 6 THEN concat('https://', host, path, ' ', CAST(page_id AS STRING))
         WHEN 7 THEN concat('ftp://', host, path)
         WHEN 8 THEN concat('https://10.0.', CAST(page_id % 256 AS STRING), '.7', path)
         WHEN 9 THEN concat('https://', host, path, '.JPG?x=1')
         WHEN 10 THEN concat(host, path)
         ELSE concat('http://h_', CAST(page_id % 9 AS STRING), '.', host, path, '?') END AS url,
       host, path
FROM ({D_HOST_PAGES}) hp
"""

# one rule text per 50 pages: sections, comments, rules of every kind, lines that must be skipped
D_RULE_LINES = f"""
SELECT CAST(floor(page_id / 50) AS BIGINT) AS doc, page_id, host, path,
       CASE WHEN page_id % 3 = 0 THEN 'Domain' ELSE 'Host' END AS scope_word,
       CASE page_id % 6
         WHEN 0 THEN concat('  DenyPath ', path)
         WHEN 1 THEN '  DenyPath .*'
         WHEN 2 THEN concat('  DenyPathQuery [?&]page=', CAST(page_id % 5 AS STRING), '  # comment')
         WHEN 3 THEN '  DenyPath (unclosed'
         WHEN 4 THEN '  AllowPath /x'
         ELSE '# DenyPath /all' END AS rule_line
FROM ({D_HOST_PAGES}) hp
"""


def with_ctes(*names: str) -> str:
    """A WITH clause of the named derived tables for the checking engine."""
    parts = []
    for name in names:
        parts.append(f"{name} AS ({globals()[name.upper()]})")
    return "WITH " + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table on the Spark side, from the same text."""
    sql = globals()[name.upper()]
    for source in ("events", "pages", "documents"):
        sql = sql.replace(f"FROM {source}\n", f"FROM parquet.`{sf_dir}/{source}.parquet`\n")
    return spark.sql(sql)


def _meta(**cells: Column) -> Column:
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in cells.items()])
    present = F.filter(pairs, lambda p: p["v"].isNotNull())
    return F.map_from_entries(
        F.transform(present, lambda p: F.struct(p["k"].alias("key"), F.array(p["v"]).alias("value")))
    ).cast(META)


def status_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status table in its canonical schema."""
    d = derived(spark, sf_dir, "d_status")
    change = F.date_format("signature_change", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    meta = _meta(
        isFeed=F.col("is_feed"),
        isSitemap=F.col("is_sitemap"),
        numLinks=F.col("num_links"),
        signatureChangeDate=change,
    )
    return d.select(
        "url", url_id(F.col("url")).alias("url_id"), "key", "status", F.col("next_fetch").cast("timestamp").alias("next_fetch"), meta.alias("metadata")
    )


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "d_metrics").withColumn("ts", F.col("ts").cast("timestamp"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched records of every kind: ``page_id, url, content, content_type, metadata``."""
    d = derived(spark, sf_dir, "d_bodies")
    meta = _meta(
        isSitemapNews=F.col("was_news"),
        isSitemapIndex=F.col("was_index"),
        isSitemapVerified=F.col("was_verified"),
        isSitemap=F.col("was_sitemap"),
    )
    return d.select("page_id", "url", F.col("body").cast("binary").alias("content"), "content_type", meta.alias("metadata"))


def _xml_escape(text: Column) -> Column:
    return F.replace(text, F.lit("&"), F.lit("&amp;"))


def sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News sitemaps of at most 40 entries each: ``url, content``."""
    rows = derived(spark, sf_dir, "d_sitemap_rows")
    entry = F.concat(
        F.lit("<url><loc>"), F.col("loc_xml"), F.lit("</loc><lastmod>"), F.col("lastmod"), F.lit("</lastmod>"),
        F.coalesce(F.concat(F.lit("<news:news><news:publication_date>"), F.col("news_date"), F.lit("</news:publication_date></news:news>")), F.lit("")),
        F.coalesce(F.concat(F.lit('<xhtml:link rel="alternate" href="'), _xml_escape(F.col("alt")), F.lit('"/>')), F.lit("")),
        F.lit("</url>"),
    )
    entries = F.array_sort(F.collect_list(F.struct(F.col("pos"), entry.alias("x"))))
    body = F.concat(
        F.lit(f'<?xml version="1.0"?><urlset xmlns="{MAP_NS}" xmlns:news="{NEWS_NS}" xmlns:xhtml="http://www.w3.org/1999/xhtml">'),
        F.array_join(F.transform(entries, lambda e: e["x"]), ""),
        F.lit("</urlset>"),
    )
    return rows.groupBy(F.col("parent_url").alias("url")).agg(body.cast("binary").alias("content"))


def index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap indexes of at most 20 children each: ``url, content``."""
    rows = derived(spark, sf_dir, "d_sitemap_rows")
    # a child is as fresh as its freshest entry
    children = rows.groupBy("index_url", "parent_url").agg(F.max("lastmod").alias("lastmod"), F.min("pos").alias("pos"))
    child = F.concat(F.lit("<sitemap><loc>"), F.col("parent_url"), F.lit("</loc><lastmod>"), F.col("lastmod"), F.lit("</lastmod></sitemap>"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("pos"), child.alias("x"))))
    body = F.concat(
        F.lit(f'<?xml version="1.0"?><sitemapindex xmlns="{MAP_NS}">'),
        F.array_join(F.transform(listed, lambda e: e["x"]), ""),
        F.lit("</sitemapindex>"),
    )
    return children.groupBy(F.col("index_url").alias("url")).agg(body.cast("binary").alias("content"))


def feed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS documents of at most 50 items each: ``url, content``."""
    rows = derived(spark, sf_dir, "d_feed_rows")
    item = F.concat(
        F.lit("<item><title>t</title><link>"), F.col("link"), F.lit("</link><pubDate>Mon, "), F.col("rfc822"), F.lit("</pubDate></item>")
    )
    items = F.array_sort(F.collect_list(F.struct(F.col("pos"), item.alias("x"))))
    body = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>'),
        F.array_join(F.transform(items, lambda e: e["x"]), ""),
        F.lit("</channel></rss>"),
    )
    return rows.groupBy(F.col("parent_url").alias("url")).agg(body.cast("binary").alias("content"))


def head_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "d_heads").select("page_id", "url", F.col("html").cast("binary").alias("content"))


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule texts of at most 50 sections each: ``doc, text``. Every text opens with a rule outside any section."""
    rows = derived(spark, sf_dir, "d_rule_lines")
    pair = F.concat_ws("\n", F.concat_ws(" ", "scope_word", "host"), F.col("rule_line"), F.lit(""))
    lines = F.array_sort(F.collect_list(F.struct("page_id", pair.alias("x"))))
    text = F.concat(F.lit("  DenyPath /orphan\nHost\n"), F.array_join(F.transform(lines, lambda e: e["x"]), "\n"))
    return rows.groupBy("doc").agg(text.alias("text"))


def ts_text(c: Column | str) -> Column:
    """Timestamps as text, so both engines compare the same thing; missing = empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def sql_ts(c: str) -> str:
    return f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')"

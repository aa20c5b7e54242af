"""Registered queries on document bodies: detection, extraction, whole crawl steps."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from crawlframe.catalog.fixtures import (
    ATOM_NS,
    MAP_NS,
    NEWS_NS,
    NOW,
    bodies,
    derived,
    feed_docs,
    head_docs,
    index_docs,
    sitemap_docs,
    table,
    ts_text,
    with_ctes,
)
from crawlframe.catalog.url_queries import RULES_SQL, _robots_texts, _rules, _URLS_SQL
from crawlframe.functions import content as C
from crawlframe.functions import metadata as M
from crawlframe.functions.dates import parse_date_lenient, recently_modified
from crawlframe.operators import extract as X
from crawlframe.operators import schedule as SC
from crawlframe.operators import upsert as UP
from crawlframe.operators.filtering import filter_outlinks
from crawlframe.plans import crawl, profiles
from crawlframe.schemas import FETCHED

HOURS = 240
CUT = "TIMESTAMP '2024-01-21 00:00:00'"
NEWS_HTTPS = "https://www.google.com/schemas/sitemap-news/0.9"


def _hex_find(text: str, clue: str, n: int) -> str:
    """SQL: the clue's bytes occur in the first n bytes."""
    return f"regexp_matches(hex(encode({text})[1:{n}]), '^(..)*{clue.encode().hex().upper()}')"


def _any(text: str, clues, n: int) -> str:
    return "(" + " OR ".join(_hex_find(text, c, n) for c in clues) + ")"


_NEWS = _any("body", C.NEWS_NAMESPACES, 1024)
_INDEX = _hex_find("body", "<sitemapindex", 1024)
_MAP = _any("body", (MAP_NS, *C.LEGACY_NAMESPACES), 1024)
_FEED_1024 = _any("body", ("<rss", "<feed", ATOM_NS), 1024)
_FEED_512 = _any("body", ("<rss", "<feed", ATOM_NS), 512)
_TYPE = f"CASE WHEN {_FEED_1024} THEN NULL WHEN {_NEWS} THEN 'NEWS' WHEN {_INDEX} THEN 'INDEX' WHEN {_MAP} THEN 'SITEMAP' END"
_BY_TYPE = "coalesce(contains(content_type, 'rss+xml') OR contains(content_type, 'atom+xml') OR contains(content_type, 'text/rss'), FALSE)"
B = with_ctes("d_bodies")


def _content() -> F.Column:
    return F.col("content")


def q_first_clue(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    groups = [("</title>", "ê"), ("</title>",), ("<script>",)]
    return pages.select("page_id", C.first_clue_match(_content(), groups, 140).cast("bigint").alias("match"))


SQL_FIRST_CLUE = f"""SELECT page_id, CAST(CASE WHEN {_hex_find('html', '</title>', 140)} AND {_hex_find('html', 'ê', 140)} THEN 0
  WHEN {_hex_find('html', '</title>', 140)} THEN 1 WHEN {_hex_find('html', '<script>', 140)} THEN 2 ELSE -1 END AS BIGINT) AS match FROM pages"""


def q_sitemap_type(spark: SparkSession, sf: str) -> DataFrame:
    return bodies(spark, sf).select("page_id", F.coalesce(C.detect_sitemap_type(_content()), F.lit("-")).alias("type"))


def q_detect_feed(spark: SparkSession, sf: str) -> DataFrame:
    flagged = F.col("page_id") % 11 == 0
    return bodies(spark, sf).select("page_id", C.detect_feed(F.col("content_type"), _content(), flagged).alias("is_feed"))


def q_detect_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("metadata")
    flags = C.detect_sitemap_bootstrap(_content(), M.meta_true(m, "isSitemap"), M.meta_true(m, "isSitemapNews"))
    return bodies(spark, sf).select("page_id", flags.alias("f")).select("page_id", "f.is_sitemap", "f.is_news")


_WAS_S, _WAS_N = "coalesce(was_sitemap = 'true', FALSE)", "coalesce(was_news = 'true', FALSE)"
SQL_BOOT = f"""{B} SELECT page_id, {_WAS_S} OR (NOT ({_WAS_S} AND {_WAS_N}) AND ({_NEWS} OR {_INDEX} OR {_MAP})) AS is_sitemap,
  {_WAS_N} OR (NOT ({_WAS_S} AND {_WAS_N}) AND {_NEWS}) AS is_news FROM d_bodies"""

# the flag table: news / index / verified before, type found, what is left and what happens next
_FLAGS = f"""{B}, t AS (SELECT *, coalesce({_TYPE}, '') AS type, {_WAS_N} AS n, coalesce(lower(was_index) = 'true', FALSE) AS i,
   coalesce(was_verified = 'true', FALSE) AS v, {_WAS_S} AS s, coalesce(content_type, '') AS ct FROM d_bodies),
a AS (SELECT *, CASE type WHEN 'NEWS' THEN TRUE WHEN 'INDEX' THEN FALSE WHEN 'SITEMAP' THEN CASE WHEN v THEN n ELSE FALSE END ELSE n END AS n2,
   CASE type WHEN 'INDEX' THEN TRUE WHEN 'SITEMAP' THEN CASE WHEN v THEN i ELSE FALSE END ELSE i END AS i2 FROM t),
f AS (SELECT *, CASE WHEN n2 OR i2 OR v THEN 'parse' WHEN type <> '' OR s THEN 'fetched' ELSE 'pass' END AS action,
   CASE WHEN type = 'NEWS' THEN 'true' WHEN n AND NOT n2 THEN 'false' ELSE coalesce(was_news, '-') END AS m_news,
   CASE WHEN type = 'INDEX' THEN 'true' WHEN i AND NOT i2 THEN 'false' ELSE coalesce(was_index, '-') END AS m_index FROM a),
g AS (SELECT *, CASE WHEN action = 'parse' THEN '-' WHEN type <> '' THEN 'true' ELSE coalesce(was_sitemap, '-') END AS m_sitemap FROM f)
"""


def _flag(name: str):
    return F.coalesce(M.meta_first(F.col("metadata"), name), F.lit("-"))


def q_resolve_flags(spark: SparkSession, sf: str) -> DataFrame:
    f = C.resolve_sitemap_flags(F.col("metadata"), C.detect_sitemap_type(_content()))
    rows = bodies(spark, sf).select("page_id", f.alias("f")).select("page_id", "f.action", F.col("f.metadata").alias("metadata"))
    return rows.select(
        "page_id", "action", _flag("isSitemap").alias("m_sitemap"), _flag("isSitemapNews").alias("m_news"), _flag("isSitemapIndex").alias("m_index")
    )


def q_route_fetched(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.route_fetched(bodies(spark, sf)).select("page_id", "branch", _flag("isFeed").alias("is_feed"))


SQL_ROUTE = f"""{_FLAGS}, r AS (SELECT page_id, CASE action WHEN 'parse' THEN 'sitemap' WHEN 'fetched' THEN 'plain_sitemap'
   ELSE CASE WHEN {_BY_TYPE} OR {_FEED_512} THEN 'feed' ELSE 'article' END END AS branch FROM g)
SELECT page_id, branch, CASE WHEN branch = 'feed' THEN 'true' ELSE '-' END AS is_feed FROM r"""


def q_parse_mode(spark: SparkSession, sf: str) -> DataFrame:
    return bodies(spark, sf).select("page_id", C.sitemap_parse_mode(F.col("content_type")).alias("mode"))


def q_namespace_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Roots with accepted, missing and foreign namespaces around the page."""
    n = F.col("page_id") % 5
    root = (
        F.when(n == 0, F.lit(f'<?xml version="1.0"?><urlset xmlns="{MAP_NS}">'))
        .when(n == 1, F.lit("<!-- c --><urlset>"))
        .when(n == 2, F.lit('<urlset xmlns="http://other.example/ns">'))
        .when(n == 3, F.lit(f'<s:urlset xmlns:s="{MAP_NS}">'))
        .otherwise(F.lit(f"<urlset a='b' xmlns = '{NEWS_NS}'>"))
    )
    rows = table(spark, sf, "pages").select("page_id", F.concat(root, F.col("html")).cast("binary").alias("content"))
    return rows.select("page_id", C.namespace_guard(_content()).alias("accepted"))


def q_trim_content(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select("page_id", C.trim_content(F.col("html").cast("binary"), 2000).alias("t"))
    return rows.select("page_id", F.octet_length("t.content").cast("bigint").alias("n"), F.md5("t.content").alias("md5"), F.col("t.trimmed"))


SQL_TRIM = """SELECT page_id, CAST(least(2000, octet_length(encode(html))) AS BIGINT) AS n, md5(encode(html)[1:2000]) AS md5,
  octet_length(encode(html)) > 2000 AS trimmed FROM pages"""


def q_signature(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    m = C.with_signature(F.when(F.col("doc_id") % 2 == 0, M.meta_of(signature="before")).otherwise(M.empty_meta()), _content())
    return d.select("doc_id", m.alias("metadata")).select(
        "doc_id", _flag("signature").alias("signature"), _flag("signatureOld").alias("signature_old")
    )


def q_signature_change(spark: SparkSession, sf: str) -> DataFrame:
    """Stored signatures of the documents, two of three of them still right."""
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("https://d.example/"), F.col("doc_id").cast("string")).alias("url"), "text")
    stored = d.filter("doc_id % 4 <> 3").select(
        "url", M.meta_of(signature=F.when(F.col("doc_id") % 3 == 0, "stale").otherwise(F.md5(F.col("text").cast("binary")))).alias("metadata")
    )
    out = UP.signature_change(d.select("url", F.col("text").cast("binary").alias("content")), stored)
    return out.select("url", "signature", F.coalesce("signature_old", F.lit("-")).alias("signature_old"), "changed")


SQL_SIG_CHANGE = """SELECT concat('https://d.example/', doc_id) AS url, md5(text) AS signature,
  CASE WHEN doc_id % 4 = 3 THEN '-' WHEN doc_id % 3 = 0 THEN 'stale' ELSE md5(text) END AS signature_old, doc_id % 4 = 3 OR doc_id % 3 = 0 AS changed FROM documents"""


def q_parse_date(spark: SparkSession, sf: str) -> DataFrame:
    """Every date shape, built from the events' times."""
    ts, n = F.col("ts"), F.col("event_id") % 8
    text = (
        F.when(n == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(n == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'"))
        .when(n == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(n == 3, F.concat(F.lit("Mon, "), F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" -0500")))
        .when(n == 4, F.concat(F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(n == 5, F.date_format(ts, "yyyy"))
        .when(n == 6, F.lit("yesterday-ish"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    )
    return table(spark, sf, "events").select("event_id", ts_text(parse_date_lenient(text)).alias("ts"))


SQL_PARSE_DATE = """SELECT event_id, coalesce(strftime(CASE event_id % 8 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts)
  WHEN 2 THEN ts - INTERVAL 2 HOUR WHEN 3 THEN ts + INTERVAL 5 HOUR WHEN 4 THEN ts WHEN 5 THEN date_trunc('year', ts) WHEN 6 THEN NULL ELSE ts END,
  '%Y-%m-%d %H:%M:%S'), '') AS ts FROM events"""


def q_recent(spark: SparkSession, sf: str) -> DataFrame:
    d = derived(spark, sf, "d_status")
    return d.select("url", recently_modified(F.col("next_fetch").cast("timestamp"), NOW, HOURS).alias("recent"))


# --- extraction -------------------------------------------------------------------------------


def q_sitemap_urls(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract_sitemap_urls(sitemap_docs(spark, sf), NOW, HOURS).select("parent_url", "url", "status", _flag("isSitemap").alias("is_sitemap"))


_KEPT = f"CAST(lastmod AS TIMESTAMP) >= {CUT} AND (news_date IS NULL OR CAST(news_date AS TIMESTAMP) >= {CUT})"
R = with_ctes("d_sitemap_rows")
_LINKS = f"""SELECT parent_url, alt AS url, pos, 0 AS k FROM d_sitemap_rows WHERE {_KEPT} AND alt IS NOT NULL AND alt <> loc
  UNION ALL SELECT parent_url, loc, pos, 1 FROM d_sitemap_rows WHERE {_KEPT}"""
SQL_SITEMAP_URLS = f"{R} SELECT parent_url, url, 'DISCOVERED' AS status, 'false' AS is_sitemap FROM ({_LINKS}) x"


def q_sitemap_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Position of every link within its document."""
    links = X.extract_sitemap_urls(sitemap_docs(spark, sf), NOW, HOURS)
    return links.select("parent_url", "url", F.col("url_pos").cast("bigint").alias("url_pos"), F.col("link_pos").cast("bigint").alias("link_pos"))


SQL_POSITIONS = f"""{R}, p AS (SELECT *, row_number() OVER (PARTITION BY parent_url ORDER BY pos) - 1 AS i FROM d_sitemap_rows)
SELECT parent_url, alt AS url, CAST(i AS BIGINT) AS url_pos, CAST(0 AS BIGINT) AS link_pos FROM p WHERE {_KEPT} AND alt IS NOT NULL AND alt <> loc
UNION ALL SELECT parent_url, loc, i, CASE WHEN alt IS NOT NULL AND alt <> loc THEN 1 ELSE 0 END FROM p WHERE {_KEPT}"""


def q_alternates(spark: SparkSession, sf: str) -> DataFrame:
    parsed = X.parse_sitemap(sitemap_docs(spark, sf)).select("url", F.explode("entries").alias("e"))
    return parsed.select(F.col("url").alias("parent_url"), F.explode(X.extract_alternates(F.col("e"))).alias("url"))


def q_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cut off inside their last entry: all entries before it are still there."""
    cut = F.expr("substring(content, 1, octet_length(content) - 20)")
    docs = sitemap_docs(spark, sf).withColumn("content", cut)
    parsed = X.parse_sitemap(docs)
    return parsed.select(F.col("url").alias("parent_url"), "ok", F.explode("entries.loc").alias("url"))


SQL_PARTIAL = f"""{R}, p AS (SELECT *, row_number() OVER (PARTITION BY parent_url ORDER BY pos DESC) AS back FROM d_sitemap_rows)
SELECT parent_url, TRUE AS ok, loc AS url FROM p WHERE back > 1"""


def q_sitemap_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.extract_sitemap_index(index_docs(spark, sf), NOW, HOURS)
    return rows.select("parent_url", "url", F.coalesce("delay", F.lit(0)).cast("bigint").alias("delay"), _flag("isSitemap").alias("is_sitemap"))


_CHILDREN = f"""{R}, c AS (SELECT index_url, parent_url, max(lastmod) AS lastmod, min(pos) AS pos FROM d_sitemap_rows GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY index_url ORDER BY pos) - 1 AS n FROM c WHERE CAST(lastmod AS TIMESTAMP) >= {CUT})"""
SQL_INDEX = f"{_CHILDREN} SELECT index_url AS parent_url, parent_url AS url, CAST(n * 15 AS BIGINT) AS delay, 'true' AS is_sitemap FROM k"


def q_stagger(spark: SparkSession, sf: str) -> DataFrame:
    """Links of the sitemaps staggered per document."""
    links = X.extract_sitemap_urls(sitemap_docs(spark, sf), NOW, HOURS)
    return X.stagger_subsitemaps(links, 15).select("parent_url", "url", F.coalesce("delay", F.lit(0)).cast("bigint").alias("delay"))


SQL_STAGGER = f"{R} SELECT parent_url, url, CAST((row_number() OVER (PARTITION BY parent_url ORDER BY pos, k) - 1) * 15 AS BIGINT) AS delay FROM ({_LINKS}) x"


def q_link_stats(spark: SparkSession, sf: str) -> DataFrame:
    return X.sitemap_link_stats(sitemap_docs(spark, sf), NOW, HOURS)


SQL_LINK_STATS = f"""{R} SELECT parent_url, count(*) AS links_found, count(*) FILTER (NOT ({_KEPT})) AS links_skipped,
  CAST(coalesce(sum(CASE WHEN {_KEPT} THEN 1 + CASE WHEN alt IS NOT NULL AND alt <> loc THEN 1 ELSE 0 END ELSE 0 END), 0) AS BIGINT) AS links_kept
FROM d_sitemap_rows GROUP BY parent_url"""


def q_inherit_verified(spark: SparkSession, sf: str) -> DataFrame:
    links = X.extract_sitemap_urls(sitemap_docs(spark, sf), NOW, HOURS)
    parents = derived(spark, sf, "d_sitemap_rows").groupBy("parent_url").agg(
        (F.min("pos") % 2 == 0).alias("is_index"), (F.min("pos") % 3 == 0).alias("is_verified")
    )
    out = X.inherit_verified(links, parents)
    return out.select("parent_url", "url", _flag("isSitemap").alias("is_sitemap"), _flag("isSitemapVerified").alias("verified"))


SQL_INHERIT = f"""{R}, l AS ({_LINKS}), p AS (SELECT parent_url, min(pos) AS m FROM d_sitemap_rows GROUP BY 1)
SELECT l.parent_url, l.url, CASE WHEN m % 2 = 0 THEN 'true' ELSE 'false' END AS is_sitemap, CASE WHEN m % 6 = 0 THEN 'true' ELSE '-' END AS verified
FROM l JOIN p ON p.parent_url = l.parent_url"""


def q_feed_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.extract_feed_links(feed_docs(spark, sf), NOW, HOURS)
    return rows.select("parent_url", "url", ts_text("published").alias("published"), "status")


SQL_FEED = with_ctes("d_feed_rows") + f"SELECT parent_url, link AS url, published, 'DISCOVERED' AS status FROM d_feed_rows WHERE CAST(published AS TIMESTAMP) >= {CUT}"


def q_autodiscovery(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.extract_feed_autodiscovery(head_docs(spark, sf))
    return rows.select("parent_url", "url", "status", _flag("isFeed").alias("is_feed"))


SQL_AUTODISCOVERY = with_ctes("d_host_pages") + """SELECT url AS parent_url,
  concat(regexp_extract(url, '^([a-z]+)://', 1), '://', host, '/feed/', page_id, '.xml') AS url, 'DISCOVERED' AS status, 'true' AS is_feed
FROM d_host_pages WHERE page_id % 2 = 0"""


def q_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract_canonical(head_docs(spark, sf))


def q_html_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("url", F.col("html").cast("binary").alias("content"))
    return X.extract_html_links(pages).select("parent_url", "href")


def q_discover_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.discover_sitemaps(_robots_texts(spark, sf))
    return rows.select("key", F.col("pos").cast("bigint").alias("pos"), "url", "status", _flag("isSitemap").alias("is_sitemap"))


SQL_DISCOVER = with_ctes("d_host_pages") + """, h AS (SELECT DISTINCT host FROM d_host_pages)
SELECT host AS key, CAST(0 AS BIGINT) AS pos, concat('https://', host, '/sm.xml') AS url, 'DISCOVERED' AS status, 'true' AS is_sitemap FROM h
UNION ALL SELECT host, 1, concat('https://', host, '/sm2.xml'), 'DISCOVERED', 'true' FROM h"""


def q_filter_outlinks(spark: SparkSession, sf: str) -> DataFrame:
    """Sitemap links through the production chain and the pre-fetch rules."""
    links = X.extract_sitemap_urls(sitemap_docs(spark, sf), NOW, HOURS)
    chain = [*profiles.production(), *profiles.pre_fetch(_rules(spark))]
    return filter_outlinks(links, chain).select("parent_url", "url")


SQL_FILTER_OUTLINKS = f"""{R}, l AS ({_LINKS}), z AS (SELECT parent_url, CASE WHEN regexp_matches(u, '^[a-z]+://[^/?]*$') THEN concat(u, '/') ELSE u END AS url
  FROM (SELECT parent_url, regexp_extract(url, '^[^#]*') AS u FROM l) q),
{RULES_SQL}, {_URLS_SQL.strip().replace("page_id, url, regexp", "parent_url, url, regexp").replace("FROM pages)", "FROM z)")}
SELECT parent_url, url FROM d_u WHERE url NOT IN (SELECT url FROM d_hits)"""


# --- whole steps ------------------------------------------------------------------------------


def _disguised(spark: SparkSession, sf: str) -> DataFrame:
    """Sitemaps as they also come: compressed ones (every second), and feeds under a sitemap's stale flag."""
    packed = F.arrow_udf(lambda bodies: pa.array([gzip.compress(b, mtime=0) for b in bodies.to_pylist()], pa.binary()), BinaryType())
    every = F.pmod(F.crc32(F.encode("url", "utf-8")), F.lit(2)) == 0
    maps = sitemap_docs(spark, sf)
    maps = maps.withColumn("content", F.when(every, packed("content")).otherwise(F.col("content")))
    return maps.unionByName(feed_docs(spark, sf))


def q_disguised_urls(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract_sitemap_urls(_disguised(spark, sf), NOW, HOURS).select("parent_url", "url", _flag("isSitemap").alias("is_sitemap"))


SQL_DISGUISED_URLS = f"""{R.strip()}, {with_ctes('d_feed_rows')[5:].strip()}
SELECT parent_url, url, 'false' AS is_sitemap FROM ({_LINKS}) x
UNION ALL SELECT parent_url, link, 'false' FROM d_feed_rows WHERE CAST(published AS TIMESTAMP) >= {CUT}"""


def q_sitemap_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Plain-text sitemaps, a URL a line, some lines no URL; where the media type says XML they are no sitemaps."""
    rows = derived(spark, sf, "d_sitemap_rows")
    listed = F.array_sort(F.collect_list(F.struct("pos", F.concat("loc", F.when(F.col("pos") % 5 == 0, "\nnot a url").otherwise("")).alias("x"))))
    text = F.concat(F.array_join(F.transform(listed, lambda e: e["x"]), "\n"), F.lit("\n"))
    docs = rows.groupBy(F.col("parent_url").alias("url")).agg(text.cast("binary").alias("content"), F.min("pos").alias("first"))
    kinds = F.array(*[F.lit(x) for x in ("text/plain", "application/octet-stream", "application/xml")])
    docs = docs.withColumn("type", F.element_at(kinds, (F.col("first") % 3 + 1).cast("int")))
    parsed = X.parse_sitemap(docs, content_type=F.col("type"))
    return parsed.select("url", "ok", F.coalesce(F.array_join("entries.loc", " "), F.lit("")).alias("locs"))


SQL_SITEMAP_LINES = f"""{R} SELECT parent_url AS url, min(pos) % 3 <> 2 AS ok,
  CASE WHEN min(pos) % 3 <> 2 THEN string_agg(loc, ' ' ORDER BY pos) ELSE '' END AS locs FROM d_sitemap_rows GROUP BY 1"""


def _parents(docs: DataFrame, **flags: str) -> DataFrame:
    return docs.withColumn("metadata", M.meta_of(**flags))


def _updates_flat(df: DataFrame) -> DataFrame:
    return df.select(
        "url", "status", _flag("numLinks").alias("num_links"), _flag("isSitemap").alias("is_sitemap"), _flag("isSitemapIndex").alias("is_index"),
        F.coalesce("delay", F.lit(0)).cast("bigint").alias("delay"), _flag("error.source").alias("error"),
    )


def q_process_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """News sitemaps, verified indexes and pages that only claim to be sitemaps, in one step."""
    broken = table(spark, sf, "pages").select(
        F.concat(F.lit("https://broken.example/"), F.col("page_id").cast("string")).alias("url"), F.col("html").cast("binary").alias("content")
    )
    docs = (
        _parents(sitemap_docs(spark, sf), isSitemapNews="true")
        .unionByName(_parents(index_docs(spark, sf), isSitemapVerified="true"))
        .unionByName(_parents(broken, isSitemapNews="true", numLinks="7"))
    )
    return _updates_flat(crawl.process_sitemaps(docs, NOW, HOURS, 15))


def q_process_disguised(spark: SparkSession, sf: str) -> DataFrame:
    return _updates_flat(crawl.process_sitemaps(_parents(_disguised(spark, sf), isSitemapNews="true"), NOW, HOURS, 15))


SQL_PROCESS_DISGUISED = f"""{R.strip()}, {with_ctes('d_feed_rows')[5:].strip()}, l AS ({_LINKS}
  UNION ALL SELECT parent_url, link, pos, 1 FROM d_feed_rows WHERE CAST(published AS TIMESTAMP) >= {CUT}),
docs AS (SELECT DISTINCT parent_url FROM d_sitemap_rows UNION SELECT DISTINCT parent_url FROM d_feed_rows), n AS (SELECT parent_url, count(*) AS n FROM l GROUP BY 1)
SELECT url, 'DISCOVERED' AS status, '-' AS num_links, 'false' AS is_sitemap, '-' AS is_index, CAST(0 AS BIGINT) AS delay, '-' AS error FROM l
UNION ALL SELECT d.parent_url, 'FETCHED', CAST(coalesce(n.n, 0) AS VARCHAR), '-', '-', 0, '-' FROM docs d LEFT JOIN n ON n.parent_url = d.parent_url"""


def q_parse_filter_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A parse filter that refuses some sitemaps, and pages no parser can read, of which it refuses some as well."""
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("https://broken.example/"), F.col("page_id").cast("string")).alias("url"), F.col("html").cast("binary").alias("content")
    )
    docs = _parents(sitemap_docs(spark, sf).unionByName(pages), isSitemapNews="true", numLinks="3")
    refuse = lambda df: crawl.failing(df, F.when(F.col("url").rlike(r"7(\.xml)?$"), F.concat(F.lit("refused "), "url")))
    out = crawl.process_sitemaps(crawl.apply_parse_filters(docs, (crawl.signature_filter, refuse)), NOW, HOURS, 15)
    return _updates_flat(out)


_REFUSED = "ends_with(parent_url, '7.xml')"
SQL_PARSE_FILTER_ERRORS = f"""{R}, l AS ({_LINKS}), pn AS (SELECT parent_url, count(*) AS n FROM l GROUP BY 1), p AS (SELECT DISTINCT parent_url FROM d_sitemap_rows)
SELECT url, 'DISCOVERED' AS status, '-' AS num_links, 'false' AS is_sitemap, '-' AS is_index, CAST(0 AS BIGINT) AS delay, '-' AS error FROM l WHERE NOT {_REFUSED}
UNION ALL SELECT p.parent_url, CASE WHEN {_REFUSED.replace('parent_url', 'p.parent_url')} THEN 'ERROR' ELSE 'FETCHED' END,
  CASE WHEN {_REFUSED.replace('parent_url', 'p.parent_url')} THEN '-' ELSE CAST(coalesce(pn.n, 0) AS VARCHAR) END, '-', '-', 0,
  CASE WHEN {_REFUSED.replace('parent_url', 'p.parent_url')} THEN 'content filtering' ELSE '-' END FROM p LEFT JOIN pn ON pn.parent_url = p.parent_url
UNION ALL SELECT concat('https://broken.example/', page_id), 'ERROR', '-', '-', '-', 0, 'sitemap parsing' FROM pages"""


SQL_PROCESS = f"""{_CHILDREN}, l AS ({_LINKS}), pn AS (SELECT parent_url, count(*) AS n FROM l GROUP BY 1), xn AS (SELECT index_url, count(*) AS n FROM k GROUP BY 1)
SELECT url, 'DISCOVERED' AS status, '-' AS num_links, 'false' AS is_sitemap, '-' AS is_index, CAST(0 AS BIGINT) AS delay, '-' AS error FROM l
UNION ALL SELECT parent_url, 'DISCOVERED', '-', 'true', '-', CAST(n * 15 AS BIGINT), '-' FROM k
UNION ALL SELECT p.parent_url, 'FETCHED', CAST(coalesce(pn.n, 0) AS VARCHAR), '-', '-', 0, '-' FROM (SELECT DISTINCT parent_url FROM d_sitemap_rows) p LEFT JOIN pn ON pn.parent_url = p.parent_url
UNION ALL SELECT p.index_url, 'FETCHED', CAST(coalesce(xn.n, 0) AS VARCHAR), '-', 'true', 0, '-' FROM (SELECT DISTINCT index_url FROM d_sitemap_rows) p LEFT JOIN xn ON xn.index_url = p.index_url
UNION ALL SELECT concat('https://broken.example/', page_id), 'ERROR', '-', '-', '-', 0, 'sitemap parsing' FROM pages"""


def q_process_feeds(spark: SparkSession, sf: str) -> DataFrame:
    out = crawl.process_feeds(_parents(feed_docs(spark, sf)), NOW, HOURS)
    return out.select("url", "status", _flag("isFeed").alias("is_feed"), F.array_join(F.coalesce(F.try_element_at("metadata", F.lit("url.path")), F.array(F.lit("-"))), " ").alias("path"))


SQL_PROCESS_FEEDS = with_ctes("d_feed_rows") + f"""SELECT link AS url, 'DISCOVERED' AS status, '-' AS is_feed, parent_url AS path FROM d_feed_rows WHERE CAST(published AS TIMESTAMP) >= {CUT}
UNION ALL SELECT DISTINCT parent_url, 'FETCHED', 'true', '-' FROM d_feed_rows"""


def _fetched(spark: SparkSession, sf: str) -> DataFrame:
    """A table of fetched records: sitemaps, indexes, feeds, pages, redirects and failures."""
    none = F.lit(None).cast("string")

    def record(df: DataFrame, meta, status=None) -> DataFrame:
        return df.select(
            "url", F.lit(NOW).cast("timestamp").alias("fetch_time"), (F.lit(200) if status is None else status).cast("int").alias("http_status"),
            F.lit("text/html").alias("content_type"), "content", none.alias("trimmed"), meta.alias("metadata"),
            none.alias("request_headers"), none.alias("response_headers"),
        )

    pages = table(spark, sf, "pages").select("page_id", "url", F.col("html").cast("binary").alias("content"))
    code = F.element_at(F.array(*[F.lit(c) for c in (200, 304, 301, 404, 503)]), (F.col("page_id") % 5 + 1).cast("int"))
    meta = F.when(F.col("page_id") % 5 == 2, M.meta_of(_redirTo=F.concat(F.lit("https://to.example/"), F.col("page_id").cast("string")))).otherwise(M.empty_meta())
    parts = [
        record(sitemap_docs(spark, sf), M.empty_meta()),
        record(index_docs(spark, sf), M.empty_meta()),
        record(feed_docs(spark, sf), M.meta_of(isFeed="true")),
        record(pages, meta, code),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    assert out.columns == [c.split(" ")[0] for c in FETCHED.split(", ")]
    return out


def q_crawl_step(spark: SparkSession, sf: str) -> DataFrame:
    """One whole round against an empty status table; urls found more than once are collapsed."""
    empty = spark.createDataFrame([], "url STRING, url_id STRING, key STRING, status STRING, next_fetch TIMESTAMP, metadata MAP<STRING,ARRAY<STRING>>")
    updates = crawl.crawl_step(_fetched(spark, sf), NOW, SC.default_intervals(spark), deny_rules=_rules(spark), hours=HOURS)
    out = UP.status_upsert(empty, updates)
    path = F.coalesce(F.try_element_at("metadata", F.lit("url.path")), F.array(F.lit("-")))
    return out.select(
        "url", "key", "status", ts_text("next_fetch").alias("next_fetch"), _flag("numLinks").alias("num_links"), _flag("isSitemap").alias("is_sitemap"),
        _flag("isSitemapIndex").alias("is_index"), _flag("isSitemapNews").alias("is_news"), _flag("isFeed").alias("is_feed"), F.array_join(path, " ").alias("path"),
        _flag("error.source").alias("error_source"), _flag("error.cause").alias("error_cause"), F.map_contains_key("metadata", F.lit("signature")).alias("signed"),
    )


SQL_CRAWL_STEP = f"""{R.strip()}, {with_ctes('d_feed_rows')[5:].strip()}, {RULES_SQL},{_URLS_SQL},
c AS (SELECT index_url, parent_url, max(lastmod) AS lastmod, min(pos) AS pos FROM d_sitemap_rows GROUP BY 1, 2),
docs AS (SELECT DISTINCT parent_url AS url, 'map' AS t FROM d_sitemap_rows UNION ALL SELECT DISTINCT index_url, 'index' FROM d_sitemap_rows
   UNION ALL SELECT DISTINCT parent_url, 'feed' FROM d_feed_rows),
du AS (SELECT url, t, regexp_extract(url, '^https://([^/]*)', 1) AS host, regexp_extract(url, '^https://[^/]*(.*)$', 1) AS path FROM docs),
dd AS (SELECT url, t FROM du WHERE NOT (host = 'example.org' OR regexp_matches(host, '(^|[.])ththth[.]example[.]net$')
   OR regexp_matches(path, '/1[0-9]*7$') OR (host = 'www.ththin.example.net' AND contains(path, '/en/')))),
pages_ok AS (SELECT page_id, d_u.url FROM d_u WHERE url NOT IN (SELECT url FROM d_hits)),
k AS (SELECT *, row_number() OVER (PARTITION BY index_url ORDER BY pos) - 1 AS n FROM c WHERE CAST(lastmod AS TIMESTAMP) >= {CUT}),
kept_links AS (SELECT l.parent_url, l.url FROM ({_LINKS}) l), n_links AS (SELECT parent_url AS url, count(*) AS n FROM kept_links GROUP BY 1),
n_children AS (SELECT index_url AS url, count(*) AS n FROM k GROUP BY 1),
ev AS (
  SELECT l.url, 'DISCOVERED' AS status, 0 AS minutes, '-' AS num_links, 'false' AS is_sitemap, '-' AS is_index, 'false' AS is_news, '-' AS is_feed, l.parent_url AS path,
    '-' AS error_cause, FALSE AS signed FROM kept_links l JOIN dd ON dd.url = l.parent_url
  UNION ALL SELECT k.parent_url, 'DISCOVERED', 300 + n * 15, '-', 'true', '-', 'false', '-', k.index_url, '-', FALSE FROM k JOIN dd ON dd.url = k.index_url
  UNION ALL SELECT f.link, 'DISCOVERED', 0, '-', '-', '-', '-', '-', f.parent_url, '-', FALSE FROM d_feed_rows f JOIN dd ON dd.url = f.parent_url WHERE CAST(f.published AS TIMESTAMP) >= {CUT}
  UNION ALL SELECT concat('https://to.example/', page_id), 'DISCOVERED', 0, '-', '-', '-', '-', '-', url, '-', FALSE FROM pages_ok WHERE page_id % 5 = 2
  UNION ALL SELECT dd.url, 'FETCHED', CASE t WHEN 'map' THEN 1440 WHEN 'index' THEN 10080 ELSE 720 END,
    CASE t WHEN 'map' THEN CAST(coalesce(a.n, 0) AS VARCHAR) WHEN 'index' THEN CAST(coalesce(b.n, 0) AS VARCHAR) ELSE '-' END, '-', CASE WHEN t = 'index' THEN 'true' ELSE '-' END,
    CASE WHEN t = 'map' THEN 'true' ELSE '-' END, CASE WHEN t = 'feed' THEN 'true' ELSE '-' END, '-', '-', TRUE
    FROM dd LEFT JOIN n_links a ON a.url = dd.url LEFT JOIN n_children b ON b.url = dd.url
  UNION ALL SELECT url, CASE page_id % 5 WHEN 2 THEN 'REDIRECTION' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'FETCH_ERROR' ELSE 'FETCHED' END,
     CASE WHEN page_id % 5 = 4 THEN 2880 ELSE -1 END, '-', '-', '-', '-', '-', '-', '-', FALSE FROM pages_ok
  UNION ALL SELECT url, 'ERROR', NULL, '-', '-', '-', '-', CASE WHEN t = 'feed' THEN 'true' ELSE '-' END, '-', 'Filtered', FALSE FROM docs WHERE url NOT IN (SELECT url FROM dd)
  UNION ALL SELECT url, 'ERROR', NULL, '-', '-', '-', '-', '-', '-', 'Filtered', FALSE FROM d_u WHERE url IN (SELECT url FROM d_hits)),
w AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY CASE WHEN status = 'DISCOVERED' THEN 1 ELSE 0 END, coalesce(minutes, 0) DESC) AS rn FROM ev)
SELECT url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS key, status,
  CASE WHEN minutes >= 0 THEN strftime(TIMESTAMP '{NOW}' + to_minutes(CAST(minutes AS BIGINT)), '%Y-%m-%d %H:%M:%S') ELSE '' END AS next_fetch,
  num_links, is_sitemap, is_index, is_news, is_feed, path, '-' AS error_source, error_cause, signed FROM w WHERE rn = 1"""


def q_bootstrap_step(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pages, sitemaps and feeds classified; pages announce feeds."""
    good = F.lit(200).alias("http_status")
    heads = head_docs(spark, sf).select("url", "content", F.when(F.col("page_id") % 7 == 3, 404).otherwise(200).alias("http_status"))
    docs = heads.unionByName(sitemap_docs(spark, sf).select("*", good)).unionByName(feed_docs(spark, sf).select("*", good)).withColumn("metadata", M.empty_meta())
    out = crawl.bootstrap_step(docs, scheduler=lambda rows: SC.next_fetch_default(rows, NOW, SC.default_intervals(spark)))
    path = F.coalesce(F.try_element_at("metadata", F.lit("url.path")), F.array(F.lit("-")))
    return out.select(
        "url", "key", "status", ts_text("next_fetch").alias("next_fetch"), _flag("isFeed").alias("is_feed"), _flag("isSitemap").alias("is_sitemap"),
        _flag("isSitemapNews").alias("is_news"), _flag("canonical").alias("canonical"), F.array_join(path, " ").alias("path"), _flag("depth").alias("depth"),
    )


SQL_BOOTSTRAP_STEP = f"""{R.strip()}, {with_ctes('d_feed_rows')[5:].strip()}, {with_ctes('d_host_pages')[5:].strip()}, o AS (
SELECT url, CASE WHEN page_id % 7 = 3 THEN 'ERROR' ELSE 'FETCHED' END AS status, -1 AS minutes, '-' AS is_feed, '-' AS is_sitemap, '-' AS is_news,
  CASE WHEN page_id % 5 = 0 AND page_id % 7 <> 3 THEN concat('https://c.example.com/', page_id) ELSE '-' END AS canonical, '-' AS path, '-' AS depth FROM pages
UNION ALL SELECT DISTINCT parent_url, 'FETCHED', 1440, '-', 'true', 'true', '-', '-', '-' FROM d_sitemap_rows
UNION ALL SELECT DISTINCT parent_url, 'FETCHED', 720, 'true', '-', '-', '-', '-', '-' FROM d_feed_rows
UNION ALL SELECT concat(regexp_extract(url, '^([a-z]+)://', 1), '://', host, '/feed/', page_id, '.xml'), 'DISCOVERED', 0, 'true', '-', '-', '-', url, '1'
  FROM d_host_pages WHERE page_id % 2 = 0 AND page_id % 7 <> 3)
SELECT url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS key, status,
  CASE WHEN minutes >= 0 THEN strftime(TIMESTAMP '{NOW}' + to_minutes(minutes), '%Y-%m-%d %H:%M:%S') ELSE '' END AS next_fetch,
  is_feed, is_sitemap, is_news, canonical, path, depth FROM o"""


def q_parse_filters(spark: SparkSession, sf: str) -> DataFrame:
    docs = crawl.apply_parse_filters(head_docs(spark, sf).withColumn("metadata", M.meta_of(signature="x")), crawl.PARSE_FILTERS["bootstrap"])
    return docs.select("page_id", _flag("signature").alias("signature"), _flag("signatureOld").alias("old"), _flag("canonical").alias("canonical"))


SQL_PARSE_FILTERS = with_ctes("d_heads") + """SELECT page_id, md5(html) AS signature, 'x' AS old,
  CASE WHEN page_id % 5 = 0 THEN concat('https://c.example.com/', page_id) ELSE '-' END AS canonical FROM d_heads"""


def q_read_fetched(spark: SparkSession, sf: str) -> DataFrame:
    return _fetched(spark, sf).select("url", F.col("http_status").cast("bigint").alias("http_status")).groupBy("http_status").agg(F.count("*").alias("n"))


SQL_READ_FETCHED = f"""{R.strip()}, {with_ctes('d_feed_rows')[5:].strip()}
SELECT CAST(s AS BIGINT) AS http_status, count(*) AS n FROM (SELECT [200, 304, 301, 404, 503][page_id % 5 + 1] AS s FROM pages
  UNION ALL SELECT 200 FROM (SELECT DISTINCT parent_url FROM d_sitemap_rows) a UNION ALL SELECT 200 FROM (SELECT DISTINCT index_url FROM d_sitemap_rows) b
  UNION ALL SELECT 200 FROM (SELECT DISTINCT parent_url FROM d_feed_rows) c) x GROUP BY 1"""


QUERIES: dict[str, tuple] = {
    "first_clue_match": (q_first_clue, SQL_FIRST_CLUE),
    "detect_sitemap_type": (q_sitemap_type, f"{B} SELECT page_id, coalesce({_TYPE}, '-') AS type FROM d_bodies"),
    "detect_feed": (q_detect_feed, f"{B} SELECT page_id, page_id % 11 = 0 OR {_BY_TYPE} OR {_FEED_512} AS is_feed FROM d_bodies"),
    "detect_sitemap_bootstrap": (q_detect_bootstrap, SQL_BOOT),
    "resolve_sitemap_flags": (q_resolve_flags, f"{_FLAGS} SELECT page_id, action, m_sitemap, m_news, m_index FROM g"),
    "route_fetched": (q_route_fetched, SQL_ROUTE),
    "sitemap_parse_mode": (
        q_parse_mode,
        f"{B} SELECT page_id, CASE WHEN coalesce(trim(content_type), '') = '' OR contains(content_type, 'octet-stream') THEN 'guess' ELSE 'trust' END AS mode FROM d_bodies",
    ),
    "namespace_guard": (q_namespace_guard, "SELECT page_id, page_id % 5 <> 2 AS accepted FROM pages"),
    "trim_content": (q_trim_content, SQL_TRIM),
    "content_signature": (
        q_signature,
        "SELECT doc_id, md5(text) AS signature, CASE WHEN doc_id % 2 = 0 THEN 'before' ELSE '-' END AS signature_old FROM documents",
    ),
    "signature_change": (q_signature_change, SQL_SIG_CHANGE),
    "parse_date_lenient": (q_parse_date, SQL_PARSE_DATE),
    "recently_modified": (q_recent, with_ctes("d_status") + f"SELECT url, coalesce(next_fetch >= {CUT}, TRUE) AS recent FROM d_status"),
    "extract_sitemap_urls": (q_sitemap_urls, SQL_SITEMAP_URLS),
    "extract_sitemap_positions": (q_sitemap_positions, SQL_POSITIONS),
    "extract_alternates": (q_alternates, f"{R} SELECT parent_url, alt AS url FROM d_sitemap_rows WHERE alt IS NOT NULL AND alt <> loc"),
    "partial_sitemap_urls": (q_partial, SQL_PARTIAL),
    "extract_sitemap_index": (q_sitemap_index, SQL_INDEX),
    "stagger_subsitemaps": (q_stagger, SQL_STAGGER),
    "sitemap_link_stats": (q_link_stats, SQL_LINK_STATS),
    "inherit_verified": (q_inherit_verified, SQL_INHERIT),
    "extract_feed_links": (q_feed_links, SQL_FEED),
    "extract_feed_autodiscovery": (q_autodiscovery, SQL_AUTODISCOVERY),
    "extract_canonical": (q_canonical, "SELECT url, concat('https://c.example.com/', page_id) AS canonical FROM pages WHERE page_id % 5 = 0"),
    "extract_html_links": (
        q_html_links,
        "SELECT url AS parent_url, trim(replace(unnest(regexp_extract_all(html, '<a[^>]* href=\"([^\"]*)\"', 1)), '&amp;', '&')) AS href FROM pages",
    ),
    "discover_sitemaps": (q_discover_sitemaps, SQL_DISCOVER),
    "filter_outlinks": (q_filter_outlinks, SQL_FILTER_OUTLINKS),
    "process_sitemaps": (q_process_sitemaps, SQL_PROCESS),
    "extract_sitemap_urls_disguised": (q_disguised_urls, SQL_DISGUISED_URLS),
    "sitemap_lines": (q_sitemap_lines, SQL_SITEMAP_LINES),
    "process_sitemaps_disguised": (q_process_disguised, SQL_PROCESS_DISGUISED),
    "parse_filter_errors": (q_parse_filter_errors, SQL_PARSE_FILTER_ERRORS),
    "process_feeds": (q_process_feeds, SQL_PROCESS_FEEDS),
    "crawl_step": (q_crawl_step, SQL_CRAWL_STEP),
    "bootstrap_step": (q_bootstrap_step, SQL_BOOTSTRAP_STEP),
    "apply_parse_filters": (q_parse_filters, SQL_PARSE_FILTERS),
    "read_fetched": (q_read_fetched, SQL_READ_FETCHED),
}

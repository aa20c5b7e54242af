"""Link extraction from sitemaps, sitemap indexes, feeds, HTML and robots texts.

All extractors are narrow: one document row in, link rows out, positions taken from the document
itself and never from partition order. Bodies are dropped before any link row exists.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlframe.functions.content import inflate, root_name, sitemap_parse_mode
from crawlframe.functions.dates import parse_date_lenient, recently_modified
from crawlframe.functions.metadata import meta_of
from crawlframe.functions.stage import compute_once, with_parts
from crawlframe.functions.urls import resolve_url
from crawlframe.schemas import IS_FEED, IS_NEWS, IS_SITEMAP, ROBOTS_RULES
from crawlframe.sources.rules import numbered_lines

Clock = Column | str | dt.datetime

_ENTRY = "STRUCT<loc:STRING,lastmod:STRING,news:ARRAY<STRUCT<publication_date:STRING>>,link:ARRAY<STRUCT<_href:STRING>>>"
_ENTRY_FIELDS = "loc STRING,lastmod STRING,news ARRAY<STRUCT<publication_date:STRING>>,link ARRAY<STRUCT<_href:STRING>>"
_CHILD_FIELDS = "loc STRING,lastmod STRING"
_DOC_FIELDS = f"url ARRAY<{_ENTRY}>, sitemap ARRAY<STRUCT<loc:STRING,lastmod:STRING>>, _corrupt_record STRING"
_FEED_FIELDS = (
    "channel STRUCT<item:ARRAY<STRUCT<link:ARRAY<STRUCT<_VALUE:STRING>>,guid:STRUCT<_VALUE:STRING,_isPermaLink:STRING>,"
    "pubDate:STRING,date:STRING>>>, "
    "item ARRAY<STRUCT<link:ARRAY<STRUCT<_VALUE:STRING>>,guid:STRUCT<_VALUE:STRING,_isPermaLink:STRING>,"
    "pubDate:STRING,date:STRING>>, "
    "entry ARRAY<STRUCT<link:ARRAY<STRUCT<_href:STRING,_rel:STRING>>,published:STRING,updated:STRING>>, "
    "_corrupt_record STRING"
)
_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

_URL_FRAGMENT = r"(?s)<(?:\w+:)?url>.*?</(?:\w+:)?url>"
_SITEMAP_FRAGMENT = r"(?s)<(?:\w+:)?sitemap>.*?</(?:\w+:)?sitemap>"


def body_text(content: Column) -> Column:
    """The body as text without a byte order mark or blanks ahead of the markup."""
    return F.regexp_replace(content.cast("string"), "^[\\uFEFF\\s]+", "")


def partial_sitemap_urls(content: Column) -> Column:
    """Complete ``<url>`` entries of a body, also of one cut off in the middle: array of entries."""
    fragments = F.regexp_extract_all(body_text(content), F.lit(_URL_FRAGMENT), 0)
    return F.transform(fragments, lambda f: F.from_xml(f, _ENTRY_FIELDS, _XML))


def _fragments(pattern: str, fields: str) -> Column:
    """Complete elements of a broken text, each read on its own."""
    return F.transform(F.regexp_extract_all("_text", F.lit(pattern), 0), lambda f: F.from_xml(f, fields, _XML))


#: Roots of feeds, which may stand where a sitemap was expected.
FEED_ROOTS = ("rss", "RDF", "feed")
_URL_LINE = r"^(?i:https?)://\S+$"


def _feed_entries(items: Column) -> Column:
    """Items of a feed as entries of a sitemap: the link, and its date as the last change."""

    def entry(i: Column) -> Column:
        none = (F.lit(None).cast("array<struct<publication_date:string>>"), F.lit(None).cast("array<struct<_href:string>>"))
        return F.struct(i["link"].alias("loc"), i["published"].alias("lastmod"), none[0].alias("news"), none[1].alias("link"))

    return F.transform(items, entry).cast(f"ARRAY<{_ENTRY}>")


def _line_entries(text: Column) -> Column:
    # F.trim by itself would be handed the line's position too, as the characters to trim
    lines = F.filter(F.transform(F.split(text, r"[\r\n]+"), lambda x: F.trim(x)), lambda x: x.rlike(_URL_LINE))
    return _feed_entries(F.transform(lines, lambda x: F.struct(x.alias("link"), F.lit(None).cast("string").alias("published"))))


def parse_sitemap(
    docs: DataFrame, content: str = "content", allow_partial: bool = True, content_type: Column | None = None, inflated: bool = False
) -> DataFrame:
    """Replace the body by ``ok, is_index, entries, children``.

    The root element chooses the reader: sitemaps and indexes, but also feeds, whose items count as entries. A body
    without markup is read as one URL a line, unless its media type (where it is to be trusted) says XML. Gzip bodies
    are decompressed. A broken document keeps the complete entries before the break; one that gives nothing at
    all is not ok. Nothing is raised.
    """
    keep = [c for c in docs.columns if c != content]
    body = F.col("_text") if inflated else inflate(F.col("_text"))
    xml_type = F.lit(False) if content_type is None else (sitemap_parse_mode(content_type) == "trust") & content_type.contains("xml")
    typed = docs.select(*keep, F.col(content).alias("_text"), F.coalesce(xml_type, F.lit(False)).alias("_xml"))
    staged = compute_once(typed, "_text", body_text(body))
    # the root element decides; a broken text that has lost it is looked into for entries
    staged = compute_once(staged, "_root", F.coalesce(root_name(F.col("_text")), F.lit("")))
    is_feed = F.col("_root").isin(*FEED_ROOTS)
    is_text = ~F.col("_xml") & (F.col("_root") == "") & F.coalesce(F.col("_text").rlike(r"^(?i:https?)://"), F.lit(False))
    staged = staged.withColumns({"_is_feed": is_feed, "_is_text": is_text})
    staged = compute_once(staged, "_feed_doc", F.from_xml(F.when(F.col("_is_feed"), F.col("_text")), _FEED_FIELDS, _XML))
    of_map = F.when(~F.col("_is_feed") & ~F.col("_is_text"), F.col("_text"))
    staged = compute_once(staged, "_doc", F.from_xml(of_map, _DOC_FIELDS, _XML))
    broken = F.col("_doc").isNull() | F.col("_doc._corrupt_record").isNotNull()
    known = F.col("_root").isin("urlset", "sitemapindex") | (broken & (F.col("_root") == ""))
    staged = staged.withColumns({"_broken": broken, "_known": known, "is_index": F.col("_root") == "sitemapindex"})
    rescue = F.col("_broken") if allow_partial else F.lit(False)
    entries = (
        F.when(F.col("_is_feed"), _feed_entries(_feed_items("_feed_doc")))
        .when(F.col("_is_text"), _line_entries(F.col("_text")))
        .when(rescue & ~F.col("is_index"), _fragments(_URL_FRAGMENT, _ENTRY_FIELDS))
        .otherwise(F.col("_doc.url"))
    )
    children = F.when(rescue & F.col("is_index"), _fragments(_SITEMAP_FRAGMENT, _CHILD_FIELDS)).otherwise(
        F.col("_doc.sitemap")
    )
    found = compute_once(
        staged, "_found", F.struct(entries.alias("entries"), children.alias("children"))
    )
    n = F.coalesce(F.size("_found.entries"), F.lit(0)) + F.coalesce(F.size("_found.children"), F.lit(0))
    return found.select(
        *keep,
        "is_index",
        F.col("_found.entries").alias("entries"),
        F.col("_found.children").alias("children"),
        F.when(F.col("_is_feed"), _feed_ok("_feed_doc"))
        .when(F.col("_is_text"), True)
        .otherwise(F.col("_known") & (~F.col("_broken") | (n > 0)))
        .alias("ok"),
    )


def _is_recent_entry(entry: Column, now: Clock, hours: int) -> Column:
    """Neither lastmod nor any news date lies before the window."""
    news = F.coalesce(entry["news"], F.array().cast("array<struct<publication_date:string>>"))
    stale_news = F.exists(
        news, lambda n: ~recently_modified(parse_date_lenient(n["publication_date"]), now, hours)
    )
    return recently_modified(parse_date_lenient(entry["lastmod"]), now, hours) & ~stale_news


def extract_alternates(entry: Column) -> Column:
    """Alternate-language hrefs of an entry in order, without those equal to its loc."""
    loc = F.trim(entry["loc"])
    hrefs = F.transform(F.coalesce(entry["link"], F.array().cast("array<struct<_href:string>>")), lambda x: F.trim(x["_href"]))
    return F.filter(hrefs, lambda h: h.isNotNull() & (h != "") & (h != loc))


def sitemap_entries(parsed: DataFrame, now: Clock, hours: int = 720) -> DataFrame:
    """One row per entry with its position and whether it is recent; documents without entries keep a row."""
    keep = [c for c in parsed.columns if c not in ("entries", "children")]
    rows = parsed.select(*keep, F.posexplode_outer("entries").alias("url_pos", "entry"))
    has_loc = F.coalesce(F.trim("entry.loc") != "", F.lit(False))
    return rows.withColumns({"has_loc": has_loc, "recent": _is_recent_entry(F.col("entry"), now, hours)})


def _flagged(is_sitemap: str) -> Column:
    return meta_of(**{IS_SITEMAP: is_sitemap, IS_NEWS: "false"})


def sitemap_links(parsed: DataFrame, now: Clock, hours: int = 720, url: str = "url") -> DataFrame:
    """Links of parsed sitemaps: alternates of an entry in their order, then its loc. Duplicates stay."""
    entries = sitemap_entries(parsed.filter(~F.col("is_index")), now, hours).filter("has_loc AND recent")
    targets = F.concat(extract_alternates(F.col("entry")), F.array(F.trim("entry.loc")))
    return entries.select(
        F.col(url).alias("parent_url"), "url_pos", F.posexplode(targets).alias("link_pos", "url")
    ).select(
        "parent_url", "url_pos", "link_pos", "url", F.lit("DISCOVERED").alias("status"), _flagged("false").alias("metadata")
    )


def index_links(parsed: DataFrame, now: Clock, hours: int = 720, url: str = "url") -> DataFrame:
    """Recent children of parsed sitemap indexes."""
    children = parsed.filter("is_index").select(
        F.col(url).alias("parent_url"), F.posexplode("children").alias("url_pos", "c")
    )
    return (
        children.filter(F.coalesce(F.trim("c.loc") != "", F.lit(False)))
        .filter(recently_modified(parse_date_lenient(F.col("c.lastmod")), now, hours))
        .select(
            "parent_url",
            "url_pos",
            F.lit(0).alias("link_pos"),
            F.trim("c.loc").alias("url"),
            F.lit("DISCOVERED").alias("status"),
            _flagged("true").alias("metadata"),
        )
    )


def extract_sitemap_urls(fetched: DataFrame, now: Clock, hours: int = 720) -> DataFrame:
    """Recent links of sitemap documents (``url, content``)."""
    return sitemap_links(parse_sitemap(fetched.select("url", "content")), now, hours)


def stagger_subsitemaps(links: DataFrame, delay: int = 15) -> DataFrame:
    """Add ``delay``: the k-th kept child of an index waits k times ``delay`` minutes, the first one not at all.

    A parent is one document, so its group is bounded by the body limit.
    """
    if delay <= 0:
        return links.withColumn("delay", F.lit(None).cast("int"))
    nth = F.row_number().over(W.partitionBy("parent_url").orderBy("url_pos", "link_pos")) - 1
    return links.withColumn("delay", F.when(nth > 0, nth * delay))


def extract_sitemap_index(fetched: DataFrame, now: Clock, hours: int = 720, delay: int = 15) -> DataFrame:
    """Recent children of sitemap indexes with their staggered delay."""
    return stagger_subsitemaps(index_links(parse_sitemap(fetched.select("url", "content")), now, hours), delay)


def sitemap_link_stats(fetched: DataFrame, now: Clock, hours: int = 720) -> DataFrame:
    """Per sitemap: entries found, entries skipped as old, links kept. Parents without links stay."""
    entries = sitemap_entries(
        parse_sitemap(fetched.select("url", "content")).filter(~F.col("is_index")), now, hours
    )
    n_links = F.when(F.col("recent"), F.size(extract_alternates(F.col("entry"))) + 1).otherwise(0)
    seen = F.col("has_loc")
    return entries.groupBy(F.col("url").alias("parent_url")).agg(
        F.count_if(seen).alias("links_found"),
        F.count_if(seen & ~F.col("recent")).alias("links_skipped"),
        F.coalesce(F.sum(F.when(seen, n_links)), F.lit(0)).alias("links_kept"),
    )


def inherit_verified(links: DataFrame, parents: DataFrame) -> DataFrame:
    """Children of an index become sitemaps; children of a verified index become verified too.

    ``parents`` has ``parent_url, is_index, is_verified``.
    """
    from crawlframe.functions.metadata import meta_set
    from crawlframe.schemas import IS_VERIFIED

    joined = links.join(parents.select("parent_url", "is_index", "is_verified"), "parent_url", "left")
    is_index = F.coalesce("is_index", F.lit(False))
    meta = F.when(is_index, meta_set(F.col("metadata"), IS_SITEMAP, "true")).otherwise(F.col("metadata"))
    meta = F.when(is_index & F.coalesce("is_verified", F.lit(False)), meta_set(meta, IS_VERIFIED, "true")).otherwise(meta)
    return joined.withColumn("metadata", meta).select(*links.columns)


# --- feeds ------------------------------------------------------------------------------------


def _feed_ok(doc: str) -> Column:
    return F.col(doc).isNotNull() & F.col(f"{doc}._corrupt_record").isNull()


def _feed_items(doc: str) -> Column:
    """Items of a read RSS or Atom document: array of link, published."""
    none = F.array().cast("array<struct<link:string,published:string>>")

    def rss_item(item: Column) -> Column:
        plain = F.get(F.filter(item["link"], lambda x: F.trim(x["_VALUE"]) != ""), F.lit(0))["_VALUE"]
        permalink = F.when(
            F.coalesce(F.lower(item["guid"]["_isPermaLink"]) != "false", F.lit(True)), item["guid"]["_VALUE"]
        )
        return F.struct(
            F.trim(F.coalesce(plain, permalink)).alias("link"),
            F.coalesce(item["pubDate"], item["date"]).alias("published"),
        )

    def atom_entry(entry: Column) -> Column:
        wanted = F.filter(entry["link"], lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
        return F.struct(
            F.trim(F.get(wanted, F.lit(0))["_href"]).alias("link"),
            F.coalesce(entry["published"], entry["updated"]).alias("published"),
        )

    return F.concat(
        F.coalesce(F.transform(f"{doc}.channel.item", rss_item), none),
        F.coalesce(F.transform(f"{doc}.item", rss_item), none),
        F.coalesce(F.transform(f"{doc}.entry", atom_entry), none),
    )


def parse_feed(docs: DataFrame, content: str = "content") -> DataFrame:
    """Replace the body by ``ok`` and ``items`` (array of link, published) for RSS and Atom alike."""
    keep = [c for c in docs.columns if c != content]
    staged = compute_once(docs, "_doc", F.from_xml(body_text(F.col(content)), _FEED_FIELDS, _XML)).drop(content)
    return staged.select(*keep, _feed_ok("_doc").alias("ok"), _feed_items("_doc").alias("items"))


def feed_links(
    parsed: DataFrame, now: Clock, hours: int = 720, url: str = "url", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Recent links of parsed feeds, relative ones resolved against the feed."""
    items = with_parts(parsed, url, "_base").select(
        F.col(url).alias("parent_url"), "_base", *carry, F.posexplode("items").alias("url_pos", "i")
    ).select(
        "parent_url", "_base", *carry, "url_pos", F.col("i.link").alias("link"), parse_date_lenient(F.col("i.published")).alias("published")
    )
    return (
        items.filter(F.coalesce(F.col("link") != "", F.lit(False)))
        .filter(recently_modified(F.col("published"), now, hours))
        .select(
            "parent_url",
            "url_pos",
            F.lit(0).alias("link_pos"),
            resolve_url(F.col("parent_url"), F.col("link"), F.col("_base")).alias("url"),
            "published",
            F.lit("DISCOVERED").alias("status"),
            meta_of().alias("metadata"),
            *carry,
        )
    )


def extract_feed_links(fetched: DataFrame, now: Clock, hours: int = 720) -> DataFrame:
    """Recent links of RSS and Atom documents (``url, content``)."""
    return feed_links(parse_feed(fetched.select("url", "content")), now, hours)


# --- HTML -------------------------------------------------------------------------------------

# Media types that announce a feed.
FEED_LINK_TYPES = ("application/rss+xml", "text/rss", "application/atom+xml")


def tag_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, entities of the URL kind decoded; empty text when missing."""
    quoted = r"(?is)\s" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, quoted, i) for i in (1, 2, 3)])
    return F.trim(F.regexp_replace(value, "&amp;", "&"))


def html_tags(docs: DataFrame, pattern: str, content: str = "content", url: str = "url") -> DataFrame:
    """Start tags of a document in order, with the parts of its URL: ``parent_url, _base, pos, tag``."""
    text = F.col(content).cast("string")
    return with_parts(docs.select(url, content), url, "_base").select(
        F.col(url).alias("parent_url"), "_base", F.posexplode(F.regexp_extract_all(text, F.lit(pattern), 0)).alias("pos", "tag")
    )


def extract_feed_autodiscovery(fetched: DataFrame) -> DataFrame:
    """Feeds announced in HTML heads; every other link of the page is discarded."""
    tags = html_tags(fetched, r"(?is)<link\b[^>]*>")
    rel, kind = (tag_attribute(F.col("tag"), n) for n in ("rel", "type"))
    feeds = tags.filter((rel == "alternate") & kind.isin(*FEED_LINK_TYPES))
    found = compute_once(feeds, "_href", tag_attribute(F.col("tag"), "href")).filter(F.col("_href") != "")
    return found.select(
        "parent_url",
        F.col("pos").alias("url_pos"),
        F.lit(0).alias("link_pos"),
        resolve_url(F.col("parent_url"), F.col("_href"), F.col("_base")).alias("url"),
        F.lit("DISCOVERED").alias("status"),
        meta_of(**{IS_FEED: "true"}).alias("metadata"),
    )


def feed_urls_of(text: Column, url: Column, base_parts: Column) -> Column:
    """The same links as an array, for plans that keep one row per document."""
    tags = F.filter(
        F.regexp_extract_all(text, F.lit(r"(?is)<link\b[^>]*>"), 0),
        lambda t: (tag_attribute(t, "rel") == "alternate")
        & tag_attribute(t, "type").isin(*FEED_LINK_TYPES)
        & (tag_attribute(t, "href") != ""),
    )
    return F.transform(tags, lambda t: resolve_url(url, tag_attribute(t, "href"), base_parts))


def canonical_href(content: Column) -> Column:
    """``href`` of the first element marked as canonical, NULL when there is none."""
    tag = F.regexp_extract(content.cast("string"), r"""(?is)<\w+\b[^>]*\srel\s*=\s*["']?canonical["']?[^>]*>""", 0)
    href = tag_attribute(tag, "href")
    return F.when(href != "", href)


def extract_canonical(fetched: DataFrame) -> DataFrame:
    """Pages with their canonical link."""
    return fetched.select(F.col("url"), canonical_href(F.col("content")).alias("canonical")).filter(
        F.col("canonical").isNotNull()
    )


def extract_html_links(fetched: DataFrame) -> DataFrame:
    """Anchors of a page in order, as written and resolved."""
    tags = html_tags(fetched, r"(?is)<a\b[^>]*>")
    found = compute_once(tags, "href", tag_attribute(F.col("tag"), "href")).filter("href <> ''")
    return found.select(
        "parent_url",
        F.col("pos").alias("link_pos"),
        "href",
        resolve_url(F.col("parent_url"), F.col("href"), F.col("_base")).alias("url"),
    )


# --- robots texts -----------------------------------------------------------------------------


def discover_sitemaps(robots: DataFrame, host: str = "host", text: str = "text") -> DataFrame:
    """Sitemaps announced in robots texts."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?im)^[ \t]*sitemap[ \t]*:[ \t]*(\S+)"), 1)
    return robots.select(F.col(host).alias("key"), F.posexplode(found).alias("pos", "url")).select(
        "key", "pos", "url", F.lit("DISCOVERED").alias("status"), meta_of(**{IS_SITEMAP: "true"}).alias("metadata")
    )


def extract_robots_rules(robots: DataFrame, host: str = "host", text: str = "text") -> DataFrame:
    """Robots texts as rules: consecutive ``User-agent`` lines share the group that follows them."""
    lines = numbered_lines(robots, host, text)
    clean = F.trim(F.substring_index("line", "#", 1))
    name = F.lower(F.trim(F.substring_index(clean, ":", 1)))
    value = F.trim(F.substring(clean, F.length(F.substring_index(clean, ":", 1)) + 2, F.length(clean)))
    # fields that end a run of agent lines
    member = name.isin("allow", "disallow", "crawl-delay")
    fields = lines.select("doc", "pos", name.alias("name"), value.alias("value"), clean.contains(":").alias("_f")).filter(
        F.col("_f") & (member | (name == "user-agent"))
    )
    by_doc = W.partitionBy("doc").orderBy("pos")
    is_agent = F.col("name") == "user-agent"
    starts = is_agent & (F.coalesce(F.lag("name").over(by_doc), F.lit("")) != "user-agent")
    grouped = fields.withColumn("_starts", starts).withColumn(
        "grp", F.sum(F.col("_starts").cast("int")).over(by_doc.rowsBetween(W.unboundedPreceding, 0))
    )
    agents = grouped.filter(is_agent).groupBy("doc", "grp").agg(F.collect_set(F.lower("value")).alias("agents"))
    rules = grouped.filter(~is_agent & (F.col("grp") > 0)).join(agents, ["doc", "grp"])
    allow = F.when(F.col("name") != "crawl-delay", F.col("name") == "allow")
    cols = [c.split(" ")[0] for c in ROBOTS_RULES.split(", ")]
    return rules.select(
        F.col("doc").alias("key"),
        F.explode("agents").alias("agent"),
        allow.alias("allow"),
        F.when(F.col("name") != "crawl-delay", F.col("value")).alias("pattern"),
        F.when(F.col("name") == "crawl-delay", F.col("value").try_cast("double")).alias("crawl_delay"),
    ).select(*cols)

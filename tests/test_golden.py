"""Golden cases: filter, detector, extraction and scheduler behaviour, and the pinned edge semantics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crawlframe.functions import content as C
from crawlframe.functions import metadata as M
from crawlframe.functions import predicates as P
from crawlframe.functions import urls as U
from crawlframe.functions.dates import parse_date_lenient, parse_instant, recently_modified, status_date
from crawlframe.operators import extract as X
from crawlframe.operators import filtering as FI
from crawlframe.operators import schedule as SC
from crawlframe.operators.keys import domain_join
from crawlframe.plans import crawl
from crawlframe.schemas import META, ROBOTS_RULES
from crawlframe.sources import rules as R
from crawlframe.sources.seeds import parse_seeds

NOW = "2024-06-01 00:00:00"

RULE_TEXT = """
Domain shop.example
  DenyPathQuery [?&]basket=
Host media.radio.example
  DenyPath ^/live/
Domain .
  DenyPath /calendar/[0-9]{4}/
Domain gone.example
  DenyPath .
Host intranet
  DenyPath /
"""


def texts(spark, *items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "doc INT, text STRING")


def urls(spark, *items):
    return spark.createDataFrame([(u,) for u in items], "url STRING")


def kept(spark, rules, *items, **bounds):
    return {r.url for r in FI.deny_filter(urls(spark, *items), rules, **bounds).collect()}


@pytest.fixture(scope="module")
def rules(spark):
    return R.parse_deny_rules(texts(spark, RULE_TEXT)).drop("doc").persist()


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "share": 16}], ids=["lookup", "shuffle"])
@pytest.mark.parametrize(
    "url,keep",
    [
        ("http://media.radio.example/live/1", False),
        ("http://media.radio.example/x/../live/2", False),
        ("http://media.radio.example/archive/live/1", True),
        ("http://news.radio.example/live/1", True),
        ("https://shop.example/list?page=2&basket=9", False),
        ("https://eu.shop.example/list?basket=9", False),
        ("https://shop.example/basket=9", True),
        ("https://workshop.example/?basket=1", True),
        ("ftp://deep.gone.example/readme", False),
        ("http://gone.example", True),
        ("http://any.example/calendar/2019/x", False),
        ("http://any.example/calendar/week", True),
        ("http://me@intranet:81/x", False),
        ("http://INTRANET/x", True),
        ("not a link", False),
        ("gopher://shop.example/", False),
    ],
)
def test_deny_filter(spark, rules, url, keep, bounds):
    assert (url in kept(spark, rules, url, **bounds)) is keep


def test_deny_global_rule_reaches_urls_without_host(spark):
    rules = R.parse_deny_rules(texts(spark, "Domain .\n DenyPath ^/private\n")).drop("doc")
    assert kept(spark, rules, "file:/private/x", "file:/public", "http://a.example/private", None) == {"file:/public"}


def test_deny_global_rules_of_all_kinds(spark):
    text = "Domain .\n DenyPath ^/a[0-9]$\n DenyPathQuery [?]x=(.)\\1\n DenyPathQuery b=2|c=3\n DenyPath (?i)/Upper\n"
    items = ["http://h/a1", "http://h/a1/b", "http://h/?x=zz", "http://h/?x=zy", "http://h/?c=3", "http://h/c=3", "http://h/UPPER", "http://h/b"]
    for bounds in ({}, {"max_rows": 0, "share": 16}):
        rules = R.parse_deny_rules(texts(spark, text)).drop("doc")
        assert kept(spark, rules, *items, **bounds) == {"http://h/a1/b", "http://h/?x=zy", "http://h/b"}


def test_deny_rule_text_semantics(spark):
    text = "DenyPath /orphan\nHostx a.example\nDenyPath /two words\nDenyPath /cut#off\nHost\nDenyPath (bad\nDenyPath .\nDenyPathQuery .?\n"
    got = {(r.scope, r.key, r.kind, r.pattern) for r in R.parse_deny_rules(texts(spark, text)).collect()}
    assert got == {
        ("host", "a.example", "path", "/two"),
        ("host", "a.example", "path", "/cut"),
        ("host", "a.example", "path", "."),
        ("host", "a.example", "all", "."),
    }
    skipped = {r.line for r in R.skipped_rule_lines(texts(spark, text)).collect()}
    assert skipped == {"DenyPath /orphan", "Host", "DenyPath (bad"}


def test_dot_rule_needs_a_path(spark):
    rules = R.parse_deny_rules(texts(spark, "Host a.example\nDenyPath .\n")).drop("doc")
    assert kept(spark, rules, "http://a.example", "http://a.example/") == {"http://a.example"}


def test_rule_stats_repeated_catch_all_counts_once(spark):
    rules = R.parse_deny_rules(texts(spark, "Host a\nDenyPath .*\nDenyPath .*\nDenyPath /x\nDenyPath /x\n"))
    assert R.rule_stats(rules).first().n_rules == 3


def test_deny_explain_order(spark):
    text = "Domain example\nDenyPath /\nDomain a.example\nDenyPath /\nDomain .\nDenyPath /\nHost b.a.example\nDenyPath /x\n"
    rules = R.parse_deny_rules(texts(spark, text)).drop("doc")
    for bounds in ({}, {"max_rows": 0, "share": 16}):
        out = FI.deny_explain(urls(spark, "http://b.a.example/x", "http://b.a.example/y", "http://c.other/y"), rules, **bounds)
        got = {r.url: (r.rule.scope, r.rule.key) for r in out.collect()}
        assert got == {
            "http://b.a.example/x": ("host", "b.a.example"),
            "http://b.a.example/y": ("domain", "a.example"),
            "http://c.other/y": ("domain", "."),
        }


def test_prefilter_keeps_original_url_and_names_cause(spark, rules):
    rows = spark.createDataFrame([("http://media.radio.example/live/", {"error.cause": ["Old"]}), ("HTTP://ok.example", {})], f"url STRING, metadata {META}")
    good, bad = FI.prefilter(rows, rules)
    assert [r.url for r in good.collect()] == ["HTTP://ok.example"]
    row = bad.first()
    assert row.status == "ERROR" and row.metadata["error.cause"] == ["Old", "Filtered"]


# --- URLs -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "url,host,path,file,valid",
    [
        ("http://Ex.example:8080/a/b?x=1#f", "Ex.example", "/a/b", "/a/b?x=1", True),
        (" https://u:p@h_x.example/p q/é? ", "h_x.example", "/p q/é", "/p q/é?", True),
        ("file:/p/q", "", "/p/q", "/p/q", True),
        ("http://[::1]:80/x", "[::1]", "/x", "/x", True),
        ("http://h/a/./b/../c/..", "h", "/a/", "/a/", True),
        ("http://h/../x", "h", "/../x", "/../x", True),
        ("http://a.example.", "a.example.", "", "", True),
        ("http://h:ab/", "h", "/", "/", False),
        ("foo://x/y", "x", "/y", "/y", False),
        ("//x/y", None, None, None, False),
        ("", None, None, None, False),
    ],
)
def test_url_parts(spark, url, host, path, file, valid):
    p = urls(spark, url).select(U.url_parts(F.col("url")).alias("p")).first().p
    assert (p.host, p.path, p.file, p.valid) == (host, path, file, valid)


@pytest.mark.parametrize(
    "url,want",
    [
        ("http://münchen.example:81/ü?q=1#frag", "http://xn--mnchen-3ya.example:81/ü?q=1"),
        ("http://user@bücher.example/x", "http://xn--bcher-kva.example/x"),
        ("http://ascii.example/#f", "http://ascii.example/#f"),
        ("http://" + "ü" * 80 + ".example/", None),
        ("nonsense", None),
    ],
)
def test_punycode_host(spark, url, want):
    assert urls(spark, url).select(U.punycode_host(F.col("url")).alias("u")).first().u == want


@pytest.mark.parametrize(
    "url,want",
    [
        (" HTTP://Ex.example:80 ", "http://ex.example/"),
        ("https://ex.example:443/a b#x", "https://ex.example/a%20b"),
        ("http://ex.example/p&a=1&b=2", "http://ex.example/p?a=1&b=2"),
        ("http://ex.example/p&a=1?b=2", "http://ex.example/p&a=1?b=2"),
        ("http://ex.example/a\tb", None),
        ("http://bücher.example/", "http://xn--bcher-kva.example/"),
        ("nonsense", None),
        (None, None),
    ],
)
def test_normalize_url(spark, url, want):
    assert urls(spark, url).select(U.normalize_url(F.col("url")).alias("u")).first().u == want


def test_regex_normalize(spark):
    rules = [(r"[?&]utm_[a-z]+=[^&#]*", ""), (r"/amp/?$", "/"), (r"^http://(shop[.])", "https://$1")]
    cases = {"http://shop.example/a/amp": "https://shop.example/a/", "http://h/x?id=3&utm_source=feed": "http://h/x?id=3", "http://h/amp/x": "http://h/amp/x"}
    for url, want in cases.items():
        assert urls(spark, url).select(U.regex_normalize(F.col("url"), rules).alias("u")).first().u == want


def test_parse_rewrites(spark):
    doc = "<rules><!-- c --><regex><pattern>&amp;{2,}</pattern><substitution>&amp;</substitution></regex><regex><pattern>x$</pattern><substitution></substitution></regex></rules>"
    got = [(r.seq, r.pattern, r.substitution) for r in R.parse_rewrites(texts(spark, doc)).orderBy("seq").collect()]
    assert got == [(0, "&{2,}", "&"), (1, "x$", "")]


def test_regex_url_filter(spark):
    bad = ["ftp://a.example/", "http://localhost:9200/", "http://127.3.4.5/x", "http://10.1.2.3/", "http://192.168.1.1", "http://172.20.1.1/", "http://a.example/x.PNG", "http://a.example/x.zip?y", "http://[::1]/"]
    good = ["http://a.example/", "http://172.32.1.1/", "http://a.example/zip", "http://11.1.1.1/"]
    got = {r.url for r in urls(spark, *bad, *good).filter(P.regex_url_filter(F.col("url"))).collect()}
    assert got == set(good)


def test_basic_and_host_filters(spark):
    rows = urls(spark, "http://h/a/a/a/x", "http://h/a/b/a/c/a/a", "http://h/" + "x" * 2000)
    assert [r.url for r in rows.filter(P.basic_url_filter(F.col("url"))).collect()] == ["http://h/a/a/a/x"]
    row = spark.range(1).select(
        P.host_filter(F.lit("http://a.x/"), F.lit("http://b.x/")).alias("off"),
        P.host_filter(F.lit("http://a.x/"), F.lit("http://b.x/"), ignore_host=True).alias("host"),
        P.host_filter(F.lit("http://a.x/"), F.lit("http://b.x/"), ignore_domain=True, parent_domain=F.lit("x"), url_domain=F.lit("x")).alias("domain"),
    ).first()
    assert tuple(row) == (True, False, True)


@pytest.mark.parametrize(
    "host,suffix,domain",
    [
        ("www.a.co.uk", "co.uk", "a.co.uk"),
        ("a.b.ck", "b.ck", "a.b.ck"),
        ("x.a.b.ck", "b.ck", "a.b.ck"),
        ("www.ck", "ck", "www.ck"),
        ("x.www.ck", "ck", "www.ck"),
        ("a.unknown", "unknown", "a.unknown"),
        ("uk", "uk", "uk"),
        ("10.1.2.3", None, "10.1.2.3"),
    ],
)
def test_domain_join(spark, host, suffix, domain):
    table = R.parse_suffixes(texts(spark, "// list\nuk\nco.uk\n*.ck\n!www.ck\ncom\n"))
    row = domain_join(spark.createDataFrame([(host,)], "host STRING"), table).first()
    assert (row.suffix, row.domain) == (suffix, domain)


def test_domain_join_forms_agree(spark):
    table = R.parse_suffixes(texts(spark, "// list\nuk\nco.uk\n*.ck\n!www.ck\ncom\n"))
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "x.a.b.ck", "www.ck", "a.com", "uk", None)], "host STRING")
    looked_up, joined = (sorted(map(str, domain_join(hosts, table, **b).collect())) for b in ({}, {"max_rows": 0}))
    assert looked_up == joined and any("domain='b.co.uk'" in r for r in joined)


@pytest.mark.parametrize(
    "path,agent,allowed",
    [
        ("/private/x", "bot", False),
        ("/private/open", "bot", True),
        ("/a.pdf", "bot", False),
        ("/a.pdf?x", "bot", True),
        ("/anything", "special", False),
        ("/tie/x", "bot", True),
    ],
)
def test_robots(spark, path, agent, allowed):
    text = "User-agent: special\nDisallow: /\n\nUser-agent: *\nDisallow: /private\nAllow: /private/open\nDisallow: *.pdf$\nDisallow: /tie/\nAllow: /tie/\n"
    rules = X.extract_robots_rules(spark.createDataFrame([("h.example", text)], "host STRING, text STRING"))
    row = FI.robots_flag(urls(spark, f"http://h.example{path}"), rules, agent).first()
    assert row.allowed is allowed


def test_robots_without_rules_keeps(spark):
    rules = spark.createDataFrame([], ROBOTS_RULES)
    assert FI.robots_filter(urls(spark, "http://h.example/x"), rules).count() == 1


def test_seeds(spark):
    lines = spark.createDataFrame([("# c",), ("",), (" http://a/ ",), ("http://b/\tisFeed=true\tk=1\tk=2",)], "value STRING")
    got = {r.url: r.metadata for r in parse_seeds(lines).collect()}
    assert got == {"http://a/": {}, "http://b/": {"isFeed": ["true"], "k": ["1", "2"]}}


# --- detection --------------------------------------------------------------------------------

NEWS_MAP = (
    '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:n="http://www.google.com/schemas/sitemap-news/0.9"'
    ' xmlns:h="http://www.w3.org/1999/xhtml"><url><h:link rel="alternate" hreflang="fr-CA" href="https://paper.example/fr/budget"/>'
    "<loc>https://paper.example/budget</loc><n:news><n:title>Budget</n:title><n:publication_date>{date}</n:publication_date></n:news></url></urlset>"
)

FEED_WITH_MAP_NS = (
    '<rss version="2.0" xmlns:m="http://www.sitemaps.org/schemas/sitemap/0.9"><channel><title>t</title><item>'
    "<pubDate>Thu, 30 May 2024 08:05:00 +0200</pubDate><link>https://radio.example/a</link></item></channel></rss>"
)


def docs(spark, *bodies):
    rows = [(f"http://site.example/{i}", b.encode() if isinstance(b, str) else b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "url STRING, content BINARY")


def detect(spark, body, offset=1024):
    return docs(spark, body).select(C.detect_sitemap_type(F.col("content"), offset).alias("t")).first().t


def test_detect_types(spark):
    assert detect(spark, NEWS_MAP.format(date="2024-05-31")) == "NEWS"
    assert detect(spark, FEED_WITH_MAP_NS) is None
    assert detect(spark, '<sitemapindex xmlns:n="http://www.google.com/schemas/sitemap-news/0.9">') == "NEWS"
    assert detect(spark, "<sitemapindex>") == "INDEX"
    assert detect(spark, '<urlset xmlns="http://www.google.com/schemas/sitemap/0.84">') == "SITEMAP"
    assert detect(spark, "<html>") is None
    assert detect(spark, "") is None
    assert detect(spark, None) is None
    # a clue across the cut does not count; bytes are counted, not letters
    assert detect(spark, " " * 1020 + "<sitemapindex") is None
    assert detect(spark, " " * 1011 + "<sitemapindex") == "INDEX"
    assert detect(spark, "é" * 506 + "<sitemapindex") is None
    # the sitemap step looks for feeds in its own, larger window
    late_feed = " " * 600 + "<rss " + "http://www.sitemaps.org/schemas/sitemap/0.9"
    assert detect(spark, late_feed) is None
    assert docs(spark, late_feed).select(C.detect_feed(F.lit(None).cast("string"), F.col("content")).alias("f")).first().f is False


@pytest.mark.parametrize(
    "meta,found,action,want",
    [
        ({}, None, "pass", {}),
        ({"isSitemapNews": ["true"]}, None, "parse", {"isSitemapNews": ["true"]}),
        ({}, "NEWS", "parse", {"isSitemapNews": ["true"]}),
        ({"isSitemapNews": ["true"]}, "INDEX", "parse", {"isSitemapNews": ["false"], "isSitemapIndex": ["true"]}),
        ({}, "INDEX", "parse", {"isSitemapIndex": ["true"]}),
        ({"isSitemapVerified": ["true"], "isSitemapNews": ["true"]}, "SITEMAP", "parse", {"isSitemapVerified": ["true"], "isSitemapNews": ["true"]}),
        ({"isSitemapNews": ["true"], "isSitemapIndex": ["TRUE"]}, "SITEMAP", "fetched", {"isSitemap": ["true"], "isSitemapNews": ["false"], "isSitemapIndex": ["false"]}),
        ({"isSitemap": ["true"]}, None, "fetched", {"isSitemap": ["true"]}),
        ({"isSitemap": ["yes"]}, None, "pass", {"isSitemap": ["yes"]}),
        (None, "SITEMAP", "fetched", {"isSitemap": ["true"]}),
    ],
)
def test_flag_table(spark, meta, found, action, want):
    row = spark.createDataFrame([(meta, found)], f"m {META}, t STRING").select(C.resolve_sitemap_flags(F.col("m"), F.col("t")).alias("f")).first().f
    assert (row.action, row.metadata) == (action, want)


# --- extraction -------------------------------------------------------------------------------


def links(spark, body, hours=168):
    return [r.url for r in X.extract_sitemap_urls(docs(spark, body), NOW, hours).orderBy("url_pos", "link_pos").collect()]


def test_news_sitemap_windows(spark):
    assert links(spark, NEWS_MAP.format(date="2019-02-03")) == []
    assert links(spark, NEWS_MAP.format(date="2024-05-31")) == ["https://paper.example/fr/budget", "https://paper.example/budget"]
    assert len(links(spark, NEWS_MAP.format(date="2019-02-03"), hours=-1)) == 2
    assert len(links(spark, NEWS_MAP.format(date="some day"))) == 2


def test_sitemap_oddities(spark):
    entry = "<url><loc>{}</loc></url>"
    whole = "<urlset>" + entry.format("http://a/1") + "<url><loc></loc></url>" + entry.format("<![CDATA[http://a/2?x=1&y=2]]>") + entry.format("http://a/1") + "</urlset>"
    assert links(spark, whole) == ["http://a/1", "http://a/2?x=1&y=2", "http://a/1"]
    assert links(spark, whole[:-20]) == ["http://a/1", "http://a/2?x=1&y=2"]
    assert links(spark, "<urlset>" + entry.format("http://a/1") + "<url><loc>http://b/&nbsp;</loc></url></urlset>") == ["http://a/1"]
    assert links(spark, "﻿  <urlset>" + entry.format("http://a/1") + "</urlset>") == ["http://a/1"]
    assert links(spark, '<s:urlset xmlns:s="x"><s:url><s:loc>http://a/1</s:loc></s:url></s:urlset>') == ["http://a/1"]
    for nothing in ("<urlset/>", "", None, "no markup", "<urlset></urlset>"):
        assert links(spark, nothing) == []


def test_large_sitemap_in_one_document(spark):
    body = "<urlset>" + "".join(f"<url><loc>http://a/{i}</loc></url>" for i in range(50_000)) + "</urlset>"
    out = X.extract_sitemap_urls(docs(spark, body), NOW, 168)
    assert out.agg(F.count("*"), F.max("url_pos")).first() == (50_000, 49_999)


def test_stagger_counts_kept_children_only(spark):
    child = "<sitemap><loc>http://a/{}</loc><lastmod>{}</lastmod></sitemap>"
    body = "<sitemapindex>" + child.format(1, "2024-05-31") + child.format(2, "2001-01-01") + child.format(3, "") + child.format(4, "2024-05-31T00:00Z") + "</sitemapindex>"
    got = {r.url: r.delay for r in X.extract_sitemap_index(docs(spark, body), NOW, 168, 15).collect()}
    assert got == {"http://a/1": None, "http://a/3": 15, "http://a/4": 30}
    assert {r.delay for r in X.extract_sitemap_index(docs(spark, body), NOW, 168, 0).collect()} == {None}


def test_feeds(spark):
    rss = "<rss><channel><item><guid>https://e.example/g</guid></item><item><guid isPermaLink='false'>tag:1</guid></item><item><link>/rel</link><pubDate>Sat, 25 May 2024 10:00:00 GMT</pubDate></item><item><link>http://old/</link><pubDate>1 Jan 2001 00:00:00 +0000</pubDate></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="self" href="http://x/self"/><link href="http://x/1"/><updated>2024-05-30T00:00:00Z</updated></entry></feed>'
    got = [r.url for r in X.extract_feed_links(docs(spark, rss, atom, FEED_WITH_MAP_NS, "<rss", ""), NOW, 720).orderBy("parent_url", "url_pos").collect()]
    assert got == ["https://e.example/g", "http://site.example/rel", "http://x/1", "https://radio.example/a"]


def test_html(spark):
    page = """<HTML><link rel='alternate' type="application/atom+xml" href='a.xml'><link rel="alternate" hreflang="de" href="/de">
      <LINK REL=canonical HREF="http://c.example/x?a=1&amp;b=2"><link type=text/rss rel=alternate href=/r.rss><a href="p?q=1">x</a><a name=y>"""
    feeds = [r.url for r in X.extract_feed_autodiscovery(docs(spark, page)).orderBy("url_pos").collect()]
    assert feeds == ["http://site.example/a.xml", "http://site.example/r.rss"]
    assert X.extract_canonical(docs(spark, page)).first().canonical == "http://c.example/x?a=1&b=2"
    assert [r.url for r in X.extract_html_links(docs(spark, page)).collect()] == ["http://site.example/p?q=1"]


def step(spark, body, meta, **kw):
    rows = docs(spark, body).withColumn("metadata", M.meta_of(**meta))
    return {r.url: r for r in crawl.process_sitemaps(rows, NOW, 168, **kw).collect()}


def test_process_sitemap_counts_filtered_links_and_marks_children(spark):
    out = step(spark, NEWS_MAP.format(date="2024-05-31"), {"isSitemapNews": "true"}, chain=[{"name": "regex", "params": {"rules": [(False, "/fr/"), (True, ".")]}}])
    parent = out["http://site.example/0"]
    assert parent.status == "FETCHED" and parent.metadata["numLinks"] == ["1"]
    child = out["https://paper.example/budget"]
    assert child.status == "DISCOVERED" and child.metadata["isSitemap"] == ["false"] and child.metadata["url.path"] == ["http://site.example/0"]


def test_alternates_survive_a_rejected_loc(spark):
    out = step(spark, NEWS_MAP.format(date="2024-05-31"), {"isSitemapNews": "true"}, chain=[{"name": "regex", "params": {"rules": [(False, "example/budget"), (True, ".")]}}])
    assert set(out) == {"http://site.example/0", "https://paper.example/fr/budget"}


def test_all_old_items_make_a_tombstone_candidate(spark):
    out = step(spark, NEWS_MAP.format(date="2019-02-03"), {"isSitemapNews": "true"})
    assert out["http://site.example/0"].metadata["numLinks"] == ["0"]


def test_verified_index_passes_it_on(spark):
    out = step(spark, "<sitemapindex><sitemap><loc>http://a/1</loc></sitemap></sitemapindex>", {"isSitemapVerified": "true"})
    child = out["http://a/1"].metadata
    assert child["isSitemapVerified"] == ["true"] and child["isSitemap"] == ["true"]
    assert out["http://site.example/0"].metadata["isSitemapIndex"] == ["true"]


@pytest.mark.parametrize("body", ["<html><body>", "", '<urlset xmlns="http://foreign.example/"><url><loc>http://a/1</loc></url></urlset>'])
def test_unreadable_sitemap_is_an_error_row(spark, body):
    out = step(spark, body, {"isSitemapNews": "true", "numLinks": "3", "isSitemapIndex": "true"})
    row = out["http://site.example/0"]
    assert len(out) == 1 and row.status == "ERROR" and row.metadata["error.source"] == ["sitemap parsing"] and "numLinks" not in row.metadata


# --- dates and scheduling ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "text,want",
    [
        ("2019-02-03", "2019-02-03 00:00:00"),
        ("2024-01-01T10:00Z", "2024-01-01 10:00:00"),
        ("2024-01-01T10:00:00+02:00", "2024-01-01 08:00:00"),
        ("Fri, 24 Jan 2025 15:32:41 -0500", "2025-01-24 20:32:41"),
        ("24 Jan 2025 15:32 GMT", "2025-01-24 15:32:00"),
        ("2024", "2024-01-01 00:00:00"),
        ("2024-05", "2024-05-01 00:00:00"),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, want):
    got = spark.createDataFrame([(text,)], "t STRING").select(parse_date_lenient(F.col("t")).cast("string").alias("d")).first().d
    assert got == want


def test_window_edge_is_kept(spark):
    df = spark.createDataFrame([("2024-05-25 00:00:00",), ("2024-05-24 23:59:59",), (None,)], "t STRING")
    got = df.select(recently_modified(F.col("t").cast("timestamp"), NOW, 168).alias("r")).collect()
    assert [r.r for r in got] == [True, False, True]


def test_status_date(spark):
    got = spark.range(1).select(status_date(F.lit("tomorrow"), NOW).alias("d")).first().d
    assert got == "2024-06-02T00:00:00.000Z"


def test_instants(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00.5z",), ("2024-01-01",), ("2024-01-01T00:00Z",)], "t STRING")
    assert [r.i is not None for r in df.select(parse_instant(F.col("t")).alias("i")).collect()] == [True, True, False, False]


def dead(spark, status, minutes=30 * 24 * 60, **meta):
    row = spark.range(1).select(F.lit(status).alias("s"), M.meta_of(**meta).alias("m"))
    return row.select(SC.is_dead_sitemap(F.col("s"), F.col("m"), NOW, minutes).alias("d")).first().d


def test_dead_sitemaps(spark):
    old, new = "2023-11-14T00:00:00Z", "2024-05-31T00:00:00Z"
    assert dead(spark, "FETCHED", isSitemap="true", numLinks="0", signatureChangeDate=old)
    assert dead(spark, "FETCHED", isSitemapVerified="TRUE", numLinks="0", signatureChangeDate=old)
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="5", signatureChangeDate=old)
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="00", signatureChangeDate=old)
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="0", signatureChangeDate=new)
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="0")
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="0", signatureChangeDate="garbage")
    assert not dead(spark, "FETCHED", numLinks="0", signatureChangeDate=old)
    assert not dead(spark, "FETCHED", isSitemap="false", numLinks="0", signatureChangeDate=old)
    assert not dead(spark, "DISCOVERED", isSitemap="true", numLinks="0", signatureChangeDate=old)
    # exactly as old as the interval is not older
    assert not dead(spark, "FETCHED", isSitemap="true", numLinks="0", signatureChangeDate="2024-05-02T00:00:00Z")


def test_interval_precedence(spark):
    rows = spark.createDataFrame(
        [
            ("FETCHED", {"isSitemap": ["true"], "isSitemapNews": ["true"]}, 1440),
            ("FETCHED", {"isFeed": ["TRUE"], "isSitemapNews": ["true"]}, 720),
            ("FETCHED", {"isFeed": ["false"]}, -1),
            ("DISCOVERED", {"isSitemap": ["true"]}, 300),
            ("DISCOVERED", {}, 0),
            ("FETCH_ERROR", None, 2880),
        ],
        f"status STRING, metadata {META}, want INT",
    )
    for r in SC.assign_interval(rows, SC.default_intervals(spark)).collect():
        assert r.minutes == r.want
    any_status = spark.createDataFrame([(0, None, "isFeed", "true", 7)], "seq INT, status STRING, meta_key STRING, meta_value STRING, minutes INT")
    got = SC.assign_interval(rows.filter("metadata.isFeed[0] = 'TRUE'"), any_status).first()
    assert got.minutes == 7


# --- the root element decides -----------------------------------------------------------------

CHILD = "<sitemap><loc>http://a/1</loc></sitemap>"
ENTRY = "<url><loc>http://a/1</loc></url>"


def test_index_behind_a_long_comment(spark):
    out = step(spark, f"<?xml version='1.0'?><!-- {'x' * 5000} <urlset> --><sitemapindex>{CHILD}</sitemapindex>", {"isSitemapVerified": "true"})
    assert out["http://site.example/0"].metadata["numLinks"] == ["1"] and out["http://a/1"].metadata["isSitemap"] == ["true"]


def test_comment_that_names_another_root(spark):
    out = step(spark, f"<!-- not a <sitemapindex> --><urlset>{ENTRY}</urlset>", {"isSitemapNews": "true"})
    assert out["http://a/1"].metadata["isSitemap"] == ["false"]


@pytest.mark.parametrize(
    "body,status",
    [
        ("<html><body><p>fine</p></body></html>", "ERROR"),
        (f'<s:urlset xmlns:s="http://foreign/ns" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">{ENTRY}</s:urlset>', "ERROR"),
        (f'<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9">{ENTRY}</s:urlset>', "FETCHED"),
        (f"<!DOCTYPE urlset [<!ENTITY a 'b'>]><!-- <html> --><urlset>{ENTRY}</urlset>", "FETCHED"),
        ('<rss version="2.0"><channel></channel></rss>', "FETCHED"),
    ],
)
def test_roots_and_namespaces(spark, body, status):
    assert step(spark, body, {"isSitemapNews": "true"})["http://site.example/0"].status == status


# --- whole rounds -----------------------------------------------------------------------------


def round_of(spark, rows, **kw):
    fetched = spark.createDataFrame(rows, f"url STRING, http_status INT, content BINARY, metadata {META}")
    out = crawl.crawl_updates(fetched, NOW, **kw).collect()
    return {r.url: r for r in out}


def test_redirect_targets_are_filtered_and_inherit_the_path_only(spark):
    meta = {"_redirTo": ["http://to.example/x"], "isFeed": ["true"], "fetchInterval": ["90"]}
    rows = [("http://a.example/", 301, b"", meta), ("http://b.example/", 302, b"", {"_redirTo": ["http://10.0.0.1/x"]})]
    out = round_of(spark, rows, chain=[{"name": "regex"}])
    assert set(out) == {"http://a.example/", "http://b.example/", "http://to.example/x"}
    assert out["http://to.example/x"].metadata == {"url.path": ["http://a.example/"]}


def test_third_failure_in_a_row_is_final(spark):
    rows = [(f"http://{n}.example/", 503, b"", {"error.count": [str(n)]} if n else {}) for n in range(4)]
    out = round_of(spark, [*rows, ("http://ok.example/", 200, b"x", {"error.count": ["2"]})])
    assert [out[f"http://{n}.example/"].status for n in range(4)] == ["FETCH_ERROR", "FETCH_ERROR", "ERROR", "ERROR"]
    assert out["http://1.example/"].metadata["error.count"] == ["2"]
    assert out["http://ok.example/"].status == "FETCHED" and "error.count" not in out["http://ok.example/"].metadata


def test_signatures_of_parsed_documents_only(spark):
    old = {"signature": ["0"]}
    rows = [
        ("http://a.example/", 200, b"<html>article</html>", {}),
        ("http://m.example/", 200, f"<urlset>{ENTRY}</urlset>".encode(), {"isSitemapNews": ["true"], **old}),
        ("http://x.example/", 200, b"<html>no map</html>", {"isSitemapNews": ["true"], **old}),
    ]
    out = round_of(spark, rows)
    assert "signature" not in out["http://a.example/"].metadata
    assert out["http://m.example/"].metadata["signature"] != ["0"] and out["http://m.example/"].metadata["signatureOld"] == ["0"]
    assert out["http://x.example/"].status == "ERROR" and out["http://x.example/"].metadata["signature"] == ["0"]


def test_host_step_inside_a_chain(spark):
    table = R.parse_suffixes(texts(spark, "// list\nuk\nco.uk\ncom\n"))
    rows = [("http://a.b.co.uk/", u) for u in ("http://c.b.co.uk/x", "http://b.co.uk/", "http://d.co.uk/", "http://a.b.co.uk/y", "nonsense")]
    links = spark.createDataFrame(rows, "parent_url STRING, url STRING")
    chain = [{"name": "host", "params": {"ignore_domain": True, "suffixes": table}}]
    assert {r.url for r in FI.apply_url_filters(links, chain).collect()} == {"http://c.b.co.uk/x", "http://b.co.uk/", "http://a.b.co.uk/y"}


def test_lines_of_a_text_sitemap_keep_their_digits(spark):
    """The n-th line once lost the digits of n at its ends."""
    lines = [f"https://h.example/{n}{n}{n}" for n in range(12)]
    body = "\n".join(f"  {x} " for x in lines)
    docs = spark.createDataFrame([("https://h.example/s.txt", body.encode())], "url STRING, content BINARY")
    assert [e.loc for e in X.parse_sitemap(docs).head().entries] == lines

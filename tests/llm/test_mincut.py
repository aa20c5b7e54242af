"""Main text: the cut against all labellings, and pages of several forms."""

from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser
from itertools import product

import pytest

from crawlframe.llm.mincut_html import cut_labels, extract_main_text, main_text, max_flow_labels, read_blocks

LONG = "It was a long day in the town, and nobody had seen the two of them since the early morning. "


def cut_cost(excess, edges, label):
    cost = sum(e for e, keep in zip(excess, label) if e > 0 and not keep) - sum(e for e, keep in zip(excess, label) if e < 0 and keep)
    return cost + sum(w for a, b, w in edges if label[a] != label[b])


def test_cut_is_minimal():
    rnd = random.Random(2)
    for _ in range(150):
        n = rnd.randrange(1, 9)
        excess = [rnd.choice([0.0, rnd.uniform(-3, 3)]) for _ in range(n)]
        edges = [(a, b, rnd.uniform(0, 2)) for a in range(n) for b in range(a) if rnd.random() < 0.5]
        least = min(cut_cost(excess, edges, x) for x in product([False, True], repeat=n))
        for labels in (cut_labels(excess, edges), max_flow_labels(excess, edges)):
            assert abs(cut_cost(excess, edges, labels) - least) < 1e-6


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("<html><body></body></html>", ""),
        ("<script>var a='<p>no</p>'</script>", ""),
        ("<article><h1>A &amp; B</h1><p>One  two\n three<p>Fo<b>ur</b>&#33;</article>", "A & B\n\nOne two three\n\nFour!"),
        ("<article><p>Tru&eacute;. cut &am", "Trué. cut &am"),
        ("<article><p>Kept.</p><p>Cut off in a ta<im", "Kept.\n\nCut off in a ta"),
        ("<article><p>Is 1 < 2 and 3 > 2?</p></article>", "Is 1 < 2 and 3 > 2?"),
        ('<article><p title="a > b">Quoted.</p><p class="x>Unbalanced.</p></article>', "Quoted.\n\nUnbalanced."),
        ("<article><p>A.<!-- <p>no --><br>B.</p><ul><li>C<li>D</ul><table><tr><td>E<td>F</table></article>", "A. B.\n\nC\n\nD\n\nE\n\nF"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def site(body, inner=""):
    return f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar comments-open">
    <header><div class="logo">Site name</div></header><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News of the day</a></li></ul></nav>
    <div class="cookie-notice">We use cookies to make this page better for you. <button>OK</button></div>
    {body}
    <aside class="sidebar"><h3>More</h3><p>{LONG}</p></aside><div id="comments"><div class="comment"><p>{LONG * 2}</p></div></div>
    <form action="/s"><label>Your mail</label><input></form><div class="ad-box">{LONG}</div>{inner}<footer><p>&copy; {LONG}</p></footer></body></html>"""


WANTED = "\n\n".join(["Title here", (LONG * 2).strip(), "Yes.", LONG.strip()])
PARTS = f"<h1>Title here</h1><p>{LONG * 2}</p><p>Yes.</p><p>{LONG}</p>"


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{PARTS}</article>",
        f"<main>{PARTS}</main>",
        f'<div class="wrap"><div class="post-content">{PARTS}</div></div>',
        f'<form id="page"><div role="main">{PARTS}</div></form>',
        f'<article><header>{PARTS.split("<p>")[0]}</header><div class="ad">Buy now!</div><p>{PARTS.split("<p>", 1)[1]}<div class="share-links"><a href="x">Share this</a></div></article>',
        f'<article>{PARTS}<section class="comments"><article class="comment"><p>{LONG}</p></article></section></article>',
    ],
)
def test_site_forms(body):
    assert main_text(site(body)) == WANTED


@pytest.mark.parametrize(
    "body",
    [
        f'<div class="layout with-sidebar"><article>{PARTS}</article></div>',
        f'<article class="post share-enabled">{PARTS}</article>',
        f'<article class="post share related-open">{PARTS}</article>',
        f'<div id="content" class="has-comments">{PARTS}</div>',
        f'<div class="sidebar-layout"><div><article>{PARTS}</article></div></div>',
        f'<div class="widget"><main>{PARTS}</main></div>',
    ],
)
def test_wrappers_with_class_words(body):
    assert main_text(site(body)) == WANTED


SHORT = [
    "The council met on Monday and agreed on a plan for the old harbour.",
    "Work on the first two piers begins in spring, it said later.",
    "Nobody spoke against it, and the mayor thanked all who had come.",
]


@pytest.mark.parametrize(
    "wrapper",
    ['class="social-policy-story"', 'class="alert-news"', 'class="banner-layout"', 'class="promo-free"', 'class="share-page content"', 'class="post-content share"',
     'class="page-header-visible content"', 'class="subscription-content"', 'id="related-content"', "", 'class="text"'],
)
def test_short_paragraphs_under_mixed_names(wrapper):
    body = "".join(f"<p>{s}</p>" for s in SHORT)
    for heading in ("", "<h1>Plan agreed</h1>"):
        page = f"<html><body><div class='menu'><a href='/'>Home</a></div><div {wrapper}>{heading}{body}</div><div class='footer'>Imprint</div></body></html>"
        assert main_text(page) == "\n\n".join((["Plan agreed"] if heading else []) + SHORT)


def test_heading_and_three_very_short_paragraphs():
    assert main_text("<div><h1>News</h1><p>It rained.</p><p>They stayed in.</p><p>All slept.</p></div>") == "News\n\nIt rained.\n\nThey stayed in.\n\nAll slept."


@pytest.mark.parametrize("name", ["ad-box", "cookie-notice", "comments", "sidebar", "sidebar-content", "newsletter-text", "share-links", "related", "promo", "modal-body", "nav-bar"])
def test_what_names_alone_put_away(name):
    away = "".join(f"<p>{s}</p>" for s in SHORT[:2])
    page = f"<body><article><h1>Title</h1><p>{LONG}</p></article><div class='{name}'>{away}</div></body>"
    assert main_text(page) == f"Title\n\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page",
    ["<section>" * 16_000 + "</blockquote>" * 16_000, "<center>" * 16_000 + "<dt>x</dt>" * 8_000, "<p><object>" + "<center>" * 16_000, "<li><ul>" + "<center>" * 8_000 + "<li>x</li>" * 8_000,
     "<table><tr><td>" + "<div>" * 8_000 + "</p>" * 8_000, "<div>" * 12_000 + "</div>" * 12_000],
)
def test_reading_takes_linear_time(page):
    began = time.time()
    read_blocks(page)
    assert time.time() - began < 1.5


class Articles(HTMLParser):
    """A plain reader of pages whose text stands in article elements: blocks in order, without what lies in other matter."""

    AWAY = {"nav", "header", "footer", "aside", "form", "script", "style", "button", "select", "noscript", "template"}
    INLINE = {"a", "b", "i", "em", "strong", "span", "code", "small", "sub", "sup", "u", "br", "img", "abbr", "mark", "q", "time"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.away, self.blocks, self.open = 0, [], [], []

    def cut(self):
        text = " ".join("".join(self.open).split())
        if text:
            self.blocks.append(text)
        self.open = []

    def handle_starttag(self, tag, attrs):
        named = dict(attrs).get("class") or ""
        if tag not in self.INLINE:
            self.cut()
        elif tag == "br":
            self.open.append(" ")
        if self.away:
            self.away += [tag] * (tag == self.away[0])
        elif tag in self.AWAY or re.search(r"\b(ad|ads|comment|comments|cookie|newsletter|share|related|sidebar|promo)\b", named):
            self.away = [tag]
        self.inside += tag in ("article", "main")

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.cut()
        if self.away and tag == self.away[0]:
            self.away.pop()
        self.inside -= tag in ("article", "main")

    def handle_data(self, data):
        if self.inside and not self.away:
            self.open.append(data)


def test_pages_against_a_plain_reader(spark):
    """On the supplied pages the cut finds what a reader finds that knows where they keep their article."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    got = {r.page_id: r.text for r in extract_main_text(rows).collect()}
    for row in rows.collect():
        reader = Articles()
        reader.feed(row.html)
        reader.cut()
        assert got[row.page_id] == "\n\n".join(reader.blocks), row.page_id


def test_long_sentences_outweigh_a_class_word():
    assert main_text(f'<div class="subscription-page"><p>{LONG * 12}</p><p>{LONG * 12}</p></div>').count("nobody") == 24


def test_links_between_paragraphs_stay():
    page = f'<article><p>{LONG}</p><p><a href="x">See what the council said about it</a></p><p>{LONG}</p></article>'
    assert main_text(page).count("\n\n") == 2


def test_long_and_deep_pages():
    assert main_text("<article>" + f"<p>{LONG}</p>" * 4000 + "</article>").count("\n\n") == 3999
    assert main_text("<div>" * 3000 + f"<p>{LONG * 3}</p>") == (LONG * 3).strip()
    assert len(read_blocks("<b>" * 20_000 + "x" + "<p>" * 20_000)) == 1
    assert isinstance(main_text("<" * 20_000), str)


def test_table(spark):
    rows = [(1, "u", site(f"<article>{PARTS}</article>"), "x", 0), (None, None, None, "x", 0), (1, "u", "", "x", 0), (1, "u", "", "x", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long").repartition(2)
    got = sorted((tuple(r) for r in extract_main_text(pages).collect()), key=str)
    assert got == sorted([(1, "u", WANTED, len(WANTED)), (None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0

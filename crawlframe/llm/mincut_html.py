"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks of text with the elements that hold them. A classifier turns each block's
region (element names, roles and class words above it), length, links and sentence marks into a cost of
calling it content and one of calling it boilerplate: the capacities to the two terminals. Smoothness
edges join blocks that follow each other, the stronger the closer they lie in the tree, and blocks with the
element that holds them, and elements with theirs; an element of a region of its own, such as a
menu, hangs on loosely. The minimum cut is the cheapest labelling. Nodes whose terminal capacity exceeds
all their edges are settled first, which doesn't change the cut's value; maximum flow decides the rest.

A class or id word such as sidebar is a cost among others: an article or main below it begins a region of
content again unless its own class names it a comment, an advertisement or related matter, and
long sentences outweigh it. A name that is made of such a word and others (social-policy-story, share-page), or stands beside
a word for text, costs little; names such as has-sidebar or share-enabled cost nothing. Without an article or main, paragraphs that
follow each other in one element speak for each other. Element names and roles
(nav, aside, footer) and hidden elements do decide for all they hold.

Each page is read where it lies: no shuffle. Work is linear in the page's length but for the flow
among what isn't settled.

Cases: null or empty html has no text; unclosed and overlapping elements close as browsers close them;
a page cut off inside a tag loses that tag; repeated rows are each extracted; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--(?:.*?-->|>|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small source span strike strong "
    "sub sup time tt u var wbr picture audio video track link meta base input area col embed param nobr".split()
)
VOID = frozenset("hr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre search section summary table ul".split()
)
#: Elements that another of their kind ends, and what bounds the look for it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: A paragraph is not looked for beyond these.
P_BOUNDS = frozenset("td th table button object li div section article main aside body".split())
_KINDS = {"li": SIBLINGS["li"], "dt": SIBLINGS["dt"], "option": SIBLINGS["option"], "tr": SIBLINGS["tr"], "td": SIBLINGS["td"]}
_KIND_OF = {"li": "li", "dt": "dt", "dd": "dt", "option": "option", "tr": "tr", "td": "td", "th": "td"}
AWAY_TAGS = frozenset("nav footer aside form button select menu dialog search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
AWAY_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr comment comments "
    "disqus reply replies respond sidebar widget widgets menu navbar nav navigation breadcrumb breadcrumbs footer newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations popup modal banner notice notices alert toolbar pagination pager "
    "masthead topbar skip".split()
)
#: Of these, the ones that tell an article apart from a page's own.
ITEM_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments disqus reply replies respond "
    "related recommended recommendations".split()
)
HEAD_WORDS = frozenset(("header", "head"))
#: Of these, the ones that say what an element is whatever else its name has.
SURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsored cookie cookies consent gdpr comment comments disqus reply replies "
    "respond sidebar widget widgets navbar breadcrumb breadcrumbs newsletter popup modal toolbar pagination pager masthead topbar".split()
)
#: Words for containers, which leave a name to the word beside them.
GENERIC_WORDS = frozenset(
    "box wrap wrapper container inner outer link links list bar section block area item items group panel row col column form title titles heading "
    "button buttons btn icon icons top bottom left right site global count unit slot zone holder page main primary secondary".split()
)
#: A class name with one of these says what the page has, not what the element is.
MODIFIERS = frozenset("has have with without no open enabled disabled free".split())
TEXT_WORDS = frozenset("article content post entry story text body main".split())
#: What a name costs that is an AWAY word among others.
MIXED_NAME = 0.6
#: NAMED: under a class or id word of AWAY_WORDS alone.
AWAY, NAMED, FORM, NEUTRAL, MILD, MAIN = -3, -2, -1, 0, 1, 2


class Element:
    """An open or closed block element: its name, holder, region, and what it costs to part from the holder.

    ``doubt``: what class words cost its text. ``p``: the open paragraph a block would end. ``ended``: by kind, the outermost open
    element that a sibling would end.
    """

    __slots__ = ("name", "up", "region", "depth", "tie", "node", "doubt", "p", "ended", "paragraphs")

    def __init__(self, name: str, up: Element | None, region: int, tie: float, doubt: float = 0.0):
        self.name, self.up, self.region, self.tie, self.doubt = name, up, region, tie, doubt
        self.depth = up.depth + 1 if up else 0
        self.node = -1
        self.paragraphs = 0
        self.p = self if name == "p" else None if up is None or name in P_BOUNDS else up.p
        self.ended = up.ended if up else {}
        changes = {}
        for kind, (ends, bounds) in _KINDS.items():
            if name in bounds:
                changes[kind] = None
            elif name in ends and self.ended.get(kind) is None:
                changes[kind] = self
        if changes:
            self.ended = {**self.ended, **changes}


class Block:
    __slots__ = ("text", "holder", "link_chars")

    def __init__(self, text: str, holder: Element, link_chars: int):
        self.text, self.holder, self.link_chars = text, holder, link_chars


def _region(name: str, attributes: str, up: Element) -> tuple[int, float, float]:
    """The region an element begins or goes on, the weight that ties it to its holder, and what its names cost."""
    words: set[str] = set()
    role = ""
    hidden = sure = plain = mixed = head = textual = False
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                for own in value.split():
                    parts = {w.lower() for w in _PART.findall(own)}
                    if parts & MODIFIERS:
                        words |= parts - AWAY_WORDS - HEAD_WORDS
                        continue
                    words |= parts
                    away, named = parts & AWAY_WORDS, parts & HEAD_WORDS
                    rest = parts - AWAY_WORDS - HEAD_WORDS - GENERIC_WORDS
                    sure |= bool(away & SURE_WORDS)
                    plain |= bool(away) and not rest
                    mixed |= bool((away or named) and rest)
                    head |= bool(named) and not rest
                    textual |= bool(parts & TEXT_WORDS) and not away & SURE_WORDS
            elif key == "role":
                role = value.lower().strip()
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                hidden = True
    held = up.region
    whole = name in ("html", "body")
    if hidden and not whole:
        return AWAY, 0.1, 0.0
    main = name in ("article", "main") or role in ("main", "article")
    if held == AWAY:
        return AWAY, 1.0, 0.0
    if not whole and (role in AWAY_ROLES or name in AWAY_TAGS) and not (name == "main" or role == "main"):
        if name == "form" and not words & AWAY_WORDS:
            return (FORM if NAMED < held < MAIN else NAMED if held == NAMED else AWAY), 0.1, up.doubt
        return AWAY, 0.1, 0.0
    if main and not (words & ITEM_WORDS and name != "main" and role != "main"):
        return MAIN, 0.3, 0.0
    if name == "header" and held < MILD and not whole:
        return AWAY, 0.1, 0.0
    if not whole and (sure or (not textual and (plain or (head and held < MILD)))):
        return NAMED, 0.1, 0.0
    doubt = MIXED_NAME if not whole and (mixed or plain) else up.doubt
    if held == NAMED:
        return NAMED, 1.0, 0.0
    if held in (MAIN, FORM):
        return held, 1.0, doubt
    if words & TEXT_WORDS and not whole:
        return MILD, 0.5, doubt
    return held, 1.0, doubt


def read_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, their white space collapsed and character references decoded."""
    root = Element("", None, NEUTRAL, 0.0)
    at, pos, links = root, 0, 0
    text: list[str] = []
    linked: list[str] = []
    blocks: list[Block] = []
    # open elements by name: a tag that ends nothing looks at none of them
    opened: dict[str, int] = {}

    def close_to(up: Element) -> None:
        """Elements below ``up`` end."""
        nonlocal at
        while at is not up:
            opened[at.name] -= 1
            at = at.up

    def end_block() -> None:
        if text:
            own = " ".join(entities.unescape("".join(text)).split())
            if own:
                inside = " ".join(entities.unescape("".join(linked)).split()) if linked else ""
                blocks.append(Block(own, at, len(inside)))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        text.append(piece)
        if links:
            linked.append(piece)

    n = len(page)
    lower: str | None = None
    while pos < n:
        begin = page.find("<", pos)
        if begin < 0:
            add(page[pos:])
            break
        if begin > pos:
            add(page[pos:begin])
        m = _TOKEN.match(page, begin)
        if not m:
            add("<")
            pos = begin + 1
            continue
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing = name.lower(), m[1] or m[4]
        if closing:
            if name == "a":
                links = 0
            if name in INLINE:
                continue
            found = at if opened.get(name) else None
            while found is not None and found.name != name:
                found = found.up
                if found is not None and found.name in ("td", "th", "table") and name in ("p", "div", "li"):
                    found = None
            end_block()
            if found is not None and found is not root:
                close_to(found.up)
                links = 0
            continue
        if name in RAW:
            # browsers look for the end tag without regard to case
            lower = lower or page.lower()
            if len(lower) != n:
                close = re.compile(f"</{name}", re.I).search(page, pos)
                end = close.start() if close else -1
            else:
                end = lower.find(f"</{name}", pos)
            pos = n if end < 0 else (page.find(">", end) + 1 or n)
            continue
        if name in INLINE:
            if name == "a":
                links = 1
            elif name in ("br", "img", "input", "wbr") and name != "wbr":
                add(" ")
            continue
        end_block()
        if name in CLOSES_P and at.p is not None:
            close_to(at.p.up)
        if name in SIBLINGS and at.ended.get(_KIND_OF[name]) is not None:
            close_to(at.ended[_KIND_OF[name]].up)
        if name in VOID:
            continue
        if not m[0].endswith(">"):
            break
        at = Element(name, at, *_region(name, m[3] or m[6] or "", at))
        opened[name] = opened.get(name, 0) + 1
    end_block()
    return blocks


def log_odds(block: Block, some_main: bool) -> float:
    """How much the classifier prefers content over boilerplate."""
    region = block.holder.region
    if region == AWAY:
        base = -6.0
    elif region == NAMED:
        base = -3.0 if some_main else -2.6
    elif region == MAIN:
        base = 2.5
    elif region == MILD:
        base = 0.0 if some_main else 1.0
    else:
        base = -2.5 if some_main else -0.8
    base -= block.holder.doubt
    if not some_main and region in (NEUTRAL, MILD) and block.holder.name == "p":
        # of the paragraphs that one element holds, each speaks for the others
        base += min(1.2, 0.4 * (block.holder.up.paragraphs - 1))
    words = block.text.count(" ") + 1
    base += min(3.0, 0.6 * math.log2(1 + words / 8)) if region != AWAY else min(1.0, 0.1 * math.log2(1 + words / 8))
    base -= 4.0 * min(1.0, block.link_chars / len(block.text))
    if block.text[-1] in ".!?…。\"'”»":
        base += 0.5
    if block.holder.name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        base += 0.5
    return base


def max_flow_labels(excess: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of a minimum cut: ``excess`` > 0 is capacity from the source, < 0 to the sink.

    Shortest augmenting paths (a level graph at a time); all edges work both ways.
    """
    n = len(excess)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, e in enumerate(excess):
        if e > 0:
            link(source, i, e, 0.0)
        elif e < 0:
            link(i, sink, -e, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[node] < len(out[node]):
                e = out[node][at[node]]
                if room[e] > 1e-9 and level[to[e]] == level[node] + 1:
                    path.append(e)
                    node = to[e]
                    break
                at[node] += 1
            else:
                if node == source:
                    break
                e = path.pop()
                node = to[e ^ 1]
                at[node] += 1


def cut_labels(excess: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The source side of a minimum cut; nodes stronger than all their edges are settled before any flow."""
    n = len(excess)
    excess = list(excess)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    ties = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    todo = deque(i for i in range(n) if abs(excess[i]) > ties[i])
    while todo:
        i = todo.popleft()
        if label[i] is not None:
            continue
        label[i] = excess[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                ties[j] -= w
                excess[j] += w if label[i] else -w
                if abs(excess[j]) > ties[j] + 1e-9:
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = [(place[i], place[j], w) for i in rest for j, w in near[i].items() if j in place and i < j]
        for i, found in zip(rest, max_flow_labels([excess[i] for i in rest], inner), strict=True):
            label[i] = found
    return [bool(x) for x in label]


ADJACENT, HELD = 1.2, 0.8


def _steps(a: Element, b: Element) -> int:
    """Elements to cross from one holder to the other, up to 8."""
    steps = 0
    while a is not b and steps < 8:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


def main_text(page: str | None) -> str:
    """The blocks labelled content, joined by an empty line."""
    blocks = read_blocks(page or "")
    some_main = any(b.holder.region == MAIN for b in blocks)
    for b in blocks:
        if b.holder.name == "p" and b.link_chars < len(b.text) / 2:
            b.holder.up.paragraphs += 1
    excess = [log_odds(b, some_main) for b in blocks]
    edges: list[tuple[int, int, float]] = []
    for i in range(1, len(blocks)):
        a, b = blocks[i - 1].holder, blocks[i].holder
        apart = 0.2 if (a.region <= NAMED) != (b.region <= NAMED) else 1.0
        edges.append((i - 1, i, ADJACENT * apart / (1 + _steps(a, b))))
    for i, block in enumerate(blocks):
        child, at = i, block.holder
        weight = HELD
        while at is not None and at.up is not None:
            new = at.node < 0
            if new:
                at.node = len(excess)
                excess.append(0.0)
            edges.append((child, at.node, weight))
            if not new:
                break
            child, weight, at = at.node, HELD * at.tie, at.up
    found = cut_labels(excess, edges)
    return "\n\n".join(b.text for b, keep in zip(blocks, found, strict=False) if keep)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")

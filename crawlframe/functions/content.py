"""Content sniffing, sitemap flags and other per-document expressions on BINARY bodies."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from crawlframe.functions.metadata import empty_meta, meta_first, meta_true, meta_update
from crawlframe.schemas import IS_INDEX, IS_NEWS, IS_SITEMAP, IS_VERIFIED

# XML namespaces.
NEWS_NAMESPACES = (
    "http://www.google.com/schemas/sitemap-news/0.9",
    "https://www.google.com/schemas/sitemap-news/0.9",
)
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
LEGACY_NAMESPACES = (
    "https://www.sitemaps.org/schemas/sitemap/0.9",
    "http://www.sitemaps.org/schemas/sitemap/0.9/",
    "https://www.sitemaps.org/schemas/sitemap/0.9/",
    "http://www.google.com/schemas/sitemap/0.84",
    "http://www.google.com/schemas/sitemap/0.9",
    "http://www.google.com/schemas/sitemap/0.90",
)
LINK_NAMESPACE = "http://www.w3.org/1999/xhtml"

# Feed clues in types and bodies, and the byte windows they are looked up in.
FEED_TYPES = ("rss+xml", "atom+xml", "text/rss")
FEED_CLUES = (("<rss",), ("<feed",), ("http://www.w3.org/2005/Atom",))
INDEX_CLUE = "<sitemapindex"
SITEMAP_WINDOW = 1024
FEED_WINDOW = 512


def sitemap_clues(
    news: Sequence[str] = NEWS_NAMESPACES,
    sitemap: str = SITEMAP_NAMESPACE,
    legacy: Sequence[str] = LEGACY_NAMESPACES,
) -> list[tuple[str, ...]]:
    """Clue groups in the order that decides the type: news, index, plain, legacy."""
    return [(n,) for n in news] + [(INDEX_CLUE,), (sitemap,)] + [(n,) for n in legacy]


def first_clue_match(content: Column, groups: Sequence[Sequence[str]], max_offset: int) -> Column:
    """Index of the first group whose clues all occur in the first ``max_offset`` bytes, else -1."""
    window = F.substring(content, 1, max_offset)
    verdict = None
    for i, group in enumerate(groups):
        hit = F.lit(True)
        for clue in group:
            hit = hit & F.contains(window, F.lit(clue.encode("utf-8")))
        verdict = F.when(hit, F.lit(i)) if verdict is None else verdict.when(hit, F.lit(i))
    return F.lit(-1) if verdict is None else verdict.otherwise(F.lit(-1))


def detect_sitemap_type(content: Column, offset: int = SITEMAP_WINDOW) -> Column:
    """NEWS, INDEX, SITEMAP or NULL. A feed clue in the window rules a sitemap out."""
    groups = sitemap_clues()
    match = first_clue_match(content, groups, offset)
    index_at = len(NEWS_NAMESPACES)
    return (
        F.when(first_clue_match(content, FEED_CLUES, offset) >= 0, F.lit(None).cast("string"))
        .when(match.between(0, index_at - 1), F.lit("NEWS"))
        .when(match == index_at, F.lit("INDEX"))
        .when(match > index_at, F.lit("SITEMAP"))
    )


def detect_feed(content_type: Column, content: Column, flagged: Column | None = None) -> Column:
    """Known as feed, a feed media type, or a feed clue in the first 512 bytes."""
    by_type = F.lit(False)
    for clue in FEED_TYPES:
        by_type = by_type | content_type.contains(clue)
    by_body = first_clue_match(content, FEED_CLUES, FEED_WINDOW) >= 0
    known = F.lit(False) if flagged is None else flagged
    return F.coalesce(known, F.lit(False)) | F.coalesce(by_type, F.lit(False)) | by_body


def detect_sitemap_bootstrap(content: Column, is_sitemap: Column, is_news: Column) -> Column:
    """Struct of the two flags as the site classifier sets them: no feed check, no index flag."""
    match = first_clue_match(content, sitemap_clues(), SITEMAP_WINDOW)
    sniff = ~(is_sitemap & is_news)
    return F.struct(
        (is_sitemap | (sniff & (match >= 0))).alias("is_sitemap"),
        (is_news | (sniff & match.between(0, len(NEWS_NAMESPACES) - 1))).alias("is_news"),
    )


def resolve_sitemap_flags(metadata: Column, detected: Column) -> Column:
    """Struct of the updated metadata and what happens next: parse, fetched or pass."""
    verified = meta_true(metadata, IS_VERIFIED)
    was_news = meta_true(metadata, IS_NEWS)
    was_index = meta_true(metadata, IS_INDEX)
    found = F.coalesce(detected, F.lit(""))
    is_news = F.when(found == "NEWS", True).when(found == "INDEX", False).when(
        (found == "SITEMAP") & ~verified, False
    ).otherwise(was_news)
    is_index = F.when(found == "INDEX", True).when((found == "SITEMAP") & ~verified, False).otherwise(was_index)
    is_sitemap = (found != "") | meta_true(metadata, IS_SITEMAP)
    parse = is_news | is_index | verified

    # new value per flag, NULL = as it was; isSitemap is dropped from everything that gets parsed
    news = F.when(found == "NEWS", "true").when(was_news & ~is_news, "false")
    index = F.when(found == "INDEX", "true").when(was_index & ~is_index, "false")
    sitemap = F.when(~parse & (found != ""), "true")
    updated = meta_update(metadata, {IS_SITEMAP: sitemap, IS_NEWS: news, IS_INDEX: index}, remove={IS_SITEMAP: parse})
    out = F.when((found != "") | parse, updated).otherwise(F.coalesce(metadata, empty_meta()))
    action = F.when(parse, "parse").when(is_sitemap, "fetched").otherwise("pass")
    return F.struct(out.alias("metadata"), action.alias("action"), verified.alias("verified"))


GZIP_MAGIC = b"\x1f\x8b"
#: A compressed body gives at most this many bytes.
INFLATE_LIMIT = 64 * 1024 * 1024


def gunzip(body: bytes, limit: int = INFLATE_LIMIT) -> bytes:
    """What can be read of a gzip body, all its members, up to the limit; a broken one gives what lies before the break."""
    out, left = [], limit
    while body[:2] == GZIP_MAGIC and left > 0:
        member = zlib.decompressobj(31)
        try:
            piece = member.decompress(body, left)
        except zlib.error:
            break
        out.append(piece)
        left -= len(piece)
        body = member.unused_data
    return b"".join(out)


def _inflated(bodies: pa.Array) -> pa.Array:
    return pa.array([None if b is None else gunzip(b) for b in bodies.to_pylist()], pa.binary())


def inflate(content: Column) -> Column:
    """The body, decompressed where it begins as gzip does. Only such bodies leave the JVM, in Arrow batches."""
    packed = F.substring(content, 1, 2) == F.lit(GZIP_MAGIC)
    return F.when(packed, F.arrow_udf(_inflated, BinaryType())(F.when(packed, content))).otherwise(content)


def sitemap_parse_mode(content_type: Column) -> Column:
    """Whether the media type is trusted or guessed from the body."""
    unknown = content_type.isNull() | (F.trim(content_type) == "") | content_type.contains("octet-stream")
    return F.when(unknown, "guess").otherwise("trust")


#: What may stand before the root element: blanks, processing instructions, comments, a doctype.
_PROLOG = r"(?:[\uFEFF\s]++|<\?.*?\?>|<!--.*?-->|<![A-Za-z][^>\[]*+(?:\[.*?\]\s*)?>)*+"


def root_tag(text: Column) -> Column:
    """Inside of the root element's start tag; empty where the text does not begin as a document."""
    return F.regexp_extract(text, rf"(?s)^{_PROLOG}<([A-Za-z_][^>]*)>", 1)


def root_name(text: Column) -> Column:
    """Name of the root element without its prefix."""
    return F.regexp_extract(root_tag(text), r"^(?:[A-Za-z_][\w.\-]*:)?([A-Za-z_][\w.\-]*)", 1)


def namespace_guard(content: Column) -> Column:
    """True when the root element has no namespace or an accepted one."""
    text = content.cast("string")
    root = root_tag(text)
    prefix = F.regexp_extract(root, r"^([A-Za-z_][\w.\-]*):", 1)
    default_ns = F.regexp_extract(root, r"""\sxmlns\s*=\s*["']([^"']*)["']""", 1)
    bound = r"""\sxmlns:([A-Za-z_][\w.\-]*)\s*=\s*["']([^"']*)["']"""
    place = F.array_position(F.regexp_extract_all(root, F.lit(bound), 1), prefix)
    # a prefix that is bound to nothing is no namespace of ours
    bound_ns = F.coalesce(F.get(F.regexp_extract_all(root, F.lit(bound), 2), (place - 1).cast("int")), F.lit("?"))
    ns = F.when(prefix != "", bound_ns).otherwise(default_ns)
    return F.trim(ns).isin("", SITEMAP_NAMESPACE, LINK_NAMESPACE, *LEGACY_NAMESPACES, *NEWS_NAMESPACES)


def trim_content(content: Column, limit: int = 5 * 1024 * 1024, partial: Column | None = None) -> Column:
    """Struct of the body within the limit and whether it was cut (-1 = no limit)."""
    too_long = F.lit(False) if limit < 0 else F.coalesce(F.octet_length(content) > limit, F.lit(False))
    kept = content if limit < 0 else F.substring(content, 1, limit)
    flag = too_long if partial is None else too_long | F.coalesce(partial, F.lit(False))
    return F.struct(kept.alias("content"), flag.alias("trimmed"))


def content_signature(content: Column) -> Column:
    """MD5 of the raw bytes."""
    return F.md5(content)


def with_signature(metadata: Column, content: Column) -> Column:
    """Put the new signature in the metadata and keep the previous one beside it."""
    return meta_update(
        metadata, {"signature": content_signature(content), "signatureOld": meta_first(metadata, "signature")}
    )

"""URL expressions: splitting, normalising, resolving. Built-in functions only.

Splitting follows the lenient view of a classic URL class rather than the strict URI grammar:
hosts keep their case, ``_``, blanks and non-ASCII letters are fine, an unknown scheme or a port
that is no number makes the URL unparsable. ``parse_url`` is the strict one and is not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes with a handler, and their default ports where one is dropped.
KNOWN_SCHEMES = ("http", "https", "ftp", "file", "mailto", "jar")
DEFAULT_PORTS = {"http": "80", "https": "443"}

_CONTROL_AND_BLANK = "".join(chr(c) for c in range(33))
_NON_ASCII = "[^\\x00-\\x7F]"

# One pass of this pattern feeds all parts: scheme, //authority, path, ?query, #fragment.
_URL_SHAPE = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_CUT = "\x01"
_SERVER_SHAPE = r"^(?:[^@]*@)?(\[[^\]]*\]|[^:\[@]*)(:[^@]*)?$"


def _after(text: Column, head: Column, skip: int) -> Column:
    """What follows ``head`` plus ``skip`` characters."""
    return F.substring(text, F.length(head) + skip + 1, F.length(text))


def remove_dot_segments(path: Column, keep_parents: bool = False) -> Column:
    """Resolve ``.`` and ``..`` in a path; ``keep_parents`` leaves a ``..`` that has nothing to remove."""
    parts = F.split(path, "/", -1)
    empty = F.array().cast("array<string>")

    def step(acc: Column, seg: Column) -> Column:
        top = F.get(acc, F.size(acc) - 1)
        # the first element of an absolute path is the empty text before the slash: never removed
        can_pop = (F.size(acc) > 1) & (top != "..")
        popped = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        beyond = F.concat(acc, F.array(seg)) if keep_parents else acc
        return (
            F.when(seg == ".", acc)
            .when(seg == "..", F.when(can_pop, popped).otherwise(beyond))
            .otherwise(F.concat(acc, F.array(seg)))
        )

    folded = F.array_join(F.aggregate(parts, empty, step), "/")
    # a trailing "." or ".." names a directory
    folded = F.when(path.rlike(r"/\.{1,2}$") & ~folded.endswith("/"), F.concat(folded, F.lit("/"))).otherwise(folded)
    return F.when(path.contains("/."), folded).otherwise(path)


def url_pieces(url: Column) -> Column:
    """Scheme, //authority, path, ?query and #fragment as an array; one element when it is no URL."""
    text = F.btrim(url, F.lit(_CONTROL_AND_BLANK))
    return F.split(F.regexp_replace(text, _URL_SHAPE, _CUT.join(["$1", "$2", "$3", "$4", "$5"])), _CUT, -1)


def url_parts(url: Column, pieces: Column | None = None) -> Column:
    """Struct of scheme, authority, host, port, path, query, file, ref, valid.

    ``query`` and ``ref`` are NULL when absent and empty when only the mark is there. ``pieces`` is a
    column that already holds :func:`url_pieces`.
    """
    pieces = url_pieces(url) if pieces is None else pieces
    scheme = F.when(F.size(pieces) == 5, F.lower(F.get(pieces, F.lit(0))))
    authority = F.substring(F.get(pieces, F.lit(1)), 3, 2**31 - 1)
    path = remove_dot_segments(F.get(pieces, F.lit(2)), keep_parents=True)
    raw_query = F.get(pieces, F.lit(3))
    raw_ref = F.get(pieces, F.lit(4))
    # user-info, port and bracketed addresses are rare: most authorities are the host
    bare = ~authority.rlike(r"[@:\[]")
    host = F.when(bare, authority).otherwise(F.regexp_extract(authority, _SERVER_SHAPE, 1))
    port = F.when(bare, "").otherwise(F.regexp_extract(authority, _SERVER_SHAPE, 2))
    valid = (F.size(pieces) == 5) & scheme.isin(*KNOWN_SCHEMES) & ((port == "") | port.rlike("^:[0-9]{0,5}$"))
    return F.struct(
        scheme.alias("scheme"),
        authority.alias("authority"),
        host.alias("host"),
        F.substring(port, 2, 5).try_cast("int").alias("port"),
        path.alias("path"),
        F.when(raw_query != "", F.substring(raw_query, 2, 2**31 - 1)).alias("query"),
        F.concat(path, raw_query).alias("file"),
        F.when(raw_ref != "", F.substring(raw_ref, 2, 2**31 - 1)).alias("ref"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def url_host(url: Column) -> Column:
    return url_parts(url)["host"]


def label_count(host: Column) -> Column:
    """Number of dot-separated labels."""
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def last_labels(host: Column, n: int) -> Column:
    """The last ``n`` labels, NULL for a host with fewer."""
    return F.when((host != "") & (label_count(host) >= n), F.substring_index(host, ".", -n))


def host_suffixes(host: Column) -> Column:
    """The host, each parent domain, then "." for the rules that hold everywhere."""
    labels = F.split(host, "[.]", -1)
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )
    everywhere = F.array(F.lit("."))
    return F.when(host == "", everywhere).otherwise(F.concat(suffixes, everywhere))


def url_id(url: Column) -> Column:
    return F.sha2(url, 256)


def _idn(host: Column) -> Column:
    """ASCII form of a host, NULL when it has none. Runs in the JVM, and only on the rows that need it."""
    return F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host)


def punycode_host(url: Column, parts: Column | None = None) -> Column:
    """Rewrite a non-ASCII host; other URLs stay as they are, malformed ones become NULL (rejected).

    The rewritten URL is made of scheme, host, port and file: user-info and fragment are lost.
    """
    p = url_parts(url) if parts is None else parts
    port = F.coalesce(F.concat(F.lit(":"), p["port"].cast("string")), F.lit(""))
    rebuilt = F.concat(p["scheme"], F.lit("://"), _idn(p["host"]), port, p["file"])
    return F.when(~p["valid"], F.lit(None).cast("string")).when(p["host"].rlike(_NON_ASCII), rebuilt).otherwise(url)


def normalize_url(
    url: Column,
    remove_anchor: bool = True,
    unmangle_query: bool = True,
    check_uri: bool = True,
    idn: bool = True,
    parts: Column | None = None,
) -> Column:
    """Canonical spelling of a URL, NULL when it is rejected."""
    p = url_parts(url) if parts is None else parts
    has_user = p["authority"].contains("@")
    user = F.when(has_user, F.concat(F.substring_index(p["authority"], "@", 1), F.lit("@"))).otherwise("")
    host = F.lower(p["host"])
    if idn:
        host = F.when(host.rlike(_NON_ASCII), _idn(host)).otherwise(host)
    is_default = F.lit(False)
    for scheme, port in DEFAULT_PORTS.items():
        is_default = is_default | ((p["scheme"] == scheme) & (p["port"] == int(port)))
    port = F.when(p["port"].isNull() | is_default, "").otherwise(F.concat(F.lit(":"), p["port"].cast("string")))
    authority = F.when(p["authority"] == "", "").otherwise(F.concat(F.lit("//"), user, host, port))
    path = p["path"]
    if unmangle_query:
        path = F.when(p["query"].isNull() & path.contains("&"), F.regexp_replace(path, "^([^&]*)&", "$1?")).otherwise(path)
    path = F.when((path == "") & (p["authority"] != ""), "/").otherwise(path)
    query = F.coalesce(F.concat(F.lit("?"), p["query"]), F.lit(""))
    ref = F.lit("") if remove_anchor else F.coalesce(F.concat(F.lit("#"), p["ref"]), F.lit(""))
    out = F.concat(p["scheme"], F.lit(":"), authority, path, query, ref)
    ok = p["valid"]
    if check_uri:
        out = F.replace(out, F.lit(" "), F.lit("%20"))
        ok = ok & ~F.trim(url).rlike(r"[\x00-\x1F\x7F]")
    return F.when(ok, out)


def regex_normalize(url: Column, rules: Sequence[tuple[str, str]] = ()) -> Column:
    """Apply (pattern, substitution) pairs in order; ``$n`` names a group."""
    for pattern, substitution in rules:
        url = F.regexp_replace(url, pattern, substitution)
    return url


def resolve_url(base: Column, href: Column, base_parts: Column | None = None) -> Column:
    """Absolute form of ``href`` found in the document at ``base`` (RFC 3986, section 5)."""
    b = url_parts(base) if base_parts is None else base_parts
    root = F.concat(b["scheme"], F.lit("://"), b["authority"])
    base_path = F.when(b["path"] == "", "/").otherwise(b["path"])
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    target_path = F.regexp_extract(href, "^([^?#]*)", 1)
    tail = _after(href, target_path, 0)
    base_query = F.coalesce(F.concat(F.lit("?"), b["query"]), F.lit(""))
    has_scheme = href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    return (
        F.when(has_scheme, href)
        .when(href.startswith("//"), F.concat(b["scheme"], F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, remove_dot_segments(target_path), tail))
        .when(href == "", F.concat(root, base_path, base_query))
        .when(href.startswith("#"), F.concat(root, base_path, base_query, href))
        .when(href.startswith("?"), F.concat(root, base_path, href))
        .otherwise(F.concat(root, remove_dot_segments(F.concat(folder, target_path)), tail))
    )

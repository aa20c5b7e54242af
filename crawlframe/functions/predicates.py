"""Accept / reject predicates on URLs, addresses and depth. True means keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.urls import url_parts


def basic_url_filter(
    url: Column, max_path_rep: int = 4, max_len: int = 1024, parts: Column | None = None
) -> Column:
    """Reject long URLs and paths that repeat an element ``max_path_rep`` times."""
    path = (url_parts(url) if parts is None else parts)["path"]
    elements = F.filter(F.split(path, "/", -1), lambda e: e != "")
    # an element can only repeat that often when enough elements are duplicates
    suspicious = F.size(elements) - F.size(F.array_distinct(elements)) >= max_path_rep - 1
    repeated = F.exists(
        F.array_distinct(elements), lambda e: F.size(F.filter(elements, lambda x: x == e)) >= max_path_rep
    )
    return F.coalesce((F.length(url) <= max_len) & ~(suspicious & repeated), F.lit(False))


def self_filter(parent: Column, url: Column) -> Column:
    return ~F.coalesce(parent == url, F.lit(False))


def host_filter(
    parent: Column,
    url: Column,
    ignore_host: bool = False,
    ignore_domain: bool = False,
    parent_domain: Column | None = None,
    url_domain: Column | None = None,
) -> Column:
    """Keep links inside the parent's host or domain; with both switches off everything is kept."""
    keep = F.lit(True)
    if ignore_host:
        keep = keep & (url_parts(parent)["host"] == url_parts(url)["host"])
    if ignore_domain:
        if parent_domain is None or url_domain is None:
            raise ValueError("ignore_domain needs the registered domains of both sides, see partition_key")
        keep = keep & (parent_domain == url_domain)
    return F.coalesce(keep, F.lit(False))


def max_depth_filter(depth: Column, n: int = -1) -> Column:
    return F.lit(True) if n == -1 else F.coalesce(depth <= n, F.lit(True))


# Schemes and addresses no link may lead to, file suffixes that hold no news.
DEFAULT_REGEX_RULES: tuple[tuple[bool, str], ...] = (
    (False, r"^(?:file|ftp|mailto):"),
    (
        False,
        r"^https?://(?:localhost|127(?:\.(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))){3}|\[::1\])(?::\d+)?(?:/|$)",
    ),
    (False, r"^https?://(?:10(?:\.(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))){3})(?::\d+)?(?:/|$)"),
    (False, r"^https?://(?:192\.168(?:\.(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))){2})(?::\d+)?(?:/|$)"),
    (
        False,
        r"^https?://(?:172\.(?:1[6789]|2[0-9]|3[01])(?:\.(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))){2})(?::\d+)?(?:/|$)",
    ),
    (
        False,
        r"(?i)\.(?:apk|gif|jpg|png|ico|css|sit|eps|wmf|rar|tar|zip|gz|rpm|tgz|mov|exe|jpeg|bmp|js|mpg|mp3|mp4|ogv)(\?|&|$)",
    ),
    (True, r"."),
)


def regex_url_filter(url: Column, rules: Sequence[tuple[bool, str]] = DEFAULT_REGEX_RULES) -> Column:
    """Ordered (accept, pattern) rules; the first pattern found decides, none found rejects."""
    verdict = None
    for accept, pattern in rules:
        hit = url.rlike(pattern)
        verdict = F.when(hit, F.lit(accept)) if verdict is None else verdict.when(hit, F.lit(accept))
    return F.lit(False) if verdict is None else F.coalesce(verdict.otherwise(False), F.lit(False))


def scheme_filter(url: Column, schemes: Sequence[str] = ("http", "https")) -> Column:
    return F.coalesce(F.lower(F.substring_index(url, ":", 1)).isin(*schemes), F.lit(False))


# Loopback and site-local IPv4 ranges (first and last address) and IPv6 prefixes.
_PRIVATE_V4 = (
    ("127.0.0.0", "127.255.255.255"),
    ("10.0.0.0", "10.255.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.168.0.0", "192.168.255.255"),
)
_PRIVATE_V6 = r"^(?:::1|0:0:0:0:0:0:0:1|fe[c-f][0-9a-f]:.*)$"


def ipv4_number(ip: Column) -> Column:
    """An IPv4 text as a BIGINT, NULL when it is not one."""
    octets = F.transform(F.split(ip, "[.]"), lambda o: o.try_cast("bigint"))
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, o: acc * 256 + o)
    return F.when(ip.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), number)


def private_ip_filter(ip: Column) -> Column:
    """Keep addresses that are neither loopback nor site-local; unknown addresses are kept."""
    n = ipv4_number(ip)
    private = F.lower(ip).rlike(_PRIVATE_V6)
    for low, high in _PRIVATE_V4:
        private = private | n.between(ipv4_number(F.lit(low)), ipv4_number(F.lit(high)))
    return ~F.coalesce(private, F.lit(False))

"""Registered queries on URLs, rules and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.catalog.fixtures import derived, rule_texts, table, with_ctes
from crawlframe.functions import predicates as P
from crawlframe.functions import urls as U
from crawlframe.functions.metadata import meta_of
from crawlframe.operators import filtering, keys
from crawlframe.operators.aggregates import aggregate
from crawlframe.operators.extract import extract_robots_rules
from crawlframe.operators.frontier import newest_excluded, warc_publish_manifest
from crawlframe.plans import profiles
from crawlframe.schemas import DENY_RULES, SUFFIXES
from crawlframe.sources import rules as R
from crawlframe.sources.seeds import parse_seeds

# A small rule table of every kind; the hosts are those of the supplied pages.
RULE_ROWS = [
    (1, "host", "www.ththin.example.net", "path", "/en/"),
    (2, "domain", "example.org", "pathquery", "[?&]page=2"),
    (3, "domain", "ththth.example.net", "all", "."),
    (4, "domain", "net", "path", "^/de/[0-9]*5"),
    (5, "domain", ".", "path", "/1[0-9]*7$"),
    (6, "host", "example.org", "all", "."),
    (7, "domain", "example.com", "pathquery", "ref=x"),
    (8, "domain", "ththtion.example.com", "path", "/fr/"),
]
RULES_SQL = "d_rules(seq, scope, key, kind, pattern) AS (VALUES " + ", ".join(
    f"({s}, '{sc}', '{k}', '{kd}', '{p}')" for s, sc, k, kd, p in RULE_ROWS
) + ")"

# The deny decision written out in SQL over suffix rows; used by several checks.
_URLS_SQL = """
d_u AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 2) AS host,
               regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 3) AS path,
               regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS file FROM pages),
d_probe AS (
  SELECT url, path, file, 'host' AS scope, host AS key, 0 AS level FROM d_u
  UNION ALL
  SELECT url, path, file, 'domain', array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'), i
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM d_u) x
  UNION ALL
  SELECT url, path, file, 'domain', '.', 1000 FROM d_u),
d_hits AS (
  SELECT p.url, r.*, p.level FROM d_probe p JOIN d_rules r ON p.scope = r.scope AND p.key = r.key
  WHERE r.kind = 'all' OR (r.kind = 'path' AND regexp_matches(p.path, r.pattern))
     OR (r.kind = 'pathquery' AND regexp_matches(p.file, r.pattern)))
"""


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_ROWS, DENY_RULES)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url")


def _forms(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "d_url_forms")


def _large_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule table that grows with the pages: one rule per page, its own path under its host."""
    return derived(spark, sf, "d_host_pages").select(
        F.col("page_id").alias("seq"),
        F.when(F.col("page_id") % 2 == 0, "host").otherwise("domain").alias("scope"),
        F.col("host").alias("key"),
        F.when(F.col("page_id") % 3 == 0, "path").otherwise("pathquery").alias("kind"),
        F.regexp_extract("path", "^(/[a-z]*/[0-9]?)", 1).alias("pattern"),
    )


LARGE_RULES_SQL = """d_rules AS (
  SELECT page_id AS seq, CASE WHEN page_id % 2 = 0 THEN 'host' ELSE 'domain' END AS scope, host AS key,
         CASE WHEN page_id % 3 = 0 THEN 'path' ELSE 'pathquery' END AS kind,
         regexp_extract(path, '^(/[a-z]*/[0-9]?)', 1) AS pattern FROM d_host_pages)"""

SUFFIX_ROWS = [
    ("com", "normal"),
    ("net", "normal"),
    ("org", "normal"),
    ("example.net", "normal"),
    ("example.org", "wildcard"),
    ("ththth.example.org", "exception"),
]


def _suffixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUFFIX_ROWS, SUFFIXES)


def q_accepted_per_host(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: pages no rule denies, counted per host."""
    kept = filtering.deny_filter(_pages(spark, sf), _rules(spark))
    return kept.groupBy(U.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


def q_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    p = U.url_parts(F.col("url"))
    return _forms(spark, sf).select("page_id", p.alias("p")).select(
        "page_id",
        "p.valid",
        *[
            F.coalesce(F.when(F.col("p.valid"), F.col(f"p.{c}").cast("string")), F.lit("-")).alias(c)
            for c in ("scheme", "authority", "host", "port", "path", "query", "file", "ref")
        ],
    )


SQL_URL_PARTS = with_ctes("d_url_forms") + r"""
, m AS (SELECT page_id, url, regexp_matches(url, '^(?i)(http|https|ftp|file|mailto)://') AS valid FROM d_url_forms),
p AS (SELECT page_id, valid,
  lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme,
  regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS authority,
  regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
  regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?[^/?#:]*:([0-9]+)', 1) AS port,
  regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
  CASE WHEN regexp_matches(url, '^[^#?]*\?') THEN regexp_extract(url, '^[^?#]*\?([^#]*)', 1) END AS query,
  regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^#]*)', 1) AS file,
  CASE WHEN contains(url, '#') THEN regexp_extract(url, '#(.*)$', 1) END AS ref FROM m)
SELECT page_id, valid, CASE WHEN valid THEN scheme ELSE '-' END AS scheme, CASE WHEN valid THEN authority ELSE '-' END AS authority,
  CASE WHEN valid THEN host ELSE '-' END AS host, CASE WHEN valid AND port <> '' THEN port ELSE '-' END AS port,
  CASE WHEN valid THEN path ELSE '-' END AS path, CASE WHEN valid THEN coalesce(query, '-') ELSE '-' END AS query,
  CASE WHEN valid THEN file ELSE '-' END AS file, CASE WHEN valid THEN coalesce(ref, '-') ELSE '-' END AS ref FROM p
"""


def q_host_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _pages(spark, sf).select("page_id", F.posexplode(U.host_suffixes(U.url_host(F.col("url")))).alias("pos", "suffix"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "suffix")


SQL_HOST_SUFFIXES = with_ctes("d_host_pages") + """
SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, array_to_string(list_slice(l, i, len(l)), '.') AS suffix
FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, string_split(host, '.') AS l FROM d_host_pages) a) b
UNION ALL
SELECT page_id, CAST(len(string_split(host, '.')) AS BIGINT), '.' FROM d_host_pages
"""


# Labels and what IDNA makes of them.
IDNA_LABELS = (("bücher", "xn--bcher-kva"), ("münchen", "xn--mnchen-3ya"), ("例え", "xn--r8jz45g"), ("plain", "plain"))


def q_punycode_host(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts with one of a few labels put in front."""
    label = F.element_at(F.array(*[F.lit(a) for a, _ in IDNA_LABELS]), (F.col("page_id") % len(IDNA_LABELS) + 1).cast("int"))
    url = F.concat(F.lit("https://"), label, F.lit("."), F.col("host"), F.col("path"), F.lit("?q=é#f"))
    return derived(spark, sf, "d_host_pages").select("page_id", U.punycode_host(url).alias("url"))


SQL_PUNYCODE = with_ctes("d_host_pages") + f"""SELECT page_id, concat('https://', [{', '.join(f"'{b}'" for _, b in IDNA_LABELS)}][page_id % {len(IDNA_LABELS)} + 1],
  '.', host, path, '?q=é', CASE WHEN page_id % {len(IDNA_LABELS)} = 3 THEN '#f' ELSE '' END) AS url FROM d_host_pages"""


def q_normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    return _forms(spark, sf).select("page_id", F.coalesce(U.normalize_url(F.col("url")), F.lit("-")).alias("url"))


SQL_NORMALIZE = with_ctes("d_url_forms") + r"""
, p AS (SELECT page_id, url, regexp_matches(url, '^(?i)(http|https|ftp|file|mailto)://') AS valid,
  lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme,
  regexp_extract(url, '^[A-Za-z]+://([^/?#@]*@)?', 1) AS usr,
  lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
  regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?[^/?#:]*(:[0-9]+)', 1) AS port,
  regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query FROM d_url_forms),
n AS (SELECT page_id, valid, scheme || '://' || usr || host ||
  CASE WHEN (scheme = 'http' AND port = ':80') OR (scheme = 'https' AND port = ':443') THEN '' ELSE port END ||
  CASE WHEN path = '' THEN '/' WHEN query = '' AND contains(path, '&') THEN regexp_replace(path, '^([^&]*)&', '\1?') ELSE path END ||
  query AS url FROM p)
SELECT page_id, CASE WHEN valid THEN replace(url, ' ', '%20') ELSE '-' END AS url FROM n
"""


def q_regex_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Tracking parameters off, mobile hosts and numbered pages to their main form."""
    rules = [(r"[?&](utm_source|ref)=[^&#]*", ""), (r"://m[.]", "://"), (r"/([0-9]+)[.]html", "/$1")]
    return _forms(spark, sf).select("page_id", U.regex_normalize(F.col("url"), rules).alias("url"))


SQL_REGEX_NORMALIZE = with_ctes("d_url_forms") + r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?&](utm_source|ref)=[^&#]*', '', 'g'),
  '://m[.]', '://', 'g'), '/([0-9]+)[.]html', '/\1', 'g') AS url FROM d_url_forms
"""


def q_url_id(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(spark, sf).select("page_id", U.url_id(F.col("url")).alias("url_id"))


def q_resolve_url(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    href = (
        F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("/a/b/../"), n))
        .when(F.col("page_id") % 6 == 1, F.concat(F.lit("?k="), n))
        .when(F.col("page_id") % 6 == 2, F.concat(F.lit("#"), n))
        .when(F.col("page_id") % 6 == 3, F.concat(F.lit("//o.example/"), n))
        .when(F.col("page_id") % 6 == 4, F.concat(F.lit("https://x.example/"), n))
        .otherwise(F.concat(F.lit("./"), n))
    )
    base = F.concat(F.lit("https://"), F.col("host"), F.lit("/d/e.html?z=1#f"))
    return derived(spark, sf, "d_host_pages").select("page_id", U.resolve_url(base, href).alias("url"))


SQL_RESOLVE = with_ctes("d_host_pages") + """
SELECT page_id, CASE page_id % 6
  WHEN 0 THEN concat('https://', host, '/a/', page_id) WHEN 1 THEN concat('https://', host, '/d/e.html?k=', page_id)
  WHEN 2 THEN concat('https://', host, '/d/e.html?z=1#', page_id) WHEN 3 THEN concat('https://o.example/', page_id)
  WHEN 4 THEN concat('https://x.example/', page_id) ELSE concat('https://', host, '/d/', page_id) END AS url
FROM d_host_pages
"""


def q_basic_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _forms(spark, sf).select("page_id", P.basic_url_filter(F.col("url"), 4, 60).alias("keep"))


SQL_BASIC = with_ctes("d_url_forms") + r"""
, e AS (SELECT page_id, url, unnest(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/')) AS el FROM d_url_forms),
c AS (SELECT page_id, max(n) AS n FROM (SELECT page_id, el, count(*) AS n FROM e WHERE el <> '' GROUP BY 1, 2) g GROUP BY 1)
SELECT u.page_id, regexp_matches(u.url, '^[A-Za-z]+:') AND length(u.url) <= 60 AND coalesce(c.n, 0) < 4 AS keep FROM d_url_forms u LEFT JOIN c ON c.page_id = u.page_id
"""


def q_regex_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _forms(spark, sf).select("page_id", P.regex_url_filter(F.col("url")).alias("keep"))


def _regex_sql(column: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches({column}, '{pattern}') THEN {'TRUE' if accept else 'FALSE'}"
        for accept, pattern in P.DEFAULT_REGEX_RULES
    )
    return f"CASE {arms} ELSE FALSE END"


def q_scheme_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _forms(spark, sf).select("page_id", P.scheme_filter(F.col("url")).alias("keep"))


def q_self_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "d_sitemap_rows")
    return rows.filter(P.self_filter(F.col("loc"), F.col("alt"))).select("pos", F.coalesce("alt", F.lit("-")).alias("alt"))


def q_host_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry's location and alternate against the sitemap that names them."""
    rows = derived(spark, sf, "d_sitemap_rows")
    parent = F.col("parent_url")
    return rows.select(
        "pos",
        P.host_filter(parent, F.col("loc"), ignore_host=True).alias("loc_inside"),
        P.host_filter(parent, F.coalesce("alt", parent), ignore_host=True).alias("alt_inside"),
    )


def q_max_depth(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "d_status")
    depth = F.when(F.col("event_id") % 10 != 9, (F.col("event_id") % 6).cast("int"))
    return rows.filter(P.max_depth_filter(depth, 3)).select("url")


def q_private_ip(spark: SparkSession, sf: str) -> DataFrame:
    octets = [F.element_at(F.array(*[F.lit(x) for x in (10, 127, 172, 192, 8, 193)]), (F.col("event_id") % 6 + 1).cast("int"))]
    octets += [(F.col("event_id") % 256), (F.col("user_id") % 256), F.lit(1)]
    ip = F.concat_ws(".", *[o.cast("string") for o in octets])
    return derived(spark, sf, "d_status").select("event_id", P.private_ip_filter(ip).alias("keep"))


SQL_PRIVATE_IP = """
SELECT event_id, NOT (a IN (10, 127) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)) AS keep
FROM (SELECT event_id, [10, 127, 172, 192, 8, 193][event_id % 6 + 1] AS a, event_id % 256 AS b FROM events) x
"""


def q_deny_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filtering.deny_filter(_pages(spark, sf), _rules(spark))


SQL_DENY = f"WITH {RULES_SQL},{_URLS_SQL} SELECT page_id, url FROM d_u WHERE url NOT IN (SELECT url FROM d_hits)"


def q_deny_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Odd spellings against a look-up by host and a pattern everywhere."""
    rows = [(1, "domain", "com", "path", "/a/a"), (2, "domain", ".", "pathquery", "[?&]q=1"), (3, "host", "x", "all", ".")]
    return filtering.deny_flag(_forms(spark, sf).select("page_id", "url"), spark.createDataFrame(rows, DENY_RULES)).select(
        "page_id", "denied"
    )


SQL_DENY_FORMS = with_ctes("d_url_forms") + r"""
SELECT page_id, NOT regexp_matches(url, '^(?i)(http|https|ftp)://')
  OR (regexp_matches(url, '^[A-Za-z]+://([^/?#@]*@)?[^/?#:]*\.com([:/?#]|$)') AND regexp_matches(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/a/a'))
  OR regexp_matches(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^#]*)', 1), '[?&]q=1') AS denied FROM d_url_forms
"""


def q_deny_large(spark: SparkSession, sf: str) -> DataFrame:
    return filtering.deny_flag(_pages(spark, sf), _large_rules(spark, sf)).select("page_id", "denied")


def q_deny_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The form for rule tables beyond the broadcast bounds."""
    return filtering.deny_flag(_pages(spark, sf), _large_rules(spark, sf), max_rows=0, share=64).select("page_id", "denied")


SQL_DENY_LARGE = with_ctes("d_host_pages") + f", {LARGE_RULES_SQL},{_URLS_SQL} SELECT page_id, url IN (SELECT url FROM d_hits) AS denied FROM d_u"


def q_deny_explain(spark: SparkSession, sf: str) -> DataFrame:
    out = filtering.deny_explain(_pages(spark, sf), _rules(spark))
    return out.select("page_id", F.coalesce("rule.seq", F.lit(-1)).alias("seq"))


SQL_DENY_EXPLAIN = f"""WITH {RULES_SQL},{_URLS_SQL},
w AS (SELECT url, seq, row_number() OVER (PARTITION BY url ORDER BY level, seq) AS rn FROM d_hits)
SELECT page_id, CAST(coalesce(w.seq, -1) AS BIGINT) AS seq FROM d_u LEFT JOIN w ON w.url = d_u.url AND w.rn = 1"""


def q_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _pages(spark, sf).select("url", meta_of(isFeed="true").alias("metadata"))
    kept, rejected = filtering.prefilter(rows, _rules(spark))
    kept = kept.select("url", F.lit("").alias("status"), F.lit("").alias("cause"))
    return kept.unionByName(rejected.select("url", "status", F.col("metadata")["error.cause"][0].alias("cause")))


SQL_PREFILTER = f"""WITH {RULES_SQL},{_URLS_SQL}
SELECT url, CASE WHEN url IN (SELECT url FROM d_hits) THEN 'ERROR' ELSE '' END AS status,
       CASE WHEN url IN (SELECT url FROM d_hits) THEN 'Filtered' ELSE '' END AS cause FROM d_u"""


def q_deny_rules(spark: SparkSession, sf: str) -> DataFrame:
    return R.parse_deny_rules(rule_texts(spark, sf))


# line numbers: two fixed lines, then three per page (section, rule, blank)
_RULE_SQL = with_ctes("d_rule_lines") + r"""
, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page_id) - 1 AS i FROM d_rule_lines),
d_parsed AS (SELECT doc, CAST(2 + i * 3 + 1 AS BIGINT) AS seq, lower(scope_word) AS scope, host AS key,
  CASE page_id % 6 WHEN 0 THEN 'path' WHEN 1 THEN 'all' ELSE 'pathquery' END AS kind,
  CASE page_id % 6 WHEN 0 THEN path WHEN 1 THEN '.' ELSE concat('[?&]page=', page_id % 5) END AS pattern
  FROM n WHERE page_id % 6 IN (0, 1, 2) AND NOT (page_id % 6 = 0 AND path = ''))
"""
SQL_DENY_RULES = _RULE_SQL + "SELECT doc, seq, scope, key, kind, pattern FROM d_parsed"


def q_rule_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.rule_stats(R.parse_deny_rules(rule_texts(spark, sf)))


SQL_RULE_STATS = _RULE_SQL + """SELECT scope, CAST(count(*) FILTER (kind <> 'all') + count(DISTINCT key) FILTER (kind = 'all') AS BIGINT) AS n_rules
FROM d_parsed GROUP BY scope"""


def q_carry_section(spark: SparkSession, sf: str) -> DataFrame:
    lines = R.deny_rule_lines(rule_texts(spark, sf)).filter("NOT is_header")
    return lines.select("doc", F.col("pos").cast("bigint").alias("pos"), F.coalesce("section.key", F.lit("-")).alias("key"))


SQL_CARRY = with_ctes("d_rule_lines") + """
, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page_id) - 1 AS i FROM d_rule_lines)
SELECT doc, CAST(3 + i * 3 AS BIGINT) AS pos, host AS key FROM n WHERE page_id % 6 <> 5
UNION ALL SELECT DISTINCT doc, CAST(0 AS BIGINT), '-' FROM d_rule_lines
"""


def q_skipped_rule_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.skipped_rule_lines(rule_texts(spark, sf))
    return rows.select("doc", F.col("pos").cast("bigint").alias("pos"), "line")


SQL_SKIPPED = with_ctes("d_rule_lines") + """
, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page_id) - 1 AS i FROM d_rule_lines)
SELECT doc, CAST(3 + i * 3 AS BIGINT) AS pos, trim(rule_line) AS line FROM n WHERE page_id % 6 IN (3, 4) OR (page_id % 6 = 0 AND path = '')
UNION ALL SELECT DISTINCT doc, CAST(0 AS BIGINT), 'DenyPath /orphan' FROM d_rule_lines
UNION ALL SELECT DISTINCT doc, CAST(1 AS BIGINT), 'Host' FROM d_rule_lines
"""


def q_regex_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "d_rule_lines")
    line = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("-^https?://"), "host")).when(
        F.col("page_id") % 3 == 1, F.concat(F.lit("+"), "path")
    ).otherwise("# comment")
    texts = rows.groupBy("doc").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", line.alias("x")))), lambda e: e["x"]), "\n").alias("text")
    )
    out = R.parse_regex_rules(texts)
    return out.select("doc", F.col("seq").cast("bigint").alias("seq"), "accept", "pattern")


SQL_REGEX_RULES = with_ctes("d_rule_lines") + """
, n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page_id) - 1 AS i FROM d_rule_lines)
SELECT doc, CAST(i AS BIGINT) AS seq, page_id % 3 = 1 AS accept, CASE WHEN page_id % 3 = 0 THEN concat('^https?://', host) ELSE path END AS pattern
FROM n WHERE page_id % 3 <> 2
"""


def q_seeds(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("page_id")
    line = (
        F.when(n % 5 == 0, F.concat(F.lit("# "), "url"))
        .when(n % 5 == 1, F.lit("   "))
        .when(n % 5 == 2, F.concat("url", F.lit("\tisFeed=true\tdepth="), n.cast("string")))
        .otherwise(F.concat(F.lit("  "), "url"))
    )
    out = parse_seeds(_pages(spark, sf).select(line.alias("value")))
    first = [F.coalesce(F.try_element_at("metadata", F.lit(k))[0], F.lit("-")).alias(a) for k, a in (("isFeed", "is_feed"), ("depth", "depth"))]
    return out.select("url", "status", *first)


SQL_SEEDS = """
SELECT url, 'DISCOVERED' AS status, CASE WHEN page_id % 5 = 2 THEN 'true' ELSE '-' END AS is_feed,
       CASE WHEN page_id % 5 = 2 THEN CAST(page_id AS VARCHAR) ELSE '-' END AS depth FROM pages WHERE page_id % 5 NOT IN (0, 1)
"""


def q_domain_join(spark: SparkSession, sf: str) -> DataFrame:
    hosts = derived(spark, sf, "d_host_pages").select("page_id", "host")
    return keys.domain_join(hosts, _suffixes(spark)).select("page_id", "suffix", "domain")


def q_domain_join_beyond(spark: SparkSession, sf: str) -> DataFrame:
    """The same beyond the broadcast bounds, over hosts of which two own most rows."""
    hosts = derived(spark, sf, "d_host_pages")
    hot = F.when(F.col("page_id") % 3 == 0, "www.hot.example.org").when(F.col("page_id") % 3 == 1, "Hot.Example.com").otherwise(F.col("host"))
    return keys.domain_join(hosts.select("page_id", hot.alias("host")), _suffixes(spark), max_rows=0).select("page_id", "suffix", "domain")


SQL_DOMAIN = with_ctes("d_host_pages") + """
, l AS (SELECT page_id, host, string_split(host, '.') AS l FROM d_host_pages),
s AS (SELECT page_id, l, CASE
   WHEN host = 'ththth.example.org' OR ends_with(host, '.ththth.example.org') THEN 2
   WHEN ends_with(host, '.example.org') THEN 3
   WHEN host = 'example.net' OR ends_with(host, '.example.net') THEN 2 ELSE 1 END AS n FROM l)
SELECT page_id, array_to_string(list_slice(l, len(l) - n + 1, len(l)), '.') AS suffix,
       array_to_string(list_slice(l, greatest(len(l) - n, 1), len(l)), '.') AS domain FROM s
"""


SQL_DOMAIN_BEYOND = SQL_DOMAIN.replace(
    "l AS (SELECT page_id, host, string_split(host, '.') AS l FROM d_host_pages)",
    """x AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'www.hot.example.org' WHEN 1 THEN 'hot.example.com' ELSE host END AS host FROM d_host_pages),
l AS (SELECT page_id, host, string_split(host, '.') AS l FROM x)""",
)


def q_partition_key(spark: SparkSession, sf: str) -> DataFrame:
    by_domain = keys.partition_key(_pages(spark, sf), "byDomain", _suffixes(spark)).withColumnRenamed("key", "by_domain")
    return keys.partition_key(by_domain, "byHost").withColumnRenamed("key", "by_host").drop("url")


SQL_KEY = SQL_DOMAIN.replace(
    "SELECT page_id, l, CASE", "SELECT page_id, host, l, CASE"
).replace(
    "SELECT page_id, array_to_string(list_slice(l, len(l) - n + 1, len(l)), '.') AS suffix,", "SELECT page_id, host AS by_host,"
).replace("AS domain FROM s", "AS by_domain FROM s")


def _robots_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One robots text per host."""
    hosts = derived(spark, sf, "d_host_pages").select("host").distinct()
    text = F.concat(
        F.lit("# robots\nUser-agent: otherbot\nDisallow: /\n\nUser-Agent: *\nUser-agent: fetcher\nDisallow: /en/1\nAllow: /en/12\nDisallow: /*.html$\nDisallow:\nCrawl-delay: "),
        F.length("host").cast("string"),
        F.lit("\nSitemap: https://"), "host", F.lit("/sm.xml\n  sitemap:https://"), "host", F.lit("/sm2.xml\n"),
    )
    return hosts.select("host", text.alias("text"))


def q_robots_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract_robots_rules(_robots_texts(spark, sf))
    return rows.select(
        "key", "agent",
        F.coalesce(F.col("allow").cast("string"), F.lit("-")).alias("allow"),
        F.coalesce("pattern", F.lit("-")).alias("pattern"),
        F.coalesce("crawl_delay", F.lit(-1.0)).alias("crawl_delay"),
    )


SQL_ROBOTS_RULES = with_ctes("d_host_pages") + """
, h AS (SELECT DISTINCT host FROM d_host_pages), a(agent) AS (VALUES ('*'), ('fetcher')),
r(allow, pattern) AS (VALUES ('false', '/en/1'), ('true', '/en/12'), ('false', '/*.html$'), ('false', ''))
SELECT host AS key, agent, allow, pattern, CAST(-1.0 AS DOUBLE) AS crawl_delay FROM h, a, r
UNION ALL SELECT host, agent, '-', '-', CAST(length(host) AS DOUBLE) FROM h, a
UNION ALL SELECT host, 'otherbot', 'false', '/', CAST(-1.0 AS DOUBLE) FROM h
"""


def q_robots_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = extract_robots_rules(_robots_texts(spark, sf))
    return filtering.robots_filter(_pages(spark, sf), rules, "fetcher")


SQL_ROBOTS_FILTER = with_ctes("d_host_pages") + r"""
, m AS (SELECT page_id, url, greatest(CASE WHEN regexp_matches(url, '^[a-z]+://[^/?#]*/en/1') THEN 10 ELSE 0 END,
   CASE WHEN regexp_matches(url, '^[a-z]+://[^/?#]*/en/12') THEN 13 ELSE 0 END,
   CASE WHEN regexp_matches(url, '^[a-z]+://[^#]*\.html(#.*)?$') THEN 16 ELSE 0 END) AS best FROM d_host_pages)
SELECT page_id, url FROM m WHERE best NOT IN (10, 16)
"""


def q_crawl_delay(spark: SparkSession, sf: str) -> DataFrame:
    rules = extract_robots_rules(_robots_texts(spark, sf))
    return filtering.robots_by_host(rules, "fetcher").select("key", "crawl_delay")


def _chain(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = _forms(spark, sf).select(
            "page_id", "url", F.concat(F.lit("https://"), "host", "path").alias("parent_url"), meta_of().alias("metadata")
        )
        chain = {
            "production": profiles.production,
            "bootstrap": profiles.bootstrap,
            "inject": profiles.inject,
            "pre_fetch": lambda: profiles.pre_fetch(_rules(spark)),
        }[name]()
        return filtering.apply_url_filters(rows, chain).select("page_id", "url")

    return run


_NORM = SQL_NORMALIZE.replace("SELECT page_id, CASE WHEN valid THEN replace(url, ' ', '%20') ELSE '-' END AS url FROM n", "")
_NORMED = _NORM + ", z AS (SELECT page_id, replace(url, ' ', '%20') AS url FROM n WHERE valid)"
_NOT_SELF = "z.url <> concat('https://', f.host, f.path)"
SQL_BOOTSTRAP = f"{_NORMED} SELECT z.page_id, z.url FROM z JOIN d_url_forms f ON f.page_id = z.page_id WHERE {_regex_sql('z.url')} AND {_NOT_SELF}"
SQL_PRODUCTION = SQL_BOOTSTRAP + r""" AND length(f.url) <= 1024 AND NOT EXISTS (SELECT 1 FROM (SELECT el, count(*) AS c FROM
  (SELECT unnest(string_split(regexp_extract(f.url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/')) AS el) q WHERE el <> '' GROUP BY el) g WHERE c >= 4)"""
SQL_PRE_FETCH = (
    with_ctes("d_url_forms")
    + f", {RULES_SQL}, "
    + _URLS_SQL.strip().replace("FROM pages)", "FROM d_url_forms)").replace("'^([a-z]+)://([^/?#]*)([^?#]*)', 2)", "'^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)").replace("'^([a-z]+)://([^/?#]*)([^?#]*)', 3)", "'^[A-Za-z]+://[^/?#]*([^?#]*)', 1)").replace("'^[a-z]+://[^/?#]*([^#]*)', 1)", "'^[A-Za-z]+://[^/?#]*([^#]*)', 1)")
    + " SELECT page_id, url FROM d_u WHERE regexp_matches(url, '^(?i)(http|https|ftp)://') AND url NOT IN (SELECT url FROM d_hits)"
)


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """A file per event, named as a writer names them."""
    name = F.concat(F.lit("NEWS-"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-"), F.lpad(F.col("event_id").cast("string"), 8, "0"), F.lit(".warc.gz"))
    return table(spark, sf, "events").select(name.alias("name"))


_FILES_SQL = "WITH f AS (SELECT concat('NEWS-', strftime(ts, '%Y%m%d%H%M%S'), '-', lpad(CAST(event_id AS VARCHAR), 8, '0'), '.warc.gz') AS name FROM events) "


def q_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return warc_publish_manifest(_files(spark, sf), "s3://target/archive/", "NEWS")


def q_newest_excluded(spark: SparkSession, sf: str) -> DataFrame:
    return newest_excluded(_files(spark, sf))


QUERIES: dict[str, tuple] = {
    "accepted_pages_per_host": (
        q_accepted_per_host,
        f"WITH {RULES_SQL},{_URLS_SQL} SELECT host, count(*) AS n FROM d_u WHERE url NOT IN (SELECT url FROM d_hits) GROUP BY host",
    ),
    "url_parts": (q_url_parts, SQL_URL_PARTS),
    "host_suffixes": (q_host_suffixes, SQL_HOST_SUFFIXES),
    "punycode_host": (q_punycode_host, SQL_PUNYCODE),
    "normalize_url": (q_normalize_url, SQL_NORMALIZE),
    "regex_normalize": (q_regex_normalize, SQL_REGEX_NORMALIZE),
    "url_id": (q_url_id, "SELECT page_id, sha256(url) AS url_id FROM pages"),
    "resolve_url": (q_resolve_url, SQL_RESOLVE),
    "basic_url_filter": (q_basic_filter, SQL_BASIC),
    "regex_url_filter": (q_regex_filter, with_ctes("d_url_forms") + f"SELECT page_id, {_regex_sql('url')} AS keep FROM d_url_forms"),
    "scheme_filter": (q_scheme_filter, with_ctes("d_url_forms") + "SELECT page_id, regexp_matches(url, '^(?i)https?:') AS keep FROM d_url_forms"),
    "self_filter": (q_self_filter, with_ctes("d_sitemap_rows") + "SELECT pos, coalesce(alt, '-') AS alt FROM d_sitemap_rows WHERE alt IS NULL OR alt <> loc"),
    "host_filter": (
        q_host_filter,
        with_ctes("d_sitemap_rows")
        + ", h AS (SELECT pos, regexp_extract(parent_url, '^[a-z]+://([^/?#:]*)', 1) AS own, regexp_extract(loc, '^[a-z]+://([^/?#:]*)', 1) AS l,"
        + " regexp_extract(coalesce(alt, parent_url), '^[a-z]+://([^/?#:]*)', 1) AS a FROM d_sitemap_rows)"
        + " SELECT pos, own = l AS loc_inside, own = a AS alt_inside FROM h",
    ),
    "max_depth_filter": (
        q_max_depth,
        with_ctes("d_status") + "SELECT url FROM d_status WHERE event_id % 10 = 9 OR event_id % 6 <= 3",
    ),
    "private_ip_filter": (q_private_ip, SQL_PRIVATE_IP),
    "deny_filter": (q_deny_filter, SQL_DENY),
    "deny_filter_url_forms": (q_deny_forms, SQL_DENY_FORMS),
    "deny_filter_many_rules": (q_deny_large, SQL_DENY_LARGE),
    "deny_filter_beyond_broadcast": (q_deny_shuffled, SQL_DENY_LARGE),
    "deny_explain": (q_deny_explain, SQL_DENY_EXPLAIN),
    "prefilter": (q_prefilter, SQL_PREFILTER),
    "read_deny_rules": (q_deny_rules, SQL_DENY_RULES),
    "rule_stats": (q_rule_stats, SQL_RULE_STATS),
    "carry_section": (q_carry_section, SQL_CARRY),
    "skipped_rule_lines": (q_skipped_rule_lines, SQL_SKIPPED),
    "regex_rules": (q_regex_rules, SQL_REGEX_RULES),
    "read_seeds": (q_seeds, SQL_SEEDS),
    "domain_join": (q_domain_join, SQL_DOMAIN),
    "domain_join_beyond_broadcast": (q_domain_join_beyond, SQL_DOMAIN_BEYOND),
    "partition_key": (q_partition_key, SQL_KEY),
    "extract_robots_rules": (q_robots_rules, SQL_ROBOTS_RULES),
    "robots_filter": (q_robots_filter, SQL_ROBOTS_FILTER),
    "robots_crawl_delay": (
        q_crawl_delay,
        with_ctes("d_host_pages") + "SELECT DISTINCT host AS key, CAST(length(host) AS DOUBLE) AS crawl_delay FROM d_host_pages",
    ),
    "profile_production": (_chain("production"), SQL_PRODUCTION),
    "profile_bootstrap": (_chain("bootstrap"), SQL_BOOTSTRAP),
    "profile_inject": (_chain("inject"), SQL_PRODUCTION),
    "profile_pre_fetch": (_chain("pre_fetch"), SQL_PRE_FETCH),
    "warc_publish_manifest": (
        q_manifest,
        _FILES_SQL
        + "SELECT name, concat('s3://target/archive/', substr(name, 6, 4), '/', substr(name, 10, 2), '/', name) AS target FROM f WHERE name < (SELECT max(name) FROM f)",
    ),
    "newest_excluded": (q_newest_excluded, _FILES_SQL + "SELECT name FROM f WHERE name < (SELECT max(name) FROM f)"),
}

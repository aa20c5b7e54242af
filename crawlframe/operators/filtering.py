"""URL filtering against rule tables, and chains of URL filters.

Rule tables are matched by key equality first and by pattern second, never pattern against
everything. Two physical forms give the same rows:

* rules within the measured broadcast bounds: one row per rule key is broadcast, the keys of each level of the host apart, and
  looked up once per level (``host``, last 1, 2, ... labels). No row is multiplied, nothing is shuffled.
* larger rule tables: the host suffixes of distinct URLs are exploded and joined; keys that are asked for much, such as
  ``com``, are dealt over several tasks in proportion to their measured count.

Where only the verdict is wanted, the patterns of a key are folded: plain texts are searched as such, the others make one alternation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.metadata import meta_add, meta_first
from crawlframe.functions.predicates import (
    DEFAULT_REGEX_RULES,
    basic_url_filter,
    host_filter,
    max_depth_filter,
    regex_url_filter,
    scheme_filter,
    self_filter,
)
from crawlframe.functions.stage import compute_once, with_parts
from crawlframe.functions.urls import label_count, last_labels, normalize_url, punycode_host, regex_normalize
from crawlframe.operators.keys import domain_join
from crawlframe.operators.spread import HEAVY_SHARE, spread_join
from crawlframe.schemas import ERROR_CAUSE
from crawlframe.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

#: Global rules up to this many become literals of the plan.
GLOBAL_LITERALS = 400

_PLAIN = r"^[A-Za-z0-9/_\-=&%~,:;!@ ]+$"


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Mark patterns that are plain text: those are searched as text, not as regex."""
    return rules.select(
        "seq", "scope", "key", "kind", "pattern", F.col("pattern").rlike(_PLAIN).alias("plain")
    )


@dataclass(frozen=True)
class RuleProfile:
    rows: int
    bytes: int
    levels: tuple[int, ...]
    has_host: bool
    n_global: int
    has_global: bool

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def profile_rules(rules: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> RuleProfile:
    """Measured size of a rule table and the host levels its keys sit on (one small aggregate)."""
    is_domain = (F.col("scope") == "domain") & (F.col("key") != ".")
    row = (
        rules.limit(max_rows + 1)
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.octet_length("key") + F.octet_length("pattern") + 64), F.lit(0)).alias("b"),
            # host names have at most 127 labels, so this set is small
            F.array_sort(F.collect_set(F.when(is_domain, label_count(F.col("key"))))).alias("levels"),
            F.coalesce(F.bool_or(F.col("scope") == "host"), F.lit(False)).alias("has_host"),
            F.count_if((F.col("scope") == "domain") & (F.col("key") == ".")).alias("n_global"),
        )
        .first()
    )
    return RuleProfile(row["n"], row["b"], tuple(row["levels"]), row["has_host"], row["n_global"], row["n_global"] > 0)


def _hit(rule: Column, path: Column, file: Column) -> Column:
    text = F.when(rule["kind"] == "path", path).otherwise(file)
    return (rule["kind"] == "all") | F.when(rule["plain"], F.contains(text, rule["pattern"])).otherwise(
        F.regexp_like(text, rule["pattern"])
    )


def _grouped(rules: DataFrame) -> DataFrame:
    rule = F.struct("seq", "scope", "key", "kind", "pattern", "plain")
    return rules.groupBy("scope", "key").agg(F.array_sort(F.collect_list(rule)).alias("rules"))


#: Patterns that mean something else inside an alternation: back-references, inline flags, quoting.
_ALONE = re.compile(r"\\[0-9kQE]|\(\?[a-zA-Z-]*[):<]")
_TOGETHER = 100
_FOLDED = ("all", "path_texts", "file_texts", "path_alone", "file_alone", "path_any", "file_any")


def _folded(rules: DataFrame) -> DataFrame:
    """One row per key for the verdict alone: ``scope, key, rules``."""
    alone = F.col("pattern").rlike(_ALONE.pattern)
    regex = ~F.col("plain")

    def patterns(kind: str, cond: Column) -> Column:
        return F.array_sort(F.collect_set(F.when((F.col("kind") == kind) & cond, F.col("pattern"))))

    def any_of(kind: str) -> Column:
        wrapped = F.transform(patterns(kind, regex & ~alone), lambda p: F.concat(F.lit("(?:"), p, F.lit(")")))
        return F.nullif(F.array_join(wrapped, "|"), F.lit(""))

    cells = [F.bool_or(F.col("kind") == "all"), *[patterns(k, F.col("plain")) for k in ("path", "pathquery")]]
    cells += [*[patterns(k, regex & alone) for k in ("path", "pathquery")], any_of("path"), any_of("pathquery")]
    return rules.groupBy("scope", "key").agg(F.struct(*[c.alias(n) for c, n in zip(cells, _FOLDED, strict=True)]).alias("rules"))


def _folded_hit(r: Column, path: Column, file: Column) -> Column:
    def of(name: str, text: Column) -> Column:
        hit = F.exists(r[f"{name}_texts"], lambda p: F.contains(text, p)) | F.exists(r[f"{name}_alone"], lambda p: F.regexp_like(text, p))
        return hit | F.coalesce(F.regexp_like(text, r[f"{name}_any"]), F.lit(False))

    return F.coalesce(r["all"] | of("path", path) | of("file", file), F.lit(False))


def _with_rule_lists(urls: DataFrame, rules: DataFrame, prof: RuleProfile, explain: bool) -> tuple[DataFrame, list[str]]:
    """Join the rules that apply to each URL, most specific first. Broadcast joins only."""
    grouped = _grouped(rules) if explain else _folded(rules)
    out, lists = urls, []
    host = F.col("_p.host")

    def lookup(df: DataFrame, side: DataFrame, key: Column, name: str) -> DataFrame:
        renamed = F.broadcast(side.select(F.col("key").alias(f"{name}_key"), F.col("rules").alias(name)))
        lists.append(name)
        return df.join(renamed, key == F.col(f"{name}_key"), "left").drop(f"{name}_key")

    if prof.has_host:
        out = lookup(out, grouped.filter("scope = 'host'"), host, "_r_host")
    domain = grouped.filter("scope = 'domain'")
    for level in sorted(prof.levels, reverse=True):
        out = lookup(out, domain.filter(label_count(F.col("key")) == level), last_labels(host, level), f"_r_{level}")
    if prof.has_global:
        everywhere = domain.filter("key = '.'").select("rules")
        out = out.withColumn("_r_all", everywhere.scalar())
        lists.append("_r_all")
    return out, lists


def _everywhere(rules: DataFrame, path: Column, file: Column) -> Column:
    """Whether a global rule matches, its patterns as literals that are compiled once per task.

    Called for at most ``GLOBAL_LITERALS`` of them.
    """
    rows = rules.filter("scope = 'domain' AND key = '.'").select("kind", "pattern").distinct().collect()
    hit = F.lit(any(r["kind"] == "all" for r in rows))
    for of_path, text in ((True, path), (False, file)):
        own = sorted(r["pattern"] for r in rows if r["kind"] != "all" and (r["kind"] == "path") == of_path)
        single = [p for p in own if _ALONE.search(p)]
        joined = [f"(?:{p})" for p in own if not _ALONE.search(p)]
        for pattern in [*single, *("|".join(joined[i : i + _TOGETHER]) for i in range(0, len(joined), _TOGETHER))]:
            hit = hit | F.coalesce(text.rlike(pattern), F.lit(False))
    return hit


def _denied_by_lookup(urls: DataFrame, rules: DataFrame, prof: RuleProfile, explain: bool) -> DataFrame:
    keep = urls.columns
    staged = with_parts(urls)
    # few global rules are literals to the verdict; the explanation needs their list
    literal = prof.has_global and not explain and prof.n_global <= GLOBAL_LITERALS
    joined, lists = _with_rule_lists(staged, rules, replace(prof, has_global=False) if literal else prof, explain)
    path, file = F.col("_p.path"), F.col("_p.file")
    if explain:
        firsts = [F.get(F.filter(F.col(c), lambda r: _hit(r, path, file)), F.lit(0)) for c in lists]
        rule = F.coalesce(*firsts) if firsts else F.lit(None).cast("struct<seq:bigint,scope:string,key:string,kind:string,pattern:string,plain:boolean>")
        return joined.select(*keep, (~F.col("_p.valid")).alias("unparsable"), rule.alias("rule"))
    denied = ~F.col("_p.valid")
    if literal:
        denied = denied | _everywhere(rules, path, file)
    for c in lists:
        denied = denied | _folded_hit(F.col(c), path, file)
    return joined.select(*keep, denied.alias("denied"))


def _first_hits(urls: DataFrame, rules: DataFrame, explain: bool, share: int) -> DataFrame:
    """Distinct URLs that a rule denies, through a join that deals out heavy keys: ``url`` and, if explained, the winning ``rule``."""
    p = F.col("_p")
    # copies of a URL share their verdict, and would share their salt
    staged = with_parts(urls.select("url").distinct()).filter(p["valid"])
    host = p["host"]
    n = label_count(host)
    # level 0 = host rules, then the host as a domain, its parents, and "." last
    labels = F.split(host, "[.]", -1)
    domains = F.when(host == "", F.array().cast("array<struct<scope:string,key:string,level:int>>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.struct(
                F.lit("domain").alias("scope"),
                F.array_join(F.slice(labels, i, n - i + 1), ".").alias("key"),
                i.cast("int").alias("level"),
            ),
        )
    )
    probes = F.concat(
        F.array(F.struct(F.lit("host").alias("scope"), host.alias("key"), F.lit(0).alias("level"))),
        domains,
        F.array(F.struct(F.lit("domain").alias("scope"), F.lit(".").alias("key"), F.lit(1000).alias("level"))),
    )
    left = staged.select(
        "url",
        F.col("_p.path").alias("path"),
        F.col("_p.file").alias("file"),
        F.inline(probes).alias("scope", "key", "level"),
    )
    if not explain:
        met = spread_join(left, _folded(rules), ["scope", "key"], "url", "inner", share)
        return met.filter(_folded_hit(F.col("rules"), F.col("path"), F.col("file"))).select("url").distinct()
    rule = F.struct("seq", "scope", "key", "kind", "pattern", "plain")
    hits = spread_join(left, rules, ["scope", "key"], "url", "inner", share).filter(_hit(rule, F.col("path"), F.col("file")))
    return hits.groupBy("url").agg(F.min_by(rule, F.struct("level", "seq", "kind", "pattern")).alias("rule"))


def _denied_by_shuffle(urls: DataFrame, rules: DataFrame, explain: bool, share: int) -> DataFrame:
    hits = _first_hits(urls, rules, explain, share)
    if not explain:
        hits = hits.withColumn("_hit", F.lit(True))
    joined = with_parts(urls.join(hits, "url", "left"))
    unparsable = ~F.col("_p.valid")
    if explain:
        return joined.select(*urls.columns, unparsable.alias("unparsable"), "rule")
    return joined.select(*urls.columns, (unparsable | F.col("_hit").isNotNull()).alias("denied"))


def _denied(
    urls: DataFrame,
    rules: DataFrame,
    explain: bool,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    share: int = HEAVY_SHARE,
) -> DataFrame:
    rules = prepare_rules(rules)
    prof = profile_rules(rules, max_rows)
    if prof.fits(max_rows, max_bytes):
        return _denied_by_lookup(urls, rules, prof, explain)
    return _denied_by_shuffle(urls, rules, explain, share)


def deny_flag(urls: DataFrame, rules: DataFrame, **bounds: int) -> DataFrame:
    """Add ``denied``: the URL is unparsable or a rule for its host or a parent domain matches."""
    return _denied(urls, rules, explain=False, **bounds)


def deny_filter(urls: DataFrame, rules: DataFrame, **bounds: int) -> DataFrame:
    """Rows no rule denies."""
    return deny_flag(urls, rules, **bounds).filter(~F.col("denied")).drop("denied")


def deny_explain(urls: DataFrame, rules: DataFrame, **bounds: int) -> DataFrame:
    """Add ``unparsable`` and the winning ``rule`` (host, longest to shortest domain, global; file order)."""
    out = _denied(urls, rules, explain=True, **bounds)
    return out.withColumn("rule", F.when(F.col("rule").isNotNull(), F.col("rule").dropFields("plain")))


def prefilter(urls: DataFrame, rules: DataFrame, **bounds: int) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rejected rows turn ERROR and name their cause; kept rows keep the original URL."""
    flagged = deny_flag(urls, rules, **bounds)
    blank = F.coalesce(F.trim("url") == "", F.lit(True))
    reject = F.col("denied") | blank
    kept = flagged.filter(~reject).drop("denied")
    rejected = flagged.filter(reject).drop("denied").withColumns(
        {"status": F.lit("ERROR"), "metadata": meta_add(F.col("metadata"), ERROR_CAUSE, "Filtered")}
    )
    return kept, rejected


# --- robots -----------------------------------------------------------------------------------


def _robots_regex(pattern: Column) -> Column:
    """``*`` and a final ``$`` are special in a robots path, all else is literal."""
    quoted = F.regexp_replace(pattern, r"([\\.\[\]{}()+?^|])", r"\\$1")
    starred = F.regexp_replace(quoted, r"\*+", ".*")
    inner = F.regexp_replace(starred, r"\$$", "")
    escaped = F.regexp_replace(inner, r"\$", r"\\\$")
    return F.concat(F.lit("^"), escaped, F.when(pattern.endswith("$"), F.lit("$")).otherwise(""))


def robots_by_host(robots_rules: DataFrame, agent: str) -> DataFrame:
    """One row per host: the rules of the best matching agent group. Bounded by one robots file."""
    agent = agent.lower()
    name = F.lower("agent")
    mine = (name != "*") & (F.lit(agent).contains(name))
    pattern = F.col("pattern")
    rule = F.struct(
        F.length(pattern).alias("len"),
        F.col("allow"),
        pattern.rlike(r"[*$]").alias("special"),
        F.when(pattern.rlike(r"[*$]"), _robots_regex(pattern)).otherwise(pattern).alias("pattern"),
    )
    has_rule = F.coalesce(pattern != "", F.lit(False))
    grouped = robots_rules.groupBy("key").agg(
        F.bool_or(mine).alias("named"),
        F.array_agg(F.when(mine & has_rule, rule)).alias("own"),
        F.array_agg(F.when((name == "*") & has_rule, rule)).alias("any"),
        F.max(F.when(mine, F.col("crawl_delay"))).alias("own_delay"),
        F.max(F.when(name == "*", F.col("crawl_delay"))).alias("any_delay"),
    )
    return grouped.select(
        "key",
        F.when(F.col("named"), F.col("own")).otherwise(F.col("any")).alias("rules"),
        F.when(F.col("named"), F.col("own_delay")).otherwise(F.col("any_delay")).alias("crawl_delay"),
    )


def robots_flag(links: DataFrame, robots_rules: DataFrame, agent: str = "*") -> DataFrame:
    """Add ``allowed``: longest matching rule wins, allow wins ties, no cached rules means allowed.

    The rule table grows with the hosts, so it is never forced into a broadcast. Hot hosts repeat on
    the link side only: AQE splits their partitions.
    """
    by_host = robots_by_host(robots_rules, agent).select(F.col("key").alias("_host"), F.col("rules").alias("_rules"))
    # rows without a host, such as the marker rows of documents, are spread over keys that match nothing
    plain = [c for c, t in links.dtypes if not t.startswith(("map", "array", "struct"))]
    nowhere = F.concat(F.lit("\x01"), F.pmod(F.xxhash64(*plain), F.lit(1 << 20)).cast("string"))
    staged = with_parts(links)
    joined = staged.join(by_host, F.coalesce(F.lower("_p.host"), nowhere) == F.col("_host"), "left")
    file = F.when(F.col("_p.path") == "", F.lit("/")).otherwise(F.col("_p.file"))
    matching = F.filter(
        "_rules",
        lambda r: F.when(r["special"], F.regexp_like(file, r["pattern"])).otherwise(F.startswith(file, r["pattern"])),
    )
    best = F.array_max(F.transform(matching, lambda r: F.struct(r["len"].alias("len"), r["allow"].alias("allow"))))
    return joined.select(*links.columns, F.coalesce(best["allow"], F.lit(True)).alias("allowed"))


def robots_filter(links: DataFrame, robots_rules: DataFrame, agent: str = "*") -> DataFrame:
    return robots_flag(links, robots_rules, agent).filter("allowed").drop("allowed")


# --- chains -----------------------------------------------------------------------------------

Step = dict


# steps that look at the parts of the URL, and steps that leave the URL as it is
_NEEDS_PARTS = {"basic", "normalize", "punycode"}
_REWRITES = {"normalize", "punycode", "regex_normalize"}


def _column_step(name: str, params: dict, columns: Sequence[str]) -> Column:
    """The new value of ``url`` for a step that needs no join; NULL rejects."""
    url, parts = F.col("url"), F.col("_p")
    if name == "basic":
        return F.when(
            basic_url_filter(url, params.get("max_path_rep", 4), params.get("max_len", 1024), parts), url
        )
    if name == "normalize":
        return normalize_url(url, **params, parts=parts)
    if name == "punycode":
        return punycode_host(url, parts)
    if name == "regex_normalize":
        return regex_normalize(url, params.get("rules", ()))
    if name == "max_depth":
        keep = max_depth_filter(meta_first(F.col("metadata"), "depth").try_cast("int"), params.get("n", -1))
    elif name == "regex":
        keep = regex_url_filter(url, params.get("rules", DEFAULT_REGEX_RULES))
    elif name == "scheme":
        keep = scheme_filter(url, params.get("schemes", ("http", "https")))
    elif name == "self":
        keep = self_filter(F.col("parent_url"), url) if "parent_url" in columns else F.lit(True)
    elif name == "host":
        keep = host_filter(F.col("parent_url"), url, **params) if "parent_url" in columns else F.lit(True)
    else:
        raise ValueError(f"unknown URL filter {name!r}")
    return F.when(keep, url)


def _same_site(df: DataFrame, params: dict) -> DataFrame:
    """Add ``_same``: whether a link stays in the registered domain (and host, if asked for) of its parent."""
    if params.get("suffixes") is None:
        raise ValueError("the host step needs a suffix table for ignore_domain")
    for side, name in (("parent_url", "_pd"), ("url", "_ud")):
        staged = with_parts(df, side, "_q").withColumn("_h", F.lower("_q.host")).drop("_q")
        df = domain_join(staged, params["suffixes"], "_h").drop("_h", "suffix").withColumnRenamed("domain", name)
    keep = host_filter(F.col("parent_url"), F.col("url"), params.get("ignore_host", False), True, F.col("_pd"), F.col("_ud"))
    return df.withColumn("_same", keep)


def apply_url_filters(df: DataFrame, chain: Sequence[Step], bypass: str | None = None) -> DataFrame:
    """Run ``{name, params}`` steps in order. A rejected URL leaves the DataFrame at its step.

    Rows need ``url``; ``parent_url`` and ``metadata`` are used by the steps that look at them. A
    step may also be a callable from DataFrame to DataFrame. Rows whose ``bypass`` column is true
    (their url is NULL) stay whatever the steps say, so links and other rows share one pass.
    """
    columns = df.columns
    exempt = F.col(bypass) if bypass else F.lit(False)
    fresh = False  # whether _p holds the parts of the current url
    for step in chain:
        if callable(step):
            df, fresh = df.select(*columns), False
            df = step(df) if bypass is None else step(df.filter(~exempt)).unionByName(df.filter(exempt))
            continue
        name, params = step["name"], dict(step.get("params", {}))
        if name == "deny":
            df = deny_flag(df.select(*columns), params.pop("rules"), **params).filter(~F.col("denied") | exempt)
            fresh = False
        elif name == "robots":
            rules = params.get("rules")
            if rules is not None:
                df = robots_flag(df.select(*columns), rules, params.get("agent", "*")).filter(F.col("allowed") | exempt)
                fresh = False
        elif name == "host" and params.get("ignore_domain") and "parent_url" in columns:
            df = _same_site(df.select(*columns), params).filter(F.col("_same") | exempt)
            fresh = False
        elif not _is_noop(name, params):
            if name in _NEEDS_PARTS and not fresh:
                df, fresh = with_parts(df), True
            step_url = F.when(~exempt, _column_step(name, params, columns)) if bypass else _column_step(name, params, columns)
            df = compute_once(df, "url", step_url).filter(F.col("url").isNotNull() | exempt)
            fresh = fresh and name not in _REWRITES
    return df.select(*columns)


def _is_noop(name: str, params: dict) -> bool:
    if name == "max_depth":
        return params.get("n", -1) == -1
    if name == "host":
        return not (params.get("ignore_host") or params.get("ignore_domain"))
    return name == "regex_normalize" and not params.get("rules")


def filter_outlinks(links: DataFrame, chain: Sequence[Step]) -> DataFrame:
    """The filter chain on extracted links (``parent_url, url, metadata, ...``)."""
    return apply_url_filters(links, chain)


def status_query_filter(
    status: DataFrame, positive: Sequence[str | Column] = (), negative: Sequence[str | Column] = ()
) -> DataFrame:
    """Extra conditions on the frontier; a negative one also keeps rows where it is unknown."""

    def as_col(c: str | Column) -> Column:
        return F.expr(c) if isinstance(c, str) else c

    for cond in positive:
        status = status.filter(as_col(cond))
    for cond in negative:
        status = status.filter(~F.coalesce(as_col(cond), F.lit(False)))
    return status

"""What the plans must look like, and that results do not depend on partitioning or skew."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from crawlframe.catalog import registered
from crawlframe.catalog.fixtures import NOW, sitemap_docs, status_table
from crawlframe.functions import metadata as M
from crawlframe.operators import aggregates as A
from crawlframe.operators import filtering as FI
from crawlframe.operators import frontier as FR
from crawlframe.operators.upsert import dedup_discovered, status_upsert
from crawlframe.plans import crawl, profiles
from crawlframe.schemas import DENY_RULES, UPDATES
from crawlframe.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(repr(r) for r in df.collect())


def test_due_urls_limits_before_the_shuffle(spark):
    text = plan(FR.due_urls(status_table(spark, SF), NOW))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in text


def test_deny_filter_moves_no_url(spark):
    rules = spark.createDataFrame([(1, "host", "a.example", "path", "/x"), (2, "domain", "example", "path", "/y")], DENY_RULES)
    text = plan(FI.deny_filter(spark.range(10).select(F.lit("http://a.example/").alias("url")), rules))
    joins = re.findall(r"(\w+Join)\b", text)
    assert joins and set(joins) == {"BroadcastHashJoin"}
    # the only shuffles fold the rules
    assert all("scope" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_filter_chain_is_narrow(spark):
    df = spark.range(10).select(F.lit("http://a.example/").alias("url"), F.lit("p").alias("parent_url"), M.empty_meta().alias("metadata"))
    assert "Exchange" not in plan(FI.apply_url_filters(df, profiles.production()))


def test_crawl_updates_shuffle_documents_once(spark):
    docs = sitemap_docs(spark, SF).withColumn("metadata", M.meta_of(isSitemapNews="true")).repartition(3)
    base = plan(docs).count("Exchange hashpartitioning")
    text = plan(crawl.process_sitemaps(docs, NOW, 240))
    assert text.count("Exchange hashpartitioning") == base + 1
    moved = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert "_doc_id" in moved


def test_stored_status_is_not_shuffled_by_an_upsert(spark, tmp_path):
    root = str(tmp_path / "s")
    tables.write_snapshot(status_table(spark, SF), root, buckets=8)
    ups = spark.createDataFrame([("http://n/", "k", "FETCHED", None, {}, None)], UPDATES)
    tables.write_status(ups, root, 1)
    df = tables.read_status(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tables.read_status(spark, root))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # both scans of the snapshot stay where they are; the updates alone are dealt out
    assert text.count("Bucketed: true") == 2 and "FullOuter" not in text
    parts = re.split(r"(?=Exchange hashpartitioning)", text)
    assert len(parts) == 3 and all("Bucketed: true" not in re.split(r"\n *(?::- |\+- )(?:\*\(\d+\) )?Sort", p)[0] for p in parts[1:])
    assert df.count() == status_table(spark, SF).count() + 1
    # a session that never saw the table registers it again
    spark.sql(f"DROP TABLE {tables._table_name(root, 1)}")
    assert tables.read_status(spark, root).count() == df.count()


def test_look_up_reads_one_bucket(spark, tmp_path):
    from crawlframe.operators import status as S

    root = str(tmp_path / "s")
    rows_ = status_table(spark, SF)
    tables.write_snapshot(rows_, root, buckets=8)
    url = rows_.first().url
    ups = spark.createDataFrame([("http://n/", "k", "FETCHED", None, {}, None), (url, "k", "ERROR", None, {}, None)], UPDATES)
    tables.write_status(ups, root, 1)
    text = S.lookup_url(tables.read_status(spark, root), url)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"FileScan parquet .*?PushedFilters: \[(.*?)\]", text)
    assert len(pushed) == 4 and all(f"EqualTo(url,{url[:20]}" in p or f"EqualTo(url,{url}" in p for p in pushed)
    # files of all other buckets may be unreadable
    mine = {r.f for r in tables._read_base(spark, root).filter(F.col("url") == url).select(F.input_file_name().alias("f")).collect()}
    for file in (tmp_path / "s" / "base").rglob("*.parquet"):
        if file.name not in next(iter(mine)):
            file.write_bytes(b"no parquet")
    (row,) = S.lookup_url(tables.read_status(spark, root), url).collect()
    assert row.status == "ERROR"


def test_key_predicate_reaches_the_scan(spark, tmp_path):
    root = str(tmp_path / "s")
    tables.write_snapshot(status_table(spark, SF), root, buckets=2)
    from crawlframe.operators import status as S

    text = plan(S.query_routed(tables.read_status(spark, root), "count", "h3.example.org", "status = 'ERROR'"))
    assert "EqualTo(key,h3.example.org)" in text and "EqualTo(status,ERROR)" in text
    assert re.search(r"ReadSchema: struct<key:string,status:string>", text)


@pytest.mark.parametrize("name", list(registered()))
def test_no_cross_join(spark, name):
    text = plan(registered()[name][0](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.fixture(scope="module")
def skewed(spark):
    """A status table in which one key owns 90 % of the rows."""
    hot = F.col("id") % 10 != 0
    return spark.range(0, 4000, 1, 8).select(
        F.concat(F.lit("http://"), F.when(hot, "hot.example").otherwise(F.concat(F.lit("h"), (F.col("id") % 70).cast("string"))), F.lit("/"), F.col("id").cast("string")).alias("url"),
        F.sha2(F.col("id").cast("string"), 256).alias("url_id"),
        F.when(hot, "hot.example").otherwise(F.concat(F.lit("h"), (F.col("id") % 70).cast("string"))).alias("key"),
        F.lit("FETCHED").alias("status"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 7919 % 3600)).alias("next_fetch"),
        M.empty_meta().alias("metadata"),
    )


@pytest.mark.parametrize("n", [1, 13])
def test_results_do_not_depend_on_partitions(spark, skewed, n):
    other = skewed.repartition(n)
    assert rows(FR.due_urls(other, NOW)) == rows(FR.due_urls(skewed, NOW))
    assert rows(FR.politeness_plan(other, NOW)) == rows(FR.politeness_plan(skewed, NOW))
    assert rows(A.top_hosts(other, 5)) == rows(A.top_hosts(skewed, 5))
    docs = sitemap_docs(spark, SF).withColumn("metadata", M.meta_of(isSitemapNews="true"))
    assert rows(crawl.process_sitemaps(docs.repartition(n), NOW, 240)) == rows(crawl.process_sitemaps(docs, NOW, 240))


def test_hot_url_collapses(spark, skewed):
    """A third of all updates are copies of one url."""
    ups = skewed.select(
        F.when(F.col("url").endswith("1"), "http://copy/").otherwise(F.col("url")).alias("url"),
        "key", "status", "next_fetch", "metadata", F.col("next_fetch").alias("event_time"),
    )
    out = status_upsert(skewed.limit(0), ups)
    assert out.filter("url = 'http://copy/'").count() == 1
    latest = ups.filter("url = 'http://copy/'").agg(F.max("event_time")).first()[0]
    assert out.filter("url = 'http://copy/'").first().next_fetch == latest
    assert dedup_discovered(ups.select("url", "status", "key")).count() == out.count()


def test_copies_of_a_record_count_once(spark):
    docs = sitemap_docs(spark, SF).withColumn("metadata", M.meta_of(isSitemapNews="true"))
    copies = docs.unionByName(docs).unionByName(docs.limit(1).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("x"))
    assert rows(crawl.process_sitemaps(copies, NOW, 240)) == rows(crawl.process_sitemaps(docs, NOW, 240))
    # another body under the same url is another document
    other = docs.withColumn("content", F.lit("<urlset><url><loc>http://other/</loc></url></urlset>").cast("binary"))
    n = crawl.process_sitemaps(docs.unionByName(other), NOW, 240)
    assert n.filter("status = 'FETCHED'").count() == 2 * docs.count()
    assert n.filter("status = 'FETCHED' AND metadata.numLinks[0] = '1'").count() >= docs.count()


def test_both_forms_of_the_deny_filter_agree(spark, skewed):
    rules = spark.createDataFrame(
        [(1, "domain", "example", "path", "/1[0-9]*3$"), (2, "host", "h7", "all", "."), (3, "domain", ".", "path", "/99"), (4, "domain", "hot.example", "path", "/2")],
        DENY_RULES,
    )
    urls = skewed.select("url")
    assert rows(FI.deny_explain(urls, rules)) == rows(FI.deny_explain(urls, rules, max_rows=0, share=7))
    assert rows(FI.deny_filter(urls, rules)) == rows(FI.deny_filter(urls, rules, max_rows=0, share=7))


def test_both_forms_of_the_verdict_agree_on_many_patterns(spark, skewed):
    """Back-references and inline flags stay apart, plain texts and alternations are folded; global rules beyond the literals."""
    rules = [(1, "domain", "example", "path", r"/(1)(2)\2"), (2, "domain", "example", "path", "(?i)/3.*4"), (3, "host", "hot.example", "pathquery", "/5"), (4, "host", "h3", "path", "a|/1[0-9]$")]
    rules += [(10 + i, "domain", ".", "path", f"/77{i}$") for i in range(450)]
    table = spark.createDataFrame(rules, DENY_RULES)
    urls = skewed.select("url")
    verdicts = rows(FI.deny_flag(urls, table))
    assert verdicts == rows(FI.deny_flag(urls, table, max_rows=0, share=9))
    explained = FI.deny_explain(urls, table).select("url", (F.col("rule").isNotNull() | F.col("unparsable")).alias("denied"))
    assert verdicts == rows(explained) and sum("denied=True" in v for v in verdicts) > 100
    few = spark.createDataFrame(rules[:30], DENY_RULES)
    assert "rlike" in plan(FI.deny_flag(urls, few)).lower() and len(plan(FI.deny_flag(urls, table))) < 4 * len(plan(FI.deny_flag(urls, few)))


def test_rule_tables_are_broadcast_by_level(spark):
    rules = spark.createDataFrame([(1, "domain", "example", "path", "/x"), (2, "domain", "a.example", "path", "/y")], DENY_RULES)
    text = plan(FI.deny_filter(spark.range(10).select(F.lit("http://b.a.example/").alias("url")), rules))
    assert text.count("BroadcastHashJoin") == 2 and set(re.findall(r"\+ 1\) = (\d)\)", text)) == {"1", "2"}


def test_heavy_keys_are_dealt_out(spark, skewed):
    from crawlframe.operators.spread import spread_join

    left = skewed.select("key", "url")
    right = left.select("key").distinct().withColumn("n", F.xxhash64("key"))
    want = rows(left.join(right, "key").select("key", "url", "n"))
    met = spread_join(left, right, ["key"], "url", "inner", 16)
    assert rows(met.select("key", "url", "n")) == want
    salts = re.findall(r"_salt", plan(met))
    assert salts


def test_empty_inputs(spark, skewed):
    none = skewed.limit(0)
    assert FR.due_urls(none, NOW).count() == 0
    assert status_upsert(none, none.select("url", "key", "status", "next_fetch", "metadata")).count() == 0
    assert FI.deny_filter(skewed, spark.createDataFrame([], DENY_RULES)).count() == skewed.count()
    docs = none.select("url", F.lit(None).cast("binary").alias("content"), "metadata")
    assert crawl.process_sitemaps(docs, NOW).count() == 0

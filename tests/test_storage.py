"""Files in and out: seeds, rules, status table, metrics, WARC."""

from __future__ import annotations

import gzip
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlframe.functions import metadata as M
from crawlframe.operators import status as S
from crawlframe.operators.upsert import status_upsert
from crawlframe.schemas import FETCHED, METRICS, STATUS, UPDATES
from crawlframe.sources import rules as R
from crawlframe.sources import seeds, tables
from crawlframe.sources.warc import read_warc, write_warc

T0 = "2024-01-01 00:00:00"


def state(df):
    return {(r.url, r.status, str(r.next_fetch), str(sorted(r.metadata.items()))) for r in df.collect()}


def updates(spark, rows):
    data = [(u, "k.example", st, None, {"isFeed": [flag]}, None) for u, st, flag in rows]
    return spark.createDataFrame(data, UPDATES).withColumn("event_time", F.lit(T0).cast("timestamp"))


def test_read_seeds(spark, tmp_path):
    (tmp_path / "a.txt").write_text("http://a/\n\n# x\n")
    (tmp_path / "b.txt").write_text("http://b/\tisFeed=true\n")
    (tmp_path / "c.csv").write_text("http://c/\n")
    got = {r.url for r in seeds.read_seeds(spark, str(tmp_path), "*.txt").collect()}
    assert got == {"http://a/", "http://b/"}


def test_read_deny_rules_plain_and_gzip(spark, tmp_path):
    text = "Host a.example\n  DenyPath /x # why\n"
    (tmp_path / "r.txt").write_text(text)
    (tmp_path / "r2.txt.gz").write_bytes(gzip.compress(text.replace("a.example", "b.example").encode()))
    (tmp_path / "empty.txt").write_text("")
    got = {(r.key, r.kind, r.pattern) for r in R.read_deny_rules(spark, str(tmp_path)).collect()}
    assert got == {("a.example", "path", "/x"), ("b.example", "path", "/x")}


def test_refreshing_rules_reload_only_on_change(spark, tmp_path):
    f = tmp_path / "r.txt"
    f.write_text("Host a\nDenyPath .*\n")
    rules = R.RefreshingRules(spark, str(tmp_path))
    assert rules.get().count() == 1
    rules.get()
    assert rules.loads == 1
    f.write_text("Host a\nDenyPath .*\nHost b\nDenyPath .*\n")
    os.utime(f, (time.time() + 5, time.time() + 5))
    assert rules.get().count() == 2 and rules.loads == 2


def test_status_table_round_trip(spark, tmp_path):
    root = str(tmp_path / "status")
    tables.write_snapshot(spark.createDataFrame([], STATUS), root, buckets=2)
    first = updates(spark, [("http://a/", "DISCOVERED", "1"), ("http://b/", "FETCHED", "1")])
    second = updates(spark, [("http://a/", "FETCHED", "2"), ("http://b/", "DISCOVERED", "2"), ("http://c/", "DISCOVERED", "2")])
    tables.write_status(first, root, 0)
    tables.write_status(second, root, 1)
    want = {("http://a/", "FETCHED", "2"), ("http://b/", "FETCHED", "1"), ("http://c/", "DISCOVERED", "2")}

    def read():
        return {(r.url, r.status, r.metadata["isFeed"][0]) for r in tables.read_status(spark, root).collect()}

    assert read() == want
    tables.write_status(second, root, 1)  # a replayed batch changes nothing
    assert read() == want
    assert tables.compact_status(spark, root) == 2
    assert read() == want
    tables.rewrite_status(spark, root, lambda df: S.delete_url(df, "http://c/"))
    assert read() == want - {("http://c/", "DISCOVERED", "2")}
    assert tables.current_version(spark, root) == 3


def test_a_poll_reads_the_days_up_to_its_own(spark, tmp_path):
    root = tmp_path / "status"
    days = [f"2024-01-{d:02d} 10:00:00" for d in range(1, 21)]
    data = spark.createDataFrame([(f"http://h{i % 3}/{i}", "i", f"h{i % 3}", "FETCHED", d) for i, d in enumerate(days)], "url STRING, url_id STRING, key STRING, status STRING, d STRING")
    tables.write_snapshot(data.select("url", "url_id", "key", "status", F.col("d").cast("timestamp").alias("next_fetch"), M.empty_meta().alias("metadata")), str(root), buckets=3)
    late = updates(spark, [("http://h0/0", "FETCHED", "x"), ("http://new/", "DISCOVERED", "x"), ("http://h2/14", "FETCHED", "x")])
    moved = late.withColumn("next_fetch", F.when(F.col("url") == "http://h0/0", "2024-03-01 00:00:00").otherwise("2024-01-02 00:00:00").cast("timestamp"))
    tables.write_status(moved, str(root), 1)
    # files of later days may be unreadable
    for file in (root / "due").rglob("*.parquet"):
        if int(str(file.parent)[-2:]) > 5:
            file.write_bytes(b"no parquet")
    now = "2024-01-05 12:00:00"
    got = {(r.url, r.key, r.next_fetch) for r in tables.read_due(spark, str(root), now).collect()}
    want = tables.read_status(spark, str(root)).filter(F.col("next_fetch") <= F.lit(now).cast("timestamp"))
    assert got == {(r.url, r.key, r.next_fetch) for r in want.collect()}
    assert {u for u, _, _ in got} == {f"http://h{i % 3}/{i}" for i in range(1, 5)} | {"http://new/", "http://h2/14"}


def test_vacuum_keeps_the_last_snapshots(spark, tmp_path):
    root = str(tmp_path / "status")
    tables.write_snapshot(spark.createDataFrame([], STATUS), root, buckets=1)
    for i in range(4):
        tables.write_status(updates(spark, [(f"http://{i}/", "FETCHED", "1")]), root, i)
        tables.compact_status(spark, root)
    before = state(tables.read_status(spark, root))
    assert tables.vacuum_status(spark, root) == [1, 2, 3] and tables.vacuum_status(spark, root) == []
    assert state(tables.read_status(spark, root)) == before and len(before) == 4
    assert sorted(p.name for p in (tmp_path / "status" / "base").iterdir()) == ["v=000004", "v=000005"]


def test_upsert_is_idempotent_and_order_free(spark):
    current = spark.createDataFrame(
        [("http://a/", "i", "k", "FETCHED", None, {}), ("http://q/", "i", "k", "ERROR", None, None)], STATUS
    )
    ups = updates(spark, [("http://a/", "DISCOVERED", "x"), ("http://n/", "DISCOVERED", "x"), ("http://n/", "FETCHED", "y"), ("http://q/", "FETCHED", "z")])
    current = current.withColumn("metadata", F.coalesce("metadata", M.empty_meta()))
    once = status_upsert(current, ups)
    assert state(status_upsert(once, ups)) == state(once)
    assert state(status_upsert(current.repartition(5), ups.repartition(7))) == state(once)
    assert {(r.url, r.status) for r in once.collect()} == {("http://a/", "FETCHED"), ("http://n/", "FETCHED"), ("http://q/", "FETCHED")}


def test_init_tables(spark, tmp_path):
    root = str(tmp_path)
    tables.init_tables(spark, root)
    assert tables.read_status(spark, f"{root}/status").count() == 0
    assert tables.read_metrics(spark, f"{root}/metrics").count() == 0
    assert spark.read.parquet(f"{root}/content").columns[0] == "url"


def test_metrics_append_by_day(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, "x", "s", "c", 1, "h", 1, 2.5), (None, "y", "s", "c", 1, "h", 1, 3.5)], METRICS
    ).withColumn("ts", F.when(F.col("name") == "x", "2024-01-01 10:00:00").otherwise("2024-01-02 10:00:00").cast("timestamp"))
    path = str(tmp_path / "m")
    tables.write_metrics(rows, path)
    tables.write_metrics(rows.filter("name = 'x'"), path)
    back = tables.read_metrics(spark, path)
    assert back.count() == 3 and {str(r.date) for r in back.select("date").distinct().collect()} == {"2024-01-01", "2024-01-02"}
    assert tables.index_size_gb(back).first().size_gb > 0


def warc_docs(path: Path):
    """Records of a file as (headers, block), read with the standard library only."""
    data = gzip.decompress(path.read_bytes())
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        n = int(headers["Content-Length"])
        out.append((headers, rest[:n]))
        assert lines[0] == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
    return out


@pytest.fixture
def fetched(spark):
    body = F.concat(F.lit("body "), F.col("id").cast("string"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 20))
    df = spark.range(0, 60, 1, 3).select(
        F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 20).cast("int"))).alias("fetch_time"),
        F.lit(200).alias("http_status"),
        F.lit("text/html").alias("content_type"),
        F.when(F.col("id") != 5, body.cast("binary")).alias("content"),
        F.when(F.col("id") == 7, "length").alias("trimmed"),
        M.empty_meta().alias("metadata"),
        F.when(F.col("id") % 2 == 0, "GET / HTTP/1.1\nHost: h").alias("request_headers"),
        F.lit("HTTP/1.1 200 OK\r\nX: y").alias("response_headers"),
    )
    assert df.columns == [c.split(" ")[0] for c in FETCHED.split(", ")]
    return df


def test_write_warc(spark, tmp_path, fetched):
    out = tmp_path / "warc"
    write_warc(fetched, str(out), "NEWS", "20240101000000", max_mb=0.003, info={"software": "x"})
    files = sorted(out.glob("*.warc.gz"))
    assert len(files) > 3 and all(f.name.startswith("NEWS-20240101000000-") for f in files)
    seen, requests = {}, 0
    for f in files:
        records = warc_docs(f)
        assert records[0][0]["WARC-Type"] == "warcinfo" and b"format: WARC File Format 1.1" in records[0][1]
        assert b"software: x" in records[0][1]
        for headers, block in records[1:]:
            if headers["WARC-Type"] == "request":
                requests += 1
            else:
                assert block.startswith(b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n")
                seen[headers["WARC-Target-URI"]] = (headers, block.split(b"\r\n\r\n", 1)[1])
    want = {r.url: bytes(r.content or b"") for r in fetched.select("url", "content").collect()}
    assert {u: b for u, (_, b) in seen.items()} == want and requests == 30
    assert seen["http://h/7"][0]["WARC-Truncated"] == "length"
    # every record is a gzip member of its own
    raw = files[0].read_bytes()
    assert raw.count(b"\x1f\x8b\x08") >= len(warc_docs(files[0]))


def test_read_warc(spark, tmp_path, fetched):
    out = tmp_path / "warc"
    write_warc(fetched, str(out), "NEWS", "20240101000000", max_mb=0.003)
    assert not [f for f in out.iterdir() if f.name.startswith("_tmp-")]
    (out / "plain.warc").write_bytes(gzip.decompress(sorted(out.glob("*.warc.gz"))[0].read_bytes()))
    (out / "cut.warc").write_bytes((out / "plain.warc").read_bytes()[:-30])
    rows = read_warc(spark, str(out)).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, []).append(r)
    for path in out.glob("*.warc.gz"):
        want = [(h["WARC-Type"], h.get("WARC-Target-URI"), h["WARC-Record-ID"], b) for h, b in warc_docs(path)]
        got = [(r.type, r.url, r.record_id, r.head.encode() + b"\r\n\r\n" + r.content if r.head else bytes(r.content)) for r in by_file[path.name]]
        assert got == want
    assert len(by_file["cut.warc"]) == len(by_file["plain.warc"]) - 1
    raw = (out / "plain.warc").read_bytes()
    assert all(raw[r.offset :].startswith(b"WARC/1.1\r\n") for r in by_file["plain.warc"])
    empty = tmp_path / "none"
    empty.mkdir()
    assert read_warc(spark, str(empty)).count() == 0


def test_inflate(spark):
    from crawlframe.functions.content import gunzip, inflate

    body = b"<urlset>" + b"x" * 100_000
    packed = gzip.compress(body)
    cases = [body, packed, packed + gzip.compress(b"tail"), packed[:-20], b"\x1f\x8bnone", b"", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i INT, content BINARY").select("i", inflate(F.col("content")).alias("c"))
    got = [None if r.c is None else bytes(r.c) for r in df.orderBy("i").collect()]
    assert got[:3] == [body, body, body + b"tail"] and body.startswith(got[3]) and got[4:] == [b"", b"", None]
    assert len(gunzip(gzip.compress(b"0" * 10_000_000), 1000)) == 1000


def test_write_warc_rotates_on_age(spark, tmp_path, fetched):
    out = tmp_path / "warc"
    write_warc(fetched.coalesce(1).sortWithinPartitions("fetch_time"), str(out), "NEWS", "20240101000000", max_minutes=10)
    assert len(list(out.glob("*.warc.gz"))) == 2

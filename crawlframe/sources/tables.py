"""The stored tables: status (base snapshot + per-batch updates), content, metrics.

Layout of a status table::

    root/base/v=000003/        full snapshot, bucketed and sorted by url
    root/due/v=000003/due_day=2024-01-05/   url, key and next fetch of that snapshot, by day
    root/updates/v=000003/batch=17/   updates that arrived after that snapshot

A batch of updates is one small append, whatever the size of the table. Writing the same batch
again replaces its own directory, so replays change nothing. Readers see the snapshot without the urls that have
updates, and those urls merged by the same upsert the batch operators use. Conditions reach the scans of both
parts, and because the snapshot is bucketed by url only the updates are shuffled, and a look-up by url reads one bucket. ``compact_status`` folds the updates into a new snapshot. A snapshot counts from the
moment its marker ``root/_current/v=000003-b=16`` (version and number of buckets) exists; markers are only
ever added, and the highest one holds, so a crash at any point leaves the last complete snapshot in
force. A poll of the frontier reads the days up to its own of the due index, and the updates. ``vacuum_status`` removes
snapshots that are no longer read. One writer at a time, as with one streaming query.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.schemas import CONTENT, METRICS, STATUS, UPDATES
from crawlframe.session import as_ts

_MARKERS = "_current"
_MARKER = re.compile(r"v=(\d+)-b=(\d+)")
#: Batches of updates after which ``write_status`` folds them.
COMPACT_AFTER = 64


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _has_files(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def _pointer(spark: SparkSession, root: str) -> tuple[int, int]:
    fs, p, _ = _fs(spark, f"{root}/{_MARKERS}")
    if not fs.exists(p):
        return 0, 0
    names = (_MARKER.fullmatch(f.getPath().getName()) for f in fs.listStatus(p))
    return max(((int(m[1]), int(m[2])) for m in names if m), default=(0, 0))


def current_version(spark: SparkSession, root: str) -> int:
    """Version the pointer names; 0 when the table was never written."""
    return _pointer(spark, root)[0]


def _point_to(spark: SparkSession, root: str, version: int, buckets: int) -> None:
    fs, p, _ = _fs(spark, f"{root}/{_MARKERS}/v={version:06d}-b={buckets}")
    fs.create(p, False).close()


def _base(root: str, version: int) -> str:
    return f"{root}/base/v={version:06d}"


def _updates(root: str, version: int) -> str:
    return f"{root}/updates/v={version:06d}"


def _due(root: str, version: int) -> str:
    return f"{root}/due/v={version:06d}"


def _table_name(root: str, version: int) -> str:
    return f"status_{hashlib.sha256(root.encode()).hexdigest()[:12]}_v{version}"


def write_snapshot(df: DataFrame, root: str, buckets: int | None = None) -> int:
    """Write a full snapshot bucketed by url and point to it. One shuffle, one file per bucket."""
    spark = df.sparkSession
    version = current_version(spark, root) + 1
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [c.split(" ")[0] for c in STATUS.split(", ")]
    (
        df.select(*columns)
        .repartition(n, "url")
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(n, "url")
        .sortBy("url")
        .option("path", _base(root, version))
        .saveAsTable(_table_name(root, version))
    )
    rows = spark.read.schema(STATUS).parquet(_base(root, version)).select("url", "key", "next_fetch").filter("next_fetch is not null")
    day = rows.withColumn("due_day", F.to_date("next_fetch"))
    # a day with very many rows is more than one file
    day.repartition(n, "due_day", F.pmod(F.xxhash64("key"), F.lit(16))).write.mode("overwrite").partitionBy("due_day").parquet(_due(root, version))
    _point_to(spark, root, version, n)
    return version


def _read_base(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot as a bucketed table, registered again where this session does not know it yet."""
    version, n = _pointer(spark, root)
    name = _table_name(root, version)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({STATUS}) USING parquet CLUSTERED BY (url) SORTED BY (url) INTO {n} BUCKETS "
            f"LOCATION '{_base(root, version)}'"
        )
    return spark.table(name)


def write_status(updates: DataFrame, root: str, batch_id: int, compact_after: int = COMPACT_AFTER) -> None:
    """Append one batch of status updates; the same ``batch_id`` replaces itself.

    More than ``compact_after`` batches are folded into a new snapshot (0: never). Writing the last batch
    once more behind the fold repeats an upsert whose results are already there.
    """
    version = current_version(updates.sparkSession, root)
    cols = [c.split(" ")[0] for c in UPDATES.split(", ")]
    updates.select(*cols).write.mode("overwrite").parquet(f"{_updates(root, version)}/batch={batch_id}")
    fs, p, _ = _fs(updates.sparkSession, _updates(root, version))
    if compact_after and len(fs.listStatus(p)) > compact_after:
        compact_status(updates.sparkSession, root)


def pending_updates(spark: SparkSession, root: str) -> DataFrame | None:
    """The updates that arrived after the snapshot, with their ``batch``; None where there are none."""
    path = _updates(root, current_version(spark, root))
    if not _has_files(spark, path):
        return None
    return spark.read.schema(UPDATES + ", batch BIGINT").option("basePath", path).parquet(path)


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """Base snapshot with the later updates applied: rows without updates as they are, the others merged."""
    from crawlframe.operators.upsert import touched_rows

    base, updates = _read_base(spark, root), pending_updates(spark, root)
    if updates is None:
        return base
    untouched = base.join(updates.select("url").distinct(), "url", "left_anti").select(*base.columns)
    return untouched.unionByName(touched_rows(base, updates, batch_col="batch"))


def read_due(spark: SparkSession, root: str, now) -> DataFrame:
    """``url, key, next_fetch`` of the rows due by ``now``: as a filter of ``read_status``, from the files of the days up to it."""
    from crawlframe.operators.upsert import touched_rows

    version = current_version(spark, root)
    now = as_ts(now)
    index = spark.read.schema("url STRING, key STRING, next_fetch TIMESTAMP, due_day DATE").parquet(_due(root, version))
    due = index.filter((F.col("due_day") <= F.to_date(now)) & (F.col("next_fetch") <= now)).select("url", "key", "next_fetch")
    updates = pending_updates(spark, root)
    if updates is None:
        return due
    fresh = touched_rows(_read_base(spark, root), updates, batch_col="batch").select("url", "key", "next_fetch").filter(F.col("next_fetch") <= now)
    return due.join(updates.select("url").distinct(), "url", "left_anti").unionByName(fresh)


def vacuum_status(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` snapshots with their updates; the versions that went."""
    oldest = current_version(spark, root) - max(keep, 1) + 1
    gone = []
    for version in range(oldest - 1, 0, -1):
        fs, p, _ = _fs(spark, _base(root, version))
        if not fs.exists(p):
            break
        for path in (_base(root, version), _due(root, version), _updates(root, version)):
            fs.delete(_fs(spark, path)[1], True)
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(root, version)}")
        gone.append(version)
    return sorted(gone)


def compact_status(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """Fold all updates into a new snapshot."""
    return write_snapshot(read_status(spark, root), root, buckets)


def rewrite_status(spark: SparkSession, root: str, change, buckets: int | None = None) -> int:
    """Apply a bulk change (reset, delete, fetch_at, ...) and publish the result as a new snapshot."""
    return write_snapshot(change(read_status(spark, root)), root, buckets)


def init_tables(spark: SparkSession, root: str) -> None:
    """Start empty status, content and metrics tables; an older status stays behind its version."""
    write_snapshot(spark.createDataFrame([], STATUS), f"{root}/status", buckets=1)
    spark.createDataFrame([], CONTENT).write.mode("overwrite").parquet(f"{root}/content")
    spark.createDataFrame([], METRICS + ", date DATE").write.mode("overwrite").partitionBy("date").parquet(
        f"{root}/metrics"
    )


def write_metrics(df: DataFrame, path: str) -> None:
    """Append metric rows, one directory per day."""
    df.withColumn("date", F.to_date("ts")).write.partitionBy("date").mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS + ", date DATE").parquet(path)


def index_size_gb(df: DataFrame) -> DataFrame:
    """Stored size in GiB of the files behind a file-based DataFrame."""
    files = df.select(
        F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("n")
    ).groupBy("p").agg(F.max("n").alias("n"))
    return files.agg((F.coalesce(F.sum("n"), F.lit(0)) / F.lit(float(1 << 30))).alias("size_gb"))

"""WARC files as a Spark data source: ``df.write.format("warc")`` and ``spark.read.format("warc")``.

Every task writes its own gzip files from Arrow batches, one member per record, and starts a new file on size or age,
so no record is shuffled and files fill up as they do in a long-running writer. A file becomes
visible under its final name only when the job commits; the folder of unpublished files goes with the commit or the abort.
Column ``content`` is written whole. With ``batch`` the names carry it, and the commit replaces what an
earlier try of the same batch left.

Write options: ``prefix`` (required), ``max_mb`` (1023), ``max_minutes`` (1440), ``date`` (yyyyMMddHHmmss,
required, part of the names), ``batch``, and ``info.<field>`` for the header of each file.

Reading gives the records of all files below the path: ``file, offset, type, url, date, record_id, digest, head, content``. A file is a
partition, read as a stream, record by record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

# Format statement of the file header.
WARC_INFO = {
    "format": "WARC File Format 1.1",
    "conformsTo": "https://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/",
}


@dataclass
class WarcFiles(WriterCommitMessage):
    """(temporary path, final name) of the files a task wrote."""

    files: list[tuple[str, str]] = field(default_factory=list)


def _record(headers: dict[str, str], body: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    raw = head.encode("utf-8") + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    return gzip.compress(raw, mtime=0)


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def _digest(body: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()


def _http_head(text: str | None, fallback: str) -> bytes:
    head = (text or fallback).replace("\r\n", "\n").strip("\n").replace("\n", "\r\n")
    return head.encode("utf-8") + b"\r\n\r\n"


def _utc(when: datetime) -> str:
    """A worker's time, which is in its own zone, in UTC."""
    return datetime.fromtimestamp(when.timestamp(), UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_records(row: dict) -> bytes:
    """Request (when its headers were stored) and response records of one fetched row."""
    when = _utc(row["fetch_time"])
    url, body = row["url"], bytes(row["content"] or b"")
    response_id = _record_id("response", url, when)
    out = b""
    if row["request_headers"]:
        out += _record(
            {
                "WARC-Type": "request",
                "WARC-Target-URI": url,
                "WARC-Date": when,
                "WARC-Record-ID": _record_id("request", url, when),
                "WARC-Concurrent-To": response_id,
                "Content-Type": "application/http; msgtype=request",
            },
            _http_head(row["request_headers"], ""),
        )
    headers = {
        "WARC-Type": "response",
        "WARC-Target-URI": url,
        "WARC-Date": when,
        "WARC-Record-ID": response_id,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": _digest(body),
    }
    if row["trimmed"]:
        headers["WARC-Truncated"] = row["trimmed"]
    status_line = f"HTTP/1.1 {row['http_status'] or 200}"
    return out + _record(headers, _http_head(row["response_headers"], status_line) + body)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.prefix = options["prefix"]
        self.date = options["date"]
        self.max_bytes = int(float(options.get("max_mb", "1023")) * 1024 * 1024)
        self.max_seconds = 60 * int(options.get("max_minutes", "1440"))
        self.info = {**{k[5:]: v for k, v in options.items() if k.startswith("info.")}, **WARC_INFO}
        self.batch = options.get("batch")
        self.job = uuid.uuid4().hex[:12]

    def _filesystem(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    @property
    def _stem(self) -> str:
        return f"{self.prefix}-{self.date}-" + (f"b{int(self.batch):08d}-" if self.batch is not None else "")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WarcFiles:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        filesystem, root = self._filesystem()
        filesystem.create_dir(f"{root}/_tmp-{self.job}", recursive=True)
        done = WarcFiles()
        out, started = None, None
        try:
            for row in (r for batch in iterator for part in range(0, batch.num_rows, 256) for r in batch.slice(part, 256).to_pylist()):
                data = warc_records(row)
                now = row["fetch_time"].timestamp()
                if out is not None and (out.tell() >= self.max_bytes or now - started >= self.max_seconds):
                    out.close()
                    out = None
                if out is None:
                    name = f"{self._stem}{part:05d}{len(done.files):05d}.warc.gz"
                    tmp = f"{root}/_tmp-{self.job}/{attempt}-{name}"
                    out, started = filesystem.open_output_stream(tmp, compression=None), now
                    done.files.append((tmp, name))
                    body = "".join(f"{k}: {v}\r\n" for k, v in self.info.items()).encode("utf-8")
                    out.write(
                        _record(
                            {
                                "WARC-Type": "warcinfo",
                                "WARC-Date": _utc(row["fetch_time"]),
                                "WARC-Filename": name,
                                "WARC-Record-ID": _record_id("warcinfo", name),
                                "Content-Type": "application/warc-fields",
                            },
                            body,
                        )
                    )
                out.write(data)
        finally:
            if out is not None:
                out.close()
        return done

    def _of_batch(self, filesystem, root: str) -> list[str]:
        """Files that any try of this batch published."""
        from pyarrow import fs

        if self.batch is None:
            return []
        listed = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        mark = f"-b{int(self.batch):08d}-"
        return [f.path for f in listed if f.is_file and f.base_name.startswith(f"{self.prefix}-") and mark in f.base_name]

    def commit(self, messages: list[WarcFiles | None]) -> None:
        filesystem, root = self._filesystem()
        new = [pair for message in messages for pair in (message.files if message else ())]
        for path in self._of_batch(filesystem, root):
            filesystem.delete_file(path)
        for tmp, name in new:
            filesystem.move(tmp, f"{root}/{name}")
        self._clean(filesystem, root)

    def abort(self, messages: list[WarcFiles | None]) -> None:
        self._clean(*self._filesystem())

    def _clean(self, filesystem, root: str) -> None:
        from pyarrow import fs

        tmp = f"{root}/_tmp-{self.job}"
        if filesystem.get_file_info(tmp).type == fs.FileType.Directory:
            filesystem.delete_dir(tmp)


_READ = "file STRING, offset BIGINT, type STRING, url STRING, date STRING, record_id STRING, digest STRING, head STRING, content BINARY"
_READ_ARROW = pa.schema(
    [pa.field(c.split()[0], {"STRING": pa.string(), "BIGINT": pa.int64(), "BINARY": pa.binary()}[c.split()[1]]) for c in _READ.split(", ")]
)
#: Bytes of content handed on at a time.
_READ_BYTES = 4 << 20


class WarcFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    """A partition for each file."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[WarcFile]:
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(self.path)
        listed = filesystem.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted(f.path for f in listed if f.is_file and f.base_name.endswith((".warc.gz", ".warc")) and "/_tmp-" not in f.path)
        return [WarcFile(f) for f in files] or [WarcFile("")]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        if not partition.path:
            return
        filesystem, _ = fs.FileSystem.from_uri(self.path)
        name = partition.path.rsplit("/", 1)[-1]
        rows: list[tuple] = []
        size = 0
        with filesystem.open_input_stream(partition.path, compression=None) as raw:
            text = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
            for row in read_records(text):
                rows.append((name, *row))
                size += len(row[-1])
                if size > _READ_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ_ARROW, strict=True)], schema=_READ_ARROW)


def read_records(stream) -> Iterator[tuple]:
    """(offset, type, url, date, record id, digest, head, content) of every record of a plain stream.

    ``head`` is what stands ahead of the content of a request or response. A file that ends inside a record ends before it.
    """
    buffer, offset = io.BufferedReader(stream), 0
    while True:
        at, line = offset, buffer.readline()
        while line in (b"\r\n", b"\n"):
            at += len(line)
            line = buffer.readline()
        if not line.startswith(b"WARC/"):
            return
        used, headers = len(line), {}
        while (line := buffer.readline()) not in (b"\r\n", b"\n", b""):
            used += len(line)
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        length = int(headers.get("content-length", "0"))
        block = buffer.read(length)
        if len(block) < length:
            return
        offset = at + used + len(line) + length
        head, content = "", block
        if headers.get("content-type", "").startswith("application/http"):
            first, mark, rest = block.partition(b"\r\n\r\n")
            head, content = first.decode("utf-8", "replace"), rest if mark else b""
        fields = (headers.get(k) for k in ("warc-type", "warc-target-uri", "warc-date", "warc-record-id", "warc-payload-digest"))
        yield (at, *fields, head, content)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _READ

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; one without is of the default file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    qualified = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    if qualified.startswith("file:/") and not qualified.startswith("file://"):
        qualified = "file://" + qualified[5:]
    return qualified


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files below ``path``."""
    register(spark)
    return spark.read.format("warc").load(_qualified(spark, path))


def write_warc(
    df: DataFrame,
    path: str,
    prefix: str,
    date: str,
    max_mb: float = 1023,
    max_minutes: int = 1440,
    info: dict[str, str] | None = None,
    batch_id: int | None = None,
) -> None:
    """Write fetched records to WARC files below ``path``; one without a scheme is of the default file system.

    With ``batch_id`` a repeated call replaces the files of the batch.
    """
    spark = df.sparkSession
    register(spark)
    writer = (
        df.select("url", "fetch_time", "http_status", "content", "trimmed", "request_headers", "response_headers")
        .write.format("warc")
        .option("prefix", prefix)
        .option("date", date)
        .option("max_mb", str(max_mb))
        .option("max_minutes", str(max_minutes))
    )
    if batch_id is not None:
        writer = writer.option("batch", str(batch_id))
    for key, value in (info or {}).items():
        writer = writer.option(f"info.{key}", value)
    writer.mode("append").save(_qualified(spark, path))

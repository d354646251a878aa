"""WARC archives with a two-level capture index.

Writing: each page becomes one WARC record, its own gzip member in an archive
file of about ``archive_bytes``; pages of equal payload become revisits of the
one with the largest page_id. Tasks write under fresh names through pyarrow's
file systems (local, S3, HDFS) into the shared folder, and only the capture
rows of committed tasks name them, so what a lost attempt left is never read.

Index: captures are range-partitioned and sorted by reversed-host URL key and
page_id. Each range becomes one index file: compressed blocks of
``block_lines`` captures, then a sparse directory with the first key of each
block. One row per index file (``parts``: as many as there are partitions) is
the upper level.

Lookup: queries are sorted the same way; a task bisects the parts, then the
directory, range-reads the block, bisects it, and range-reads the records.

Edge cases: a null html is an empty payload (response, 0 bytes); a null url
has the empty key and no target header; control characters and spaces of a
url are percent-encoded. Rows that repeat a page_id are each written and read
back; if they repeat the largest of a group, each is a response. A null
page_id is written without a page and comes back as null; a group whose ids
are all null has no revisits. Other columns of the input are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import add_columns, fresh_path, table, written

MIN_REVISIT_BYTES = 1000
_CAPTURE = pa.schema([("urlkey", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURE_DDL = "urlkey string, page_id long, file string, offset long, length long"
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64())])


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.Example.com/a?b#c`` -> ``com,example,www)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:  # not a URL: the text itself is the key
        return url
    return f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _header_text(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 captured: str) -> bytes:
    """One WARC/1.1 record: a response, or a revisit that keeps the response's headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:{f'x-page:{page_id}' if page_id is not None else f'uuid:{uuid.uuid4()}'}>",
            f"WARC-Date: {captured}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:])}


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload bytes, payload digest, type, refers_to); the digest of a response is made anew and compared."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = _fields(head)
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest differs in {h['warc-record-id']}")
    page = lambda x: int(x[len("<urn:x-page:"):-1]) if x and x.startswith("<urn:x-page:") else None
    return (page(h["warc-record-id"]), int(_fields(http)["content-length"]), digest, h["warc-type"],
            page(h.get("warc-refers-to")))


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which page each page revisits, null for responses."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"),
                        F.octet_length(payload).alias("bytes"))
    groups = (rows.where(F.col("bytes") >= MIN_REVISIT_BYTES).groupBy("digest", "bytes")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(written(groups, "warc-groups"), ["digest", "bytes"], "left")
    return rows.select("page_id", "url", "html", "digest", F.when(
        ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, captured: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """Writes the archives below ``folder``; returns the captures (urlkey, page_id, file, offset, length), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            rows = []
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                raw = gzip.compress(record_bytes(page_id, url, (html or "").encode(), digest, refers_to, captured),
                                    level, mtime=0)
                out.write(raw)
                rows.append((url_key(url), page_id, name, at, len(raw)))
                at += len(raw)
                if at >= archive_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                zip(*rows, strict=True) if rows else [[]] * 5, _CAPTURE, strict=True)], schema=_CAPTURE)
        if out is not None:
            out.close()

    return written(with_revisits(pages).mapInArrow(run, _CAPTURE_DDL), "warc-captures")


def _order(key: str, page_id: int | None) -> tuple[bytes, bool, int]:
    """As Spark sorts (urlkey, page_id): by bytes, nulls first."""
    return key.encode(), page_id is not None, page_id or 0


@dataclass(frozen=True)
class Index:
    """Upper level of the capture index: one entry for each index file, by first key."""

    folder: str
    parts: list[tuple[tuple[bytes, bool, int], str, int, int]]  # first key, file, directory offset and length
    records: int  # bytes of all records in the archives


def write_index(captures: DataFrame, folder: str, block_lines: int = 256) -> Index:
    """Sorts the captures into compressed blocks with a sparse directory per index file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        out, name, at, lines, directory = None, f"{uuid.uuid4().hex}.cdx", 0, [], []

        def flush() -> int:
            raw = zlib.compress("\n".join(lines).encode())
            out.write(raw)
            directory.append([*json.loads(lines[0])[:2], at, len(raw)])
            lines.clear()
            return at + len(raw)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out = out or files.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(json.dumps(row))
                if len(lines) == block_lines:
                    at = flush()
        if out is None:
            return
        if lines:
            at = flush()
        raw = zlib.compress(json.dumps(directory).encode())
        out.write(raw)
        out.close()
        key, page = directory[0][:2]
        yield pa.RecordBatch.from_pydict({"urlkey": [key], "page_id": [page], "file": [name], "offset": [at],
                                          "length": [len(raw)]}, _CAPTURE)

    rows = captures.repartitionByRange("urlkey", "page_id").sortWithinPartitions("urlkey", "page_id")
    parts = written(rows.mapInArrow(run, _CAPTURE_DDL), "warc-index")
    got = parts.collect()  # one row per partition of the index
    records = captures.agg(F.sum("length")).first()[0] or 0
    return Index(folder, sorted(((_order(r[0], r[1]), r[2], r[3], r[4]) for r in got)), records)


class _Reader:
    """Range reads with a few open files."""

    def __init__(self, folder: str, keep: int = 16):
        self.files, self.path = open_folder(folder)
        self.open: OrderedDict = OrderedDict()
        self.keep = keep

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= self.keep:
                self.open.popitem(last=False)[1].close()
            self.open[name] = self.files.open_input_file(f"{self.path}/{name}")
        self.open.move_to_end(name)
        return self.open[name].read_at(length, offset)

    def close(self) -> None:
        while self.open:
            self.open.popitem()[1].close()


class _Search:
    """Finds captures by (key, page_id): parts, then directory, then block; the last of each stay in memory."""

    def __init__(self, index: Index, reader: _Reader):
        self.index, self.reader = index, reader
        self.firsts = [p[0] for p in index.parts]
        self.part = self.block = None

    def _open_part(self, part: int) -> None:
        if self.part != part:
            _, name, offset, length = self.index.parts[part]
            self.directory = json.loads(zlib.decompress(self.reader.read(name, offset, length)))
            self.starts = [_order(d[0], d[1]) for d in self.directory]
            self.part, self.block = part, None

    def _open_block(self, block: int) -> None:
        if self.block != block:
            _, _, offset, length = self.directory[block]
            raw = zlib.decompress(self.reader.read(self.index.parts[self.part][1], offset, length)).decode()
            self.lines = [json.loads(x) for x in raw.split("\n")]
            self.keys = [_order(x[0], x[1]) for x in self.lines]
            self.block = block

    def find(self, want: tuple) -> Iterator[list]:
        """Every capture with exactly this key; equal keys may run over blocks and files."""
        part = max(bisect_left(self.firsts, want) - 1, 0)
        while part < len(self.firsts) and self.firsts[part] <= want:
            self._open_part(part)
            block = max(bisect_left(self.starts, want) - 1, 0)
            while block < len(self.starts) and self.starts[block] <= want:
                self._open_block(block)
                yield from self.lines[bisect_left(self.keys, want):bisect_right(self.keys, want)]
                block += 1
            part += 1


def lookup(queries: DataFrame, index: Index, archives: str, task_bytes: int = 8 << 20) -> DataFrame:
    """Records of the captures of each (url, page_id) of ``queries``, read back from the archives.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. The queries go to as many tasks as
    the archives have ``task_bytes``: what is read is records, not the few bytes of a query.
    """
    keyed = add_columns(queries.select("page_id", "url"), "urlkey string", "url",
                        lambda col: {"urlkey": pa.array([url_key(u.as_py()) for u in col], pa.string())})
    keyed = keyed.select("urlkey", "page_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cdx, warc = _Reader(index.folder), _Reader(archives)
        search = _Search(index, cdx)
        for b in batches:
            hits = [c for k, p in zip(*(c.to_pylist() for c in b.columns), strict=True) for c in search.find(_order(k, p))]
            for i in range(0, len(hits), 1000):
                some = sorted(hits[i:i + 1000], key=lambda c: (c[2], c[3]))  # by place in the archives
                rows = [parse_record(gzip.decompress(warc.read(*c[2:]))) for c in some]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    zip(*rows, strict=True), _RECORD, strict=True)], schema=_RECORD)
        cdx.close()
        warc.close()

    return (keyed.repartitionByRange(max(1, -(-index.records // task_bytes)), "urlkey", "page_id").sortWithinPartitions("urlkey", "page_id")
            .mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives, folder = fresh_path(spark, "warc"), fresh_path(spark, "cdx")
    index = write_index(write_archives(pages, archives), folder)
    return lookup(pages, index, archives)


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
FROM k
"""

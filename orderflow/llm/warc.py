"""WARC archives with a two-level capture index.

Pages are written as one gzip member per record; equal payloads are stored once and revisited.  The
index holds a line per capture under its reversed-host key: sorted by range, packed into compressed
blocks of lines, one file per range with a sparse directory of its blocks at the end.  The list of
those files is the upper level.  A lookup bisects the list, then a file's directory, reads the one
block by its range, bisects its lines, and reads the record by its range.

Files are written and read inside tasks under fresh names and become known only through the rows of
the task that succeeded, so a task that is lost and runs again leaves nothing half-written in use.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import shared_uri
from orderflow.session import stage

FILE_BYTES = 1 << 29  # an archive file is closed beyond this size
LINES = 3000  # captures in a block of the index
TASK_BYTES = 1 << 20  # of records worth a task of reading back; a task reads at most 64 times as much
MIN_REVISIT = 100  # payloads shorter than this are always stored
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_OUT = 64  # records handed on at once


def surt(url: Column) -> Column:
    """Sort-friendly key: the host's labels in reverse, then path and query; null and odd urls as they are."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    start = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*+@)?([^/?#:]*)((?::[0-9]*)?)"
    host, port = F.lower(F.regexp_extract(url, start, 1)), F.regexp_extract(url, start, 2)
    port = F.when(port.isin("", ":", ":80", ":443"), "").otherwise(port)
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*+", ""), "(?s)#.*$", "")
    return F.when(host == "", url).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path))


def _uri(url: str) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")


def _record(page: int | None, url: str | None, digest: str, refers: int | None, payload: bytes, place: str = "", refers_url: str | None = None) -> bytes:
    """A record; ``place`` is where it is written, which makes its identifier its own.  A revisit names its response's page and url."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place} {page} {url} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if url is not None:
        head.append("WARC-Target-URI: " + _uri(url))
    if refers is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page: {refers}", "WARC-Refers-To-Date: 1970-01-01T00:00:00Z"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + _uri(refers_url))
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _read_record(raw: bytes) -> tuple:
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("broken record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload does not match its digest")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return (None if page is None else int(page), size, digest, kind, None if refers is None else int(refers), payload if kind == "response" else None)


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def write_archives(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` and return the captures: key, page_id, file, offset, length.

    Of rows with equal payloads of at least 100 bytes, those with the smallest ``page_id`` are stored and
    the others revisit it; a null id is never the smallest.  Null html is an empty payload.
    """
    spark = pages.sparkSession
    page = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    page = page.withColumn("digest", F.sha2("html", 256)).withColumn("key", surt(F.col("url")))
    long_ = page.filter(F.octet_length("html") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n"))
    # staged, so that its true size decides how it meets the pages
    copies = stage(long_.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first", "first_url"), "warc-copies")
    marked = page.join(copies, "digest", "left").withColumn("refers", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    folder = shared_uri(spark, "warc")

    def write(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for table in tables:
            rows = []
            for key, page, url, digest, refers, html, first_url in zip(*(table.column(c).to_pylist() for c in ("key", "page_id", "url", "digest", "refers", "html", "first_url")), strict=True):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                raw = _record(page, url, digest, refers, html.encode(), f"{name} {at}", first_url)
                out.write(raw)
                rows.append((key, page, name, at, len(raw)))
                at += len(raw)
            if rows:
                yield _columns(rows, ["key", "page_id", "file", "offset", "length"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()])
        if out is not None:
            out.close()

    written = marked.select("key", "page_id", "url", "digest", "refers", "html", "first_url").mapInArrow(write, "key string, page_id long, file string, offset long, length long")
    return stage(written.withColumn("folder", F.lit(folder)), "captures")


def _order(key: str, page: int | None) -> tuple:
    return (key, page is not None, page or 0)  # as Spark sorts, nulls first


def build_index(captures: DataFrame) -> list[tuple]:
    """Write the index and return its upper level: per file the first entry and where its directory lies.

    There are at most ``spark.sql.shuffle.partitions`` files, which bounds the list.
    """
    spark = captures.sparkSession
    folder = shared_uri(spark, "capture-index")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")

    def write(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        directory, lines, out, at, name = [], [], None, 0, uuid.uuid4().hex

        def close_block() -> None:
            nonlocal at
            raw = zlib.compress(json.dumps(lines).encode())
            out.write(raw)
            directory.append([lines[0][0], lines[0][1], at, len(raw)])
            at += len(raw)
            lines.clear()

        for table in tables:
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            for line in zip(*(table.column(c).to_pylist() for c in ("key", "page_id", "folder", "file", "offset", "length")), strict=True):
                lines.append(line)
                if len(lines) == LINES:
                    close_block()
        if out is None:
            return
        if lines:
            close_block()
        raw = zlib.compress(json.dumps(directory).encode())
        out.write(raw)
        out.close()
        yield _columns([(directory[0][0], directory[0][1], f"{folder}/{name}", at, len(raw))], ["key", "page_id", "path", "offset", "length"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()])

    files = stage(ordered.mapInArrow(write, "key string, page_id long, path string, offset long, length long"), "capture-index-files").collect()
    return sorted(((_order(f.key, f.page_id), f.path, f.offset, f.length) for f in files), key=lambda f: f[0])


class _Files:
    """Files kept open, the least recently used closed beyond a number."""

    def __init__(self, most: int) -> None:
        self.most, self.open = most, {}

    def __call__(self, path: str):
        file = self.open.pop(path, None)
        if file is None:
            fs, name = FileSystem.from_uri(path)
            file = fs.open_input_file(name)
        self.open[path] = file
        if len(self.open) > self.most:
            self.open.pop(next(iter(self.open))).close()
        return file


def lookup(wanted: DataFrame, index: list[tuple], tasks: int | None = None) -> DataFrame:
    """The records under each distinct ``key`` and ``page_id`` of ``wanted``, read from the archives in ``tasks`` tasks.

    Columns: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload`` (null
    for a revisit).  What the archives do not hold gives no row.
    """
    firsts = [f[0] for f in index]

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Files(64)

        @lru_cache(maxsize=8)
        def directory(k: int) -> tuple[list[tuple], list[list]]:
            _, path, offset, length = index[k]
            rows = json.loads(zlib.decompress(opened(path).read_at(length, offset)))
            return [_order(r[0], r[1]) for r in rows], rows

        @lru_cache(maxsize=8)
        def block(k: int, b: int) -> tuple[list[tuple], list[list]]:
            _, _, offset, length = directory(k)[1][b]
            rows = json.loads(zlib.decompress(opened(index[k][1]).read_at(length, offset)))
            return [_order(r[0], r[1]) for r in rows], rows

        def captures(entry: tuple) -> Iterator[list]:
            k = bisect_right(firsts, entry) - 1
            if k < 0:
                return
            heads = directory(k)[0]
            b = max(0, bisect_left(heads, entry) - 1)
            while b < len(heads) and heads[b] <= entry:
                entries, rows = block(k, b)
                at = bisect_left(entries, entry)
                while at < len(rows) and entries[at] == entry:
                    yield rows[at]
                    at += 1
                b += 1

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for table in tables:
            found = [c for key, page in zip(table.column("key").to_pylist(), table.column("page_id").to_pylist(), strict=True) for c in captures(_order(key, page))]
            found.sort(key=lambda c: (c[2], c[3], c[4]))  # each archive is read forwards
            for at in range(0, len(found), _OUT):
                yield _columns([_read_record(opened(f"{f}/{name}").read_at(length, offset)) for _, _, f, name, offset, length in found[at : at + _OUT]], names, kinds)

    distinct = wanted.select("key", "page_id").distinct()
    ranges = distinct.repartitionByRange(tasks, "key", "page_id") if tasks else distinct.repartitionByRange("key", "page_id")
    keys = ranges.sortWithinPartitions("key", "page_id")
    return keys.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``; further columns are ignored) and read every record back.

    Repeated rows are records each; null urls share an empty key; an empty table gives no record.
    """
    captures = write_archives(pages)
    # keys are short and their records long: tasks are counted by what they read
    size = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES), -(-size // (64 * TASK_BYTES)))
    return lookup(captures, build_index(captures), tasks)

"""Web archives (WARC) with a two-level capture index.

Tasks write archive files of gzip members, one record each, below a shared folder.  The capture
index is sorted by the page's key, its address with the host reversed, and cut into ranges; each
range is one file of compressed blocks, followed by a sparse directory that holds every block's first key.
A lookup picks the range by its bounds, finds the block by binary search in the directory,
reads that block, searches it, and reads just the record's bytes of the archive.

Files carry the name of the task attempt; only files that the written index names count, so attempts
that were lost or repeated leave no wrong records.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

REVISIT_FROM = 1000  # bytes
BLOCK_LINES = 300
FILE_BYTES = 1 << 30
OPEN_FILES = 16
LEVEL = 5
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "2000-01-01T00:00:00Z"  # the tables hold no capture time
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def reversed_key(url: str | None) -> str:
    """``http://www.a.org:80/x?y`` as ``org,a,www:80)/x?y``; ``-`` without an address."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return ")" + url
    rest = url.split(parts.netloc, 1)[1] if parts.netloc else url
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (rest or "/")


def decide(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null for responses)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    repeated = (
        own.where(F.col("payload_bytes") >= REVISIT_FROM)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = own.join(repeated, ["payload_digest", "payload_bytes"], "left")
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, without compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head += [f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {digest}')}>", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; the digest of a response is taken from its payload and must be the stated one."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged record of page {fields.get('X-Page-Id')}")
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if response else None,
    }


def _attempt() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.stageId()}-{task.taskAttemptId()}"


def _folder(uri: str) -> tuple[pa.fs.FileSystem, str]:
    files, path = pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    files.create_dir(path, recursive=True)
    return files, path


def write_records(pages: DataFrame, folder: str) -> DataFrame:
    """Write an archive record for every page; (key, file, start, size) per record, as a written table."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _folder(folder)
        out, name, at, n = None, "", 0, 0
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at, n = f"pages-{_attempt()}-{n}.warc.gz", 0, n + 1
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = packer.compress(record(p["page_id"], p["url"], p["payload"], p["payload_bytes"], p["payload_digest"], p["refers_to"])) + packer.flush()
                out.write(data)
                rows.append({"key": reversed_key(p["url"]), "file": name, "start": at, "size": len(data)})
                at += len(data)
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("key", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())]))
        if out is not None:
            out.close()

    return written(decide(pages).mapInArrow(run, "key string, file string, start long, size long"), "warc-captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorted, compressed blocks with a sparse directory; (file, first, last) per range, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _folder(folder)
        name = f"index-{_attempt()}.idx"
        out, at, held, directory, last = None, 0, [], [], ""

        def block() -> None:
            nonlocal at
            data = zlib.compress("\n".join(held).encode(), LEVEL)
            directory.append([json.loads(held[0])[0], at, len(data)])
            out.write(data)
            at += len(data)
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                out = out or files.open_output_stream(f"{path}/{name}", compression=None)
                held.append(json.dumps([r["key"], r["file"], r["start"], r["size"]]))
                last = r["key"]
                if len(held) == BLOCK_LINES:
                    block()
        if out is not None:
            if held:
                block()
            data = zlib.compress("\n".join(map(json.dumps, directory)).encode(), LEVEL)
            out.write(data + struct.pack("<QQ", at, len(data)))
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "first": [directory[0][0]], "last": [last]})

    parts = captures.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = captures.repartitionByRange(int(parts), "key", "file", "start").sortWithinPartitions("key", "file", "start")
    return written(ordered.mapInArrow(run, "file string, first string, last string"), "warc-ranges")


class Range:
    """One file of the index, read through its directory; keeps the block it read last."""

    def __init__(self, files: pa.fs.FileSystem, path: str) -> None:
        self.file = files.open_input_file(path)
        size = self.file.size()
        start, length = struct.unpack("<QQ", self.file.read_at(16, size - 16))
        lines = zlib.decompress(self.file.read_at(length, start)).decode().split("\n")
        self.directory = [tuple(json.loads(x)) for x in lines]
        self.firsts = [x[0] for x in self.directory]
        self.at, self.lines = -1, []

    def block(self, at: int) -> list[list]:
        if at != self.at:
            _, start, length = self.directory[at]
            self.lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(length, start)).decode().split("\n")]
            self.at = at
        return self.lines

    def find(self, key: str) -> Iterator[list]:
        """All captures of ``key``: they may begin in the block before the first that starts with it."""
        at = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while at < len(self.firsts) and self.firsts[at] <= key:
            lines = self.block(at)
            i = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while i < len(lines) and lines[i][0] == key:
                yield lines[i]
                i += 1
            at += 1


def lookup(spark: SparkSession, folder: str, ranges: DataFrame, keys: DataFrame) -> DataFrame:
    """Records (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of the distinct ``key``.

    A key may span several ranges; each range that can hold it is asked.  ``ranges`` has one row per
    index file, as many as shuffle partitions, and is sent to all tasks.
    """
    prepare(spark)
    bounds = sorted(ranges.collect(), key=lambda r: (r["first"], r["last"]))  # a row per index file
    names = [r["file"] for r in bounds]
    spans = [(r["first"], r["last"]) for r in bounds]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lasts = [b for _, b in spans]
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                at = bisect.bisect_left(lasts, key)
                while at < len(spans) and spans[at][0] <= key:
                    rows.append((at, key))
                    at += 1
            yield pa.RecordBatch.from_pydict({"at": pa.array([r[0] for r in rows], pa.int32()), "key": pa.array([r[1] for r in rows], pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _folder(folder)
        at, index, archives = None, None, {}
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            found, size = [], 0
            for k, key in zip(*(batch.column(c).to_pylist() for c in ("at", "key")), strict=True):
                if k != at:
                    at, index = k, Range(files, f"{path}/{names[k]}")
                for _, name, start, length in index.find(key):
                    if name not in archives:
                        if len(archives) >= OPEN_FILES:
                            archives.pop(next(iter(archives))).close()
                        archives[name] = files.open_input_file(f"{path}/{name}")
                    found.append(parse(zlib.decompress(archives[name].read_at(length, start), 31)))
                    size += found[-1]["payload_bytes"]
                    if size > 8_000_000:  # a very common key has many captures
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found, size = [], 0
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    wanted = keys.select("key").distinct().mapInArrow(asked, "at int, key string")
    return wanted.repartition("at", "key").sortWithinPartitions("at", "key").mapInArrow(read, RECORD)


def archive_and_read(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages to archives and an index below ``folder``, then read every record back by its key.

    Of pages with equal payloads of at least REVISIT_FROM bytes, that with the largest page_id is the
    response and the others revisit it.  Defined cases: null html is an empty payload; pages without url
    share the key ``-``; a page without page_id revisits one that has an id, and is a response where
    none of its equals has; rows that repeat the largest page_id and payload are all responses; an
    empty table gives no rows; other columns are ignored.
    """
    captures = write_records(pages, folder)
    ranges = write_index(captures, folder)
    return lookup(pages.sparkSession, folder, ranges, captures)

"""WARC archives with a two-level capture index.

Pages become gzip-compressed WARC records, one member each. Payloads that occur again become revisit
records that point to one response. The index has sorted lines (reversed-host URL key, page, place of
the record) in compressed blocks, and a sparse directory with the first line of every block. A lookup
finds its shard and then its block by binary search, reads that byte range, searches it again and
reads the record's byte range.

Archives and index files go to a folder that all machines share, through pyarrow's file systems, so
the folder may be on any store that pyarrow knows. Tasks write under names of their own and report
them; only files that a finished task reported are ever read, so lost executors and repeated tasks
leave at most unused files.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from stockcast.session import write_stage

RECORD_DATE = "2024-01-01T00:00:00Z"  # pages carry no time of capture
ARCHIVE_BYTES = 1 << 30   # an archive is closed beyond this
BLOCK_LINES = 512         # index lines in a compressed block
SHARD_LINES = 50_000      # index lines a shard aims at
GZIP_LEVEL = 3
OPEN_FILES = 32           # archives a reading task keeps open
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, archive string, offset long, length long"


def url_key(url: str | None) -> str:
    """Reversed-host key of a URL: ``com,example)/path?query``. No URL gives an empty key.

    Control characters and spaces are percent-encoded, so a key fits an index line.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # not a URL: the text itself is the key
        return quote(url, safe="/?&=:,;@!$'()*+~[]|%-._")
    rest = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest
    return quote(key, safe="/?&=:,;@!$'()*+~[]|%-._")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    tail = identifier.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; with ``refers_to`` a revisit, which has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
             f"WARC-Date: {RECORD_DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="/?&=:,;@!$'()*+~[]|%-._#"))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


@dataclass
class Record:
    """A record as it was read: its headers, the HTTP header's length of the payload, and the payload (none in a revisit)."""

    headers: dict[str, str]
    payload_bytes: int
    payload: bytes | None


def parse_record(member: bytes) -> Record:
    """Read one gzip member back; a payload that differs from its digest or length is an error."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if headers["WARC-Type"] == "revisit":
        return Record(headers, size, None)
    if len(payload) != size or "sha1:" + payload_digest(payload) != headers["WARC-Payload-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return Record(headers, size, payload)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Of payloads that occur more than once: sha256 and the largest page_id, whose record is the response (written)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digests = pages.select(F.sha2(html, 256).alias("sha256"), F.col("page_id").cast("long").alias("page_id")).where(
        F.octet_length(html) >= min_bytes)
    groups = digests.groupBy("sha256").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    return write_stage(groups.where("n > 1").drop("n"), "revisits")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record for every page; returns where each is (key, page_id, archive, offset, length; written).

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is the response,
    and so is every row that repeats that id; without any id all are responses. Null html is an empty
    payload, a null url an empty key.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.cast("binary").alias("payload"), F.sha2(html, 256).alias("digest"))
    known = revisits(pages, min_bytes)
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.join(known, rows["digest"] == known["sha256"], "left").select(
        "page_id", "url", "payload", F.when(other, F.col("response")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                found: list[list] = [[], [], [], [], []]
                for page_id, url, payload, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = record(page_id.as_py(), url.as_py(), payload.as_py(), refers.as_py())
                    out.write(member)
                    for column, value in zip(found, (url_key(url.as_py()), page_id.as_py(), name, at, len(member))):
                        column.append(value)
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    ["key", "page_id", "archive", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)
    return write_stage(rows.mapInArrow(write, CAPTURE), "captures")


Place = tuple[bytes, int, int]  # key, whether there is a page_id, page_id: sorts like the index


def _place(key: str, page_id: int | None) -> Place:
    return key.encode(), int(page_id is not None), page_id or 0


def _parse_lines(data: bytes) -> list[tuple[Place, str, int, int]]:
    out = []
    for line in data.decode().splitlines():
        key, page, name, offset, length = line.split("\t")
        out.append((_place(key, int(page) if page else None), name, int(offset), int(length)))
    return out


@dataclass
class CaptureIndex:
    """Shards in key order: the first place of each and its file. The directory of its blocks ends the file."""

    folder: str
    shards: list[tuple[Place, str, int, int]]  # first place, file, offset and length of the directory


def build_index(captures: DataFrame, folder: str) -> CaptureIndex:
    """Sort captures by (key, page_id) and write one index file per range.

    One row per shard (``SHARD_LINES`` captures) comes back to the driver. Pages of one URL may span
    blocks and shards.
    """
    n = max(1, math.ceil(captures.count() / SHARD_LINES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, at, lines, directory, first = f"index-{uuid.uuid4().hex}.gz", 0, [], [], None
        out = None

        def flush() -> None:
            nonlocal at, lines
            packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
            block = packer.compress("\n".join(lines).encode()) + packer.flush()
            out.write(block)
            key, page = lines[0].split("\t")[:2]
            directory.append(f"{key}\t{page}\t\t{at}\t{len(block)}")
            at, lines = at + len(block), []

        try:
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "archive", "offset", "length"))):
                    if out is None:
                        out, first = store.open_output_stream(f"{root}/{name}", compression=None), row[:2]
                    lines.append("\t".join("" if v is None else str(v) for v in row))
                    if len(lines) == BLOCK_LINES:
                        flush()
            if out is not None:
                if lines:
                    flush()
                sparse = zlib.compress("\n".join(directory).encode())
                out.write(sparse)
        finally:
            if out is not None:
                out.close()
        if first is not None:
            yield pa.RecordBatch.from_pylist([dict(key=first[0], page_id=first[1], archive=name, offset=at, length=len(sparse))], schema)

    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    ordered = captures.repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    written = write_stage(ordered.mapInArrow(write, CAPTURE), "index-shards").collect()
    return CaptureIndex(folder, sorted((_place(r["key"], r["page_id"]), r["archive"], r["offset"], r["length"]) for r in written))


class IndexReader:
    """Looks captures up and reads records, by byte ranges; keeps one directory, one block and some open archives."""

    def __init__(self, index: CaptureIndex):
        self.index, (self.store, self.root) = index, _store(index.folder)
        self.starts = [s[0] for s in index.shards]
        self.directory: tuple[int, list, list] | None = None
        self.block: tuple[tuple[int, int], list] | None = None
        self.files: dict[str, pa.NativeFile] = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= OPEN_FILES:
                self.files.pop(next(iter(self.files))).close()
            self.files[name] = self.store.open_input_file(f"{self.root}/{name}")
        return self.files[name].read_at(length, offset)

    def _directory(self, shard: int) -> tuple[int, list, list]:
        if self.directory is None or self.directory[0] != shard:
            _, name, offset, length = self.index.shards[shard]
            entries = _parse_lines(zlib.decompress(self.read(name, offset, length)))
            self.directory = shard, [e[0] for e in entries], entries
        return self.directory

    def _lines(self, shard: int, number: int) -> list:
        if self.block is None or self.block[0] != (shard, number):
            _, _, offset, length = self._directory(shard)[2][number]
            self.block = (shard, number), _parse_lines(zlib.decompress(self.read(self.index.shards[shard][1], offset, length), 31))
        return self.block[1]

    def captures(self, place: Place) -> Iterator[tuple[str, int, int]]:
        """Where the records of a (key, page_id) are. The first may end the block before the one that begins with it."""
        before = place[0], place[1], place[2] - 1
        shard = max(0, bisect_right(self.starts, before) - 1)
        number = max(0, bisect_right(self._directory(shard)[1], before) - 1) if self.index.shards else 0
        while shard < len(self.index.shards):
            while number < len(self._directory(shard)[1]):
                lines = self._lines(shard, number)
                for at in range(bisect_right(lines, before, key=lambda x: x[0]), len(lines)):
                    if lines[at][0] != place:
                        return
                    yield lines[at][1:]
                number += 1
            shard, number = shard + 1, 0

    def close(self) -> None:
        for f in self.files.values():
            f.close()


READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string"


def read_back(index: CaptureIndex, wanted: DataFrame) -> DataFrame:
    """Records of the captures that ``wanted`` (url, page_id) names, each once; repeats in ``wanted`` change nothing.

    Lookups are dealt by key range, so tasks read neighbouring blocks; pages of one URL are dealt by id.
    """
    @F.arrow_udf("string")
    def keys(urls: pa.Array) -> pa.Array:
        return pa.array([url_key(u) for u in urls.to_pylist()], pa.string())

    places = wanted.select(keys(F.col("url").cast("string")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    n = wanted.count()
    tasks = max(1, math.ceil(n / SHARD_LINES), min(n // 1_000, 4 * wanted.sparkSession.sparkContext.defaultParallelism))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = IndexReader(index), None
        names = [f.split(" ")[0] for f in READ_BACK.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        try:
            for batch in batches:
                columns: list[list] = [[] for _ in names]
                for url, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist()):
                    if (place := _place(url, page_id)) == last:
                        continue
                    last = place
                    for name, offset, length in reader.captures(place):
                        got = parse_record(reader.read(name, offset, length))
                        refers = got.headers.get("WARC-Refers-To")
                        row = (page_of(got.headers["WARC-Record-ID"]), got.payload_bytes,
                               got.headers["WARC-Payload-Digest"].removeprefix("sha1:"), got.headers["WARC-Type"],
                               page_of(refers) if refers else None, url)
                        for column, value in zip(columns, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        finally:
            reader.close()

    ordered = places.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(look_up, READ_BACK)

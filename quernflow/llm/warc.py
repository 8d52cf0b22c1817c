"""Web archives packaged as ZIP: written by tasks to a shared folder, and read record by record without extraction.

A package has one stored member ``archive/data.warc.gz`` (each record a gzip member of its own) and one stored member
``indexes/index.cdxj`` with a line per record: its place, length, type and digest. The reader takes the end of the file,
finds the central directory (through the ZIP64 locator where there is one), locates both members, reads the index and then
ranges of the archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches as arrow
from quernflow.scratch import fresh_path, materialize

LEAST_REVISIT = 1000
#: A package is closed when its archive reaches this size; a range read takes neighbouring records up to READ bytes.
PACKAGE = 128 << 20
READ = 8 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)


# ---------------------------------------------------------------- records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the headers, the payload's digest and its length, not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if target:
        lines.insert(3, f"WARC-Target-URI: {target}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    if len(block) != int(headers["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, block.partition(b"\r\n\r\n")[2]


# ---------------------------------------------------------------- ZIP


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    offset: int
    size: int


def _zip64(extra: bytes, *fields: int) -> list[int]:
    """Fields of a directory entry, those at their limit replaced from the ZIP64 extra field."""
    at, found = 0, b""
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            found = extra[at + 4 : at + 4 + size]
        at += 4 + size
    out, at = [], 0
    for value in fields:
        if value == 0xFFFFFFFF:
            (value,) = struct.unpack_from("<Q", found, at)
            at += 8
        out.append(value)
    return out


def directory(file) -> dict[str, Member]:
    """The central directory of an open random-access file."""
    end = file.size()
    tail_at = max(0, end - 65_557)
    file.seek(tail_at)
    tail = file.read(end - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of a central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if at < 20 or tail[at - 20 : at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (record_at,) = struct.unpack_from("<Q", tail, at - 12)
        file.seek(record_at)
        big = file.read(56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of a central directory")
        count, size, start = struct.unpack_from("<QQQ", big, 32)
    file.seek(start)
    data, at, members = file.read(size), 0, {}
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("a directory entry is damaged")
        method, _, _, _, packed, plain, n, m, c = struct.unpack_from("<HHHIIIHHH", data, at + 10)
        (offset,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n].decode("utf-8")
        plain, packed, offset = _zip64(data[at + 46 + n : at + 46 + n + m], plain, packed, offset)
        members[name] = Member(name, method, offset, packed)
        at += 46 + n + m + c
    return members


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    file.seek(member.offset)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("a local header is damaged")
    return member.offset + 30 + sum(struct.unpack_from("<HH", head, 26))


class _Stream(io.RawIOBase):
    """Only writing, so that zipfile neither seeks nor goes back."""

    def __init__(self, out):
        self.out = out

    def writable(self):
        return True

    def write(self, data):
        self.out.write(bytes(data))
        return len(data)


class Package:
    """A package being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        files, local = _filesystem(self.path)
        files.create_dir(local.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(local)
        self.zip = zipfile.ZipFile(_Stream(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, row: dict) -> None:
        payload = row["html"] or b""
        data = gzip.compress(record(row["page_id"], row["url"], payload, row["payload_digest"], row["refers_to"]), 1, mtime=0)
        self.member.write(data)
        about = {"offset": self.size, "length": len(data), "digest": f"sha1:{row['payload_digest']}", "filename": ARCHIVE}
        self.lines.append(f"{json.dumps(row['url'])} {DATE} {json.dumps(about)}\n")
        self.size += len(data)

    def close(self) -> str:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()
        self.out.close()
        return self.path


def _write(folder: str, package: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one, paths = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                open_one = open_one or Package(folder)
                open_one.add({name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)})
                if open_one.size >= package:
                    paths.append(open_one.close())
                    open_one = None
        if open_one:
            paths.append(open_one.close())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return run


def read_package(path: str, read: int = READ) -> Iterator[dict]:
    """The records of a package in the order of its index, by range reads. A wrong digest or length is an error."""
    files, local = _filesystem(path)
    with files.open_input_file(local) as file:
        members = directory(file)
        index = members[INDEX]
        file.seek(data_start(file, index))
        entries = [json.loads(line[line.rindex(" {") + 1 :]) for line in file.read(index.size).decode("utf-8").splitlines()]
        base, at = data_start(file, members[ARCHIVE]), 0
        while at < len(entries):
            first, last = entries[at]["offset"], at
            while last + 1 < len(entries) and entries[last + 1]["offset"] + entries[last + 1]["length"] - first <= read:
                last += 1
            file.seek(base + first)
            data = file.read(entries[last]["offset"] + entries[last]["length"] - first)
            for entry in entries[at : last + 1]:
                piece = data[entry["offset"] - first : entry["offset"] - first + entry["length"]]
                headers, payload = parse_record(zlib.decompress(piece, 31))
                yield _row(entry, headers, payload)
            at = last + 1


def _row(entry: dict, headers: dict[str, str], payload: bytes) -> dict:
    digest, size = headers["warc-payload-digest"], int(headers["x-payload-length"])
    if headers["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest[5:] or len(payload) != size) or digest != entry["digest"]:
        raise ValueError("a payload does not have its digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return {"page_id": number("x-page-id"), "url": headers.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest[5:], "record_type": headers["warc-type"], "refers_to": number("x-refers-to-page-id")}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows: list[dict] = []
            for row in read_package(path):
                rows.append(row)
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def write_archives(pages: DataFrame, least: int = LEAST_REVISIT, package: int = PACKAGE) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); gives (path), a row per package.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest page_id is a response and the others
    revisit it; rows that repeat that page_id are responses too, and so are payloads whose page_ids are all null. A null html
    is an empty payload, a null url or page_id is left out of its record. Packages have names of their own, so a task that
    runs again leaves an unlisted file and nothing twice; the list is a table in the shared folder. No rows: no package.
    """
    arrow.bound(pages.sparkSession)
    folder = fresh_path(pages.sparkSession, "archives")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("payload_digest"))
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    large = F.octet_length("html") >= least
    groups = rows.where(large).groupBy("payload_digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    # a table of known size: the planner broadcasts it below its threshold; small payloads need no join
    groups = materialize(groups.where("n > 1 and top is not null").select("payload_digest", "top"), "groups")
    rows = rows.where(large).join(groups, "payload_digest", "left").unionByName(rows.where(~large).withColumn("top", F.lit(None).cast("long")))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("top")), F.lit(None)).otherwise(F.col("top")).cast("long")
    rows = rows.select("page_id", "url", "html", "payload_digest", refers.alias("refers_to"))
    return materialize(rows.mapInArrow(_write(folder, package), "path string"), "packages")


def read_archives(paths: DataFrame) -> DataFrame:
    """The records of packages listed in ``paths`` (path): page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    return paths.repartition(max(1, paths.count())).mapInArrow(_read, RECORD)  # a task a package: the rows are too small to be dealt by size


def op8_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM g
"""

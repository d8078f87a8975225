"""WARC records in ZIP packages, written and read by range.

A package holds ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one line per record with its offset and length, both
stored, not deflated.  So a record can be read from the package with one range
read: the reader takes the end of the file, finds the central directory (or,
where an offset or size does not fit, the ZIP64 one), looks up where a stored
member begins, reads the index and then only the bytes of each record.

Records of equal payloads of at least ``min_bytes`` are stored once: that of
the largest id is a ``response``, the others are ``revisit`` records that name
it.  All rows with that largest id are responses; if no row of a payload has an
id, all are.  A null payload is an empty one, a null URL is left out, an empty
table gives no package.  Whatever other columns a table has is not looked at.

Packages go to the folder all executors share.  A task writes packages under
names of its own; only those in the rows that the finished tasks return are
read, so a task that is lost or run twice leaves at most a file nobody reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.wordlists import fits_broadcast
from tokenloom.session import settled, shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# A new package is begun at about this size.
PACKAGE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """``(page_id, url, payload_bytes, payload_digest, type, refers_to, payload)`` of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda name: int(m[1]) if (m := re.match(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    url = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), u) if (u := fields.get("WARC-Target-URI")) is not None else None
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return number("WARC-Record-ID"), url, size, digest, kind, number("WARC-Refers-To"), payload if kind == "response" else None


class Package:
    """A package being written to a stream; the index is kept until it is closed."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, compresslevel=3, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as out:
            for line in self.index:
                out.write(line.encode() + b"\n")
        self.zip.close()


def _at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Offset and size of the data of each stored member of a ZIP file of ``size`` bytes."""
    tail_at = max(0, size - 65_557 - 20)
    tail = _at(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if tail[max(0, end - 20) : max(0, end - 20) + 4] == b"PK\x06\x07":
        (wide,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        count, length, start = struct.unpack("<QQQ", _at(file, wide, 56)[32:56])
    central, members, p = _at(file, start, length), {}, 0
    for _ in range(count):
        if central[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, full, n, extra, note, local = struct.unpack("<10xH8xIIHHH8xI", central[p : p + 46])
        name, more = central[p + 46 : p + 46 + n].decode(), central[p + 46 + n : p + 46 + n + extra]
        while len(more) >= 4:  # the ZIP64 field has what did not fit, in this order
            kind, m = struct.unpack("<HH", more[:4])
            if kind == 1:
                wide_values = iter(struct.unpack(f"<{m // 8}Q", more[4 : 4 + m // 8 * 8]))
                full = next(wide_values) if full == 0xFFFFFFFF else full
                packed = next(wide_values) if packed == 0xFFFFFFFF else packed
                local = next(wide_values) if local == 0xFFFFFFFF else local
            more = more[4 + m :]
        if method == 0:
            a, b = struct.unpack("<HH", _at(file, local, 30)[26:30])
            members[name] = (local + 30 + a + b, full)
        p += 46 + n + extra + note
    return members


def read_package(file, size: int) -> Iterator[tuple]:
    """The records of a package, each by one range read."""
    members = directory(file, size)
    data_at, _ = members[DATA]
    for line in io.BytesIO(_at(file, *members[INDEX])):
        entry = json.loads(line)
        yield parse_record(zlib.decompress(_at(file, data_at + entry["offset"], entry["length"]), 31))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done, package, stream, path = [], None, None, ""
        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if package is None:
                    path = f"{root}/{uuid.uuid4().hex}.wacz"
                    stream = store.open_output_stream(path)
                    package = Package(stream)
                package.add(page_id, _record(page_id, url, (payload or "").encode(), refers_to, revisit))
                if package.size >= PACKAGE_BYTES:
                    package.close()
                    stream.close()
                    done.append((path, len(package.index)))
                    package = None
        if package is not None:
            package.close()
            stream.close()
            done.append((path, len(package.index)))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], kind) for i, kind in enumerate((pa.string(), pa.int64()))], names=["path", "records"])

    return run


def _read(folder: str):
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for given in batches:
            for path in given.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    for row in read_package(file, file.size()):
                        rows.append(row)
                        held += len(row[6] or b"")
                        if held > 4 << 20 or len(rows) >= 5_000:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    return run


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``page_id, url, html`` as packages under ``folder``; returns ``path, records`` of each.

    Payloads are compared by SHA-1.  Only digests with several ids are joined
    back, broadcast if they are measured to be few, so payloads are not
    shuffled then.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("__digest")
    )
    shared = settled(
        rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
        .groupBy("__digest").agg(F.max("page_id").alias("__first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND __first IS NOT NULL").select("__digest", "__first")
    )
    side = F.broadcast(shared) if fits_broadcast(shared) else shared
    revisit = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    roles = rows.join(side, "__digest", "left").select("page_id", "url", "html", F.col("__first").alias("refers_to"), revisit.alias("revisit"))
    return settled(roles.mapInArrow(_write(folder), "path string, records long"))


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """The records of packages, one row each: ``RECORDS``; a revisit's payload is null."""
    many = packages.sparkSession.sparkContext.defaultParallelism * 4
    return packages.repartition(many, "path").mapInArrow(_read(folder), RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write packages to a new shared folder and read them back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return read_packages(write_packages(pages, folder, min_bytes), folder)

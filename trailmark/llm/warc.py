"""Web archives: WARC records in ZIP packages of stored members, and a reader that takes ranges of them.

A package holds archive/data.warc, whose records follow each other, and indexes/index.cdxj, one JSON line a record with its
place. The reader finds the central directory from the end of the package (ZIP64 included), turns it into the places of the
stored members, and reads the ranges that the index names; nothing is unpacked. A package is a row (path, length, content), as
Spark's binaryFile source gives them, so packages lie in a table that every executor can read.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import flushed, materialise

#: A package is closed when its records pass so many bytes.
PACKAGE_BYTES = 4 << 20
#: Smaller payloads are always stored.
REVISIT_BYTES = 100
DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
ARCHIVES = "path string, length long, content binary"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
Read = Callable[[int, int], bytes]


# --- records ---------------------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has no payload."""
    kind = "response" if payload is not None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {n_bytes}",
        *([] if payload is not None else [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a record and its payload; payload is None for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    of = lambda name: int(x) if (x := fields.get(name, "<urn:page:>")[10:-1]) else None
    return {"page_id": of("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": of("WARC-Refers-To"), "payload": payload, "n_bytes": int(fields["WARC-Payload-Length"]), "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:")}


# --- packages --------------------------------------------------------------------------------------------------------


def members(read: Read, size: int) -> dict[str, tuple[int, int]]:
    """Name to (offset of the data, length) of each stored member, by the central directory alone and one read per member."""
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, start):  # the real values are in the ZIP64 record that the locator before the end names
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (at,) = struct.unpack_from("<Q", locator, 8)
        big = read(at, 56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", big, 32)
    directory, at, out = read(start, length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n_name, n_extra, n_note = *struct.unpack_from("<H", directory, at + 10), *struct.unpack_from("<IIHHH", directory, at + 20)
        (where,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, where = _zip64(extra, plain, packed, where)
        if method == 0:
            names = struct.unpack("<HH", read(where + 26, 4))  # the local header's own lengths
            out[name] = (where + 30 + sum(names), packed)
        at += 46 + n_name + n_extra + n_note
    return out


def _zip64(extra: bytes, plain: int, packed: int, where: int) -> tuple[int, int, int]:
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return tuple(next(values) if x == 0xFFFFFFFF else x for x in (plain, packed, where))
        at += 4 + n
    return plain, packed, where


def read_package(read: Read, size: int) -> Iterator[dict]:
    """The records of a package, each by one range read at the place its index names."""
    found = members(read, size)
    (data, _), (index, n) = found[DATA], found[INDEX]
    for line in read(index, n).decode().splitlines():
        place = json.loads(line)
        yield parse_record(read(data + place["offset"], place["length"]))


class _Package:
    def __init__(self) -> None:
        self.data, self.lines = io.BytesIO(), []

    def add(self, page_id: int | None, url: str | None, raw: bytes) -> None:
        self.lines.append(json.dumps({"page": page_id, "url": url, "offset": self.data.tell(), "length": len(raw)}))
        self.data.write(raw)

    def bytes(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for name, what in ((DATA, self.data.getvalue()), (INDEX, "\n".join(self.lines).encode())):
                z.writestr(zipfile.ZipInfo(name), what)
        return out.getvalue()


# --- tables ----------------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """pages with digest, n_bytes and refers_to (null for a response).

    The first page of each digest comes from a pre-aggregated minimum. A payload that very many pages share makes a hot digest
    only in a join of ids and digests; the payloads themselves are joined by page.
    """
    payload: Column = F.coalesce(F.col(payload_col), F.lit(""))
    described = pages.withColumn("digest", F.sha2(payload, 256)).withColumn("n_bytes", F.octet_length(payload).cast("long"))
    light = described.where(F.col("n_bytes") >= REVISIT_BYTES).select(F.col(id_col).alias("_id"), F.col("digest").alias("_digest"))
    first = light.groupBy("_digest").agg(F.min("_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1 and refers_to is not null").drop("_n")
    again = light.join(first, "_digest").where(~F.col("_id").eqNullSafe(F.col("refers_to"))).dropDuplicates(["_id", "_digest"])
    return described.join(again, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").drop("_id", "_digest")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """A package table (path, length, content) with one WARC record per row of pages.

    A null payload is empty. Of rows with equal payloads of at least REVISIT_BYTES bytes those with the smallest id are
    responses and the others revisits; smaller payloads are all responses. A null id is never the smallest. Control characters
    and spaces of a url are percent-encoded, a null url has no field. Repeated rows give a record each.
    """
    rows = with_revisits(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("html")))
    rows = rows.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.coalesce("html", F.lit(""))).alias("html"), "digest", "n_bytes", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, package = TaskContext.get().partitionId(), 0, _Package()
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])

        def closed() -> pa.RecordBatch:
            nonlocal seq, package
            raw, name = package.bytes(), f"part-{part:06d}-{seq:05d}.wacz"
            seq, package = seq + 1, _Package()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(raw)]), pa.array([raw], pa.binary())], schema=schema)

        for b in batches:
            for page_id, url, html, digest, n_bytes, refers_to in zip(*b.columns, strict=True):
                payload = html.as_py()
                raw = record(page_id.as_py(), url.as_py(), None if payload is None else payload.encode("utf-8", "surrogatepass"), digest.as_py(), n_bytes.as_py(), refers_to.as_py(), date)
                package.add(page_id.as_py(), url.as_py(), raw)
                if package.data.tell() >= PACKAGE_BYTES:
                    yield closed()
        if package.lines:
            yield closed()

    return rows.mapInArrow(run, ARCHIVES)


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of packages (content, with its length): RECORDS, and payload (binary, null for a revisit) if asked for.

    payload_bytes and payload_digest (SHA-256, hex) describe the full payload: measured for a response, which must agree with
    what its header says, and taken from the header for a revisit.
    """
    columns = RECORDS + ", payload binary" * payloads
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())] + [("payload", pa.binary())] * payloads)

    def rows(content: memoryview) -> Iterator[tuple]:
        for r in read_package(lambda at, n: bytes(content[at : at + n]), len(content)):
            n_bytes, digest, payload = r["n_bytes"], r["digest"], r["payload"]
            if payload is not None and (len(payload), hashlib.sha256(payload).hexdigest()) != (n_bytes, digest):
                raise ValueError(f"the payload of page {r['page_id']} differs from its header")
            yield (r["page_id"], r["url"], r["record_type"], r["refers_to"], n_bytes, digest) + (payload,) * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                yield from flushed(rows(memoryview(content.as_buffer())), schema, lambda r: 200 + len(r[-1] or b"") * payloads)

    return archives.select("content").mapInArrow(run, columns)


def archive(pages: DataFrame) -> DataFrame:
    """Write the packages of pages to the shared folder and give them as a table."""
    return materialise(write_archives(pages), "archives")

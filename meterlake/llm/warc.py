"""WARC archives as a Spark data source in Python, and archiving of pages.

Writing: each task writes one gzip file of WARC records, a member a record, under
a name of its own; the driver lists the files of successful tasks in a manifest
when the job commits, so that lost or repeated tasks leave no records behind.

Reading: the driver plans one partition for each range of a file; filters on the
record type and on header values are pushed down; a task reads a record's headers
first and decodes its payload only when the record passes and the payload is
asked for. Each gzip member carries its own length in an extra field ("sl"), so a
record that is not wanted is stepped over without being decompressed, and a range
can begin at any member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "file string, offset long, warc_type string, record_id string, target_uri string, date string, "
    "payload_digest string, payload_sha1 string, refers_to string, payload_length long, page_id long, "
    "refers_to_page long, payload binary"
)
WRITE_SCHEMA = "page_id long, target_uri string, warc_type string, refers_to long, payload binary"
#: Columns whose filters are answered from the headers alone.
HEADER_COLUMNS = ("warc_type", "record_id", "target_uri", "payload_digest", "payload_sha1", "refers_to", "page_id")
#: Payloads of at least so many bytes are stored once.
LEAST_REVISIT = 1000
#: A partition of the reader begins about every so many bytes.
SPLIT_BYTES = 64 * 1024 * 1024
_CHUNK = 64 * 1024
_MANIFEST = "_manifest"


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int, uri: str | None, kind: str, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC record: a revisit holds the HTTP headers alone, a response the payload too."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    clean = "".join(c if c.isprintable() else "%%%02X" % ord(c) if ord(c) < 256 else "?" for c in uri or "")
    headers = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {clean}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        headers[5:5] = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(headers).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with its whole length and the data's length in the extra field "sl"."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(data)) < 2**32:
        extra = b"sl" + struct.pack("<HII", 8, size, len(data))
        head = b"\x1f\x8b\x08\x04" + b"\0\0\0\0" + b"\0\xff" + struct.pack("<H", len(extra)) + extra
    else:
        head = b"\x1f\x8b\x08\0" + b"\0\0\0\0" + b"\0\xff"
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Committed(WriterCommitMessage):
    name: str | None
    size: int
    starts: list[int]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator: Iterator) -> Committed:
        files, base = fs.FileSystem.from_uri(self.path)
        files.create_dir(base, recursive=True)
        name, at, starts, out = f"part-{uuid.uuid4().hex}.warc.gz", 0, [], None
        for row in iterator:
            out = out or files.open_output_stream(f"{base}/{name}", compression=None)
            data = member(record(row["page_id"], row["target_uri"], row["warc_type"], row["refers_to"], bytes(row["payload"] or b"")))
            if not starts or at - starts[-1] >= SPLIT_BYTES:
                starts.append(at)
            out.write(data)
            at += len(data)
        if out:
            out.close()
        return Committed(name if out else None, at, starts)

    def commit(self, messages: list) -> None:
        files, base = fs.FileSystem.from_uri(self.path)
        files.create_dir(base, recursive=True)
        listed = [{"name": m.name, "size": m.size, "starts": m.starts} for m in messages if m and m.name]
        if not self.overwrite:
            listed = manifest(files, base) + listed
        with files.open_output_stream(f"{base}/{_MANIFEST}.new", compression=None) as out:
            out.write(json.dumps(listed).encode())
        files.move(f"{base}/{_MANIFEST}.new", f"{base}/{_MANIFEST}")

    def abort(self, messages: list) -> None:
        """Files that no manifest lists are not read."""


def manifest(files: fs.FileSystem, base: str) -> list[dict]:
    if files.get_file_info(f"{base}/{_MANIFEST}").type == fs.FileType.NotFound:
        return []
    with files.open_input_stream(f"{base}/{_MANIFEST}", compression=None) as f:
        return json.loads(f.read())


@dataclass
class Span(InputPartition):
    name: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns, self.wanted = path.rstrip("/"), columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps equality and membership of header columns; the rest stays with Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                values = (f.value,) if isinstance(f, EqualTo) else tuple(f.value)
                self.wanted.append((f.attribute[0], values))
            else:
                yield f

    def partitions(self) -> list[Span]:
        files, base = fs.FileSystem.from_uri(self.path)
        listed = manifest(files, base)
        if not listed:  # archives made elsewhere: one partition a file
            found = files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
            names = {f.path[len(base.rstrip("/")) + 1 :]: f.size for f in found}
            listed = [{"name": n, "size": s, "starts": [0]} for n, s in names.items() if n.endswith((".warc.gz", ".warc"))]
        return [
            Span(f["name"], start, end)
            for f in listed
            for start, end in zip(f["starts"], [*f["starts"][1:], f["size"]])
        ] or [Span("", 0, 0)]

    def read(self, partition: Span) -> Iterator[tuple]:
        if not partition.name:
            return
        files, base = fs.FileSystem.from_uri(self.path)
        with files.open_input_file(f"{base}/{partition.name}") as f:
            for offset, headers, payload in records(f, partition.start, partition.end):
                row = fields(partition.name, offset, headers)
                if all(row[c] in values for c, values in self.wanted):
                    if "payload" in self.columns:
                        row["payload"] = payload()
                    yield tuple(row[c] for c in self.columns)


class Bytes:
    """Reads on demand from a raw range or from one gzip member, forward only."""

    def __init__(self, f, at: int):
        self.f, self.at, self.buffer = f, at, b""
        f.seek(at)
        start = f.read(12)
        self.zip = zlib.decompressobj(zlib.MAX_WBITS | 16) if start[:2] == b"\x1f\x8b" else None
        self.jump = None
        if self.zip and len(start) == 12 and start[3] & 4:
            extra = f.read(struct.unpack("<H", start[10:12])[0])
            while len(extra) >= 4:
                (n,) = struct.unpack("<H", extra[2:4])
                if extra[:2] == b"sl" and n == 8:
                    self.jump = at + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n :]
        f.seek(at)
        self.raw = at  # how far the file has been read

    def more(self) -> bool:
        data = self.f.read(_CHUNK)
        if not data:
            return False
        self.raw += len(data)
        if self.zip is None:
            self.buffer += data
            return True
        if self.zip.eof:
            return False
        self.buffer += self.zip.decompress(data)
        if self.zip.eof:
            self.raw -= len(self.zip.unused_data)
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.buffer.find(mark)) < 0:
            if not self.more():
                return None
        out, self.buffer = self.buffer[: i + len(mark)], self.buffer[i + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if not self.buffer and not self.more():
                break
            part, self.buffer = self.buffer[: n - have], self.buffer[n - have :]
            parts.append(part)
            have += len(part)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        while n > 0:
            if not self.buffer and not self.more():
                return
            part = min(n, len(self.buffer))
            self.buffer, n = self.buffer[part:], n - part


def records(f, start: int, end: int):
    """(offset, headers, payload function) of each record that begins in the range.

    The next record is found from the member's own length where it is known, from
    the plain offsets in an uncompressed file, else by inflating the rest.
    """
    at = start
    while at < end:
        data = Bytes(f, at)
        raw = data.until(b"\r\n\r\n")
        if raw is None:
            return
        headers = parse(raw)
        length = int(headers.get("content-length", 0))
        left = [length]

        def payload() -> bytes:
            http = b""
            if headers.get("content-type", "").startswith("application/http"):
                http = data.until(b"\r\n\r\n") or b""
            left[0] -= len(http)
            body = data.take(left[0])
            left[0] = 0
            return body

        yield at, headers, payload
        if data.jump:
            at = data.jump
            continue
        data.skip(left[0] + 4)
        if data.zip is None:
            at += len(raw) + length + 4
        else:
            while not data.zip.eof and data.more():
                data.buffer = b""
            at = data.raw


def parse(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def number(value: str | None) -> int | None:
    return int(value) if value and value.lstrip("-").isdigit() else None


def bare(digest: str) -> str | None:
    """The digest as lower-case hex: archives hold it as base 32 or as hex."""
    if len(digest) == 40:
        return digest.lower()
    return base64.b32decode(digest).hex() if len(digest) == 32 else None


def fields(name: str, offset: int, headers: dict[str, str]) -> dict:
    digest = headers.get("warc-payload-digest") or ""
    return {
        "file": name,
        "offset": offset,
        "warc_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id"),
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "payload_digest": headers.get("warc-payload-digest"),
        "payload_sha1": bare(digest[5:]) if digest.startswith("sha1:") else None,
        "refers_to": headers.get("warc-refers-to"),
        "payload_length": number(headers.get("x-payload-length")),
        "page_id": number(headers.get("x-page-id")),
        "refers_to_page": number(headers.get("x-refers-to-page-id")),
        "payload": None,
    }


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.names)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def write_warc(rows: DataFrame, path: str) -> None:
    """Write rows of WRITE_SCHEMA as WARC records under ``path``."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode("append").option("path", path).save()


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records under ``path``, one row each, with the given columns of SCHEMA (all by default).

    Without ``payload`` among them no payload is decoded. Filters on header
    columns are answered in the tasks, before payloads.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    kinds = dict(part.strip().split(" ") for part in SCHEMA.split(","))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("warc").schema(schema).option("path", path).load()


def archive_pages(
    pages: DataFrame,
    path: str,
    least: int = LEAST_REVISIT,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write a record for each page: equal payloads of at least ``least`` bytes are stored once.

    Of such a group the record with the largest id is the response, the others
    revisit it. Null html is an empty payload; a null url an empty one. Pages that
    repeat an id are records each; with the group's largest id, both are
    responses. Pages without an id are never revisited (and stay responses where
    the whole group has none). No page gives an archive without records.
    """
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        pages[url_col].cast("string").alias("target_uri"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    large = F.octet_length("payload") >= least
    keyed = rows.where(large).withColumn("same", F.sha2("payload", 256))
    groups = (
        keyed.groupBy(F.col("same").alias("group"))
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = keyed.join(groups, F.col("same") == F.col("group"), "left").select(*rows.columns, "kept")
    # smaller pages have no key: they stay where they are read
    joined = joined.unionByName(rows.where(~large).withColumn("kept", F.lit(None).cast("long")))
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    write_warc(
        joined.select(
            "page_id",
            "target_uri",
            F.when(again, "revisit").otherwise("response").alias("warc_type"),
            F.when(again, F.col("kept")).alias("refers_to"),
            "payload",
        ),
        path,
    )

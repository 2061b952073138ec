"""Legacy web archives (ARC) and their conversion to WARC.

An archive is one file, written by Spark's text writer as one row: what separates
records is the row's line separator, so any store will do and a lost task's archive is
written again. Archives are gzip files. They are read record by record, by the lengths
that their headers declare, so payloads may hold anything.

Of records with equal payloads (of a least length) the one with the smallest key stays a
``response``, the others become ``revisit`` records that refer to it. Keys travel in the
HTTP header of a record. Ties of keys go by archive and offset, null keys come last.

A null body is an empty payload, a null or blank URL is ``unknown:``, white space and
control bytes in URLs are percent-encoded. Repeated rows are records of their own, an
empty table gives empty archives, other columns are ignored. An archive with a broken
header, an unreadable length, a wrong digest or a missing end is an error that names it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.folders import drop_written, written
from tidemark.llm.text import bounded_batches

#: Bytes of records in one archive, before compression; a longer record has one of its own.
ARCHIVE_BYTES = 16 << 20
#: Bytes of payloads that leave a task together.
_BATCH = 1 << 20
#: Longest header line or block that is looked for.
_HEADER = 1 << 20

# Header fields of the versions of ARC.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Fixed value of WARC 1.1: what a revisit of the same payload is called.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: HTTP field of a record's key.
KEY_FIELD = "X-Record-Key"
_NO_URL = "unknown:"


class ArchiveError(ValueError):
    """An archive can't be read. Says where."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _url(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", (text or "").strip()) or _NO_URL


@dataclass
class Record:
    """A record of an ARC archive; ``block`` is all that follows its header line."""

    offset: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    version: int

    @property
    def http(self) -> bool:
        return self.url.split(":", 1)[0].lower() in ("http", "https", _NO_URL[:-1]) and self.block.startswith(b"HTTP/")

    def parts(self) -> tuple[bytes, bytes]:
        """The HTTP header with its blank line, and the payload; other blocks are payload."""
        if not self.http:
            return b"", self.block
        ends = [at + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (at := self.block.find(mark)) >= 0]
        end = min(ends, default=len(self.block))
        return self.block[:end], self.block[end:]


def _field(header: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", header)
    return found[1].decode("latin-1") if found else None


def _key(header: bytes) -> str | None:
    found = _field(header, KEY_FIELD)
    return None if found is None else unquote(found)


class _Stream:
    """The bytes of an archive, plain or gzip, and how far they were read."""

    def __init__(self, path: str, content: bytes):
        self.path, self.at = path, 0
        raw = io.BytesIO(content)
        self.source = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw

    def error(self, what: str, offset: int | None = None) -> ArchiveError:
        return ArchiveError(f"{self.path}, at {self.at if offset is None else offset}: {what}")

    def line(self) -> bytes:
        """The next line that is not empty, with its end; b"" at the end."""
        while True:
            found = self.source.readline(_HEADER)
            self.at += len(found)
            if not found or found.strip(b"\r\n"):
                return found

    def exactly(self, size: int) -> bytes:
        found = self.source.read(size)
        self.at += len(found)
        if len(found) < size:
            raise self.error(f"{size - len(found)} byte(s) of a record are missing")
        return found

    def length(self, text: bytes) -> int:
        if not text.isdigit():
            raise self.error(f"{text[:40]!r} is no length")
        return int(text)


def _arc_header(stream: _Stream, line: bytes, version: int) -> list[bytes]:
    """The fields of a header line. Only a URL may hold spaces, and it is the first."""
    fields = line.rstrip(b"\r\n").rsplit(b" ", len(ARC_FIELDS[version].split()) - 1)
    if len(fields) != len(ARC_FIELDS[version].split()):
        raise stream.error(f"a header line of version {version} has {len(fields)} field(s)")
    return fields


def arc_records(path: str, content: bytes) -> Iterator[Record]:
    """Records of an ARC archive, the first of which describes it (``filedesc://``)."""
    stream = _Stream(path, content)
    line, version, date = stream.line(), 0, ""
    while line:
        offset = stream.at - len(line)
        if not version:
            if not line.startswith(b"filedesc://"):
                raise stream.error("it does not begin with filedesc://", offset)
            block = stream.exactly(stream.length(line.rsplit(b" ", 1)[-1].strip()))
            number = block.split(b" ", 1)[0]
            if number not in (b"1", b"2"):
                raise stream.error(f"version {number[:20]!r} is unknown", offset)
            version = int(number)
            fields = _arc_header(stream, line, version)
        else:
            fields = _arc_header(stream, line, version)
            block = stream.exactly(stream.length(fields[-1]))
        url, ip, own, mime = (x.decode("utf-8", "replace") for x in fields[:4])
        date = own if _warc_date(own) else date  # an unreadable date is that of the archive
        if not _warc_date(date):
            raise stream.error("it has no readable date", offset)
        yield Record(offset, url, ip, own if _warc_date(own) else date, mime, block, version)
        line = stream.line()


def _warc_date(date: str) -> str | None:
    """``20010203040506``, or its first part, as WARC spells it."""
    if not re.fullmatch(r"\d{4}(\d\d){0,5}", date):
        return None
    full = date + "00000101000000"[len(date):]
    year, month, day, hour, minute, second = (int(x) for x in re.fullmatch(r"(\d{4})" + r"(\d\d)" * 5, full).groups())
    if not (1 <= month <= 12 and 1 <= day <= 31 and hour < 24 and minute < 60 and second <= 60):
        return None
    return f"{year:04}-{month:02}-{day:02}T{hour:02}:{minute:02}:{second:02}Z"


def _save(archives: DataFrame, folder: str, separator: str) -> None:
    """One file for each row. The separator ends the last record."""
    archives.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def write_arc(pages: DataFrame, folder: str, version: int | None = None, date: str = "20240101000000", id_column: str = "page_id",
              url_column: str = "url", body_column: str = "html") -> None:
    """Write pages as ARC archives of HTTP responses: of a version, or of both by turns."""
    bounded_batches(pages.sparkSession)
    source = pages.select(F.col(id_column).cast("string").alias("key"), F.col(url_column).cast("string").alias("url"), F.col(body_column).cast("binary").alias("body"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        mine = version or 1 + part % 2

        def add(url: str, mime: str, block: bytes) -> None:
            nonlocal size
            more = f"200 - - {size} {name} " if mine == 2 else ""
            record = f"{url} 0.0.0.0 {date} {mime} {more}{len(block)}\n".encode() + block
            held.append(record)
            size += len(record) + 1

        for batch in batches:
            for key, url, body in zip(*(c.to_pylist() for c in batch.columns)):
                if not held:
                    name = f"{part}-{number}.arc"
                    add(f"filedesc://{name}", "text/plain", f"{mine} 0 tidemark\n{ARC_FIELDS[mine]}\n".encode())
                body = body or b""
                own = "" if key is None else f"{KEY_FIELD}: {quote(key)}\r\n"
                add(_url(url), "text/html", f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(body)}\r\n\r\n".encode() + body)
                if size >= ARCHIVE_BYTES:
                    yield _row(archive=pa.array([b"\n".join(held)], pa.binary()))
                    number, held, size = number + 1, [], 0
        if held:
            yield _row(archive=pa.array([b"\n".join(held)], pa.binary()))

    _save(source.mapInArrow(archive, "archive binary"), folder, "\n")


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, offset, version, url, ip, date, mime, http, key, payload_bytes, payload_digest)``
    of each record of ARC archives but their descriptions."""
    bounded_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for r in arc_records(path.as_py(), content.as_py()):
                    if r.url.startswith("filedesc://"):
                        continue
                    header, payload = r.parts()
                    rows.append((path.as_py(), r.offset, r.version, r.url, r.ip, r.date, r.mime, r.http, _key(header), len(payload), payload_digest(payload)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["path", "offset", "version", "url", "ip", "date", "mime", "http", "key", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 4, pa.bool_(), pa.string(), pa.int64(), pa.string()]
    return _files(spark, folder).mapInArrow(read, (
        "path string, offset long, version int, url string, ip string, date string, mime string, http boolean, key string, "
        "payload_bytes long, payload_digest string"))


def _record_id(path: str, offset: int) -> str:
    """The same for a record of an archive, however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>"


def _warc(fields: dict, block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def _converted(record: Record, path: str, first: dict | None) -> bytes:
    """The WARC record of an ARC record. ``first``: the earlier record that has its payload."""
    date = _warc_date(record.date)
    common = {"WARC-Record-ID": _record_id(path, record.offset), "WARC-Date": date}
    if record.url.startswith("filedesc://"):
        block = f"software: tidemark\r\nformat: WARC File Format 1.1\r\nsource: {record.url} (ARC version {record.version})\r\n".encode()
        return _warc({"WARC-Type": "warcinfo", **common, "Content-Type": "application/warc-fields"}, block)
    header, payload = record.parts()
    common |= {"WARC-Target-URI": _url(record.url), "WARC-IP-Address": record.ip if record.ip not in ("", "-", "0.0.0.0") else None,
               "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}", "Payload-Length": len(payload)}
    if not record.http:
        return _warc({"WARC-Type": "resource", **common, "Content-Type": record.mime}, record.block)
    common["Content-Type"] = "application/http; msgtype=response"
    if first is None:
        return _warc({"WARC-Type": "response", **common, "WARC-Block-Digest": f"sha1:{payload_digest(record.block)}"}, record.block)
    return _warc({
        "WARC-Type": "revisit", **common, "WARC-Block-Digest": f"sha1:{payload_digest(header)}", "WARC-Profile": SAME_PAYLOAD,
        "WARC-Refers-To": _record_id(first["path"], first["offset"]), "WARC-Refers-To-Target-URI": _url(first["url"]),
        "WARC-Refers-To-Date": _warc_date(first["date"]), "Refers-To-Key": None if first["key"] is None else quote(first["key"])}, header)


def _revisits(entries: DataFrame, least: int, key_type: str) -> DataFrame:
    """``(path, revisits)``: records of an archive whose payload another one has, with that one.

    Only digests and places are shuffled; the first of a payload is found by a minimum,
    which is combined before the shuffle, and a frequent payload's records may be split."""
    http = entries.where(F.col("http") & (F.col("payload_bytes") >= least))
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key").cast(key_type).alias("typed"), "path", "offset", "key", "url", "date")
    firsts = written(http.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    again = http.select("payload_digest", "path", "offset").join(firsts, "payload_digest").where("path <> first.path or offset <> first.offset")
    return again.groupBy("path").agg(F.collect_list(F.struct(F.col("offset").alias("at"), "first.path", "first.offset", "first.key", "first.url", "first.date")).alias("revisits"))


def convert(spark: SparkSession, source: str, target: str, least: int = 0, key_type: str = "long") -> None:
    """Convert ARC archives to WARC archives, file by file.

    Payloads of ``least`` bytes or more are stored once. Keys are compared as ``key_type``.
    The list of an archive's revisits has no more rows than the archive has records.
    """
    entries = written(read_arc(spark, source), "entries")
    revisits = _revisits(entries, least, key_type)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, again in zip(batch.column(0), batch.column(1), batch.column(2)):
                name, again = path.as_py(), {x["at"]: x for x in again.as_py() or ()}
                out = [_converted(r, name, again.get(r.offset)) for r in arc_records(name, content.as_py())]
                if out:
                    yield _row(archive=pa.array([b"\r\n\r\n".join(out)], pa.binary()))

    joined = _files(spark, source).join(revisits, "path", "left").select("path", "content", "revisits")
    _save(joined.mapInArrow(change, "archive binary"), target, "\r\n\r\n")
    drop_written(entries)


@dataclass
class WarcRecord:
    offset: int
    fields: dict[str, str]
    block: bytes


def warc_records(path: str, content: bytes) -> Iterator[WarcRecord]:
    stream = _Stream(path, content)
    while line := stream.line():
        offset = stream.at - len(line)
        if not line.startswith(b"WARC/"):
            raise stream.error("a record does not begin with WARC/", offset)
        fields: dict[str, str] = {}
        while (line := stream.source.readline(_HEADER)).strip(b"\r\n"):
            stream.at += len(line)
            name, colon, value = line.decode("utf-8", "replace").partition(":")
            if not colon:
                raise stream.error("a header line has no colon", offset)
            fields[name.strip().lower()] = value.strip()
        stream.at += len(line)
        yield WarcRecord(offset, fields, stream.exactly(stream.length(fields.get("content-length", "").encode())))


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """``(path, offset, record_type, record_id, date, url, key, payload_bytes,
    payload_digest, refers_to_id, refers_to, payload)`` of each record of WARC archives.

    The digest of every stored payload is checked. Length and digest of a revisit are
    those of the payload it refers to; ``payload`` is there if asked for, null for revisits."""
    bounded_batches(spark)

    def row(path: str, r: WarcRecord) -> tuple:
        kind, field = r.fields.get("warc-type", ""), r.fields.get
        http = Record(r.offset, "http:", "", "", "", r.block, 0) if "application/http" in field("content-type", "") else None
        header, payload = http.parts() if http else (b"", r.block)
        digest = field("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            size, payload = int(field("payload-length") or _field(header, "Content-Length") or 0), None
        else:
            size, own = len(payload), payload_digest(payload)
            if digest and digest != own:
                raise ArchiveError(f"{path}, at {r.offset}: the payload's digest is {own}, not {digest}")
            digest = own
        referred = field("refers-to-key")
        return (path, r.offset, kind, field("warc-record-id"), field("warc-date"), field("warc-target-uri"), _key(header), size, digest,
                field("warc-refers-to"), None if referred is None else unquote(referred), payload if payloads else None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for r in warc_records(path, content.as_py()):
                    rows.append(row(path, r))
                    size += 256 + len(rows[-1][-1] or b"")
                    if size >= _BATCH:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["path", "offset", "record_type", "record_id", "date", "url", "key", "payload_bytes", "payload_digest", "refers_to_id", "refers_to", "payload"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), *[pa.string()] * 3, pa.binary()]
    return _files(spark, folder).mapInArrow(read, (
        "path string, offset long, record_type string, record_id string, date string, url string, key string, payload_bytes long, "
        "payload_digest string, refers_to_id string, refers_to string, payload binary"))

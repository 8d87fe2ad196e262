"""WARC records in ZIP-packaged archives: writer, directory parser and range reader (op1).

An archive is a ZIP file whose members are stored, not compressed: a WARC file of
gzip members (`archive/data.warc.gz`), an index with one JSON line for each record
(`indexes/index.cdxj`) and `datapackage.json`. As members are stored, a record is a
byte range of the archive: the reader parses the end record, the ZIP64 locator and
end record where present, and the central directory; finds the members' data; and
fetches only the index and the records' ranges. Nothing is extracted.

Payloads with equal bytes are written once, as the response with the largest page
id; the others become revisit records that name its record id and carry digest and
length of the full payload.

Defined results: null html is the empty payload; null ids are lowest and make
records without a target page id; of rows equal in id and payload one, with the largest
url, counts as the page and the others revisit it or what it revisits; an empty table
writes no archive and reads no records; columns other than id, url and html are not
looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlex.llm.common import cut, narrow_join, new_path

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: Bytes of WARC data after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Bytes of neighbouring records that are fetched with one range read.
RANGE_BYTES = 1 << 20
#: Bytes of records that one task reads back.
TASK_BYTES = 8 << 20
MIN_REVISIT_BYTES = 0


# ------------------------------------------------------------------- ZIP


class Member(NamedTuple):
    name: str
    method: int
    header: int  # offset of the local header
    stored: int  # bytes in the archive
    size: int  # bytes unpacked


def _end_record(read: Callable[[int, int], bytes], size: int) -> tuple[int, int, int]:
    """(offset, bytes, entries) of the central directory."""
    tail_at = max(0, size - 65557 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0:  # a comment may hold the signature: the comment's length must fit
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP archive, or cut off")
    disk, _, _, entries, length, offset = struct.unpack_from("<HHHHII", tail, at + 4)
    if 0xFFFF in (disk, entries) or 0xFFFFFFFF in (length, offset):
        where = tail_at + at - 20
        locator = read(where, 20) if where >= 0 else b""
        if locator[:4] == b"PK\x06\x07":
            end64 = struct.unpack_from("<Q", locator, 8)[0]
            record = read(end64, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("broken ZIP64 end record")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
    if offset + length > size:
        raise ValueError("central directory beyond the end of the archive")
    return offset, length, entries


def members(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """All members that the central directory lists. read(offset, length) gives bytes."""
    offset, length, entries = _end_record(read, size)
    directory, at, found = read(offset, length), 0, []
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, full = struct.unpack_from("<II", directory, at + 20)
        n, extra, comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        field, end = at + 46 + n, at + 46 + n + extra
        while field + 4 <= end:
            kind, width = struct.unpack_from("<HH", directory, field)
            if kind == 1:  # ZIP64: only the values that overflow are there, in this order
                values = list(struct.unpack_from(f"<{width // 8}Q", directory, field + 4))
                full = values.pop(0) if full == 0xFFFFFFFF else full
                stored = values.pop(0) if stored == 0xFFFFFFFF else stored
                header = values.pop(0) if header == 0xFFFFFFFF else header
            field += 4 + width
        found.append(Member(name, method, header, stored, full))
        at = end + comment
    return found


def data_offset(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a member's bytes begin. Only stored members can be read by range."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed in the archive")
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"broken local header of {member.name}")
    n, extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + extra


# ------------------------------------------------------------------ WARC


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip_member(text.encode() + block + b"\r\n\r\n")


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def build_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, revisit: bool, when: str) -> bytes:
    """One gzip member with a response or revisit record; size and digest are those of
    the full payload, which a revisit doesn't hold."""
    clean = "".join(c for c in (url or "urn:unknown") if c > " ").strip() or "urn:unknown"
    own = f"<urn:uuid:{uuid.uuid4()}>" if page_id is None or revisit else record_id(page_id)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", when), ("WARC-Target-URI", clean)]
    head += [("X-Page-Id", "null" if page_id is None else str(page_id))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response")]
    return _record(head, _HTTP if revisit else _HTTP + payload)


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        """The HTTP body."""
        return self.block.partition(b"\r\n\r\n")[2]


def parse_record(member: bytes) -> WarcRecord:
    data = zlib.decompressobj(31).decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    n = int(headers["Content-Length"])
    if len(rest) < n:
        raise ValueError("cut-off WARC record")
    return WarcRecord(headers, rest[:n])


# ----------------------------------------------------------------- files


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):  # file:/a and file:///a alike
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def range_reader(path: str) -> tuple[Callable[[int, int], bytes], int, Callable[[], None]]:
    """(read, size, close) of an archive in any store that Arrow opens."""
    system, inner = _file_system(path)
    handle = system.open_input_file(inner)

    def read(offset: int, length: int) -> bytes:
        handle.seek(offset)
        return handle.read(length)

    return read, handle.size(), handle.close


class ArchiveWriter:
    """One archive: records are appended to the stored WARC member as they come;
    the index follows when the archive is closed."""

    def __init__(self, path: str) -> None:
        system, inner = _file_system(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.path, self.lines, self.at = path, [], 0
        self._out = system.open_output_stream(inner)
        self._zip = zipfile.ZipFile(_Forward(self._out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(zipfile.ZipInfo(DATA, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def add(self, page_id: int | None, url: str | None, record: bytes) -> None:
        self._data.write(record)
        self.lines.append(json.dumps({"page": page_id, "url": url, "offset": self.at, "length": len(record)}))
        self.at += len(record)

    def close(self) -> None:
        self._data.close()
        self._zip.writestr(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "".join(x + "\n" for x in self.lines))
        self._zip.writestr(zipfile.ZipInfo(PACKAGE, (2024, 1, 1, 0, 0, 0)), json.dumps({"profile": "data-package", "resources": [{"path": DATA, "bytes": self.at, "records": len(self.lines)}, {"path": INDEX}]}))
        self._zip.close()
        self._out.close()


class _Forward(io.RawIOBase):
    """A write-only stream for zipfile, which then needs no seeking."""

    def __init__(self, out) -> None:
        self._to, self._n = out, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self._to.write(bytes(data))
        self._n += len(data)
        return len(data)

    def tell(self) -> int:
        raise OSError("no seeking")


# ------------------------------------------------------------- operators


def mark_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (null for revisits), size, sha1, revisit, refers_to: of rows
    with equal payloads, the one with the largest id is the response. Ids, digests and
    sizes alone are grouped by digest; the marks are joined back by id, so a payload that
    a third of the rows have gathers nowhere."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload"))})
    narrow = cut(rows.select("page_id", "url", "size", "sha1"), "digests")
    last = F.max(F.struct(F.col("page_id").isNotNull().alias("has"), "page_id"))
    best = narrow.where(F.col("size") >= least).groupBy("sha1").agg(last.alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    best = cut(best.select("sha1", F.col("m.page_id").alias("refers_to")), "repeated")
    marks = narrow.select("page_id", "sha1").join(best, "sha1").where("not (page_id <=> refers_to)").distinct()
    marks = cut(marks.select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "refers_to", F.lit(True).alias("revisit")), "revisits")
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_sha1"))
    columns = ["page_id", "url", "payload", "size", "sha1", "revisit", "refers_to"]

    def marked(some: DataFrame) -> DataFrame:
        out = narrow_join(some, marks, same, "left").withColumn("revisit", F.coalesce("revisit", F.lit(False)))
        return out.withColumn("payload", F.when(~F.col("revisit"), F.col("payload"))).select(columns)

    # rows equal in id and payload: all but one of them are revisits, too
    again = narrow.groupBy("page_id", "sha1", "size").agg(F.count(F.lit(1)).alias("m"), F.max("url").alias("top")).where((F.col("m") > 1) & (F.col("size") >= least))
    again = cut(again.select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "top"), "again")
    if again.isEmpty():
        return marked(rows)
    one = narrow_join(rows, again, same, "left_semi").groupBy("page_id", "sha1", "size").agg(F.max("url").alias("url"), F.first("payload").alias("payload"))
    counted = narrow_join(narrow, again, same).groupBy("page_id", "sha1", "size", "url", "top").agg(F.count(F.lit(1)).alias("m"))
    rest = counted.withColumn("m", F.col("m") - F.when(F.col("url").eqNullSafe(F.col("top")), 1).otherwise(0)).where("m > 0")
    rest = rest.join(best, "sha1").select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "size", "sha1", F.lit(True).alias("revisit"), "refers_to", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("i"))
    return marked(narrow_join(rows, again, same, "left_anti")).union(marked(one.select(rows.columns))).union(rest.select(columns))


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of mark_revisits(); a table of (path, records,
    bytes) of the archives. A task that is run again writes under new names, and
    only the names of the run that counted are in the table."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        when = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        out, done = None, []

        def finish() -> None:
            out.close()
            done.append((out.path, len(out.lines), out.at))

        for batch in batches:
            for page_id, url, payload, size, sha1, revisit, refers_to in zip(*(batch[c] for c in ("page_id", "url", "payload", "size", "sha1", "revisit", "refers_to")), strict=True):
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                if out is None:
                    out = ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                out.add(page_id, url, build_record(page_id, url, payload or b"", int(size), base64.b32encode(sha1).decode(), refers_to, bool(revisit), when))
                if out.at >= archive_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    exact = marked.withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("page_id", "refers_to")})
    return cut(exact.mapInPandas(write, "path string, records long, bytes long"), "manifest")


def locate(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges (path, offset, lengths) of neighbouring records, from each
    archive's directory and index."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                read, size, close = range_reader(path)
                try:
                    by_name = {m.name: m for m in members(read, size)}
                    index, base = by_name[INDEX], data_offset(read, by_name[DATA])
                    lines = read(data_offset(read, index), index.stored).splitlines()
                finally:
                    close()
                rows, at, lengths = [], None, []
                for line in lines:
                    entry = json.loads(line)
                    if lengths and sum(lengths) + entry["length"] > range_bytes:
                        rows.append((path, base + at, lengths))
                        lengths = []
                    at = at if lengths else entry["offset"]
                    lengths = [*lengths, entry["length"]]
                if lengths:
                    rows.append((path, base + at, lengths))
                yield pd.DataFrame(rows, columns=["path", "offset", "lengths"])

    tasks = max(1, archives.count())
    return archives.select("path").repartition(tasks).mapInPandas(ranges, "path string, offset long, lengths array<long>")


RECORD = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives, fetched by range. Digest and length of responses
    are taken from the payload read, which must agree with the record's headers;
    those of revisits from their headers."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, offset, lengths in zip(batch["path"], batch["offset"], batch["lengths"], strict=True):
                read, _, close = range_reader(path)
                data = read(int(offset), int(sum(lengths)))
                close()
                rows, at = [], 0
                for n in lengths:
                    record = parse_record(data[at : at + n])
                    at += n
                    h, kind, payload = record.headers, record.headers["WARC-Type"], record.payload()
                    digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                    if kind == "response" and (sha1_base32(payload), len(payload)) != (digest, size):
                        raise ValueError(f"{path}: a payload doesn't have its digest")
                    refers = h.get("WARC-Refers-To", "")
                    rows.append((h["X-Page-Id"], h["WARC-Target-URI"], kind, digest, size, refers.removeprefix("<urn:page:").rstrip(">") or None, payload if with_payload and kind == "response" else None))
                yield pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])

    # as many tasks as the archives' bytes ask for, whatever the size of their index
    tasks = max(1, -(-(archives.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES))
    raw = locate(archives).repartition(tasks).mapInPandas(fetch, RECORD)
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("long")
    return raw.withColumns({"page_id": number("page_id"), "refers_to": number("refers_to")})


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write pages to archives in `folder` (a new shared one) and read them back."""
    archives = write_archives(mark_revisits(pages, **columns), folder or new_path(spark, "warc"))
    return read_records(archives)

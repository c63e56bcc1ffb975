"""Web archives packed in ZIP files: writing them, and reading records by range without extraction.

An archive holds a stored member of gzipped WARC records, an index of them and a description. The reader finds the
central directory from the file's end (in either the 32-bit or the ZIP64 form), locates the members, reads the index
and fetches each record by its range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import math
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import heavy_bar, materialize, read_table, scratch_path
from .store import Ranges, create

#: An archive is closed once its records have so many bytes.
ARCHIVE_BYTES = 32 << 20
#: Bytes of records that one reading task gets, about.
READ_BYTES = 8 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
#: A table of repeated digests with more rows is joined by shuffle and not broadcast; a row has under 100 bytes.
BROADCAST_ROWS = 200_000
DATA, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: WARC-Date of every record; a page table has no fetch time.
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing


def target_uri(url: str | None) -> str:
    """The URL as a header may hold it: what is no printable ASCII, and spaces, are percent-encoded."""
    return quote(url or "", safe="%/:?#[]@!$&'()*+,;=~|", errors="replace")


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or (payload None) a revisit without."""
    kind = "response" if payload is not None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target_uri(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class ArchiveWriter:
    """Appends records to archives in a folder."""

    def __init__(self, folder: str, limit: int = ARCHIVE_BYTES):
        self.folder, self.limit = folder, limit
        self.zip: zipfile.ZipFile | None = None

    def _open(self) -> None:
        self.stream, self.uri = create(self.folder, "pages-{}.wacz")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member, self.at, self.lines = self.zip.open(DATA, "w", force_zip64=True), 0, []

    def put(self, page_id: int | None, url: str | None, data: bytes, kind: str) -> str | None:
        """Appends a record; returns the archive's URI when this closed it."""
        if self.zip is None:
            self._open()
        packed = gzip.compress(data, 6, mtime=0)
        self.member.write(packed)
        self.lines.append(f"{target_uri(url)} 19700101000000 " + json.dumps({"offset": self.at, "length": len(packed), "filename": DATA, "type": kind, "page_id": page_id}))
        self.at += len(packed)
        return self.close() if self.at >= self.limit else None

    def close(self) -> str | None:
        if self.zip is None:
            return None
        self.member.close()
        self.zip.writestr(INDEX, "".join(x + "\n" for x in self.lines), zipfile.ZIP_DEFLATED)
        self.zip.writestr(ABOUT, json.dumps({"profile": "data-package", "resources": [DATA, INDEX]}))
        self.zip.close()
        self.stream.close()
        self.zip = None
        return self.uri


def repeated_payloads(pages: DataFrame) -> DataFrame:
    """__digest, __n and __target, the largest page_id, of payloads that two or more pages have, stored."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    hashed = pages.filter(size >= LEAST_BYTES).select("page_id", _digest().alias("__digest"))
    groups = hashed.groupBy("__digest").agg(F.count("*").alias("__n"), F.max("page_id").alias("__target"))
    return materialize(groups.filter("__n > 1"), "warc-repeated")


def _digest():
    return F.unhex(F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))


def with_targets(pages: DataFrame) -> DataFrame:
    """page_id, url, html and __target, the page whose record has the payload (null: the row's own)."""
    groups = repeated_payloads(pages)
    rows = pages.select("page_id", "url", "html", _digest().alias("__digest"))
    if groups.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(groups), "__digest", "left")
    else:  # payloads with a large share of the rows are few; the others shuffle
        bar = heavy_bar(pages.count())
        heavy, light = groups.filter(F.col("__n") >= bar), groups.filter(F.col("__n") < bar)
        joined = rows.join(F.broadcast(heavy), "__digest").unionByName(
            rows.join(F.broadcast(heavy.select("__digest")), "__digest", "left_anti").join(light, "__digest", "left")
        )
    return joined.select("page_id", "url", "html", "__target", F.col("__n").isNotNull().alias("__repeated"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each page into archives in the folder and returns their URIs, stored.

    Of pages with equal payloads of LEAST_BYTES or more, that with the largest page_id is the response and the
    others revisit it; rows that repeat that page_id are responses as well. Null html is an empty payload; a null
    page_id is never the largest unless no page of the payload has one. A lost task writes new archives, and no
    row names those of the failed attempt.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = ArchiveWriter(folder)
        for frame in frames:
            done = []
            for page_id, url, html, target, repeated in zip(*(frame[c] for c in ("page_id", "url", "html", "__target", "__repeated")), strict=True):
                own = None if page_id is None else int(page_id)
                to = None if target is None else int(target)
                payload = (html if isinstance(html, str) else "").encode("utf-8", "replace")
                digest = payload_digest(payload)
                revisit = repeated and to is not None and own != to
                address = url if isinstance(url, str) else None
                data = record(own, address, None if revisit else payload, digest, len(payload), to if revisit else None)
                done.append(writer.put(own, address, data, "revisit" if revisit else "response"))
            yield pd.DataFrame({"archive": pd.Series([x for x in done if x], dtype=object)})
        yield pd.DataFrame({"archive": pd.Series([x for x in [writer.close()] if x], dtype=object)})

    rows = with_targets(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "__target")})  # pandas makes floats of null numbers
    return materialize(rows.mapInPandas(run, "archive string"), "warc-archives")


# ---- reading


@dataclass
class Member:
    """A member of a ZIP file, as the central directory has it."""

    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def central_directory(uri: str, ranges: Ranges) -> tuple[int, int, int]:
    """Entries, offset and size of the central directory, from the end record or the ZIP64 one."""
    total = ranges.size(uri)
    tail_at = max(0, total - 65557)
    tail = ranges.read(uri, tail_at, total - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError(f"{uri} is no ZIP file")
    entries, size, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if entries == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = ranges.read(uri, tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError(f"{uri} lacks its ZIP64 locator")
        end = ranges.read(uri, struct.unpack("<Q", locator[8:16])[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError(f"{uri} lacks its ZIP64 end record")
        entries, size, offset = struct.unpack("<QQQ", end[32:56])
    return entries, offset, size


def members(uri: str, ranges: Ranges) -> dict[str, Member]:
    """The members of a ZIP file by name; no data is read."""
    entries, offset, size = central_directory(uri, ranges)
    data, at, found = ranges.read(uri, offset, size), 0, {}
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError(f"{uri} has a damaged directory")
        flags, method = struct.unpack("<HH", data[at + 8 : at + 12])
        crc, packed, full, n_name, n_extra, n_note = struct.unpack("<IIIHHH", data[at + 16 : at + 34])
        header = struct.unpack("<I", data[at + 42 : at + 46])[0]
        name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = data[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, length = struct.unpack("<HH", extra[e : e + 4])
            if kind == 1:  # ZIP64: has those fields, in this order, that do not fit above
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[e + 4 : e + 4 + length // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            e += 4 + length
        found[name] = Member(name, method, crc, packed, full, header)
        at += 46 + n_name + n_extra + n_note
    return found


def data_offset(uri: str, member: Member, ranges: Ranges) -> int:
    """Where the member's data begin: its local header has name and extra field of its own lengths."""
    local = ranges.read(uri, member.header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError(f"{uri} lacks the header of {member.name}")
    return member.header + 30 + sum(struct.unpack("<HH", local[26:30]))


def read_member(uri: str, member: Member, ranges: Ranges) -> bytes:
    """A whole small member, such as an index."""
    data = ranges.read(uri, data_offset(uri, member, ranges), member.packed)
    if member.method not in (0, 8):
        raise ValueError(f"method {member.method}")
    data = zlib.decompress(data, -15) if member.method == 8 else data
    if zlib.crc32(data) != member.crc:
        raise ValueError(f"{member.name} is damaged")
    return data


def locate_records(archives: DataFrame) -> DataFrame:
    """archive, offset and length of every record that the archives' indexes name, as ranges of the ZIP files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = Ranges()
        for frame in frames:
            for uri in frame["archive"]:
                inside, bases, rows = members(uri, ranges), {}, []
                for name in sorted(n for n in inside if n.startswith("indexes/")):
                    for line in read_member(uri, inside[name], ranges).decode().splitlines():
                        entry = json.loads(line[line.index(" 19700101000000 ") + 16 :] if " 19700101000000 " in line else line[line.index("{") :])
                        target = entry["filename"]
                        if target not in bases:
                            if inside[target].method != 0:
                                raise ValueError(f"{target} is not stored")
                            bases[target] = data_offset(uri, inside[target], ranges)
                        rows.append((uri, bases[target] + int(entry["offset"]), int(entry["length"])))
                yield pd.DataFrame(rows, columns=["archive", "offset", "length"])
        ranges.close()

    return archives.select("archive").mapInPandas(run, "archive string, offset long, length long")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:] if ": " in line)}
    body = rest[: int(headers["content-length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def read_records(places: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record, read by its range.

    Size and digest of a response are those of the payload read; a revisit's are in its headers.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = Ranges()
        for frame in frames:
            rows = []
            for place in zip(frame["archive"], frame["offset"], frame["length"], strict=True):
                headers, payload = parse_record(gzip.decompress(ranges.read(*place)))
                kind, told = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response":
                    size, digest = len(payload), payload_digest(payload)
                    if digest != told:
                        raise ValueError("a payload does not match its digest")
                else:
                    size, digest = int(headers["x-payload-length"]), told
                page, to = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                rows.append((page, size, digest, kind, to))
            yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        ranges.close()

    # ids travel as text: pandas makes floats of numbers beside nulls
    found = places.mapInPandas(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of all archives; those of one stretch of an archive are read by one task, in order."""
    places = materialize(locate_records(archives), "warc-places")
    size = places.agg(F.sum("length")).first()[0] or 0
    parts = max(archives.sparkSession.sparkContext.defaultParallelism, math.ceil(size / READ_BYTES))
    return read_records(places.repartition(parts, "archive", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("archive", "offset"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return read_archives(write_archives(pages, scratch_path(spark, "warc")))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT page_id, size, max(page_id) OVER (PARTITION BY hex) AS target,
         array_to_string(list_transform(range(1, 41), lambda i: right('0000' || bin(('0x' || substr(hex, i, 1))::INT), 4)), '') AS bits
  FROM p)
SELECT page_id, size::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(1, 6), lambda j: (substr(bits, 5 * i + j, 1)::INT * (32 >> j))))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> target THEN target END AS refers_to
FROM b
"""

QUERIES = {"op9_warc": op9_warc}
ORACLES = {"op9_warc": ORACLE}

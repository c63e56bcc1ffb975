"""Media columns: content-addressed PNG payloads in tar shards.

A task appends the payloads it meets to a shard, each distinct one once, under the digest of the stored form. Rows
carry shard, digest, offset and length only. Metadata columns come from range reads of the fixed-size header, and
whole payloads are read back by their range.
"""

from __future__ import annotations

import hashlib
import math
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, scratch_path, with_ids
from .store import Ranges, create

#: Samples of a row of the image; payloads are padded to a positive multiple of it.
WIDTH = 576
PAD = b"\xff"
LEVEL = 1
#: A shard is closed once it has so many bytes.
SHARD_BYTES = 64 << 20
#: Bytes of media that one reading task gets, about.
READ_BYTES = 16 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Signature and header chunk: what a metadata read fetches.
HEADER_BYTES = 33
BLOCK = 512

INDEX = "shard string, offset long, length long, media_sha256 string"


def padded(text: str | None) -> bytes:
    """The text in UTF-8, null as empty, filled with bytes 255, which UTF-8 never has, to whole rows."""
    raw = (text or "").encode("utf-8", "replace")
    rows = max(1, math.ceil(len(raw) / WIDTH))
    return raw + PAD * (rows * WIDTH - len(raw))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """The payload as 8-bit grey samples, WIDTH to a row."""
    rows = len(payload) // WIDTH
    samples = np.zeros((rows, WIDTH + 1), dtype=np.uint8)  # each row begins with filter 0
    samples[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(rows, WIDTH)
    header = struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(samples.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample, from the first HEADER_BYTES bytes."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    width, height, bits = struct.unpack(">IIB", head[16:25])
    return width, height, bits


def from_png(media: bytes) -> bytes:
    """The samples of an unfiltered 8-bit grey image; checks every chunk's sum."""
    width, height, bits = png_header(media[:HEADER_BYTES])
    at, data = 8, []
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged chunk")
        if kind == b"IDAT":
            data.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(height, width * bits // 8 + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes()


class ShardWriter:
    """Appends media to tar shards in a folder, each distinct payload once to a shard."""

    def __init__(self, folder: str, limit: int = SHARD_BYTES):
        self.folder, self.limit = folder, limit
        self.stream, self.uri, self.at = None, "", 0
        self.known: dict[bytes, tuple[str, int, int, str]] = {}

    def put(self, payload: bytes) -> tuple[str, int, int, str]:
        """shard, offset, length and digest of the payload's stored form."""
        key = hashlib.sha256(payload).digest()
        if key in self.known:
            return self.known[key]
        if self.stream is None:
            self.stream, self.uri = create(self.folder, "shard-{}.tar")
        media = to_png(payload)
        name = hashlib.sha256(media).hexdigest()
        entry = tarfile.TarInfo(f"{name[:2]}/{name}.png")
        entry.size = len(media)
        self.stream.write(entry.tobuf(tarfile.USTAR_FORMAT))
        self.stream.write(media)
        self.stream.write(b"\0" * (-len(media) % BLOCK))
        found = self.known[key] = (self.uri, self.at + BLOCK, len(media), name)
        self.at += BLOCK + len(media) + -len(media) % BLOCK
        if self.at >= self.limit:
            self.close()
        return found

    def close(self) -> None:
        if self.stream is not None:
            self.stream.write(b"\0" * (2 * BLOCK))
            self.stream.close()
        self.stream, self.at = None, 0
        self.known.clear()


def store_texts(docs: DataFrame, folder: str) -> DataFrame:
    """Writes every text's payload to shards in the folder: doc_id with shard, offset, length and media_sha256.

    Copies in one shard share a member; copies in different shards have equal bytes and digests. A lost task
    writes shards of its own again, and no row points to those of the failed attempt.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = ShardWriter(folder)
        for frame in frames:
            places = [writer.put(padded(t if isinstance(t, str) else None)) for t in frame["text"]]
            rows = pd.DataFrame(places, columns=["shard", "offset", "length", "media_sha256"])
            rows.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield rows
        writer.close()

    return with_ids(docs, "text", run, INDEX)


def _by_place(index: DataFrame) -> DataFrame:
    """Rows of one stretch of a shard together, in order of offset."""
    size = index.agg(F.sum("length")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(size / READ_BYTES))
    stretch = F.floor(F.col("offset") / READ_BYTES)
    return index.repartition(parts, "shard", stretch).sortWithinPartitions("shard", "offset")


def header_columns(index: DataFrame) -> DataFrame:
    """Adds width, height and bits, reading HEADER_BYTES bytes of each member and no payload."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges, last, meta = Ranges(), None, (0, 0, 0)
        for frame in frames:
            found = []
            for place in zip(frame["shard"], frame["offset"], strict=True):
                if place != last:
                    last, meta = place, png_header(ranges.read(*place, HEADER_BYTES))
                found.append(meta)
            frame[["width", "height", "bits"]] = np.array(found, dtype=np.int64).reshape(len(found), 3)
            yield frame
        ranges.close()

    rows = index.select(F.col("doc_id").cast("string").alias("doc_id"), "shard", "offset", "length", "media_sha256")
    found = rows.mapInPandas(run, f"doc_id string, {INDEX}, width long, height long, bits long")
    return found.withColumn("doc_id", F.col("doc_id").cast(index.schema["doc_id"].dataType))


def feature(payload: bytes) -> str:
    """Mean, spread, eight-bin histogram and 64-bit average hash of the samples."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    mean = samples.mean()
    bins = np.bincount(samples >> 5, minlength=8)
    parts = np.add.reduceat(samples.astype(np.int64), np.arange(0, len(samples), len(samples) // 64)[:64])
    hashed = int("".join("1" if v > mean * (len(samples) // 64) else "0" for v in parts), 2)
    return f"{mean:.3f};{samples.std():.3f};{'/'.join(map(str, bins))};{hashed:016x}"


def payload_columns(index: DataFrame) -> DataFrame:
    """Reads every member back by its range: n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    Null and empty texts are one row of bytes 255 with n_bytes 0. An empty table gives no rows.
    """
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def describe(media: bytes) -> tuple:
        payload = from_png(media)
        return (
            len(payload.rstrip(PAD)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]),
            len(media), hashlib.sha256(media).hexdigest(), feature(payload),
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges, last, told = Ranges(), None, ()
        for frame in frames:
            found = []
            for place in zip(frame["shard"], frame["offset"], frame["length"], strict=True):
                if place != last:
                    last, told = place, describe(ranges.read(*place))
                found.append(told)
            rows = pd.DataFrame(found, columns=names)
            rows.insert(0, "doc_id", frame["doc_id"].to_numpy())
            rows["width"], rows["height"] = frame["width"].to_numpy(), frame["height"].to_numpy()
            yield rows
        ranges.close()

    rows = index.select(F.col("doc_id").cast("string").alias("doc_id"), "shard", "offset", "length", "width", "height")
    kinds = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width long, height long"
    return rows.mapInPandas(run, f"doc_id string, {kinds}").withColumn("doc_id", F.col("doc_id").cast(index.schema["doc_id"].dataType))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    index = materialize(store_texts(docs, scratch_path(spark, "media")), "media-index")
    return payload_columns(header_columns(_by_place(index)))


QUERIES = {"op8_media": op8_media}
ORACLES: dict[str, str] = {}

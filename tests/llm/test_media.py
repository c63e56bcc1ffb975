import hashlib

import tarfile
import zlib

from foliospark.llm import media as M
from foliospark.llm.common import materialize, scratch_path
from hypothesis import given
from hypothesis import strategies as st


@given(st.text(max_size=3000))
def test_png_round_trip(text):
    payload = M.padded(text)
    raw = text.encode("utf-8", "replace")
    assert len(payload) % 576 == 0 and payload.rstrip(b"\xff") == raw and len(payload) - len(raw) < 576 + (not raw)
    image = M.to_png(payload)
    assert M.from_png(image) == payload
    assert M.png_header(image[: M.HEADER_BYTES]) == (576, len(payload) // 576, 8)


def test_shards_are_tar_files(tmp_path):
    writer = M.ShardWriter(f"file://{tmp_path}", limit=4000)
    texts = ["a", "b" * 5000, "a", "", "c" * 900]
    places = [writer.put(M.padded(t)) for t in texts]
    writer.close()
    assert places[0] == places[2]
    for t, (shard, offset, length, name) in zip(texts, places, strict=True):
        with tarfile.open(shard.removeprefix("file://")) as tar:
            member = tar.getmember(f"{name[:2]}/{name}.png")
            body = tar.extractfile(member).read()
        assert (member.offset_data, member.size) == (offset, length)
        assert hashlib.sha256(body).hexdigest() == name and M.from_png(body) == M.padded(t)



def test_rows_of_every_kind(spark):
    rows = [(1, "grün", 7), (2, None, 7), (3, "", 7), (4, "z" * 300_000, 7), (1, "grün", 7), (None, "grün", 7), (2**60 + 1, "gross", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, width long")
    index = materialize(M.store_texts(docs, scratch_path(spark, "media")), "media-index")
    got = M.payload_columns(M.header_columns(M._by_place(index))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t or "" for k, t, _ in rows if k == r.doc_id)
        payload = M.padded(text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text.encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(M.to_png(payload)), hashlib.sha256(M.to_png(payload)).hexdigest())
        assert r.width * r.height == r.payload_bytes
    assert len({r.feature for r in got if r.doc_id in (1, None)}) == 1
    empty = materialize(M.store_texts(docs.limit(0), scratch_path(spark, "media")), "media-index")
    assert M.payload_columns(M.header_columns(M._by_place(empty))).count() == 0


def plain_png(data):
    """Width, height and samples of an image, by its chunks, in plain Python."""
    assert data[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, packed, head = 8, b"", None
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        assert int.from_bytes(data[at + 8 + size : at + 12 + size], "big") == zlib.crc32(kind + body)
        head, packed = (body if kind == b"IHDR" else head), packed + (body if kind == b"IDAT" else b"")
        at += 12 + size
    width, height = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    assert head[8:] == bytes([8, 0, 0, 0, 0])
    raw = zlib.decompress(packed)
    lines = [raw[k * (width + 1) : (k + 1) * (width + 1)] for k in range(height)]
    assert all(line[0] == 0 for line in lines)
    return width, height, b"".join(line[1:] for line in lines)


def test_table_by_brute_force(spark, tmp_path):
    """Everything that the rows tell, from the members of the shards and from the texts."""
    texts = ["", None, "grün", "x" * 576, "x" * 577, "ab" * 5000, "grün"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = f"file://{tmp_path}"
    index = materialize(M.store_texts(docs, folder), "media-index")
    got = {r.doc_id: r for r in M.payload_columns(M.header_columns(M._by_place(index))).collect()}
    members = {}
    for path in tmp_path.glob("*.tar"):
        with tarfile.open(path) as tar:
            for m in tar.getmembers():
                body = tar.extractfile(m).read()
                assert m.name == f"{hashlib.sha256(body).hexdigest()[:2]}/{hashlib.sha256(body).hexdigest()}.png"
                members[hashlib.sha256(body).hexdigest()] = body
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = got[k]
        media = members[r.media_sha256]
        assert plain_png(media) == (576, len(payload) // 576, payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media))
        mean = sum(payload) / len(payload)
        spread = (sum((v - mean) ** 2 for v in payload) / len(payload)) ** 0.5
        bins = [sum(32 * b <= v < 32 * b + 32 for v in payload) for b in range(8)]
        step = len(payload) // 64
        starts = list(range(0, len(payload), step))[:64]
        sums = [sum(payload[a : b]) for a, b in zip(starts, [*starts[1:], len(payload)], strict=True)]
        hashed = int("".join("1" if v > mean * step else "0" for v in sums), 2)
        assert r.feature == f"{mean:.3f};{spread:.3f};{'/'.join(map(str, bins))};{hashed:016x}"

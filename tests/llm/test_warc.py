import base64
import gzip
import hashlib
import struct
import zipfile

import pytest
from foliospark.llm import warc as W
from foliospark.llm.common import scratch_path
from foliospark.llm.store import Ranges


def test_members_of_plain_and_zip64_files(tmp_path, monkeypatch):
    plain, wide = tmp_path / "a.zip", tmp_path / "b.zip"
    for path in (plain, wide):
        with zipfile.ZipFile(path, "w") as z:
            with z.open("archive/x.warc.gz", "w", force_zip64=path is wide) as f:
                f.write(b"12345" * 100)
            z.writestr("indexes/ü.cdxj", "line\n" * 50, zipfile.ZIP_DEFLATED)
            z.comment = b"a note"
    for path in (plain, wide):
        ranges, uri = Ranges(), f"file://{path}"
        found = W.members(uri, ranges)
        assert list(found) == ["archive/x.warc.gz", "indexes/ü.cdxj"]
        with zipfile.ZipFile(path) as z:
            for name, m in found.items():
                assert W.read_member(uri, m, ranges) == z.read(name)
        ranges.close()


def test_zip64_end_record(tmp_path):
    """More than 65,535 entries have a ZIP64 end record and locator."""
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as z:
        for k in range(65_600):
            z.writestr(f"m{k}", b"")
    ranges = Ranges()
    assert len(W.members(f"file://{path}", ranges)) == 65_600
    ranges.close()
    data = path.read_bytes()
    assert struct.unpack("<H", data[-12:-10])[0] == 0xFFFF


def test_no_zip(tmp_path):
    (tmp_path / "x").write_bytes(b"hello" * 10)
    with pytest.raises(ValueError):
        W.members(f"file://{tmp_path / 'x'}", Ranges())


def brute(rows):
    out = []
    for k, _, html, *_ in rows:
        same = [i for i, _, h, *_ in rows if (h or "") == (html or "") and i is not None]
        top = max(same, default=None)
        data = (html or "").encode()
        revisit = top is not None and k != top
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [W.BROADCAST_ROWS, 0])
def test_round_trip_of_every_kind(spark, monkeypatch, bound):
    monkeypatch.setattr(W, "BROADCAST_ROWS", bound)
    rows = [(k, f"http://h.example/{k}?é\n", f"<p>{k % 5}</p>", "x") for k in range(40)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (None, "u", "<p>1</p>", "x"), (102, "u", "ä" * 400_000, None), (39, "again", "<p>4</p>", "x"), (None, "u", "alone", "x"), (2**60 + 1, "u", "big", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    archives = W.write_archives(pages, scratch_path(spark, "warc"))
    got = sorted(map(tuple, W.read_archives(archives).collect()), key=str)
    assert got == brute(rows)
    for r in archives.collect():
        with zipfile.ZipFile(r.archive.removeprefix("file://")) as z:
            assert z.testzip() is None
            assert gzip.decompress(z.read(W.DATA)).startswith(b"WARC/1.1")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(W.write_archives(pages, scratch_path(spark, "warc"))).count() == 0

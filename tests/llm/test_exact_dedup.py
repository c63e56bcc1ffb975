import hashlib
import re
import zlib

import pytest
from foliospark.llm import common as C
from foliospark.llm import exact_dedup as E
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, __sha string, kept string"


def normal(text):
    return re.sub(r"[ \t\n\x0b\x0c\r]", "", text or "")


def brute(rows):
    groups = {}
    for k, t, *_ in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), k is None, k or 0))
    out = []
    for k, t, *_ in rows:
        own = groups[normal(t)]
        best = min(own)
        out.append((k, None if best[1] else best[2], len(own), hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [
    (1, "a b", "x", None), (2, "ab", "x", "y"), (3, "a  b", None, None), (4, None, "x", "x"), (5, "", "x", "x"), (6, " \n\t\x0b\x0c\r", "x", "x"), (7, "a b", "x", "x"), (8, "ä" * 300_000, "x", "x"),
    (9, "ä" * 300_000 + " ", "x", "x"), (10, "alone", "x", "x"), (None, "nobody", "x", "x"), (None, "no body", "x", "x"), (11, "twin", "x", "x"), (11, "twin", "x", "x"), (2**60 + 1, "big id", "x", "x"), (2**60, "big id", "x", "x"), (None, "ab", "x", "x"),
]


@pytest.mark.parametrize("max_bits", [C.FILTER_BITS, 1])
def test_rows_of_every_kind(spark, monkeypatch, max_bits):
    if max_bits == 1:  # several segments for a few rows
        monkeypatch.setattr(C, "CHUNK", 8)
        max_bits = 32
    docs = spark.createDataFrame(ODD, SCHEMA)
    got = E.exact_duplicates(docs, max_bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ODD)
    assert sum(r.kept for r in got) == len({normal(t) for _, t, *_ in ODD})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = E.drop_exact_duplicates(docs, max_bits)
    assert kept.columns == docs.columns
    texts = {}
    for r in kept.collect():
        assert normal(r.text) not in texts
        texts[normal(r.text)] = r.doc_id
    assert texts == {normal(t): next(g.keep_id for g in got if g.text_sha256 == hashlib.sha256(normal(t).encode()).hexdigest()) for _, t, *_ in ODD}


@pytest.mark.parametrize("max_bits", [C.FILTER_BITS, C.CHUNK])
def test_only_candidates_pass_the_filter_at_any_size(spark, max_bits):
    """With a filter far smaller than the rows need, the segments still let only a few other rows through."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 19_000).cast("string")).alias("text"))
    prints = E.fingerprints(docs)
    assert C.segment_count(20_000, max_bits) == (1 if max_bits > 200_000 else 5)
    flagged = E.flag_repeats(prints, 20_000, max_bits, "t").groupBy("__maybe").count().collect()
    passed = {r["__maybe"]: r["count"] for r in flagged}
    assert 2000 <= passed[True] <= 3000 and sum(passed.values()) == 20_000
    got = E.exact_duplicates(docs, max_bits)
    assert got.filter("kept").count() == 19_000
    assert got.filter("group_size = 2 AND keep_id = doc_id % 19000").count() == 2000


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert E.exact_duplicates(docs).count() == 0
    assert E.drop_exact_duplicates(docs).count() == 0


@pytest.mark.parametrize("max_bits", [C.FILTER_BITS, C.CHUNK])
def test_members_are_never_missed(spark, max_bits):
    keys = spark.range(0, 30_000, 3).select(F.col("id").alias("k"))
    rows = spark.range(60_000).select("id", F.struct("id").alias("__row"))
    got = C.flag_members(rows, F.col("id"), keys, "hit", max_bits)
    assert got.columns == ["id", "__row", "hit"] and got.count() == 60_000
    assert got.filter("id < 30000 AND id % 3 = 0 AND NOT hit").count() == 0
    assert got.filter("hit").count() < 10_000 + 3_000


def test_ids_travel_whole_through_pandas(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a"), (None, "b")], "doc_id long, text string")
    got = C.with_ids(docs, "text", lambda frames: frames, "text string")
    assert {tuple(r) for r in got.collect()} == {(2**60 + 1, "a"), (None, "b")}


def test_shares_by_hash(spark):
    got = spark.range(2000).select(C.crc_mod("id", 5).alias("m"), "id", C.hash_share("id", "x").alias("h")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in got)
    assert abs(sum(r.h < 0.3 for r in got) / 2000 - 0.3) < 0.05


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://x:7077"}.get(key, default)

    with pytest.raises(ValueError):
        C.scratch_root(type("S", (), {"conf": Conf()})())

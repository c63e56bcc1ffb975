"""The stages of the pipeline against their brute-force versions, on a small table."""

import hashlib

import pytest
import tiktoken

pipeline = pytest.importorskip("corpus_pipeline")

import public_tokenizers  # noqa: E402
from foliospark.llm import byte_bpe  # noqa: E402

EN = "the quick brown fox jumps over the lazy dog while the cat sat on the mat and that was all there is to say about it"
DE = "der schnelle braune fuchs springt nicht über den faulen hund und die katze schläft auf dem sofa und das ist alles"


def documents(spark):
    rows = [(k, f"{EN if k % 2 else DE} {' '.join(f'{w}{k}' for w in ('uno', 'dos', 'tres', 'vier', 'five', 'six', 'acht', 'nine'))}", "en" if k % 2 else "de", f"s{k % 3}") for k in range(40)]
    base = rows[3][1]
    rows += [(100, base + " ", "en", "s0"), (101, base.replace("nine3", "last3"), "en", "s0"), (102, None, None, None), (103, "12 34 !!", "en", "s1"), (104, "", "de", "s1"), (3, base, "en", "s0")]
    return spark.createDataFrame([(*r, len(r[1] or ""), "more") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")


def test_stages(spark, tmp_path):
    docs = documents(spark)
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, "")
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
    ids = {k: sorted(r.doc_id for r in v.select("doc_id").collect()) for k, v in seen.items()}
    columns = documents(spark).columns
    assert all(v.columns == columns for k, v in seen.items() if k != "byte_bpe")
    assert ids["language_id"] == sorted([*range(40), 3, 100, 101])  # those without letters go
    # of 3, its repetition and 100, which has one blank more, the longest stays
    assert ids["exact_dedup"] == sorted([*(k for k in range(40) if k != 3), 100, 101])
    near = ids["near_dedup"]
    assert near == [k for k in ids["exact_dedup"] if k != 101]  # one shingle of 101 differs from those of 100
    assert set(ids["mixing"]) <= set(near) and ids["mixing"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    texts = {r.doc_id: r.text for r in seen["mixing"].collect()}
    for r in seen["byte_bpe"].collect():
        want = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert len(texts) == seen["byte_bpe"].count()


def test_stored_tables_leave_the_driver_no_garbage(spark, monkeypatch):
    from foliospark.llm import common

    monkeypatch.setattr(common, "DRIVER_HEAP_SHARE", 0.0, raising=False)
    jvm = spark._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    used = lambda: runtime.totalMemory() - runtime.freeMemory()
    common.materialize(spark.range(3), "driver-first")  # what a first table leaves is there for the next ones
    jvm.java.lang.System.gc()
    floor = used()
    box = jvm.java.util.ArrayList()
    box.ensureCapacity(25_000_000)
    assert used() > floor + 90_000_000
    box.trimToSize()  # the large array is garbage now
    common.materialize(spark.range(3), "driver-garbage")
    assert used() < floor + 60_000_000

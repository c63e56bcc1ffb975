"""Steps that were mended for larger tables, held against plain walks."""

import io
import math
import random
import zipfile

import duckdb
import pandas as pd
import pytest
from foliospark.functions import classify as C
from foliospark.functions import predicates as P
from foliospark.operators import chunking as X
from foliospark.operators import dedup as D
from foliospark.operators import micro as M
from foliospark.operators import retrieval as V
from foliospark.plans import catalog
from foliospark.sources import archives as Z
from pyspark.sql import functions as F
from test_catalog import rows


def _hash_walk(hashes, most):
    kept = []
    for k, h in hashes:
        if all(((h ^ x) & (1 << 64) - 1).bit_count() > most for _, x in kept):
            kept.append((k, h))
    return {k for k, _ in kept}


@pytest.mark.parametrize("spread", [14, 40, 64])
def test_hashes_by_a_walk(spark, monkeypatch, spread):
    """Blocks of hashes and rounds over pairs give what a walk over all hashes gives, and each pair comes once."""
    dice = random.Random(spread)
    monkeypatch.setattr(D, "HASH_BLOCK", 7)
    monkeypatch.setattr(D, "FIRST_BLOCK", 16)
    values = [sum(dice.getrandbits(1) << (i * 64 // spread) for i in range(spread)) for _ in range(120)]
    hashes = [(k, v - (1 << 64) if v >> 63 else v) for k, v in enumerate(values + values[:5])]
    images = spark.createDataFrame(hashes, "image_id long, phash long")
    got = [(r.hash_a, r.hash_b, r.distance) for r in D.similar_hashes(images).collect()]
    unique = sorted({h for _, h in hashes})
    bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert sorted(got) == [(a, b, bits(a, b)) for a in unique for b in unique if a < b and bits(a, b) <= 10]
    assert {r.image_id for r in D.first_of_similar(images).collect()} == _hash_walk(hashes, 10)


def test_blank_chunks_divide_by_nothing(spark):
    df = spark.createDataFrame([(0, ""), (1, "   "), (2, "a"), (3, None)], "k int, t string")
    x = F.col("t")
    got = df.select("k", P.is_corrupt(x).alias("a"), P.drop_corrupt_chunk(x, F.lit("hybrid")).alias("b"), P.is_contents_page(x).alias("c"), P.looks_like_code(x).alias("d")).orderBy("k").collect()
    assert [(r.a, r.b) for r in got[:3]] == [(False, False)] * 3
    assert [(r.c, r.d) for r in got[:3]] == [(False, False)] * 3


def test_long_lines_take_no_square_of_their_length(spark):
    """A contents page, an index and an edit of blanks with lines of 50,000 characters."""
    words = "word and text " * 4000
    pages = ["\n".join([words + f" {k}" for k in range(9)]), "\n".join([words + "." * 5000 + " 7"] * 6), "\n".join(["1, 2, 3, " * 6000 + "4"] * 6), "\n".join([words] * 6)]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, t string")
    assert [r.c for r in df.select("k", P.is_contents_page(F.col("t")).alias("c")).orderBy("k").collect()] == [True, True, True, False]
    edits = spark.createDataFrame([("a  b , c" * 9000, "a b, c" * 9000), ("ab" * 20000, "ab" * 10000), ("a , b", "a, b"), ("ab c", "a bc"), ("a\t\tb c d", "a b c d")], "t string, u string")
    assert [r.e for r in edits.select(C.edit_allowed(F.col("t"), F.col("u")).alias("e")).collect()] == [True, False, True, False, True]


#: Texts on which rules and their SQL came apart: runs of one character, letters beyond ASCII at a word's end, list numbers within
#: sentences, a first sentence over the limit whose last part begins with a blank, blank lines.
ODD = [
    "aaaaaaaaaaaaaaaaaa and a long enough line of words to count here\nwords ======= and words that go on for quite a while",
    "first man\nagerè goes on\nthird wo\nrdé next\nplain wo\nods on",
    "take this set from 2. brownells now and go on with it\nand use the tool from 3. parts of it here",
    " ".join("aner," for _ in range(900)) + " thor. " + " ".join("thor." for _ in range(900)),
    "one\n\n  \ntwo\n" + "réquea ab " * 4000,
    "Zoo - a b, c d , e\n" + "x y z , q w  e . " * 300 + "\nlast",
]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    texts = [t for t in ODD for _ in range(43)]
    pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": "web", "n_chars": [len(t) for t in texts]}).to_parquet(folder / "documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["a22_manual_gate", "c10_text_confidence", "f02_f10_corruption", "f14_f19_code_contents", "m06_hyphenated", "q10_audit", "x11_token_chunks"])
def test_odd_rows_equal_those_of_the_sql(spark, odd, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet'")
    assert rows(catalog.queries()[name](spark, odd).toPandas()) == rows(con.sql(catalog.oracles()[name]).df())


def test_pages_share_calls_of_python(spark):
    """Tiny chunks are settled page by page, but not with a call for each page."""
    df = spark.createDataFrame([(d, p, 0, "paragraph", "words of a page that are long enough to stay") for d in range(20) for p in (1, 2)], "doc_id long, page_number int, pos long, kind string, content string")
    merged = M.merge_tiny(df)
    assert "FlatMapGroupsInPandas" not in merged._jdf.queryExecution().toString() and "MapInPandas" in merged._jdf.queryExecution().toString()
    assert merged.count() == 40


def test_word_chunks_fold_once(spark):
    """The fold over the words stands once in the plan, so it is not run twice for each text."""
    plan = X.word_chunks(spark.createDataFrame([("a b c " * 500,)], "text string"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(__pieces") == 1


def test_blocks_of_files_come_together(spark):
    """Blocks of several files are handed on as one table, and a broken file among them gives its error alone."""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="urn:w"><w:body><w:p><w:r><w:t>text</w:t></w:r></w:p></w:body></w:document>')
    files = spark.createDataFrame([("a", data.getvalue()), ("b", b"broken"), ("c", data.getvalue())], "path string, content binary").coalesce(1)
    batches = Z.archive_blocks(files, "docx").mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n int")
    assert [r.n for r in batches.collect()] == [3]
    assert [(r.path, r.kind) for r in Z.archive_blocks(files, "docx").collect()] == [("a", "paragraph"), ("b", "error"), ("c", "paragraph")]


def test_searches_in_tiles_by_a_walk(spark, monkeypatch):
    """Tiles smaller than the table, ties and keywords give what a walk over all vectors gives."""
    monkeypatch.setattr(V, "TILE", 3)
    vectors = [(k, [float(k % 4), 1.0, float(k % 3)], ("Alpha x", "beta", "none")[k % 3]) for k in range(40)]
    asked = [(k, vectors[k][1], ("alpha", "BETA", None, "gamma")[k % 4]) for k in range(12)]
    have = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, content string").repartition(2)
    want = spark.createDataFrame(asked, "query_id long, embedding array<float>, keyword string")
    cosine = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)), 6)
    near = lambda e, among: [v for _, v in sorted((-cosine(e, x), v) for v, x, _ in among)[:4]]
    plain = V.dense_search(have, want.drop("keyword"), 4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in plain] == [(q, v) for q, e, _ in asked for v in near(e, vectors)]
    got = V.search_points(have.drop("content"), have.select("vec_id", "content"), want, 4, at_least=-1.0).orderBy("query_id", "rank").collect()
    hits = lambda w: [v for v in vectors if w and w.lower() in v[2].lower()] or vectors
    assert [(r.query_id, r.vec_id) for r in got] == [(q, v) for q, e, w in asked for v in near(e, hits(w))]


def test_corruption_weights(spark):
    """Each sign counts with its own weight, twice or at most three times."""
    df = spark.createDataFrame([("word /C21 and more /C22 words",), ("word /C21 and /C22 and /C23 and /C24",), ("plain words only",)], "t string")
    assert [round(r.s, 6) for r in df.select(C.corruption_score(F.col("t")).alias("s")).collect()] == [0.8, 1.0, 0.0]

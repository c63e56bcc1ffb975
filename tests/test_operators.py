"""Folds and windows against plain loops."""

import random
import re

from foliospark.operators import chunking as X
from foliospark.operators import dedup as D
from foliospark.operators import retrieval as V
from foliospark.operators import windows as W
from pyspark.sql import functions as F


def texts():
    rng = random.Random(3)
    out = ["", "short", "no marks " * 80, "x" * 1000]
    for _ in range(20):
        out.append(" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) + rng.choice(["", "", ".", "!", ",", "?\n"]) for _ in range(rng.randint(5, 300))))
    return out


def packed(text, pieces, most, tail):
    if len(text) <= most:
        return [text]
    out, cur = [], ""
    for s in pieces:
        if len(cur) + len(s) + 1 > most and cur:
            out.append(cur.strip(" "))
            cur = tail(cur) + " " + s
        else:
            cur = cur + " " + s if cur else s
    return (out + [cur.strip(" ")] if cur.strip(" ") else out) or [text]


def word_tail(cur, n=60):
    if len(cur) <= n:
        return cur
    end = cur[-n:]
    m = re.search("[ \n\t]", end)
    return (end[m.start() :] if m else end).strip(" \n\t")


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def arrays(df):
    return [r.chunks for r in df.orderBy("doc_id").collect()]


def test_packers(spark):
    values = texts()
    df = frame(spark, values)
    split = [re.split(r"(?<=[.!?])[ \t\n\r\f\v]+", t) for t in values]
    assert arrays(X.mapper_chunks(df)) == [packed(t, s, 400, lambda c: c[-60:]) for t, s in zip(values, split, strict=True)]
    plain = [[x.strip(" ") for x in s if x.strip(" ")] for s in split]
    assert arrays(X.sentence_chunks(df)) == [packed(t, s, 400, word_tail) for t, s in zip(values, plain, strict=True)]
    assert arrays(X.word_chunks(df)) == [packed(t, t.split(), 400, word_tail) for t in values]


def test_code_keeps_lines_and_repeats_the_last(spark):
    rng = random.Random(9)
    for _ in range(3):
        lines = ["x" * rng.randint(0, 40) for _ in range(60)]
        got = X.code_chunks(frame(spark, ["\n".join(lines)]), most=120, overlap=4).first().chunks
        at, want = 0, []
        while at < len(lines):
            end, size = at, 0
            while end < len(lines) and (end == at or size + 1 + len(lines[end]) <= 120):
                size += len(lines[end]) + (end > at)
                end += 1
            want.append("\n".join(lines[at:end]).strip("\n"))
            if end == len(lines):
                break
            at = end if end - at <= 4 else end - 4
        assert got == [w for w in want if w.strip()]


def test_repeats_are_cut_to_one(spark):
    from foliospark.operators import layout as O

    title = "A Long Title of a Book about Birds and their Nests\nby Someone Else\n"
    cases = {title * 2: title.strip(), title * 4: title.strip(), "a\nb\nc": "a\nb\nc", "first line\nsecond line\nFIRST LINE\nend here": "first line\nsecond line\nend here", "": "", "x\nx\nx\nx": "x\nx\nx\nx"}
    got = frame(spark, list(cases)).select("doc_id", O.drop_repeats(F.col("text")).alias("x")).orderBy("doc_id").collect()
    assert [r.x for r in got] == list(cases.values())


def test_recovered_texts_by_box_and_by_words(spark):
    recovered = spark.createDataFrame([(1, 1, 0, "a b", [0, 0, 10, 10]), (1, 1, 1, "a b", [0, 0, 10, 100]), (1, 1, 2, "alpha beta gamma", None), (1, 1, 3, "alpha other words more", None), (1, 2, 4, "alpha", None)], "doc_id long, page_number int, pos long, content string, bbox array<int>")
    tables = spark.createDataFrame([(1, 1, "| alpha | beta |", [0, 0, 10, 20])], "doc_id long, page_number int, content string, bbox array<int>")
    assert {r.pos for r in D.drop_recovered(recovered, tables).collect()} == {1, 3, 4}


def test_lines_lose_nothing(spark):
    values = texts()
    for t, parts in zip(values, arrays(X.line_chunks(frame(spark, values), most=50)), strict=True):
        assert all(len(p) <= 50 for p in parts)
        assert "".join("".join(parts).split()) == "".join(t.split())  # white space at a cut goes


def chunk_rows(spark, contents, pages=None):
    rows = [(1, k, (pages or [1] * len(contents))[k], t) for k, t in enumerate(contents)]
    return spark.createDataFrame(rows, "doc_id long, pos long, page_number int, content string")


def test_sentence_merge_does_not_chain(spark):
    got = W.merge_sentences(chunk_rows(spark, ["foo bar", "baz qux", "end"])).orderBy("pos").collect()
    assert [r.content for r in got] == ["foo bar baz qux", "end"]


def test_overlap_trim_uses_trimmed_text(spark):
    rng = random.Random(1)
    parts = ["abcdefghijkl mnop"]
    for _ in range(12):
        parts.append(parts[-1][-rng.randint(0, 14) :] + "".join(rng.choices("xyz ", k=20)))
    want, before = [], ""
    for t in parts:
        k = next((k for k in range(min(300, len(t), len(before)), 9, -1) if before.endswith(t[:k])), 0)
        before = t[k:].lstrip() if k else t
        want.append(before)
    assert [r.content for r in W.trim_overlap(chunk_rows(spark, parts)).orderBy("pos").collect()] == want


def test_breadcrumbs_by_stack(spark):
    rng = random.Random(2)
    levels = [rng.choice([None, 1, 2, 3, 4, 5, 7]) for _ in range(200)]
    df = spark.createDataFrame([(1, k, v, f"h{k}") for k, v in enumerate(levels)], "doc_id long, pos long, lv int, h string")
    got = [r.breadcrumb for r in W.breadcrumbs(df, F.col("lv"), F.when(F.col("lv").isNotNull(), F.col("h"))).orderBy("pos").collect()]
    stack, want = [], []
    for k, v in enumerate(levels):
        if v is not None:
            v = min(v, 5)
            stack = [x for x in stack if x[0] < v] + [(v, f"h{k}")]
        want.append([h for _, h in stack])
    assert got == want


def test_greedy_subsets(spark):
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    contents = [" ".join(rng.sample(vocabulary, rng.randint(1, 6))) for _ in range(25)]
    sets = [set(t.split()) for t in contents]
    gone = set()
    for i in range(25):
        for j in range(i + 1, 25):
            if i not in gone and j not in gone and len(sets[i] & sets[j]) / min(len(sets[i]), len(sets[j])) > 0.8:
                gone.add(i if len(sets[i]) < len(sets[j]) else j)
    assert {r.pos for r in D.drop_subsets(chunk_rows(spark, contents)).collect()} == set(range(25)) - gone


def test_prepositions_move(spark):
    cases = {
        ("the history of", "Rome is long", "end"): ["the history of", "Rome is long", "end"],
        ("the history\nof.", "Rome is long", "end"): ["the history", "of Rome is long", "end"],
        ("of", "Rome"): ["of Rome"], ("x\nfor", "Von", "Ende"): ["x", "for Von", "Ende"], ("By", "Of", "In", "Rome"): ["By Of", "In Rome"], ("x\nmit", "klein"): ["x\nmit", "klein"],
    }
    for given, want in cases.items():
        got = W.move_prepositions(chunk_rows(spark, list(given))).orderBy("pos").collect()
        assert [r.content for r in got] == want
    assert W.move_prepositions(chunk_rows(spark, ["x\nof", "Rome"], [1, 3])).count() == 2


def test_trimming_stops_where_a_chunk_is_emptied(spark):
    parts = ["one two three four five", "three four five", "three four five six", "four five six seven"]
    assert [r.content for r in W.trim_overlap(chunk_rows(spark, parts)).orderBy("pos").collect()] == ["one two three four five", "", "three four five six", "four five six seven"]


def test_rank_fusion_and_vectors(spark):
    one = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, doc_id long, rank int")
    two = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id long, doc_id long, rank int")
    got = V.fuse_ranks(one, two, "doc_id", 3).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [11, 10, 12]
    score = spark.range(1).select(V.boosted(F.lit(0.5), F.array(*map(F.lit, "abcdefg")), F.lit("image"), F.lit("d")).alias("s")).first().s
    assert abs(score - 0.65) < 1e-9


def test_fragments_and_hyphens(spark):
    from foliospark.operators import layout as O

    got = W.rejoin_fragments(chunk_rows(spark, ["we introd", "uce to all", "ment alone", "ment"])).orderBy("pos").collect()
    assert [r.content for r in got] == ["we introduce to all", "ment alone", "ment"]
    got = O.rejoin_hyphenated(chunk_rows(spark, ["they man-", "age it", "end"])).orderBy("pos").collect()
    assert [r.content for r in got] == ["they manage", "it", "end"]


def test_reading_order_of_columns(spark):
    from foliospark.operators import layout as O

    rows = [(1, 1, 0, 600, 10, 900), (1, 1, 1, 0, 50, 400), (1, 1, 2, 0, 10, 400), (1, 1, 3, 600, 5, 900), (1, 1, 4, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, page_number int, item int, x0 int, y0 int, x1 int").withColumn("page_width", F.lit(1000))
    assert [r.item for r in O.order_in_page(df).orderBy("position").collect()] == [2, 1, 3, 0, 4]


def test_models_are_asked_once(spark):
    from foliospark.operators import external as E

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id long, text string")
    known = spark.range(1).select(E.input_key("echo", F.lit("b")).alias("key"), F.lit("kept").alias("answer"))
    got = {r.id: r.x for r in E.apply_model(df, "text", "x", E.EchoBackend(), known).collect()}
    assert got == {1: "a", 2: "a", 3: None, 4: "kept"}


def test_stream_writes_each_batch_once(spark, tmp_path):
    from foliospark.streaming import ingest

    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    docs = spark.createDataFrame([(1, "en", "s", "a\nb"), (2, "de", "s", "c")], "doc_id long, lang string, source string, text string")
    docs.write.parquet(src)
    for _ in range(2):
        ingest.write_chunks(ingest.arriving_documents(spark, src, docs.schema), out, f"{tmp_path}/cp").awaitTermination(120)
    assert sorted(r.content for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_json_lines_round_trip(spark, tmp_path):
    from foliospark.sources import readers, sinks

    rows = chunk_rows(spark, ["x", "y"]).withColumns({"chunk_id": F.concat(F.lit("c"), "pos"), "modality": F.lit("text")})
    sinks.write_jsonl(rows.withColumn("doc_id", F.col("doc_id").cast("string")), f"{tmp_path}/out")
    chunks, headers, bad = readers.read_jsonl(spark, f"{tmp_path}/out")
    assert sorted(r.content for r in chunks.collect()) == ["x", "y"]
    assert headers.first().chunk_count == 2 and bad.count() == 0


def test_layout_repairs_take_the_whole_text(spark, tmp_path):
    from foliospark.plans import catalog

    text = "x" * 60 + " C H A P T E R  O N E <think>" + "y" * 600 + "</think> tail"
    frame(spark, [text]).write.parquet(f"{tmp_path}/documents.parquet")
    row = catalog.queries()["p05_p20_layout_repairs"](spark, str(tmp_path)).first()
    assert " CHAPTER ONE <think>" in row.p05
    assert row.p21.endswith(" tail") and "yy" not in row.p21


def test_spaced_headings_and_descriptions_by_rule(spark):
    from foliospark.operators import layout as O

    headings = {"C H A P T E R O N E": "CHAPTER ONE", "See C H A P T E R  T W O, then P A R T": "See CHAPTER TWO, then PART", "T W E N T Y F I V E X": "TWENTY FIVE X", "A B C": "A B C", "A\nB C D": "A\nBCD", "": ""}
    headings |= {"Q U I E T H O U S E": "QUIETHOUSE", "O N E " * 5000: "ONE " * 5000}
    got = frame(spark, list(headings)).select("doc_id", O.collapse_spaced_heading(F.col("text")).alias("x")).orderBy("doc_id").collect()
    assert [r.x for r in got] == list(headings.values())
    words = {
        "Photo of a dog, as shown in the image.": "A dog, as shown", "Photo of a dog, as shown in the figure.": "A dog", "The image depicts a red 'car' on the page": "A red car", "An illustration of a cat appears to be from a technical manual.": "A cat appears to be",
        "a dog <think>unfinished": "A dog", "<think>a</think>Figure showing two \"men\" in the book\n": "Two men", "Here we see the visual representation of it": "The visual representation of it",
        "This is a photo of x": "A photo of x", "the page contains text" + " " * 100_000 + "end": ("Text" + " " * 400)[:400], "<think>" * 20_000: "", "": "", "a" * 500: "A" + "a" * 399,
    }
    got = frame(spark, list(words)).select("doc_id", O.clean_description(F.col("text")).alias("x")).orderBy("doc_id").collect()
    assert [r.x for r in got] == list(words.values())


def test_tiny_chunks_go_to_their_neighbours(spark):
    from foliospark.operators import micro as M

    body = "This is running text of some length."
    cases = [
        ([("x", "Reassembly Tips:"), ("code", "  x = 1")], [("code", "Reassembly Tips:\nx = 1")]),
        ([("list_item", "one"), ("list_item", "two"), ("list_item", "three"), ("x", body)], [("list_item", "one\ntwo\nthree"), ("x", body)]),
        ([("x", body), ("x", "Spare Parts")], [("x", body + "\nSpare Parts")]),
        ([("x", "Spare Parts"), ("x", "Other Parts")], []),
        ([("x", "Spare Parts"), ("x", body)], [("x", "Spare Parts"), ("x", body)]),
        ([("x", "tiny bit"), ("x", body)], [("x", "tiny bit " + body)]),
        ([("x", body), ("x", "tiny bit")], [("x", body + " tiny bit")]),
        ([("marker", "[more]"), ("x", "tiny bit")], [("marker", "[more]"), ("x", "tiny bit")]),
        ([("x", "tiny"), ("marker", "[more]"), ("code", "y")], [("x", "tiny"), ("marker", "[more]"), ("code", "y")]),
        ([("list_item", str(k) * 3 + " words") for k in range(10)], [("list_item", "\n".join(str(k) * 3 + " words" for k in range(8)) + " 888 words 999 words")]),
    ]
    rows = [(1, page, pos, k, t) for page, (given, _) in enumerate(cases) for pos, (k, t) in enumerate(given)]
    df = spark.createDataFrame(rows, "doc_id long, page_number int, pos long, kind string, content string")
    got = {}
    for r in M.merge_tiny(df).orderBy("page_number", "pos").collect():
        got.setdefault(r.page_number, []).append((r.kind, r.content))
    for page, (_, want) in enumerate(cases):
        assert got.get(page, []) == want, page


def test_archives_of_every_kind_and_broken_ones(spark):
    from foliospark.plans import lanes
    from foliospark.sources import archives as Z

    lines = [f"line {k} <&> é" for k in range(12)]
    made = {"epub": lanes._book(lines), "docx": lanes._letters(lines), "pptx": lanes._slides(lines), "xlsx": lanes._sheets(lines)}
    for kind, data in made.items():
        files = spark.createDataFrame([("good", data), ("bad", b"PK no zip"), ("empty", b"")], "path string, content binary")
        rows = Z.archive_blocks(files, kind).collect()
        assert all(x in "\n".join(r.text for r in rows if r.path == "good") for x in lines)
        assert {r.path for r in rows if r.kind == "error"} == {"bad", "empty"}
    assert [r.kind for r in Z.archive_blocks(spark.createDataFrame([("b", lanes._book([]))], "path string, content binary"), "epub").collect()] == ["blank"]
    assert Z.html_blocks("<p>a<br>b</p><script>x</script><h3>T</h3>tail") == [("paragraph", None, "a"), ("paragraph", None, "b"), ("heading", 3, "T"), ("paragraph", None, "tail")]


def test_mixed_texts_keep_code_apart(spark):
    code, prose = "def f(x):\n    return x", "Some words here. More words there."
    cases = {
        f"{prose}\n\n{code}\n \n{code}\n\n\n{prose}": [("paragraph", prose), ("code", f"{code}\n\n{code}"), ("paragraph", prose)],
        prose: [("paragraph", prose)], code: [("code", code)], " \n ": [("paragraph", " \n ")],
        "\n\n".join([prose] * 3): [("paragraph", "\n\n".join([prose] * 3))],
    }
    df = frame(spark, list(cases))
    got = {}
    for r in X.mixed_chunks(df).orderBy("doc_id", "part").collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.chunk))
    ids = {r.text: r.doc_id for r in df.collect()}
    for text, want in cases.items():
        assert got[ids[text]] == want
    long = "\n".join(f"    x{k} = {k}" for k in range(100))
    parts = [r.chunk for r in X.mixed_chunks(frame(spark, [long]), most=200).orderBy("part").collect()]
    assert all(len(p) <= 200 for p in parts) and parts[1].split("\n")[:4] == parts[0].split("\n")[-4:]


def test_vector_search_by_brute_force(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    table = np.vstack([rng.normal(size=(300, 8)), np.zeros((2, 8)), rng.normal(size=(1, 8)).repeat(5, axis=0)])
    vectors = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(table)], "vec_id long, embedding array<double>").repartition(7)
    asked = vectors.filter("vec_id % 30 = 0").withColumnRenamed("vec_id", "query_id")
    unit = table / np.where(np.linalg.norm(table, axis=1, keepdims=True) > 0, np.linalg.norm(table, axis=1, keepdims=True), 1)
    for block in (V.QUERY_BLOCK, 4):
        monkeypatch.setattr(V, "QUERY_BLOCK", block)
        got = {}
        for r in V.dense_search(vectors, asked, 6).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        for q in range(0, len(table), 30):
            scores = np.round(unit[q] @ unit.T, 6)
            assert got[q] == sorted(range(len(table)), key=lambda v: (-scores[v], v))[:6]
    assert V.dense_search(vectors, asked.limit(0), 3).count() == 0
    assert V.dense_search(vectors.limit(0), asked, 3).count() == 0


def test_final_repairs_in_order(spark):
    rows = chunk_rows(spark, ["turn it 7. open the lid\nof", "Rome is", "long ago"]).withColumn("parent_heading", F.lit(None).cast("string"))
    assert [r.content for r in W.final_repairs(rows).orderBy("pos").collect()] == ["turn it\n7. open the lid of Rome is", "long ago"]

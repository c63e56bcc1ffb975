import itertools
import math

import numpy as np
import public_tokenizers
from foliospark.llm import language_id as L

PIECES = [" a", " ", "a", "b", "ab", "ba", "aba"]


def all_cuts(word, lattice):
    """Every way to cut the word, by brute force."""
    n = len(word)
    for marks in itertools.product([0, 1], repeat=n - 1):
        cut, parts = 0, []
        for k, m in enumerate(marks, 1):
            if m:
                parts.append(word[cut:k])
                cut = k
        parts.append(word[cut:])
        ids = [lattice.ids.get(p, lattice.unknown if len(p) == 1 else None) for p in parts]
        if None not in ids:
            yield ids


def test_forward_sums_all_cuts():
    lattice = L.Lattice(PIECES)
    rng = np.random.default_rng(3)
    model = rng.random((len(PIECES) + 1, 2))
    words = [" ab", " abab", " abba", " axb", " b", "x"]
    got = lattice.log_probability(words, model)
    for k, w in enumerate(words):
        for lang in range(2):
            want = sum(math.prod(model[i, lang] for i in ids) for ids in all_cuts(w, lattice))
            assert abs(got[k, lang] - math.log(want)) < 1e-9


def test_expected_counts_by_brute_force():
    lattice = L.Lattice(PIECES)
    model = np.random.default_rng(4).random((len(PIECES) + 1, 1))
    words, counts = [" abab", " aba"], np.array([2.0, 3.0])
    want = np.zeros(len(PIECES) + 1)
    for w, c in zip(words, counts, strict=True):
        cuts = [(math.prod(model[i, 0] for i in ids), ids) for ids in all_cuts(w, lattice)]
        whole = sum(p for p, _ in cuts)
        for p, ids in cuts:
            for i in ids:
                want[i] += c * p / whole
    assert np.allclose(lattice.expected(words, counts, model), want)


def docs_of(spark):
    en = "the quick brown fox jumps over the lazy dog and the cat sat on the mat with that thing"
    de = "der schnelle braune fuchs springt nicht über den faulen hund und die katze schläft auf dem sofa"
    rows = [(k, en if k % 2 else de, "en" if k % 2 else "de", "src") for k in range(60)]
    rows += [(100, None, "en", "x"), (101, "", "de", "x"), (102, "½ ² ① Ⅷ 123 _ !!", None, "x"), (None, en, None, None), (103, "w" * 100_000, "en", "x"), (1, en, "en", "src")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_predicts_and_treats_odd_rows(spark):
    docs = docs_of(spark)
    model = L.train(docs.filter("doc_id < 60"), public_tokenizers.path(L.VOCABULARY))
    assert model.languages == ["de", "en"]
    got = L.predict_language(docs, model).collect()
    assert len(got) == docs.count()
    told = {r.doc_id: r for r in got}
    assert all(told[k].lang_pred == ("en" if k % 2 else "de") and told[k].score > 0.9 for k in range(60))
    assert all(told[k].lang_pred == "und" and told[k].score == 0 for k in (100, 101, 102))
    assert told[None].lang_pred == "en"
    assert 0 <= told[103].score <= 1
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id in (100, 101, 102)").count() == 0
    assert kept.filter("doc_id = 1").count() == 2


def test_empty_tables_and_no_labels(spark):
    docs = docs_of(spark)
    path = public_tokenizers.path(L.VOCABULARY)
    none = L.train(docs.limit(0), path)
    assert none.languages == []
    assert {r.lang_pred for r in L.predict_language(docs, none).collect()} == {"und"}
    assert L.predict_language(docs.limit(0), none).count() == 0


def test_words_that_languages_share_are_kept(spark):
    rows = [(k, "a hotel in the centre with radio and taxi", lang) for k, lang in enumerate(["de", "en", "fr"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs, public_tokenizers.path(L.VOCABULARY))
    asked = spark.createDataFrame([(1, "hotel taxi", "x"), (2, "123", "x")], "doc_id long, text string, lang string")
    assert L.predict_language(asked, model).filter("doc_id = 1").first().score < 0.5
    assert [r.doc_id for r in L.keep_identified(asked, model).collect()] == [1]

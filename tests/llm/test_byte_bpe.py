import hashlib

import public_tokenizers
import pytest
import tiktoken
from foliospark.llm import byte_bpe as B
from hypothesis import given, settings
from hypothesis import strategies as st

PATH = public_tokenizers.path(B.RANKS)
ENCODER = B.Encoder(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})


TEXTS = ["", " ", "Hello world, it's 2024!", "aaaaaaaaaaaaaaaa", "ababababab " * 5, "größe Übermaß žluťoučký 日本語テキスト", "<|endoftext|>", "\n\n \t x", "é" * 300, "🙂👨‍👩‍👧", "x" * 9000]


def test_same_ids_as_the_library(library):
    got = ENCODER.encode_block(TEXTS)
    assert got == [library.encode_ordinary(t) for t in TEXTS]
    replay = B.replay_of(PATH)
    assert [replay.decode(i).decode() for i in got] == TEXTS


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abes 'tlrn\n.0"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8))
def test_any_text(texts):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.replay.ranks, special_tokens={})
    assert ENCODER.encode_block(texts) == [own.encode_ordinary(t) for t in texts]


def test_pairs_of_lower_rank_that_arise_late():
    """Merging "ab" first makes "aba", which ranks lower than the second "ab"."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ba": 400, b"aba": 256, b"ab": 300, b"abab": 500}
    own = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    words = ["abab", "ababab", "aabab", "babab", "abaab"]
    assert B.MergeReplay(ranks).encode_pieces([w.encode() for w in words]) == [own.encode_ordinary(w) for w in words]


@pytest.mark.parametrize("block", [B.BLOCK_CHARS, 50])
def test_rows_of_every_kind(spark, library, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK_CHARS", block)
    rows = [(1, "one two", "x"), (2, None, "x"), (None, "", "y"), (2, None, "x"), (2**60 + 1, "long " * 20000, "y"), (7, "x" * 9000, "z")]
    rows += [(10 + k, f"text number {k % 7} of one two three", "n") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, B.encode_digests(docs, PATH).collect()), key=str)
    want = []
    for k, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert B.encode_digests(docs.limit(0), PATH).count() == 0
    coded = B.encode_texts(docs, PATH)
    assert {(r.doc_id, bytes(r.decoded)) for r in B.decode_ids(coded, PATH).collect()} == {(k, (t or "").encode()) for k, t, _ in rows}

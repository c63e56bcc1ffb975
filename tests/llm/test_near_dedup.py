import random

import numpy as np
import pytest
from foliospark.llm import near_dedup as N
from hypothesis import given, settings
from hypothesis import strategies as st


def sets_of(text):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return sorted(((k, len(sets[i]), least.get(root(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 400), st.integers(0, 10**6))
def test_linked_sets_share_a_key(n, seed):
    """Pigeonhole: sets at the largest difference that still links share a key."""
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(1, 2**63, size=3 * n + 10).astype(np.uint64))
    rng.shuffle(pool)
    drop, gain = int(rng.integers(0, n)), int(rng.integers(0, n))
    a, b = np.sort(pool[:n]), np.sort(np.concatenate((pool[drop:n], pool[n : n + gain])))
    if len(b) and N.linked(a, b) and not np.array_equal(a, b):
        keys = [set(N.block_keys(x, N.mix(x + np.uint64(11))).tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_most_differing_is_exact():
    for n in range(1, 60):
        for m in range(n, 80):
            most = max((n + m - 2 * c for c in range(n + 1) if c and 100 * c >= 80 * (n + m - c)), default=0)
            assert most <= N.most_differing(n + m)


def test_short_texts():
    a, b, c, d = N.shingles(["One two", "one TWO ", "", "one two three four five six"])
    assert np.array_equal(a, b) and len(c) == 0 and len(d) == 2
    assert len(N.shingles(["É é"])[0]) == 1


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows, base = [], []
    for k in range(60):
        base.append(rng.choices(vocabulary, k=rng.choice([3, 6, 12, 40, 90, 200])))
        rows.append((1000 + k, " ".join(base[-1]) + (" " + passage if k % 3 == 0 else "")))
    for k in range(200):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1, 2]))
        rows.append((2000 + k, " ".join(words).upper() if k % 9 == 0 else "  ".join(words)))
    chain = rng.choices(vocabulary, k=100)
    for k in range(40):  # each links with the next only
        chain = chain[6:] + rng.choices(vocabulary, k=6)
        rows.append((3000 - k, " ".join(chain)))
    rows += [(1, None), (2, ""), (3, " \n\t"), (None, rows[0][1]), (None, "alone in the world of words"), (1000, rows[0][1]), (9, "x " * 50_000), (2**60 + 1, "a big number has this one")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chars", [N.BLOCK_CHARS, 1500])
def test_components_by_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(N, "BLOCK_CHARS", chars)
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, cid string").repartition(5)
    got = sorted(map(tuple, N.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, lose string")
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted({k for k, _, c in brute(rows) if k == c}, key=str)
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    assert got == sorted([k for k in want if k is not None] + [None, None], key=str)  # rows without an id stay


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(docs).count() == 0
    assert N.drop_near_duplicates(docs).count() == 0

import hashlib
import re

import numpy as np
import pytest
from foliospark.llm import mixing as M

WORDS = {"prose": "some plain words here ", "table": "a | b | c | d ", "licence": "Licensed under terms "}


def docs_of(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(400):
        topic = ["prose", "table", "licence"][int(rng.integers(3))]
        rows.append((k, WORDS[topic] * int(rng.integers(1, 9)), ["en", "de", None][int(rng.choice(3, p=[0.6, 0.3, 0.1]))], f"s{int(rng.choice(3, p=[0.7, 0.2, 0.1]))}", 0.5))
    rows += [(900, None, "en", "s0", 0.1), (901, "", "xx", None, 0.1), (None, "a word", "en", "s0", 0.1), (5, "again", "en", "s0", 0.1), (902, "long " * 100_000, "de", "s1", 0.1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, probability double")


def brute_rake(cells, goals):
    w = np.array([c["__base"] for c in cells], dtype=float)
    total = w.sum()
    for _ in range(500):
        for m in M.MARGINS:
            sums = {}
            for c, x in zip(cells, w, strict=True):
                sums[c[f"__{m}"]] = sums.get(c[f"__{m}"], 0) + x
            w = np.array([x * goals[m].get(c[f"__{m}"], 0) * total / sums[c[f"__{m}"]] if sums[c[f"__{m}"]] else 0 for c, x in zip(cells, w, strict=True)])
    return w


def test_raking_by_brute_force(spark):
    cells = M.cells_of(M.keyed(docs_of(spark).filter("doc_id <> 902")))
    goals = {m: {r[0]: r[1] for r in M.targets_of(cells, m, None).collect()} for m in M.MARGINS}
    assert all(abs(sum(g.values()) - 1) < 1e-9 for g in goals.values())
    raked, gap = M.rake(cells)
    got = sorted(raked.collect(), key=str)
    assert gap <= 1e-4
    want = brute_rake(got, goals)
    assert np.allclose([r["__weight"] for r in got], want, rtol=1e-4, atol=1e-6)


def test_given_targets_hold(spark):
    docs = docs_of(spark)
    targets = {"lang": {"en": 0.5, "de": 0.5, "zz": 3.0}}
    table, _, gap = M.probabilities(docs, targets, 0.3)
    assert gap <= M.TOLERANCE
    rows = table.collect()
    assert all(r["__p"] == 0 for r in rows if r["__lang"] not in ("en", "de"))
    by = {k: sum(r["__weight"] for r in rows if r["__lang"] == k) for k in ("en", "de")}
    assert abs(by["en"] / by["de"] - 1) < 1e-3
    assert abs(sum(r["__p"] * r["__base"] for r in rows) / (0.3 * sum(r["__base"] for r in rows)) - 1) < 1e-2


def test_targets_that_do_not_go_together_are_told(spark):
    docs = spark.createDataFrame([(1, "one two", "en", "a"), (2, "one two", "de", "b")], "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="do not go together"):
        M.mix(docs, {"source": {"a": 0.1, "b": 0.9}, "lang": {"en": 0.9, "de": 0.1}})
    assert M.mix(docs, {"source": {"a": 0.1, "b": 0.9}, "lang": {"en": 0.1, "de": 0.9}}).first().margin_gap <= M.TOLERANCE


def test_the_draw_by_brute_force(spark, monkeypatch):
    """Each document's probability and draw, from its cell's weight, in plain Python."""
    monkeypatch.setattr(M, "TOLERANCE", 1e-3)
    docs = docs_of(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    topic = lambda t: next((n for n, p in M.TOPICS if re.search(p, t)), "prose")
    cell_of = lambda r: (r[3] or "", r[2] or "", topic(r[1] or ""))
    cells = {}
    for r in rows:
        cells.setdefault(cell_of(r), [0])[0] += len((r[1] or "").split())
    keys = sorted(cells)
    given = [dict(zip(("__source", "__lang", "__topic"), k, strict=True)) | {"__base": cells[k][0]} for k in keys]
    goals = {}
    for m in M.MARGINS:
        sums = {}
        for c in given:
            sums[c[f"__{m}"]] = sums.get(c[f"__{m}"], 0) + c["__base"]
        powers = {k: v ** M.TEMPERATURE[m] for k, v in sums.items() if v}
        goals[m] = {k: v / sum(powers.values()) for k, v in powers.items()}
    weight = dict(zip(keys, brute_rake(given, goals), strict=True))
    total = sum(c["__base"] for c in given)
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(c[0], weight[k] * mid) for k, c in cells.items()) < M.BUDGET * total else (low, mid)
    got = {}
    for r in M.mix(docs).collect():
        got.setdefault(str(r.doc_id), []).append((r.probability, r.selected))
    for r in rows:
        base = cells[cell_of(r)][0]
        p = min(1.0, weight[cell_of(r)] / base * low) if (r[1] or "").split() and base else 0.0
        share = int(hashlib.md5(f"{M.SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16) / 2**32
        near = min(got[str(r[0])], key=lambda x: abs(x[0] - p))
        assert abs(near[0] - p) < 2e-3
        if abs(share - p) > 2e-3:
            assert near[1] == (share < p)


def test_rows_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(M, "TOLERANCE", 1e-2)  # few rounds
    docs = docs_of(spark)
    one = sorted(map(tuple, M.mix(docs).collect()), key=str)
    assert len(one) == docs.count()
    told = {r[0]: r for r in one}
    assert not told[900][6] and told[900][4] == 0 and told[900][5] == 0
    assert told[901][1] is None
    assert {r[3] for r in one} == {"prose", "table", "licence"}
    monkeypatch.setattr(M, "BROADCAST_CELLS", 0)
    assert sorted(map(tuple, M.mix(docs).collect()), key=str) == one
    kept = M.sample_to_mix(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in one if r[6]), key=str)
    assert M.mix(docs.limit(0)).count() == 0

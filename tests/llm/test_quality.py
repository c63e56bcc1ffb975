import numpy as np
from foliospark.llm import quality as Q
from pyspark.sql import functions as F


def test_gradient_vanishes_at_the_fit():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(80, 3))
    labels = (rows[:, 0] + 0.5 * rng.normal(size=80) > 0).astype(int)
    model = Q.fit(rows, labels)
    z = (rows - model.centre) / model.scale
    win, lose = Q.preference_pairs(int(labels.sum()), int((1 - labels).sum()))
    diff = z[labels == 1][win] - z[labels == 0][lose]
    gradient = sum(-d / (1 + np.exp(d @ model.weights)) for d in diff) / len(diff) + Q.RIDGE * model.weights
    assert np.abs(gradient).max() < 1e-6
    assert model.weights[0] > abs(model.weights[1])


def test_threshold_by_brute_force():
    strength, labels = np.array([0.1, 0.4, 0.35, 0.8, 0.9, 0.2]), np.array([0, 0, 1, 1, 1, 0])
    t = Q.quantile_threshold(strength, labels)
    worth = lambda c: (strength[labels == 1] >= c).mean() + (strength[labels == 0] < c).mean()
    assert worth(t) == max(worth(c) for c in np.linspace(0, 1, 101))


def test_pairs_cover_every_text():
    win, lose = Q.preference_pairs(5, 30, 3)
    assert set(win) == set(range(5)) and set(lose) == set(range(30))
    assert len(set(zip(win.tolist(), lose.tolist(), strict=True))) == len(win)


def test_held_out_accuracy_and_odd_rows(spark):
    good = "The valley lies between two ridges, and a river runs through it. People farm the land.\n"
    bad = "BUY!! NOW!! $$$ *** CHEAP!! CHEAP!! CHEAP!! CLICK!! "
    rows = [(k, (good if k % 3 else bad) * (1 + k % 7), k) for k in range(90)]
    rows += [(200, None, 0), (201, "", 0), (202, "x" * 200_000, 0), (None, good, 0), (5, good, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(60)] + [(1, 1, 0), (None, 1, None), (7, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels)
    got = Q.score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 90)
    assert Q.score_quality(docs.limit(0), model).count() == 0
    unlabelled = Q.train(docs, labels.limit(0))
    assert len({round(r.score, 9) for r in Q.score_quality(docs, unlabelled).collect()}) == 1


def test_table_by_brute_force(spark):
    """Fit by plain gradient descent over all preference pairs, threshold by trying every cut, scores one by one."""
    good = "The valley lies between two ridges, and a river runs through it. People farm the land {}.\n"
    bad = "BUY!! NOW!! $$$ *** CHEAP!! {} CHEAP!! CLICK!! the valley "
    texts = [(good if k % 3 else bad).format("word " * (k % 5)) * (1 + k % 4) + ("The valley. " if k % 2 else "CHEAP!! ") * (k % 3) for k in range(36)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in Q.score_quality(docs, Q.train(docs, labels)).collect()}
    rows = sorted((int(k % 3 > 0), Q.features(texts[k])) for k in range(30))
    table, told = np.array([f for _, f in rows]), np.array([y for y, _ in rows])
    centre, scale = table.mean(axis=0), np.maximum(table.std(axis=0), 1e-3)
    z = (table - centre) / scale
    win, lose = z[told == 1], z[told == 0]
    pairs = {(i, (i * Q.OPPONENTS + k) % len(lose)) for i in range(len(win)) for k in range(min(Q.OPPONENTS, len(lose)))}
    pairs |= {((j * Q.OPPONENTS + k) % len(win), j) for j in range(len(lose)) for k in range(min(Q.OPPONENTS, len(win)))}
    differences = np.array([win[i] - lose[j] for i, j in sorted(pairs)])
    w = np.zeros(z.shape[1])
    for _ in range(20_000):
        w -= 0.2 * (-(differences / (1 + np.exp(differences @ w))[:, None]).mean(axis=0) + Q.RIDGE * w)
    strength = z @ w
    cuts = sorted((a + b) / 2 for a, b in zip(sorted(strength), sorted(strength)[1:], strict=False) if b > a)
    worth = [(strength[told == 1] >= x).mean() + (strength[told == 0] < x).mean() for x in cuts]
    fair = [x for x, y in zip(cuts, worth, strict=True) if y >= max(worth) - 1e-12]
    threshold = fair[len(fair) // 2]
    for k, t in enumerate(texts):
        s = float((np.array(Q.features(t)) - centre) / scale @ w) - threshold
        assert abs(got[k] - 1 / (1 + np.exp(-s))) < 1e-3


def _noisy(k: int) -> str:
    """Texts of both labels that overlap, all different."""
    return " ".join(("CHEAP!!" if (k * 2654435761 + j * j * 40503) % 97 < (30 if k % 2 else 45) else f"valley{k % (j + 3)}") for j in range(8 + k % 13)) + f" {k}."


def test_every_labelled_text_counts(spark):
    """More labelled texts than a sample of 3000 of each label: the gradient over all pairs vanishes, no cut is better."""
    n = 7000
    docs = spark.range(n).select("id").collect()
    texts = [_noisy(r.id) for r in docs]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(n)], "doc_id long, quality int")
    assert Q.labelled_features(Q.featured(table), labels).count() == n
    model = Q.train(table, labels)
    rows, told = np.array([Q.features(t) for t in texts]), np.arange(n) % 2
    assert np.allclose(model.centre, rows.mean(axis=0), atol=1e-9)
    z = (rows - model.centre) / model.scale
    strength = z @ model.weights
    win, lose = z[told == 1], z[told == 0]
    gradient = Q.RIDGE * model.weights
    for i, s in zip(win, strength[told == 1], strict=True):
        lost = 1 / (1 + np.exp(s - strength[told == 0]))
        gradient = gradient - (lost.sum() * i - lost @ lose) / (len(win) * len(lose))
    assert np.abs(gradient).max() < 1e-5
    worth = lambda c: (strength[told == 1] >= c).mean() + (strength[told == 0] < c).mean()
    assert abs(worth(model.threshold) - max(map(worth, np.unique(strength)))) < 1e-9


def test_threshold_of_a_table_is_that_of_an_array(spark):
    rng = np.random.default_rng(3)
    for n, values in ((1, 5), (40, 6), (300, 40), (300, 10_000)):
        strength, told = rng.integers(0, values, n) / 4, rng.integers(0, 2, n)
        told[: min(2, n)] = [0, 1][: min(2, n)]
        table = spark.createDataFrame([(float(s), int(y)) for s, y in zip(strength, told, strict=True)], "s0 double, quality int")
        got = Q.table_threshold(table, F.col("s0"), int(told.sum()), int(n - told.sum()))
        assert got == (Q.quantile_threshold(strength, told) if n > 1 else strength[0])

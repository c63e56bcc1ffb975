import re

from foliospark.llm import url_filter as U

URLS = [
    None, "", "no-scheme.com/en/1", "https://WWW.Example.COM/en/77?x=1", "https://example.com/en/8", "http://a.b.example.net/de/81#t", "http://example.net/de/9",
    "ftp://x.org/es/", "http://x.org/es", "http://notexample.com/en/7", "http://org/es/1", "http://com", "http://h.com?/en/", "a://b://c.com/en/1", "http://x.example.org/fr/1#/es/",
    "https://cheap-pills.example.info/de/5", "https://library.museum.example.info/fr/5", "http://ÄX.com/EN/1", "http://x.net/" + "de/" * 5000,
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(t), t, v) for v, t in U.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else None


def test_rules_and_model(spark):
    weights = U.train(U.labelled_urls(spark))
    assert len(weights) == U.DIMENSIONS + 1
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(None, URLS[4], "x"), (4, URLS[4], "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = U.judge_urls(pages, weights).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute(URLS[4] if r.page_id is None else URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict == ("block" if r.score >= 0.5 else "allow")
    told = {r.page_id: r for r in got}
    assert told[15].verdict == "block" and told[16].verdict == "allow"
    assert U.judge_urls(pages.limit(0), weights).count() == 0
    fitted = U.judge_urls(U.labelled_urls(spark).withColumnRenamed("row", "page_id"), weights, ()).collect()
    labels = {r.row: r.label for r in U.labelled_urls(spark).collect()}
    assert sum((r.verdict == "block") == (labels[r.page_id] == 1) for r in fitted) / len(fitted) > 0.95


def test_one_step_by_brute_force(spark):
    """One epoch over two rows equals the update rule."""
    import math

    rows = spark.sql("SELECT * FROM VALUES ('http://aa.com/x', 1), ('http://bb.org/', 0) AS t(url, label)")
    host, path = U.host_and_path(U.F.col("url"))
    slots = rows.select("url", "label", U.F.xxhash64("url").alias("p"), U.hashed_grams(host, path).alias("s")).orderBy("p").collect()
    w = [0.0] * (U.DIMENSIONS + 1)
    for _ in range(U.EPOCHS):
        for r in slots:
            on = {i - 1 for i in r.s} | {U.DIMENSIONS}
            e = r.label - 1 / (1 + math.exp(-sum(w[i] for i in on)))
            w = [v * (1 - U.DECAY) + (U.RATE * e if i in on else 0) for i, v in enumerate(w)]
    assert max(abs(a - b) for a, b in zip(w, U.train(rows), strict=True)) < 1e-9


def test_words_of_the_contract(spark):
    """Each rule's own word, written out here: the longest rule that fits gives it."""
    told = {
        "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/7": ("example.com/en/7", "allow"), "http://www.example.com/en/71": ("example.com/en/7", "allow"), "http://a.net/de/8": ("net/de/", "allow"),
        "http://example.net/de/7": ("net/de/", "allow"), "http://m.example.net/de/81": ("example.net/de/8", "block"), "http://x.org/es/": ("org/es/", "block"),
    }
    pages = spark.createDataFrame(list(enumerate(told)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, [0.0] * (U.DIMENSIONS + 1)).collect()}
    assert got == dict(enumerate(told.values()))

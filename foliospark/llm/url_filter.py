"""URL filter: host and path rules, and else logistic regression on hashed character n-grams, in built-in functions only.

The model is trained by stochastic gradient descent over a small labelled table, as one fold over its rows. It has a
fixed number of weights, so it is a literal of the plan that scores the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

#: Rules as (verdict, host and path).
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: More rules than this would make too large a plan.
MOST_RULES = 2000
#: Weights of the model, without the constant.
DIMENSIONS = 2048
GRAMS = (3, 4, 5)
EPOCHS = 12
RATE = 0.15
DECAY = 0.0005
#: Words of the labelled table's hosts and paths (fixed values).
UNWANTED = "casino poker pills viagra cheap replica loan payday adult xxx porn sex escort bet jackpot spam farm warez crack keygen lottery miracle slots nude"
WANTED = (
    "news blog wiki docs library school university museum research science weather recipes garden travel history music "
    "sport health city forum books cloud code help about article story theatre market bridge river north green"
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url and label (1: unwanted): each word in a few common shapes of URL, next to neutral words."""
    unwanted, wanted = UNWANTED.split(), WANTED.split()
    rows: list[tuple[str, int]] = []
    for label, words in ((1, unwanted), (0, wanted)):
        for k, word in enumerate(words):
            other, neutral = words[(k * 7 + 3) % len(words)], wanted[(k * 5 + 1) % len(wanted)]
            top, lang, sub = ("com", "org", "net")[k % 3], ("en", "de", "fr", "es")[k % 4], ("blog", "m", "www", "shop")[k % 4]
            rows += [
                (f"https://www.{word}-{other}.example.{top}/{lang}/{k * 37 % 1000}", label),
                (f"http://{word}.example.{top}/{lang}/{k * 53 % 1000}.html", label),
                (f"https://{sub}.{neutral}.example.{top}/{word}/{other}", label),
            ]
            if not label:  # most hosts are wanted, whatever their words
                rows += [(f"http://{x}{word[::-1]}{other[:4]}.example.{y}/{lang}/{k * n % 1000}{z}", 0) for x, y, n, z in (("blog.", "com", 41, ""), ("m.", "net", 71, "/"), ("", "org", 83, ".html"), ("www.", "net", 97, ""))]
    values = ", ".join(f"({n}, '{u}', {y})" for n, (u, y) in enumerate(rows))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(row, url, label)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for a null URL and one without `://`."""
    start = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does. A rule fits its host and all subdomains."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last one set wins
        own_host, own_path = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _slot(mark: str, text: Column, n: int):
    return lambda i: (F.pmod(F.xxhash64(F.lit(mark), F.substr(text, i, F.lit(n))), F.lit(DIMENSIONS)) + 1).cast("int")


def hashed_grams(host: Column, path: Column) -> Column:
    """Distinct slots, 1 to DIMENSIONS, of the n-grams of host and path, each kind with hashes of its own."""
    parts = []
    for mark, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), F.lower(path), F.lit("$")))):
        for n in GRAMS:
            last = F.greatest(F.char_length(text) - (n - 1), F.lit(1))
            parts.append(F.transform(F.sequence(F.lit(1), last), _slot(mark, text, n)))
    return F.array_distinct(F.concat(*parts))


def train(labelled: DataFrame) -> list[float]:
    """Weights, the constant last, by EPOCHS passes of stochastic gradient descent over the rows in an order of their hash."""
    host, path = host_and_path(F.col("url"))
    slots = labelled.filter(F.col("label").isin(0, 1)).select("label", F.xxhash64("url").alias("place"), hashed_grams(host, path).alias("slots"))
    dense = slots.select(
        "place", F.col("label").cast("double").alias("y"),
        F.transform(F.sequence(F.lit(1), F.lit(DIMENSIONS + 1)), lambda i: ((i == DIMENSIONS + 1) | F.array_contains("slots", i.cast("int"))).cast("double")).alias("x"),
    )
    table = materialize(dense.agg(F.sort_array(F.collect_list(F.struct("place", "y", "x"))).alias("rows")), "url-rows")
    weights = materialize(table.select("rows", F.array_repeat(F.lit(0.0), DIMENSIONS + 1).alias("w")), "url-weights")
    epoch = f"""aggregate(rows, w, (acc, r) -> aggregate(
        array(r.y - 1D / (1D + exp(-aggregate(zip_with(acc, r.x, (a, b) -> a * b), 0D, (s, v) -> s + v)))),
        acc, (old, e) -> zip_with(old, r.x, (a, b) -> a * {1 - DECAY}D + {RATE}D * e * b)))"""
    for k in range(EPOCHS):
        weights = weights.select("rows", F.expr(epoch).alias("w"))
        if k % 4 == 3:
            weights = materialize(weights, "url-weights")
    return list(weights.first()["w"])


def probability(slots: Column, weights: list[float]) -> Column:
    """Probability that a URL with these slots is unwanted."""
    model = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(slots, F.lit(float(weights[-1])), lambda s, i: s + F.element_at(model, i))
    return 1 / (1 + F.exp(-total))


def judge_urls(pages: DataFrame, weights: list[float], rules=RULES) -> DataFrame:
    """For every row: page_id, host, path, rule, verdict and score (probability of being unwanted).

    Null and empty URLs have an empty host and path and are judged by the model like others. Repeated rows are
    judged each; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    scored = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("__rule"), probability(hashed_grams(F.col("host"), F.col("path")), weights).alias("score"))
    guess = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("__rule", guess).alias("verdict"), "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), train(labelled_urls(spark)))


QUERIES = {"op4_url_filter": op4_url_filter}
ORACLES: dict[str, str] = {}

"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its text. The weights maximise the likelihood of the
preferences "a text labelled 1 beats a text labelled 0": logistic loss on differences of features. A quantile of the
training scores, the one that tells the labels apart best, becomes the threshold.

All labelled texts are learned from, and all pairs of a good and a bad one: the loss of a pair depends on two strengths
only, so sums of the features by narrow bins of strength, a few thousand rows, give the gradient over all pairs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, materialize, read_table, tidy

#: Opponents of each text in the preference pairs of a table in memory; tables of Spark count all pairs.
OPPONENTS = 12
RIDGE = 1e-2
STEPS = 40
#: Bins of strength in each unit, for sums that the gradient and the Hessian of all pairs are made of.
FINE, COARSE = 256, 4
#: Strengths from which bins grow wider.
BIN_SPREAD = 8.0

_symbols = re.compile(r"[^\w\s.,;:!?'\"()\-]")
FEATURES = (
    "log_words", "log_distinct_share", "distinct_share", "next_equal", "top_share", "word_length", "long_words", "upper_share",
    "upper_words", "digit_share", "symbol_share", "symbol_words", "bar_words", "exclaim_words", "plain_ends", "line_repeat", "words_per_sentence", "title_words",
)


def features(text: str | None) -> list[float]:
    """The features of one text, each within a fixed range; a null text counts as an empty one."""
    text = text or ""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    chars = len(text)
    upper = sum(map(str.isupper, words))
    symbols = len(_symbols.findall(text))
    lines = [x for x in text.split("\n") if x.strip()]
    last = [w[-1] for w in words]
    ends = Counter(last)
    sentence_ends = ends["."] + ends["!"] + ends["?"]
    letters = sum(map(str.isalpha, text))
    capitals = letters and sum(1 for c in text if c.isupper()) / letters
    digits = sum(map(str.isdigit, text))
    alnum_end = sum(map(str.isalnum, last))
    return [
        min(1.0, math.log1p(n) / 10),
        math.log(len(counts) / n) / max(1.0, math.log(n)) if n > 1 else 0.0,
        len(counts) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        max(counts.values()) / n if n >= 10 else 0.0,
        min(2.0, (chars - text.count(" ")) / n / 10),
        sum(1 for w in words if len(w) > 20) / n,
        float(capitals),
        upper / n,
        digits / chars,
        symbols / chars * 5,
        min(1.0, sum(c for e, c in ends.items() if _symbols.match(e)) / n),
        counts["|"] / n,
        ends["!"] / n,
        (alnum_end + ends["."] + ends[","]) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(1.0, n / (sentence_ends + 1) / 50),
        sum(map(str.istitle, words)) / n,
    ]


@dataclass
class Ranking:
    """Centre and scale of the features, their weights, the threshold and the slope of the probability."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        strength = (rows - self.centre) / self.scale @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (strength - self.threshold), -500, 500)))


def preference_pairs(good: int, bad: int, opponents: int = OPPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (winner, loser): every text meets `opponents` of the other label, or all if there are fewer."""
    if not good or not bad:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    pairs = {(i, (i * opponents + k) % bad) for i in range(good) for k in range(min(opponents, bad))}
    pairs |= {((j * opponents + k) % good, j) for j in range(bad) for k in range(min(opponents, good))}
    found = np.array(sorted(pairs))
    return found[:, 0], found[:, 1]


def quantile_threshold(strength: np.ndarray, labels: np.ndarray) -> float:
    """The quantile of the scores that tells the labels apart best: the highest sum of both labels' shares on their side.

    It lies halfway between the scores beside it; of equally good ones the middle one counts.
    """
    order = np.argsort(strength, kind="stable")
    s, good = strength[order], labels[order] == 1
    bad_below, good_below = np.cumsum(~good)[:-1], np.cumsum(good)[:-1]
    worth = bad_below / max(1, (~good).sum()) - good_below / max(1, good.sum())
    worth[s[1:] == s[:-1]] = -1
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    k = best[len(best) // 2]
    return float((s[k] + s[k + 1]) / 2)


def fit(rows: np.ndarray, labels: np.ndarray) -> Ranking:
    """Newton's method on the ridge-penalised logistic loss of feature differences; then the quantile threshold."""
    width = rows.shape[1] if rows.ndim == 2 else len(FEATURES)
    if len(rows) == 0 or labels.min() == labels.max():
        sure = 0.0 if len(rows) == 0 else (-1.0 if labels[0] == 1 else 1.0)
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), sure, 1.0)
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-3)
    z = (rows - centre) / scale
    good, bad = z[labels == 1], z[labels == 0]
    win, lose = preference_pairs(len(good), len(bad))
    diff = good[win] - bad[lose]
    w = np.zeros(width)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (p - 1) / len(diff) + RIDGE * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strength = z @ w
    threshold = quantile_threshold(strength, labels)
    return Ranking(centre, scale, w, threshold, 1.0)


# ---- learning from whole tables


def feature_column() -> Callable[[Column], Column]:
    @tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t if isinstance(t, str) else None) for t in texts], dtype=object)

    return F.pandas_udf(run, "array<double>")


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row; null and empty texts have features too, all 0."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", feature_column()(F.col("text")).alias("features"))


def labelled_features(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """quality and the features f0, f1, ... of every labelled row of featured rows, stored.

    Repeated labels count once, and doc_ids with both labels not at all.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    once = usable.groupBy("doc_id").agg(F.min("quality").alias("__low"), F.max("quality").alias("__label")).filter("__low = __label")
    joined = rows.select("doc_id", "features").join(once, "doc_id")
    each = (F.col("features")[k].alias(f"f{k}") for k in range(len(FEATURES)))
    return materialize(joined.select(F.col("__label").cast("int").alias("quality"), *each), "quality-labelled")


def _standard(told: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean and scale of each feature and the rows of label 1 and 0. Sums are of decimals, so the order of rows changes nothing."""
    exact = lambda c: F.sum(c.cast("decimal(28,18)")).cast("double")
    columns = [F.col(f"f{k}") for k in range(len(FEATURES))]
    found = told.agg(F.count("*"), F.count(F.when(F.col("quality") == 1, 1)), *map(exact, columns), *(exact(c * c) for c in columns)).first()
    n = max(1, found[0])
    sums = np.array([x or 0.0 for x in found[2:]]).reshape(2, len(FEATURES)) / n
    return sums[0], np.maximum(np.sqrt(np.maximum(sums[1] - sums[0] ** 2, 0)), 1e-3), found[1], found[0] - found[1]


def _scaled(centre: np.ndarray, scale: np.ndarray, feature: Callable[[int], Column]) -> list[Column]:
    return [(feature(k) - F.lit(float(c))) / F.lit(float(d)) for k, (c, d) in enumerate(zip(centre, scale, strict=True))]


def _strength(z: list[Column], weights: np.ndarray) -> Column:
    return sum((c * F.lit(float(w)) for c, w in zip(z[1:], weights[1:], strict=True)), z[0] * F.lit(float(weights[0])))


def _binned(told: DataFrame, strength: Column, fineness: int, terms: list[Column], unit: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of each label: rows and sums of the terms by bin of the strength. Bins are 1 / fineness wide about 0, wider far out.

    Terms are rounded to the unit and summed as integers, so the order of rows changes nothing.
    """
    at = F.floor(F.asinh(strength / BIN_SPREAD) * (BIN_SPREAD * fineness))
    sums = [F.sum(F.round(t * F.lit(float(unit))).cast("long")).alias(f"t{k}") for k, t in enumerate(terms)]
    rows = told.groupBy("quality", at.alias("bin")).agg(F.count("*").alias("n"), *sums).collect()
    out = {}
    for label in (0, 1):
        own = np.array(sorted(tuple(r)[1:] for r in rows if r["quality"] == label), dtype=float)
        out[label] = own[:, 1], own[:, 2:] / unit
    return out


def _chances(good: np.ndarray, bad: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The probability that the bad one wins, a block of good rows at a time."""
    for k in range(0, len(good), 256):
        yield slice(k, k + 256), 1 / (1 + np.exp(np.clip(good[k : k + 256, None] - bad[None, :], -500, 500)))


def _slope_of_loss(told: DataFrame, z: list[Column], w: np.ndarray) -> np.ndarray:
    """Gradient of the mean loss of all pairs (good, bad); texts of a fine bin count with the bin's mean."""
    sums = _binned(told, _strength(z, w), FINE, z, 1 << 32)
    (n_bad, z_bad), (n_good, z_good) = sums[0], sums[1]
    total = np.zeros(len(w))
    for own, lost in _chances(z_good @ w / n_good, z_bad @ w / n_bad):
        total -= (lost @ n_bad) @ z_good[own] - (n_good[own] @ lost) @ z_bad
    return total / (n_good.sum() * n_bad.sum()) + RIDGE * w


def _bend_of_loss(told: DataFrame, z: list[Column], w: np.ndarray) -> np.ndarray:
    """Hessian of the mean loss of all pairs, by coarse bins: it steers the steps and does not move the optimum."""
    upper = np.triu_indices(len(w))
    products = [z[i] * z[j] for i, j in zip(*upper, strict=True)]
    sums = _binned(told, _strength(z, w), COARSE, [*z, *products], 1 << 20)
    n, first, second = {}, {}, {}
    for label, (rows, terms) in sums.items():
        n[label], first[label] = rows, terms[:, : len(w)]
        second[label] = np.zeros((len(rows), len(w), len(w)))
        second[label][:, upper[0], upper[1]] = second[label][:, upper[1], upper[0]] = terms[:, len(w) :]
    total = np.zeros((len(w), len(w)))
    for own, lost in _chances(first[1] @ w / n[1], first[0] @ w / n[0]):
        bend = lost * (1 - lost)
        crossed = first[1][own].T @ bend @ first[0]
        total += np.tensordot(bend @ n[0], second[1][own], 1) + np.tensordot(n[1][own] @ bend, second[0], 1) - crossed - crossed.T
    return total / (n[1].sum() * n[0].sum()) + RIDGE * np.eye(len(w))


def _best_cuts(good: int, bad: int) -> Callable:
    """Of a sorted part of the strengths, the cuts of the highest worth, counted from the part's start, and last what it holds."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, last, below, best, ties = None, None, [0, 0], None, []
        for frame in frames:
            s, ones, zeros = frame["s"].to_numpy(), frame["ones"].to_numpy(), frame["zeros"].to_numpy()
            if not len(s):
                continue
            first = s[0] if first is None else first
            sums = np.cumsum(ones) + below[1], np.cumsum(zeros) + below[0]
            # the worth of the cut below each row of the frame
            worth = (sums[1] - zeros) * good - (sums[0] - ones) * bad
            under = np.concatenate(([s[0] if last is None else last], s[:-1]))
            from_ = 1 if last is None else 0
            if len(s) > from_:
                top = int(worth[from_:].max())
                if best is None or top >= best:
                    ties = ties if top == best else []
                    best = top
                    ties += [(under[k], s[k]) for k in range(from_, len(s)) if worth[k] == top]
            below, last = [int(sums[1][-1]), int(sums[0][-1])], s[-1]
        if first is not None:
            name = float(first)
            yield pd.DataFrame({"part": name, "tie": range(len(ties)), "low": [a for a, _ in ties], "high": [b for _, b in ties], "worth": best or 0, "ties": 0, "ones": 0, "zeros": 0})
            yield pd.DataFrame({"part": [name], "tie": [-1], "low": [first], "high": [last], "worth": [best or 0], "ties": [len(ties)], "ones": [below[1]], "zeros": [below[0]]})

    return run


def table_threshold(told: DataFrame, strength: Column, good: int, bad: int) -> float:
    """quantile_threshold of a whole table: parts of the sorted strengths find their best cuts, the driver has a row for each part."""
    counts = told.groupBy(strength.alias("s")).agg(F.sum("quality").cast("long").alias("ones"), F.sum(1 - F.col("quality")).cast("long").alias("zeros"))
    parts = counts.repartitionByRange("s").sortWithinPartitions("s").mapInPandas(
        _best_cuts(good, bad), "part double, tie long, low double, high double, worth long, ties long, ones long, zeros long"
    )
    stored = materialize(parts, "quality-cuts")
    cuts: list[tuple[int, int, float, float | None]] = []  # worth, number of ties, and the part or the two sides
    ones = zeros = 0
    last = None
    for r in sorted(stored.filter("tie < 0").collect(), key=lambda r: r["part"]):
        base = zeros * good - ones * bad
        if last is not None:
            cuts.append((base, 1, last, r["low"]))
        if r["ties"]:
            cuts.append((base + r["worth"], r["ties"], r["part"], None))
        ones, zeros, last = ones + r["ones"], zeros + r["zeros"], r["high"]
    if not cuts:
        return float(last)
    top = max(c[0] for c in cuts)
    fair = [c for c in cuts if c[0] == top]
    middle = sum(c[1] for c in fair) // 2
    for _, n, low, high in fair:
        if middle < n:
            break
        middle -= n
    if high is None:
        low, high = stored.filter((F.col("part") == low) & (F.col("tie") == middle)).select("low", "high").first()
    return float((low + high) / 2)


def learn(rows: DataFrame, labels: DataFrame) -> Ranking:
    """Learns from every labelled row of featured rows: Newton's method over all pairs (good, bad), then the quantile threshold.

    A step ends the search when it is tiny, or small and no longer shrinking, which is where the bins' width shows.
    """
    width = len(FEATURES)
    told = labelled_features(rows, labels)
    centre, scale, good, bad = _standard(told)
    if not good or not bad:
        sure = 0.0 if not good and not bad else (-1.0 if good else 1.0)
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), sure, 1.0)
    z = _scaled(centre, scale, lambda k: F.col(f"f{k}"))
    w, before = np.zeros(width), math.inf
    for _ in range(STEPS):
        step = np.linalg.solve(_bend_of_loss(told, z, w), _slope_of_loss(told, z, w))
        w = w - step
        size = np.abs(step).max()
        if size < 1e-6 or (size < 1e-3 and size > before / 2):
            break
        before = size
    return Ranking(centre, scale, w, table_threshold(told, _strength(z, w), good, bad), 1.0)


def train(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Learns from all the labels given; without both labels every text gets the same score."""
    return learn(featured(docs), labels)


def score_features(rows: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, score and predicted (1 from a score of 0.5 on) of every featured row."""
    strength = _strength(_scaled(model.centre, model.scale, lambda k: F.col("features")[k]), model.weights)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), (strength - F.lit(model.threshold)) * F.lit(model.slope)))))
    return rows.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_quality(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, score and predicted of every row; null and empty texts have a score too, an empty table gives no rows."""
    return score_features(featured(docs), model)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(featured(read_table(spark, sf_dir, "documents")), "quality-features")
    labels = read_table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 3) != 1)
    return score_features(rows, learn(rows, labels)).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


QUERIES = {"op10_quality": op10_quality}
ORACLES: dict[str, str] = {}

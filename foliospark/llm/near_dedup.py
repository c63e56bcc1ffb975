"""Near duplicates by a parity-sketch join.

A document is the set of its 5-word shingles. Shingles are dealt to blocks, and a block's sketch is the XOR of the codes
of its shingles: the number of blocks that differ, like the Hamming distance of one-bit sketches, is at most the size of
the symmetric difference. Documents similar enough differ in at most D shingles, with D given by their size band, so of
more than D filled blocks at least one is equal in both. Documents that share a block are compared: first by size and by
the Hamming distance of their bit sketches, then by their texts.

In a group of documents that share a block only the comparison with its smallest member is made at first. Components of
what was verified then tell which comparisons are still open: those between different components within groups where some
comparison failed. Nothing else could add a link between components, so no link is lost and no group is paired throughout.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache, wraps

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, flag_members, heavy_bar, materialize, read_table, tidy

WORDS = 5
#: Documents link at this Jaccard similarity, in per cent, or more.
SIMILARITY = 80
#: Upper ends of the size bands grow by this factor: that of the sizes that can be similar.
BAND_GROWTH = 1.25
#: Blocks for each one needed, so that enough of them have shingles.
SPARE_BLOCKS = 1.15
#: Characters that are sketched at a time.
BLOCK_CHARS = 2_000_000
#: Words that a task remembers, about.
REMEMBERED = 100_000
#: Entries of keys that a task holds before it pairs them and keeps one for each key.
ENTRIES_HELD = 2_000_000
#: Keys that one task groups, about.
KEYS_PER_TASK = 500_000
#: Bytes of text for a key, roughly.
BYTES_PER_KEY = 10
#: Members of each undecided group that all others are compared with, before the rest is compared across components.
HUBS = 3
#: Bit sketches have at least so many words of 64 bits, and twice as many bits as shingles.
LEAST_SKETCH = 4

_U = np.uint64
_POWERS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_EMPTY = _U(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_words = _Words()


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles: of five words, or of all where there are fewer."""
    if len(_words) > REMEMBERED:
        _words.clear()
    split = [t.encode("utf-8", "replace").lower().split() if isinstance(t, str) else [] for t in texts]
    sizes = [len(w) for w in split]
    flat = np.fromiter((_words[w] for own in split for w in own), dtype=_U, count=sum(sizes))
    out, at = [], 0
    with np.errstate(over="ignore"):
        every = sum((flat[k : len(flat) - WORDS + 1 + k] * p for k, p in enumerate(_POWERS)), _U(0)) if len(flat) >= WORDS else flat[:0]
        every = mix(every) if len(every) else every
        for n in sizes:
            if n >= WORDS:
                out.append(np.unique(every[at : at + n - WORDS + 1]))
            elif n:
                one = sum((flat[at + k] * _POWERS[k] for k in range(n)), _U(n))
                out.append(mix(np.array([one], dtype=_U)))
            else:
                out.append(flat[:0])
            at += n
    return out


def most_differing(sizes: int) -> int:
    """The largest symmetric difference of two linked sets whose sizes add up to this."""
    return sizes * (100 - SIMILARITY) // (100 + SIMILARITY)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bool(100 * common >= SIMILARITY * (len(a) + len(b) - common)) and common > 0


@cache
def band_ends() -> list[int]:
    """Upper ends of the size bands. The first is for sets so small that only equal ones link."""
    ends = [next(n for n in range(1, 1000) if most_differing(2 * n + 1) > 0)]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, int(ends[-1] * BAND_GROWTH)))
    return ends


@cache
def _blocks(band: int) -> tuple[int, np.ndarray, np.ndarray]:
    """D of the band, the lower ends of its blocks' ranges of hashes and a salt for each block."""
    most = most_differing(2 * band_ends()[band])
    count = math.ceil(SPARE_BLOCKS * (most + 1))
    lower = np.array([(k << 64) // count for k in range(count)], dtype=_U)
    salts = mix(np.arange(count, dtype=_U) + _U(band << 40) + _U(1))
    return most, lower, salts


def bands_of(n: int) -> list[int]:
    """The bands in which a set of n shingles meets others: its own and those of larger sets it may link with."""
    ends = band_ends()
    found, band = [], bisect_left(ends, n)
    while band == 0 or ends[band - 1] + 1 <= n * 100 // SIMILARITY:
        if band:
            found.append(band)
        band += 1
    return found


def block_keys(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A key for each filled block of each band, from the XOR of its codes; empty blocks only where too few are filled."""
    keys = []
    for band in bands_of(len(hashes)):
        most, lower, salts = _blocks(band)
        starts = np.searchsorted(hashes, lower)
        filled = np.flatnonzero(np.diff(starts, append=len(hashes)) > 0)
        sketch = np.bitwise_xor.reduceat(codes, starts[filled])
        keys.append(mix(sketch ^ salts[filled]))
        if len(filled) <= most:
            empty = np.setdiff1d(np.arange(len(lower)), filled, assume_unique=True)
            keys.append(mix(_EMPTY ^ salts[empty]))
    return np.concatenate(keys) if keys else hashes[:0]


def sketch_words(n: int) -> int:
    return max(LEAST_SKETCH, 1 << max(0, math.ceil(math.log2(max(1, 2 * n) / 64))))


def bit_sketch(codes: np.ndarray) -> np.ndarray:
    """Each code toggles one bit; half the length is the XOR of the two halves."""
    bits = 64 * sketch_words(len(codes))
    toggled = np.bincount((codes & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(toggled.astype(np.uint8), bitorder="little").view(np.int64)


def class_id(codes: np.ndarray) -> int:
    """One number for equal sets."""
    with np.errstate(over="ignore"):
        own = np.bitwise_xor.reduce(mix(codes + _U(7))) + np.add.reduce(codes) * _U(3) + _U(len(codes))
        return int(mix(np.array([own], dtype=_U)).view(np.int64)[0])


def smallest_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the smallest id of each; key, smallest and other id of every further one."""
    if not len(keys):
        return keys, ids, keys, ids, ids
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    least = np.minimum.reduceat(ids, starts)
    of = np.repeat(least, np.diff(starts, append=len(keys)))
    more = ids != of
    return keys[starts], least, keys[more], of[more], ids[more]


#: doc_id travels as text and the numbers are never null: pandas would turn them into floats.
_ROW = "bucket int, kind int, doc_id string, n long, cid long, other long, sketch array<long>, keys array<long>, ids array<long>"
DOC, KEYS, EDGE = 0, 1, 2
_COLUMNS = ["bucket", "kind", "doc_id", "n", "cid", "other", "sketch", "keys", "ids"]


def _edges(keys: np.ndarray, least: np.ndarray, other: np.ndarray) -> list[tuple]:
    """A row for each pair, with the keys that it shares."""
    if not len(keys):
        return []
    order = np.lexsort((other, least))
    keys, least, other = keys[order], least[order], other[order]
    starts = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (other[1:] != other[:-1]))))
    shared = np.split(keys.view(np.int64), starts[1:])
    return [(b, EDGE, None, 0, o, s, None, np.unique(k), None) for b, (o, s, k) in enumerate(zip(other[starts].tolist(), least[starts].tolist(), shared, strict=True))]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
    return found.astype({"bucket": "int32", "kind": "int32", "n": "int64", "cid": "int64", "other": "int64"})


def _text_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sizes = frame["text"].str.len().fillna(0).to_numpy() if frame["text"].notna().any() else np.zeros(len(frame))
        start, held = 0, 0
        for stop in range(1, len(frame) + 1):
            held += sizes[stop - 1]
            if held >= BLOCK_CHARS or stop == len(frame):
                yield frame.iloc[start:stop]
                start, held = stop, 0


def _sketched(buckets: int):
    """Rows for the documents of each block, its keys by bucket, and pairs that share keys within the block."""

    @_tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _text_blocks(frames):
            rows, keys, ids = [], [], []
            seen: set[int] = set()
            for doc_id, hashes in zip(block["doc_id"], shingles(block["text"].tolist()), strict=True):
                if not len(hashes):
                    rows.append((len(rows) % buckets, DOC, doc_id, 0, 0, 0, None, None, None))
                    continue
                with np.errstate(over="ignore"):
                    codes = mix(hashes + _U(11))
                    own = class_id(codes)
                    rows.append((len(rows) % buckets, DOC, doc_id, len(hashes), own, 0, bit_sketch(codes), None, None))
                    if own not in seen:
                        seen.add(own)
                        keys.append(block_keys(hashes, codes))
                        ids.append(np.full(len(keys[-1]), own, dtype=np.int64))
            if keys:
                key, least, *pairs = smallest_of(np.concatenate(keys), np.concatenate(ids))
                edges = _edges(*pairs)
                rows += [(b % buckets, *rest) for b, *rest in edges]
                to = (key % _U(buckets)).astype(np.int64)
                order = np.lexsort((least, to))
                key, least, to = key[order].view(np.int64), least[order], to[order]
                starts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else []
                for a, b in zip(starts, [*starts[1:], len(to)], strict=True):
                    rows.append((int(to[a]), KEYS, None, 0, 0, 0, None, key[a:b], least[a:b]))
            yield _frame(rows)

    return run


def _tidy(run):
    """As tidy, and the words that the task remembered are forgotten."""

    @wraps(run)
    def forgetful(batches):
        try:
            yield from run(batches)
        finally:
            _words.clear()

    return tidy(forgetful)


@_tidy
def _met(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Passes documents and pairs on and makes pairs of the keys that blocks share.

    Of a key only the smallest id is kept for what follows, so a key that very many blocks have takes no more memory than
    another: each id is paired with the smallest so far, and a smaller one with the one before.
    """
    keys, ids, held = [], [], 0

    def paired() -> Iterator[pd.DataFrame]:
        key, least, *pairs = smallest_of(np.concatenate(keys), np.concatenate(ids))
        keys[:], ids[:] = [key], [least]
        rows = _edges(*pairs)
        for k in range(0, len(rows), 5000):
            yield _frame(rows[k : k + 5000])

    for frame in frames:
        is_keys = frame["kind"] == KEYS
        for k, i in zip(frame.loc[is_keys, "keys"], frame.loc[is_keys, "ids"], strict=True):
            keys.append(np.asarray(k, dtype=np.int64).view(_U))
            ids.append(np.asarray(i, dtype=np.int64))
            held += len(k)
        yield frame[~is_keys].assign(ids=None)
        if held > ENTRIES_HELD:
            yield from paired()
            held = len(keys[0]) // 2  # distinct keys count half, so pairing stays rare
    if keys:
        yield from paired()


def sketch_join(docs: DataFrame) -> DataFrame:
    """Stored rows of two kinds: DOC with doc_id, n, cid and sketch; EDGE with a pair (cid, other) and the keys they share."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BYTES_PER_KEY / KEYS_PER_TASK))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    sketched = rows.mapInPandas(_sketched(parts), _ROW).repartitionById(parts, "bucket")
    met = sketched.mapInPandas(_met, _ROW).drop("ids", "bucket").withColumn("doc_id", F.col("doc_id").cast("long"))
    return materialize(met, "near-sketches")


# ---- comparing


def hamming(a: str, b: str) -> Column:
    """Hamming distance of two bit sketches; the longer one is folded to the length of the other."""
    fold = "CASE WHEN size({0}) > size({1}) THEN zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (u, v) -> u ^ v) ELSE {0} END"
    return F.expr(f"aggregate(zip_with({fold.format(a, b)}, {fold.format(b, a)}, (u, v) -> bit_count(u ^ v)), 0, (s, v) -> s + v)")


def plausible(n_a: str, n_b: str, sketch_a: str, sketch_b: str) -> Column:
    """Whether sizes and sketches allow a link."""
    small, large = F.least(n_a, n_b), F.greatest(n_a, n_b)
    most = F.floor((F.col(n_a) + F.col(n_b)) * (100 - SIMILARITY) / (100 + SIMILARITY))
    return F.when(small * 100 < large * SIMILARITY, F.lit(False)).otherwise(hamming(sketch_a, sketch_b) <= most)


def _verify_column():
    @_tidy
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept: dict[str, np.ndarray] = {}
        chars = 0
        for one, two in batches:
            out = []
            for a, b in zip(one, two, strict=True):
                sets = []
                for t in (a, b):
                    if t not in kept:
                        if chars > BLOCK_CHARS:
                            kept.clear()
                            chars = 0
                        kept[t] = shingles([t])[0]
                        chars += len(t)
                    sets.append(kept[t])
                out.append(linked(*sets))
            yield pd.Series(out, dtype=bool)

    return F.pandas_udf(run, "boolean")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b and ok of each pair of classes, by the shingles of their texts; only these texts are shuffled."""
    pairs = pairs.select("a", "b")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = materialize(ids.join(classes.select("cid", "rep"), "cid"), "near-wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    some = flag_members(rows, F.coalesce("doc_id", F.lit(-1)), wanted.select(F.coalesce("rep", F.lit(-1)).alias("k")), "__hit").filter("__hit").drop("__hit")
    texts = wanted.join(some, F.col("rep").eqNullSafe(F.col("doc_id"))).select("cid", "text")
    texts = materialize(texts.filter(_class_column()(F.col("text")) == F.col("cid")).dropDuplicates(["cid"]), "near-texts")
    with_b = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a")
    return materialize(both.select("a", "b", _verify_column()(F.col("text_a"), F.col("text_b")).alias("ok")), "near-verified")


def _class_column():
    @_tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = []
            for k in range(0, len(texts), 200):
                for hashes in shingles(texts.iloc[k : k + 200].tolist()):
                    with np.errstate(over="ignore"):
                        found.append(class_id(mix(hashes + _U(11))) if len(hashes) else 0)
            yield pd.Series(found, dtype="int64")

    return F.pandas_udf(run, "long")


def components(edges: DataFrame) -> DataFrame:
    """cid and label, the smallest cid of its component, for every end of an edge (a, b).

    Each round takes the smallest label of all neighbours and then the label of that label.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = materialize(both.groupBy(F.col("a").alias("cid")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "near-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("cid")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("cid") == F.col("a"), "left").select("cid", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = step.alias("s").join(labels.select(F.col("cid").alias("to"), F.col("label").alias("further")), F.col("label") == F.col("to"), "left")
        new = materialize(jump.select("cid", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "near-labels")
        done = new.filter("old <> label").limit(1).count() == 0
        labels = new.select("cid", "label")
        if done:
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """For every row of docs: doc_id, n_shingles and component_id, the smallest doc_id that links reach.

    A null or wordless text has no shingles and is linked with nothing: its component_id is its doc_id. A null doc_id is
    never the smallest unless its component has no other. Repeated rows are copies. An empty table gives no rows.
    """
    rows = sketch_join(docs)
    own = rows.filter(F.col("kind") == DOC).select("doc_id", "n", "cid", "sketch")
    classes = materialize(
        own.filter("n > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("size")), "near-classes"
    )
    labels = _labels(rows.filter(F.col("kind") == EDGE).select(F.col("other").alias("a"), F.col("cid").alias("b"), "keys"), classes, docs)
    found = classes.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = found.groupBy("label").agg(F.min("rep").alias("component_id"))
    answers = materialize(found.join(least, "label").select("cid", "component_id", "size"), "near-answers")
    bar = heavy_bar(own.count())
    heavy, light = answers.filter(F.col("size") >= bar).drop("size"), answers.filter((F.col("size") < bar)).drop("size")
    thin = own.select("doc_id", "n", "cid")
    of_heavy = thin.join(F.broadcast(heavy), "cid")
    of_light = thin.filter("n > 0").join(F.broadcast(heavy.select("cid")), "cid", "left_anti").join(light, "cid")
    of_none = thin.filter("n = 0").select("cid", "doc_id", "n", F.col("doc_id").alias("component_id"))
    return of_heavy.unionByName(of_light).unionByName(of_none).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _with_sets(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        own = classes.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(own, side)
    return pairs


def _relabelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds label_a and label_b."""
    for side in ("a", "b"):
        own = labels.select(F.col("cid").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    return pairs


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of groups of three or more that have more than one label."""
    labelled = _labelled(members, labels)
    several = labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count("*").alias("n")).filter("l <> m AND n > 2")
    return labelled.join(several.select("key"), "key", "left_semi")


def _compare(pairs: DataFrame, tested: DataFrame, classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of pairs not tested yet, those verified by their texts, and those that sizes and sketches rule out."""
    fresh = pairs.join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    told = materialize(_with_sets(fresh, classes).select("a", "b", plausible("n_a", "n_b", "sketch_a", "sketch_b").alias("may")), "near-told")
    return verified(told.filter("may"), classes, docs), told.filter("NOT may").select("a", "b", F.lit(False).alias("ok"))


def _labels(edges: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """cid and label of all classes that link with another."""
    shared = edges.groupBy("a", "b").agg(F.sum(F.size("keys")).alias("shared"))
    told = _with_sets(shared, classes).select("a", "b", "shared", plausible("n_a", "n_b", "sketch_a", "sketch_b").alias("may"))
    told = materialize(told, "near-pairs")
    may = told.filter("may")
    # first each class with the one that it shares most with, then what remains between components
    first = may.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("m"), "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    tested = verified(first, classes, docs)
    links = tested.filter("ok").select("a", "b")
    labels = components(links)
    open_ = _relabelled(may.select("a", "b").join(tested.select("a", "b"), ["a", "b"], "left_anti"), labels).filter("label_a <> label_b").select("a", "b")
    more = verified(materialize(open_, "near-open"), classes, docs)
    links = links.union(more.filter("ok").select("a", "b"))
    labels = components(links)
    tested = tested.union(more)
    # groups in which a comparison failed: their members of different components have yet to be compared
    failed = told.filter("NOT may").select("a", "b").union(tested.filter("NOT ok").select("a", "b"))
    bad = edges.join(failed, ["a", "b"], "left_semi").select(F.explode("keys").alias("key")).distinct()
    members = edges.select(F.explode("keys").alias("key"), F.array("a", "b").alias("ab")).join(bad, "key", "left_semi").select("key", F.explode("ab").alias("cid")).distinct()
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("links"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("links"), "cid"))
    members = materialize(members.join(degree, "cid", "left").select("key", "cid", F.coalesce("links", F.lit(0)).alias("links")), "near-members")
    # of a group only its first rows are shuffled for this: the window's limit is applied in each task before
    hubs = materialize(members.withColumn("place", place).filter(F.col("place") <= HUBS).select("key", "cid", "place"), "near-hubs")
    members = members.select("key", "cid")
    for hub in range(1, HUBS + 1):  # the member with the most links joins most of its group, which leaves little to compare
        left = _undecided(members, labels)
        at_hub = _labelled(hubs.filter(F.col("place") == hub).select("key", "cid"), labels).select("key", F.col("cid").alias("h"), F.col("label").alias("label_h"))
        met = left.join(at_hub, "key").filter("label <> label_h").select(F.least("cid", "h").alias("a"), F.greatest("cid", "h").alias("b")).distinct()
        more, no = _compare(met, tested, classes, docs)
        links = links.union(more.filter("ok").select("a", "b"))
        tested = tested.union(more).union(no)
        labels = components(links)
    left = _undecided(members, labels)
    # a group's members of one component meet those of another; sizes and sketches are compared within the join
    sets = classes.select("cid", "n", "sketch")
    side = left.join(sets, "cid")
    one, two = (side.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("cid", "label", "n", "sketch"))) for s in "ab")
    crossed = one.join(two, (one["key"] == two["key"]) & (F.col("label_a") < F.col("label_b")) & plausible("n_a", "n_b", "sketch_a", "sketch_b"))
    pairs = crossed.select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b")).distinct()
    last, _ = _compare(pairs, tested, classes, docs)
    links = links.union(last.filter("ok").select("a", "b"))
    return components(links)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs but for those whose component has a smaller doc_id; of rows that repeat doc_id and text one stays.

    Documents without words stay, and so do rows without a doc_id, which nothing tells apart. Rows that are no candidates
    for either are not shuffled.
    """
    found = materialize(near_duplicates(docs), "near-found").filter("doc_id IS NOT NULL")
    lose = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("k")).distinct()
    twice = found.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("k")).count().filter("count > 1").select("k")
    marked = materialize(lose.withColumn("lose", F.lit(True)).unionByName(twice.withColumn("lose", F.lit(False))).groupBy("k").agg(F.max("lose").alias("lose")), "near-marked")
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("k"))
    flagged = flag_members(packed, F.col("k"), marked.select("k"), "__hit").withColumn("__hit", F.col("__hit") & F.col("k").isNotNull())
    hit = flagged.filter("__hit").join(marked, "k", "left")
    fine = hit.filter("lose IS NULL").select("__row")
    once = hit.filter("NOT lose").withColumn("__sha", F.sha2(F.coalesce(F.col("__row.text"), F.lit("")), 256)).dropDuplicates(["k", "__sha"]).select("__row")
    return flagged.filter("NOT __hit").select("__row").unionByName(fine).unionByName(once).select("__row.*")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {"op6_near_duplicates": op6_near_duplicates}
ORACLES: dict[str, str] = {}

"""Dense, sparse and hybrid retrieval and what follows it.

A set of queries is scored against all vectors: the queries are the stated small side, checked before it is broadcast.
The top rows are ranked by a window whose limit Spark applies in each task first, so few scores of a query are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are broadcast at once; more are scored in blocks of as many.
QUERY_BLOCK = 2000
#: Vectors that are multiplied with a block of queries at once.
TILE = 500
RRF = 60


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(vector: Column) -> Column:
    """The vector divided by its length; zeros stay."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    size = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, v: s + v * v))
    return F.when(size > 0, F.transform(doubles, lambda x: x / size)).otherwise(doubles)


def top_k(scored: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their rank."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def dense_search(vectors: DataFrame, queries: DataFrame, k: int, at_least: float | None = None) -> DataFrame:
    """query_id, vec_id, score and rank of the k nearest vectors by cosine, rounded to six digits; ties go to the smaller id.

    A block of queries is sent to every task, which multiplies it with one batch of vectors after another and keeps the k
    best of each query, so k rows a query and task are shuffled. Zero vectors have score 0. Queries are the stated small
    side: they are counted first, and more than QUERY_BLOCK are searched block by block. A query with a `keyword` sees only
    vectors whose `content` has it, whatever its case.
    """
    n = queries.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    parts = [queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b) if blocks > 1 else queries for b in range(blocks)]
    found = reduce(DataFrame.unionByName, (_searched(vectors, p, k) for p in parts))
    if at_least is not None:
        found = found.filter(F.col("score") >= at_least)
    return top_k(found, "query_id", [F.desc("score"), F.col("vec_id")], k)


def _searched(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each query in each task. With a column `keyword`, queries see only vectors whose `words`, places in the sorted keywords, have theirs."""
    worded = "keyword" in queries.columns
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), "embedding", *(["keyword"] if worded else [])).toPandas()
    ids = asked["query_id"].tolist()
    matrix = _units(asked["embedding"]) if ids else np.zeros((0, 1))
    words = sorted(set(asked["keyword"])) if worded else []
    of_word = [np.flatnonzero((asked["keyword"] == w).to_numpy()) for w in words]
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix, of_word))  # at most QUERY_BLOCK vectors

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, asked, of_word = shared.value
        best = [_Best(len(names) if not worded else len(q), k) for q in (of_word if worded else [names])]
        for frame in frames:
            if not len(frame) or not names:
                continue
            for start in range(0, len(frame), TILE):
                tile = frame.iloc[start : start + TILE]
                own, units = tile["vec_id"].to_numpy(dtype=np.int64), _units(tile["embedding"])
                if not worded:
                    best[0].take(asked @ units.T, own)
                    continue
                has = tile["words"].tolist()
                for w, of in enumerate(of_word):
                    at = [i for i, x in enumerate(has) if w in x]
                    if at:
                        best[w].take(asked[of] @ units[at].T, own[at])
        for w, b in enumerate(best):
            q = of_word[w][b.query] if worded else b.query
            yield pd.DataFrame({"query_id": np.array(names, dtype=object)[q], "vec_id": b.ids, "score": b.scores})

    kept = ["vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding")]
    if worded:
        listed = F.array(*(F.lit(w) for w in words)).cast("array<string>")
        places = F.transform(listed, lambda w, i: F.when(F.contains(F.lower("content"), F.lower(w)), i))
        kept.append(F.filter(places, lambda i: i.isNotNull()).alias("words"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(*kept)
    if worded:
        rows = rows.filter(F.size("words") > 0)
    found = rows.mapInPandas(run, "query_id string, vec_id long, score double")
    return found.withColumn("query_id", F.col("query_id").cast(queries.schema["query_id"].dataType))


class _Best:
    """The k best of each of n queries so far, by score rounded to six digits and then the smaller id, as rows (query, ids, scores)."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, -np.inf)
        self.query, self.ids, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)

    def take(self, scores: np.ndarray, own: np.ndarray) -> None:
        """Scores of all queries with some vectors."""
        bar = self.least
        if scores.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
        q, v = np.nonzero(scores >= bar[:, None] - 1e-6)
        if not len(q):
            return
        query, ids, found = np.concatenate((self.query, q)), np.concatenate((self.ids, own[v])), np.concatenate((self.scores, np.round(scores[q, v], 6)))
        order = np.lexsort((ids, -found, query))
        query = query[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        kept = order[place < self.k]
        self.query, self.ids, self.scores = query[place < self.k], ids[kept], found[kept]
        last = place[place < self.k] == self.k - 1
        self.least[self.query[last]] = self.scores[last]


def _units(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    sizes = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(sizes > 0, sizes, 1.0)


def sparse_vectors(docs: DataFrame) -> DataFrame:
    """doc_id, token and weight: term counts divided by their length."""
    tokens = docs.select("doc_id", F.explode(F.split(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))), " ")).alias("token")).filter("token <> ''")
    counts = tokens.groupBy("doc_id", "token").agg(F.count("*").alias("tf"))
    norms = counts.groupBy("doc_id").agg(F.sqrt(F.sum((F.col("tf") * F.col("tf")).cast("double"))).alias("norm"))
    return counts.join(norms, "doc_id").select("doc_id", "token", (F.col("tf") / F.col("norm")).alias("weight"))


def sparse_search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k documents with the largest product of weights, found through shared tokens."""
    q = queries.select("query_id", "token", F.col("weight").alias("qw"))
    scored = index.join(q, "token").groupBy("query_id", "doc_id").agg(F.sum(F.col("weight") * F.col("qw")).alias("score"))
    return top_k(scored, "query_id", [F.desc(F.round("score", 9)), F.col("doc_id")], k)


def fuse_ranks(one: DataFrame, two: DataFrame, key: str, k: int) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists."""
    a, b = one.select("query_id", key, F.col("rank").alias("r1")), two.select("query_id", key, F.col("rank").alias("r2"))
    score = F.coalesce(1.0 / (RRF + F.col("r1")), F.lit(0.0)) + F.coalesce(1.0 / (RRF + F.col("r2")), F.lit(0.0))
    both = a.join(b, ["query_id", key], "full").select("query_id", key, score.alias("score"))
    return top_k(both, "query_id", [F.desc("score"), F.col(key)], k)


def boosted(score: Column, breadcrumb: Column, modality: Column, description: Column) -> Column:
    return score + F.least(0.02 * F.size(breadcrumb), F.lit(0.1)) + F.when((modality == "image") & (F.coalesce(description, F.lit("")) != ""), 0.05).otherwise(0.0)


def fuse_vectors(text: Column, image: Column) -> Column:
    """The unit mean of two vectors; the text's own where there is no image."""
    return F.when(image.isNull(), unit(text)).otherwise(unit(F.zip_with(text, image, lambda a, b: (a + b) / 2)))


def hybrid_search(dense: DataFrame, sparse: DataFrame, k: int) -> DataFrame:
    """The k best documents of two ranked lists (query_id, doc_id, rank) of 2 * k each, by reciprocal rank fusion."""
    first = lambda x: x.filter(F.col("rank") <= 2 * k)
    return fuse_ranks(first(dense), first(sparse), "doc_id", k)


def reranked(results: DataFrame, score: Column, k: int) -> DataFrame:
    """Results (query_id, rank, breadcrumb, modality, description) by score and boosts; a query's only result stays as it is."""
    n = F.count("*").over(Window.partitionBy("query_id"))
    new = F.when(n > 1, boosted(score, F.col("breadcrumb"), F.col("modality"), F.col("description"))).otherwise(F.col("score"))
    return top_k(results.withColumn("score", new).withColumnRenamed("rank", "__rank"), "query_id", [F.desc("score"), F.col("__rank")], k).drop("__rank")


def search_points(vectors: DataFrame, payload: DataFrame, queries: DataFrame, k: int, modality: str | None = None, at_least: float = 0.20, over: int = 1) -> DataFrame:
    """Search by vector within points (vec_id, modality, content) whose content has the query's keyword, or within all where none has it.

    Queries are query_id, embedding and keyword; `over` times k results are fetched, for a ranker to choose from.
    """
    points = payload if modality is None else payload.filter(F.col("modality") == modality)
    usable = vectors.join(points.select("vec_id", "content"), "vec_id")
    plain = _filtered(usable, queries, k * over, at_least)
    worded = _filtered(usable, queries.filter(F.col("keyword").isNotNull()), k * over, at_least, by_word=True)
    rest = plain.join(worded.select("query_id").distinct(), "query_id", "left_anti")
    return worded.unionByName(rest)


def _filtered(usable: DataFrame, queries: DataFrame, k: int, at_least: float, by_word: bool = False) -> DataFrame:
    if by_word and queries.select("keyword").distinct().count() > QUERY_BLOCK:
        raise ValueError(f"more than {QUERY_BLOCK} keywords in one search")
    return dense_search(usable, queries if by_word else queries.drop("keyword"), k, at_least)


def browse(points: DataFrame, page: Column | None = None, text: Column | None = None) -> DataFrame:
    """Points of a page, or with a text in them, in order: text, tables, images, then by id."""
    kind = F.when(F.col("modality") == "text", 0).when(F.col("modality") == "table", 1).when(F.col("modality") == "image", 2).otherwise(3)
    rows = points if page is None else points.filter(F.col("page_number") == page)
    rows = rows if text is None else rows.filter(F.lower("content").contains(F.lower(text)))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "page_number").orderBy(kind, "chunk_id")))


def within_budget(ranked: DataFrame, budget: int) -> DataFrame:
    """Per query the ranked rows up to the first whose tokens, a quarter of the characters, would pass the budget.

    A row's text is its content and a blank line behind it, with its breadcrumb, if it has one, on a line before.
    """
    w = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.col("breadcrumb") if "breadcrumb" in ranked.columns else F.lit(None).cast("array<string>")
    head = F.when(F.size(path) > 0, F.concat(F.lit("[Section: "), F.array_join(path, " > "), F.lit("]\n"))).otherwise(F.lit(""))
    rows = ranked.withColumn("text", F.concat(head, "content", F.lit("\n\n")))
    spent = F.sum(F.floor(F.char_length("text") / 4)).over(w)
    return rows.withColumn("spent", spent).filter(F.col("spent") <= budget)


def context_images(cross: DataFrame, plain: DataFrame, most: int = 3) -> DataFrame:
    """Per query up to `most` images (query_id, rank, asset_path), each once: those of the cross-modal search first."""
    both = cross.withColumn("__list", F.lit(0)).unionByName(plain.withColumn("__list", F.lit(1))).filter(F.coalesce("asset_path", F.lit("")) != "")
    once = both.withColumn("__n", F.row_number().over(Window.partitionBy("query_id", "asset_path").orderBy("__list", "rank"))).filter("__n = 1")
    return top_k(once.withColumnRenamed("rank", "__rank"), "query_id", [F.col("__list"), F.col("__rank"), F.col("asset_path")], most).drop("__list", "__n", "__rank")


SYSTEM_PROMPT = "You are a helpful assistant analyzing documents.\nUse the provided context to answer questions accurately.\nCite sources using [Source: filename p.X] format."


def contexts(rows: DataFrame) -> DataFrame:
    """query_id and text_context, the texts of within_budget's rows one after another."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text")))
    return rows.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text_context"))


def chat_request(context: Column, question: Column, model: str = "local-model", temperature: float = 0.3, most: int = 1024) -> Column:
    """The JSON of a text-only chat request."""
    prompt = F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question, F.lit("\n\nAnswer based on the context above. Cite specific sources."))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", prompt)).alias("messages"), F.lit(temperature).alias("temperature"), F.lit(most).alias("max_tokens")))


def stratified(rows: DataFrame, group: str, key: str, n: int, seed: str) -> DataFrame:
    """n rows of each group by a seeded hash."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))
    return top_k(rows.select(group, key, order.alias("__o")), group, [F.col("__o")], n).select(group, key)

"""Seams for models that run outside the engine: recognition, vision, embeddings, ranking.

A backend maps batches of inputs to outputs. Results are kept by the hash of the input, so a repeated run asks only for
what is new. The default backends are deterministic and need no network.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ModelBackend(Protocol):
    name: str

    def open(self) -> None: ...

    def run(self, inputs: list[str]) -> list[str | None]: ...


class EchoBackend:
    """Returns its input: recognition of what is text already."""

    name = "echo"

    def open(self) -> None:
        pass

    def run(self, inputs: list[str]) -> list[str | None]:
        return list(inputs)


class HashEmbedder:
    """Vectors from hashes of words, as numbers joined by commas."""

    name = "hash-embedder"

    def __init__(self, size: int = 64):
        self.size = size

    def open(self) -> None:
        pass

    def run(self, inputs: list[str]) -> list[str | None]:
        out = []
        for text in inputs:
            v = [0.0] * self.size
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                v[h % self.size] += 1.0 if h >> 63 else -1.0
            out.append(",".join(map(str, v)))
        return out


def input_key(model: str, value: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(model), value), 256)


def apply_model(df: DataFrame, value: str, to: str, backend: ModelBackend, known: DataFrame | None = None) -> DataFrame:
    """df with the backend's answer for each value; answers in `known` (key, answer) are taken from there.

    Each distinct input is asked once.
    """
    rows = df.withColumn("__key", input_key(backend.name, F.col(value)))
    asked = rows.filter(F.col(value).isNotNull()).select("__key", F.col(value).alias("__value")).dropDuplicates(["__key"])
    if known is not None:
        asked = asked.join(known.select(F.col("key").alias("__key")), "__key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend.open()
        for frame in frames:
            yield pd.DataFrame({"__key": frame["__key"], "__answer": pd.Series(backend.run(frame["__value"].tolist()), index=frame.index, dtype=object)})

    answers = asked.mapInPandas(run, "__key string, __answer string")
    if known is not None:
        answers = answers.unionByName(known.select(F.col("key").alias("__key"), F.col("answer").alias("__answer")))
    return rows.join(answers, "__key", "left").withColumn(to, F.col("__answer")).drop("__key", "__answer")


def best_reading(*readings: tuple[Column, Column], accept: float = 0.7) -> Column:
    """Of (text, confidence) readings in order, the first that is good enough, else the most confident."""
    structs = [F.struct(c.alias("confidence"), t.alias("text")) for t, c in readings]
    first = F.coalesce(*(F.when(c >= accept, t) for t, c in readings))
    return F.coalesce(first, F.greatest(*structs)["text"])

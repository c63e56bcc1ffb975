"""Corpus pipeline: five stages over documents, each stored before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from foliospark.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from foliospark.llm.common import crc_mod, materialize
from pyspark.sql import DataFrame, SparkSession


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the others, null and empty texts among them, have no letters or no likeliest language.

    Learns from rows with lang. Repeated rows stay, very long texts count whole, extra columns pass; an empty table stays empty.
    """
    labelled = docs.filter(crc_mod("doc_id", 5) != 0)
    model = language_id.train(labelled, public_tokenizers.path(language_id.VOCABULARY))
    return language_id.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the longest, then that of the smallest doc_id (null last), then any of rows that are the same.

    Null and empty texts are one group. Extra columns pass, whatever their names; an empty table stays empty.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Texts without words and rows without doc_id stay; of rows that repeat doc_id and text one stays. Extra columns pass; an
    empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn towards the target weights: BUDGET of the tokens, by a hash of doc_id, so repeated ids go together.

    A null source or language is a value of its own; texts without tokens are not drawn. An empty table stays empty.
    """
    return mixing.sample_to_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what was drawn, a row for each; null and empty texts have no tokens."""
    return byte_bpe.encode_digests(docs, public_tokenizers.path(byte_bpe.RANKS))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", tokenize),
]

#: Model scores, similarity joins and token ids are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

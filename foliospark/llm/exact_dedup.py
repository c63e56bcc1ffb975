"""Exact deduplication by two-pass Bloom filtering, in built-in functions only.

Pass 1 maps the digest of every text to one slot in each of two hash tables and keeps, as bitmaps, the
slots that two or more rows fell into. Pass 2 probes the bitmaps: a row that misses in either table has a
text of its own and passes straight through; only the others are shuffled by their digest. The filter grows with the
rows; where it would pass what may be broadcast, digests are dealt to segments that are filtered one after another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FILTER_BITS, bitmaps_of, by_segment, filter_bits, filter_slots, heavy_bar, materialize, probe, read_table, segment_count

#: What is deleted before texts are compared.
WHITESPACE = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """SHA-256, as binary, of the text without white space; null counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITESPACE, "").cast("binary"), 256))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, __sha, __cp (code points of the original text) and __uid (tells equal rows apart), stored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", digest(F.col("text")).alias("__sha"), F.char_length(text).alias("__cp"))
    return materialize(rows.withColumn("__uid", F.monotonically_increasing_id()), "dedup-fingerprints")


def repeated_slots(rows: DataFrame, bits: int) -> DataFrame:
    """Pass 1: the bitmaps of the slots that two or more rows share. Of a row only its two slots, 8 bytes each, are shuffled."""
    slots = rows.select(F.posexplode(F.array(*filter_slots(F.col("__sha"), bits))).alias("__table", "__slot"))
    return bitmaps_of(slots.groupBy("__table", "__slot").count().filter("count > 1"))


def flag_repeats(rows: DataFrame, total: int, max_bits: int, label: str) -> DataFrame:
    """Both passes: adds __maybe, false only where no other row has the same __sha.

    The filter's size follows the rows; beyond max_bits it is made and probed segment by segment of the digests.
    """
    bits, sha = filter_bits(total, max_bits), F.col("__sha")
    return by_segment(rows, sha, segment_count(total, max_bits), lambda own, _: probe(own, sha, repeated_slots(own, bits), bits, "__maybe"), label)


def repeated_groups(candidates: DataFrame) -> DataFrame:
    """Of each text that two or more rows have: __sha, __size and __best, the row that stays."""
    order = F.struct((-F.col("__cp")).alias("cp"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("__uid").alias("uid"))
    return candidates.groupBy("__sha").agg(F.count("*").alias("__size"), F.min(order).alias("__best")).filter("__size > 1")


def _join_groups(candidates: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Left join by __sha. Texts with a large share of the rows are few and broadcast; the others shuffle."""
    bar = heavy_bar(total)
    heavy, light = groups.filter(F.col("__size") >= bar), groups.filter(F.col("__size") < bar)
    of_heavy = candidates.join(F.broadcast(heavy), "__sha")
    of_light = candidates.join(F.broadcast(heavy.select("__sha")), "__sha", "left_anti").join(light, "__sha", "left")
    return of_heavy.unionByName(of_light)


def exact_duplicates(docs: DataFrame, max_bits: int = FILTER_BITS) -> DataFrame:
    """For every row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space. The row with the most code points stays,
    then the smallest doc_id, a null doc_id last, then any one of rows that are the same throughout. A null
    text is an empty one, and all empty texts are one group. Very long texts count whole. Other columns of docs,
    whatever their names, are not read. An empty table gives no rows.
    """
    rows = fingerprints(docs)
    total = rows.count()
    flagged = flag_repeats(rows, total, max_bits, "dedup-flagged")
    candidates = flagged.filter("__maybe")
    groups = materialize(repeated_groups(candidates), "dedup-groups")
    joined = _join_groups(candidates, groups, total).select("doc_id", "__sha", "__uid", "__size", "__best")
    alone = flagged.filter(~F.col("__maybe")).select("doc_id", "__sha", "__uid", F.lit(None).cast("long").alias("__size"), F.lit(None).cast(groups.schema["__best"].dataType).alias("__best"))
    single = F.col("__size").isNull()
    return joined.unionByName(alone).select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("__best.doc_id")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("__best.uid") == F.col("__uid"))).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, max_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with docs' columns, whatever their names.

    Rows that miss in the filter are never shuffled; of the others those that stay are told by digest,
    length and doc_id.
    """
    prints = fingerprints(docs)
    total = prints.count()
    bits, segments, sha = filter_bits(total, max_bits), segment_count(total, max_bits), F.col("__sha")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("__row"), digest(F.col("text")).alias("__sha"), F.char_length(text).alias("__cp"), F.col("doc_id").alias("__id"))
    if segments == 1:
        bitmaps = repeated_slots(prints, bits)
        flagged, thin = probe(rows, sha, bitmaps, bits, "__maybe"), probe(prints, sha, bitmaps, bits, "__maybe")
    else:  # the rows are stored by segment once and each segment has a filter of its own
        flagged = flag_repeats(rows, total, max_bits, "dedup-rows")
        thin = flagged.select(F.col("__id").alias("doc_id"), "__sha", "__cp", F.lit(0).alias("__uid"), "__maybe")
    groups = materialize(repeated_groups(thin.filter("__maybe")), "dedup-groups")
    joined = _join_groups(flagged.filter("__maybe"), groups, total)
    alone = joined.filter(F.col("__size").isNull()).select("__row")
    best = joined.filter((F.col("__best.doc_id").eqNullSafe(F.col("__id"))) & (-F.col("__best.cp") == F.col("__cp")))
    once = best.dropDuplicates(["__sha"]).select("__row")
    return flagged.filter(~F.col("__maybe")).select("__row").unionByName(alone).unionByName(once).select("__row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha
  FROM documents),
r AS (
  SELECT doc_id, sha, count(*) OVER (PARTITION BY sha) AS n,
         first_value(doc_id) OVER (PARTITION BY sha ORDER BY cp DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY sha ORDER BY cp DESC, doc_id) AS place
  FROM d)
SELECT doc_id, keep_id, n::BIGINT AS group_size, place = 1 AS kept, sha AS text_sha256 FROM r
"""

QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLES = {"op5_exact_dedup": ORACLE}

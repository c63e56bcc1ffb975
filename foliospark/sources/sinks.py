"""Sinks: chunk files with document headers, search tables and clean-up lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import ids as I
from ..functions import predicates as P
from ..functions import text as T
from ..functions.classify import vision_status

SCHEMA_VERSION = "2.7.0"
LONGEST_PAYLOAD = 10_000


def export_fields(chunks: DataFrame) -> DataFrame:
    """Chunks fit to write: clean content, headings of at most 80 characters, boxes on the grid, priority and status set."""
    content = T.drop_controls(F.col("content"))
    box = F.when(F.col("bbox").isNotNull(), G.ensure_normalised(F.col("bbox"), F.col("page_width"), F.col("page_height"))).when(
        F.col("modality").isin("image", "table"), F.array(*(F.lit(v) for v in (0, 0, 1000, 1000)))
    )
    return chunks.withColumns(
        {
            "content": content,
            "parent_heading": F.when(F.char_length("parent_heading") <= 80, F.col("parent_heading")),
            "breadcrumb": F.filter("breadcrumb", lambda x: F.char_length(x) <= 80),
            "bbox": box,
            "search_priority": F.when(P.is_boilerplate(content), "low").otherwise(F.col("search_priority")),
            "refined_content": F.when(F.col("modality") == "text", F.coalesce("refined_content", content)).otherwise(F.col("refined_content")),
            "vision_status": F.when(F.col("modality") == "image", vision_status(F.col("description"))),
        }
    )


def headers(chunks: DataFrame) -> DataFrame:
    """A header row for each document, with the number of chunks that are written."""
    return chunks.groupBy("doc_id").agg(F.count("*").alias("chunk_count"), F.max("page_number").alias("total_pages")).withColumns(
        {"object_type": F.lit("ingestion_metadata"), "schema_version": F.lit(SCHEMA_VERSION)}
    )


def write_jsonl(chunks: DataFrame, path: str) -> None:
    """JSON lines by document, the header first; the commit protocol makes the write atomic."""
    rows = headers(chunks).select("doc_id", F.lit(-1).cast("long").alias("pos"), F.to_json(F.struct("object_type", "doc_id", "schema_version", "total_pages", "chunk_count")).alias("value"))
    body = chunks.select("doc_id", "pos", F.to_json(F.struct(*[c for c in chunks.columns if c != "pos"])).alias("value"))
    both = rows.unionByName(body).repartition("doc_id").sortWithinPartitions("doc_id", "pos")
    both.select("value").write.text(path)


def payload(chunks: DataFrame, source: str = "source_file") -> DataFrame:
    """Points of a search table: a stable id and the fields that a search returns."""
    content = F.substring(F.coalesce("refined_content", "content"), 1, LONGEST_PAYLOAD)
    return chunks.select(I.point_id(F.coalesce("chunk_id", F.concat_ws("#", source, F.col("pos").cast("string")))).alias("point_id"), "doc_id", "page_number", "modality", content.alias("content"))


def last_by_id(points: DataFrame, version: Column) -> DataFrame:
    """One point of each id, the one of the highest version, of equal versions the last by its fields: what repeated upserts leave."""
    ties = [F.col(c).desc() for c in points.columns if c != "point_id"]
    w = Window.partitionBy("point_id").orderBy(version.desc(), *ties)
    return points.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def unwritten(docs: DataFrame, chunks: DataFrame, written: DataFrame) -> DataFrame:
    """Documents of which some chunk is not in the table yet: what a resumed rebuild has to do."""
    missing = chunks.join(written.select("chunk_id"), "chunk_id", "left_anti").select("doc_id").distinct()
    return docs.join(missing, "doc_id", "left_semi")


def orphans(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Files that no chunk refers to."""
    return files.join(chunks.select(F.col("asset_path").alias("path")).distinct(), "path", "left_anti")

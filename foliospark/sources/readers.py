"""Sources: tables, formats, HTML, JSON lines and page selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Formats by file name ending (fixed values).
ENDINGS = {"pdf": "pdf", "epub": "epub", "html": "html", "htm": "html", "xhtml": "html", "docx": "docx", "pptx": "pptx", "xlsx": "xlsx", "md": "markdown", "txt": "text"}
HIERARCHY = T.StructType([T.StructField("parent_heading", T.StringType()), T.StructField("breadcrumb_path", T.ArrayType(T.StringType())), T.StructField("level", T.IntegerType())])
CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("object_type", T.StringType()), T.StructField("chunk_id", T.StringType()), T.StructField("doc_id", T.StringType()), T.StructField("modality", T.StringType()),
        T.StructField("content", T.StringType()), T.StructField("schema_version", T.StringType()), T.StructField("contextualized_text", T.StringType()),
        T.StructField("metadata", T.StructType([
            T.StructField("source_file", T.StringType()), T.StructField("page_number", T.IntegerType()), T.StructField("chunk_type", T.StringType()), T.StructField("hierarchy", HIERARCHY),
            T.StructField("extraction_method", T.StringType()), T.StructField("search_priority", T.StringType()), T.StructField("refined_content", T.StringType()), T.StructField("document_domain", T.StringType()),
        ])),
        T.StructField("total_pages", T.IntegerType()), T.StructField("chunk_count", T.LongType()), T.StructField("_corrupt_record", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder with their content, by name pattern."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


#: Formats by MIME type (fixed values).
MIME_TYPES = {
    "application/pdf": "pdf", "application/epub+zip": "epub", "text/html": "html", "application/xhtml+xml": "html", "text/markdown": "markdown", "text/plain": "text",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
}


def _named(key: Column, table: dict[str, str]) -> Column:
    found = F.lit(None).cast("string")
    for name, kind in table.items():
        found = F.when(key == name, kind).otherwise(found)
    return found


def format_of(content: Column, path: Column, mime: Column | None = None, strict: bool = False) -> Column:
    """Format by the first bytes, then by the names within a ZIP, then by the file name, then by the MIME type; `unknown`, or an error if strict, else."""
    head = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.substring(content, 1, 400).cast("string"))
    inside = content.cast("string")
    zipped = head.startswith("504B0304")
    by_bytes = (
        F.when(head.startswith("25504446"), "pdf").when(zipped & inside.contains("mimetypeapplication/epub+zip"), "epub").when(zipped & inside.contains("word/"), "docx")
        .when(zipped & inside.contains("ppt/"), "pptx").when(zipped & inside.contains("xl/"), "xlsx").when(text.rlike(r"^\s*(<!doctype html|<html)"), "html")
    )
    by_name = _named(F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)), ENDINGS)
    by_type = F.lit(None).cast("string") if mime is None else _named(F.lower(F.trim(F.split(mime, ";")[0])), MIME_TYPES)
    other = F.raise_error(F.concat(F.lit("no format for "), F.coalesce(path, F.lit("a file")))).cast("string") if strict else F.lit("unknown")
    return F.coalesce(by_bytes, by_name, by_type, other)


_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments and tags; blocks are lines and white space is single."""
    x = F.regexp_replace(html, r"(?is)<(script|style|svg|noscript)\b[^>]*>.*?</\1\s*>", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?i)</?(p|div|li|ul|ol|table|tr|h[1-6]|section|article|header|footer|nav|br|title)\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"<[^>]*>", " ")
    for name, char in _ENTITIES:
        x = F.replace(x, F.lit(name), F.lit(char))
    x = F.regexp_replace(F.regexp_replace(x, r"[ \t\r\f]+", " "), r" ?\n[ \n]*", "\n")
    return F.trim(F.trim(x), F.lit("\n"))


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def select_pages(chunks: DataFrame, most: int | None = None, also: tuple[int, ...] = ()) -> DataFrame:
    """Pages up to a number, or of a list, or both."""
    keep = F.lit(most is None and not also)
    if most is not None:
        keep = keep | (F.col("page_number") <= most)
    if also:
        keep = keep | F.col("page_number").isin(*also)
    return chunks.filter(keep)


def read_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks, document headers and lines that are no JSON, of files of JSON lines."""
    rows = spark.read.schema(CHUNK_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    header = F.col("object_type") == "ingestion_metadata"
    bad = rows.filter(F.col("_corrupt_record").isNotNull() & F.col("chunk_id").isNull() & ~F.coalesce(header, F.lit(False)))
    return rows.filter(F.col("chunk_id").isNotNull()).drop("_corrupt_record"), rows.filter(header).select("doc_id", "schema_version", "total_pages", "chunk_count"), bad

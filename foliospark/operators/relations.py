"""Base relations: pages and chunks of documents."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a synthetic page of a plain text.
LINES_PER_PAGE = 8


def chunks_of(docs: DataFrame, lines_per_page: int = LINES_PER_PAGE) -> DataFrame:
    """A chunk for each line: doc_id, lang, source, pos (from 0), page_number (from 1) and content."""
    lines = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "content"))
    return lines.select(
        "doc_id", "lang", "source", F.col("pos").cast("long").alias("pos"), (F.floor(F.col("pos") / lines_per_page) + 1).cast("int").alias("page_number"), "content"
    )


def pages_of(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id", "page_number").agg(F.sum(F.char_length("content")).cast("long").alias("chars"), F.count("*").alias("n_chunks"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder of the session (spark.checkpoint.dir), so a lost executor costs no round anew."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="foliospark-")
        context.setCheckpointDir(root)
    return df.checkpoint()

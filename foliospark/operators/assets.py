"""Filters of images and of corrupted text, and rules about pages that only images cover."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P


def quarantined(chunks: DataFrame) -> DataFrame:
    """Chunks without text that is mostly artifacts; whole-page rescues of contents and indexes stay."""
    rescued = F.coalesce(F.col("extraction_method").startswith("hybrid_chunker_pageskip"), F.lit(False))
    bad = (F.col("modality") == "text") & ~rescued & P.is_corrupt(F.coalesce("content", F.lit("")))
    return chunks.filter(~F.coalesce(bad, F.lit(False)))


def with_visuals(images: DataFrame) -> DataFrame:
    """Images but those of which the description says that nothing but text was seen."""
    return images.filter(~F.lower(F.coalesce("description", F.lit(""))).contains(P.NO_VISUALS))


def is_blank_asset(mean: Column, spread: Column) -> Column:
    """Almost white or almost black grey values that hardly differ."""
    return F.coalesce((spread < 10) & ((mean > 250) | (mean < 5)), F.lit(False))


def large_enough(width: Column, height: Column, least: int = 50) -> Column:
    return F.coalesce((width >= least) & (height >= least), F.lit(False))


def worth_extracting(width: Column, height: Column, area_share: Column, page_is_bare: Column) -> Column:
    """An image of the page behind the layout counts from 300 by 300 on, 200 by 200 on a page without chunks, or from 40 % of the page."""
    size = F.when(page_is_bare, 200).otherwise(300)
    return F.coalesce(((width >= size) & (height >= size)) | (area_share >= 0.40), F.lit(False))


def keep_for_coverage(images: DataFrame, covered: DataFrame) -> DataFrame:
    """Images (doc_id, page_number, image_id, repeated) that stay: all that repeat none, and of a page that has no text or table
    (covered: doc_id, page_number) and no image of its own the first repeated one."""
    bare = images.join(covered.select("doc_id", "page_number").distinct().withColumn("__c", F.lit(True)), ["doc_id", "page_number"], "left")
    page = Window.partitionBy("doc_id", "page_number")
    own = F.max((~F.col("repeated")).cast("int")).over(page)
    first = F.row_number().over(page.orderBy(F.col("repeated"), "image_id"))
    kept = ~F.col("repeated") | (F.col("page_number").isNotNull() & F.col("__c").isNull() & (F.col("__own") == 0) & (F.col("__first") == 1))
    return bare.withColumns({"__own": own, "__first": first}).filter(kept).drop("__c", "__own", "__first")


#: How descriptions begin that no model gave, and those that stand for a failed one (fixed values).
PLACEHOLDERS = ("Image region from page", "[Figure on page", "Image extraction unavailable")
HARD_FALLBACKS = ("Dense typographic layout", "[VLM_FAILED", "Visual element (VLM description unavailable)")


def description_kind(description: Column) -> Column:
    """empty, placeholder (no model was asked), hard_fallback or described."""
    begins = lambda words: reduce(lambda a, b: a | b, (description.startswith(w) for w in words))
    return F.when(F.trim(F.coalesce(description, F.lit(""))) == "", "empty").when(begins(PLACEHOLDERS), "placeholder").when(begins(HARD_FALLBACKS), "hard_fallback").otherwise("described")


def vision_summary(images: DataFrame) -> DataFrame:
    """Images by kind of description and vision_status (unknown where there is none), with their share of all."""
    rows = images.groupBy(description_kind(F.col("description")).alias("kind"), F.coalesce("vision_status", F.lit("unknown")).alias("vision_status")).agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def front_matter(chunks: DataFrame, images: DataFrame) -> DataFrame:
    """parent_heading becomes `Front Matter` on pages with images before the first chapter.

    A page counts if it has an image from the layout or from behind it (extraction_method docling or shadow); without any
    chapter heading one must be described as a cover or the like. Headings of chapters and numbered sections stay.
    """
    chapter = r"(?i)(?:^|\b)(?:chapter|chapitre|hoofdstuk|teil)\s+[A-Za-z0-9ivxlcdm]+|^\s*\d+(?:\.\d+)*\s+\S"
    strong = r"(?i)cover|logo|publisher|portrait|illustration|sketch|ornament|decoration|title page"
    shown = images.filter((F.col("page_number") > 0) & F.lower("extraction_method").isin("docling", "shadow")).groupBy("doc_id", "page_number").agg(F.max(F.coalesce("description", F.lit("")).rlike(strong)).alias("__strong"))
    line = F.element_at(F.split(F.trim(F.coalesce("content", F.lit(""))), "\n", -1), 1)
    rows = chunks.withColumn("__h", F.trim(F.when(F.coalesce("parent_heading", F.lit("")) != "", F.col("parent_heading")).otherwise(line)))
    rows = rows.withColumn("__chapter", F.col("__h").rlike(chapter))
    first = F.min(F.when(F.col("__chapter") & (F.col("page_number") > 0), F.col("page_number"))).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("__first", first).join(shown, ["doc_id", "page_number"], "left")
    front = F.col("__strong").isNotNull() & F.when(F.col("__first").isNull(), F.col("__strong")).otherwise(F.col("page_number") < F.col("__first")) & (F.col("__h") != "") & ~F.col("__chapter")
    return rows.withColumn("parent_heading", F.when(F.coalesce(front, F.lit(False)), "Front Matter").otherwise(F.col("parent_heading"))).select(*chunks.columns)

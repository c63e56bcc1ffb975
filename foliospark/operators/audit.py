"""Audits of converted documents: counters in one pass, ratios, thresholds and verdicts.

Rows are chunks with doc_id, pos, page_number, modality, content and, as far as they are known, chunk_type,
content_class, parent_heading, breadcrumb, bbox, page_width, page_height, description, vision_status, vision_error,
vision_provider, refined_content and schema_version. Missing columns count as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import strip_text

#: What the audit takes for faulty encoding and for the beginning of a caption (fixed values).
ARTIFACTS = r"/C\d{1,3}|/uni[A-F0-9]{4,}|\x{FFFD}"
CAPTION_HEADING = r"^(?:this chapter covers|\(continued\)|listing \d[\d.]*\b|figure \d[\d.]*\b|table \d[\d.]*\b|example \d[\d.-]*\.)"
PLACEHOLDER_IMAGE = r"(?i)^\s*(?:\[figure on page|\[image|\[vlm_failed|figure on page)"
#: A list number within a sentence: not behind a line's or sentence's beginning, nor beside words of ranges (fixed values).
INFIX = (
    r"(?<![\n\r])(?<!^)(?<!(?:[.:;!?] ))\b(?!(?:bis|to|from|through|vom|von|and|or)\s)[a-z][a-z'\-]{1,24}[^\S\n]+(?:[1-9]|[12]\d|3\d|40)\.\s+"
    r"(?!(?:bis|to|through)\b)[a-z][A-Za-z'\-]+"
)
_TYPES = {
    "doc_id": "long", "pos": "long", "page_number": "int", "modality": "string", "content": "string", "chunk_type": "string", "content_class": "string", "parent_heading": "string",
    "breadcrumb": "array<string>", "bbox": "array<int>", "page_width": "int", "page_height": "int", "description": "string", "vision_status": "string", "vision_error": "string",
    "vision_provider": "string", "refined_content": "string", "schema_version": "string",
}


def known(rows: DataFrame) -> DataFrame:
    """The rows with all columns of an audit; those that are missing are null."""
    return rows.withColumns({k: F.lit(None).cast(t) for k, t in _TYPES.items() if k not in rows.columns})


def is_code() -> Column:
    return F.coalesce(F.lower("chunk_type") == "code", F.lit(False)) | F.coalesce(F.lower("content_class") == "code", F.lit(False))


def _typed() -> Column:
    return is_code() | F.coalesce(F.lower("chunk_type").isin("heading", "title"), F.lit(False))


def documented_fallback() -> Column:
    """A hard fallback with its error and provider on record: no missing description."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.coalesce(F.col("vision_status") == "hard_fallback", F.lit(False)) & filled("vision_error") & filled("vision_provider")


def with_orphans(text: DataFrame, kind: str) -> DataFrame:
    """Adds label, orphan (no running text among the next four rows on this page or the following one) and risky (a label at a
    page's end, before 40 characters or more of running text)."""
    rows = text.withColumn("label", P.is_label(F.col("content"), kind))
    w = Window.partitionBy("doc_id").orderBy("pos")
    # 20 characters of each row tell whether it is running text, so frames of the window stay small
    size = F.char_length(strip_text(F.coalesce("content", F.lit(""))))
    rows = rows.withColumn("__size", size)
    near = F.collect_list(F.struct("page_number", "__size", "label")).over(w.rowsBetween(1, 4))
    attached = F.exists(near, lambda x: x["page_number"].between(F.col("page_number"), F.col("page_number") + 1) & (x["__size"] >= 20) & ~x["label"])
    risky = F.col("label") & (F.lead("page_number").over(w) == F.col("page_number") + 1) & (F.lead("__size").over(w) >= 40) & ~F.lead("label").over(w)
    return rows.withColumn("orphan", F.col("label") & ~attached).withColumn("risky", F.coalesce(risky, F.lit(False))).drop("__size")


def counters(rows: DataFrame, kind: str = "audit") -> DataFrame:
    """One row of counts for each document."""
    rows = known(rows)
    text = with_orphans(rows.filter("modality = 'text'"), kind)
    c = F.coalesce("content", F.lit(""))
    n = F.char_length(c)
    head = F.col("parent_heading")
    like = P.code_lines(c)
    lines = P.lines_of(c)
    indented = F.exists(lines, lambda x: x.rlike(r"^(?: {4}|\t)")) | c.contains(">>>") | c.rlike(r"(?md)^\s*\.\.\.\s")
    control = F.regexp_count(c, F.lit(r"[\x00-\x08\x0B-\x1F\x7F]"))
    titled = F.coalesce(head, F.lit("")) != ""
    of_text = text.groupBy("doc_id").agg(
        F.count("*").alias("text_chunks"), F.sum(n).alias("text_chars"), F.max(n).alias("longest"), F.count_if(n < 30).alias("micro"),
        F.count_if((n < 30) & ~F.col("label") & ~_typed()).alias("micro_non_label"), F.count_if(n > 1500).alias("oversize"), F.count_if("label").alias("labels"), F.count_if("orphan").alias("orphans"),
        F.count_if("risky").alias("risky_labels"), F.count_if(control > 0).alias("control_chunks"), F.sum(control).alias("controls"), F.count_if(c.rlike(r"(?md)^\s*\d{1,4}\s*$")).alias("page_number_chunks"),
        F.sum(F.when(is_code(), 0).otherwise(F.regexp_count(c, F.lit(INFIX)))).alias("infix"), F.count_if(F.coalesce("chunk_type", F.lit("")) == "").alias("untyped"), F.count_if(c == "").alias("empty"),
        F.count_if(c.rlike(ARTIFACTS)).alias("artifacts"), F.count_if(is_code()).alias("code"), F.count_if(is_code() & ~c.contains("\n")).alias("code_flat"), F.count_if(is_code() & indented).alias("code_indented"),
        F.count_if(like).alias("code_like"), F.count_if(like & ~is_code() & (F.char_length(strip_text(c)) < 80)).alias("code_fragments"), F.count_if(titled).alias("titled"), F.count_distinct(F.when(titled, head)).alias("headings"),
        F.count_if(F.char_length(head) > 80).alias("long_headings"), F.count_if((F.regexp_count(head, F.lit(r"\. ")) > 1) | (F.regexp_count(head, F.lit(r"\.\n")) > 1)).alias("sentence_headings"),
        F.count_if(F.lower(strip_text(F.coalesce(head, F.lit("")))).rlike(CAPTION_HEADING)).alias("caption_headings"),
    )
    image, table = F.col("modality") == "image", F.col("modality") == "table"
    stub = P.is_placeholder(F.coalesce("content", F.lit("")))
    described = F.coalesce("description", F.lit("")) != ""
    of_all = rows.groupBy("doc_id").agg(
        F.count("*").alias("chunks"), F.count_if(image).alias("image_chunks"), F.count_if(table).alias("table_chunks"), F.count_if(F.coalesce("modality", F.lit("")) == "").alias("no_modality"),
        F.count_if(image & stub & ~documented_fallback()).alias("image_stubs"), F.count_if(image & described).alias("images_described"), F.count_if(table & stub).alias("table_stubs"),
        F.count_if(table & P.is_markdown_table(F.col("content"))).alias("table_markdown"), F.count_if(F.col("bbox").isNotNull() & ~_fits("bbox")).alias("bad_boxes"),
        F.count_if(F.col("bbox").isNotNull() & (F.coalesce("page_width", F.lit(0)) * F.coalesce("page_height", F.lit(0)) == 0)).alias("boxes_without_page"), F.max("page_number").alias("last_page"),
    )
    zero = [x for x in of_text.columns if x != "doc_id"]
    return of_all.join(of_text, "doc_id", "left").fillna(0, zero)


def _fits(box: str) -> Column:
    b = lambda k: F.get(box, k)
    return F.coalesce((F.size(box) == 4) & F.forall(box, lambda x: x.between(0, 1000)) & (b(2) > b(0)) & (b(3) > b(1)), F.lit(False))


def _ratio(a: str, b: str, none: float = 0.0) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(none))


def document_class(rows: DataFrame) -> DataFrame:
    """doc_id and class of each document: that of its most frequent modality, else by votes, else by the ways of extraction.

    Rows have document_modality and extraction_method. Of equally frequent modalities the one that comes first counts.
    """
    m, e = F.lower(F.trim(F.coalesce("document_modality", F.lit("")))), F.lower(F.trim(F.coalesce("extraction_method", F.lit(""))))
    counts = rows.filter(m != "").groupBy("doc_id", m.alias("m")).agg(F.count("*").alias("n"), F.min("pos").alias("at"))
    digital = F.col("m").isin("native_digital", "image_heavy")
    top = counts.groupBy("doc_id").agg(
        F.min_by("m", F.struct((-F.col("n")).alias("n"), "at")).alias("top"), F.sum(F.when(F.col("m").startswith("scanned"), F.col("n")).otherwise(0)).alias("scanned"), F.sum(F.when(digital, F.col("n")).otherwise(0)).alias("digital")
    )
    methods = rows.groupBy("doc_id").agg(F.count_if(e.contains("ocr")).alias("ocr"), F.count_if(e == "docling").alias("layout"))
    both = methods.join(top, "doc_id", "left")
    by_votes = F.when(F.col("top").startswith("scanned"), "scanned").when(F.col("top").isin("native_digital", "image_heavy"), "digital").when(F.col("scanned") > F.col("digital"), "scanned").when(F.col("digital") > 0, "digital")
    return both.select("doc_id", F.coalesce(by_votes, F.when(F.col("ocr") > F.col("layout"), F.lit("scanned")).otherwise("digital")).alias("doc_class"))


def content_type(counts: DataFrame) -> Column:
    share = _ratio("code", "text_chunks")
    return F.when(F.col("text_chunks") == 0, "non_code").when(share >= 0.15, "code_heavy").when(F.col("code") >= 3, "mixed_prose").otherwise("non_code")


def _limits(profile: Column, doc_class: Column) -> tuple[Column, Column, Column]:
    """Most short chunks, oversize chunks and orphaned labels, as shares (fixed values)."""
    digital = doc_class == "digital"
    micro = F.when(digital & ~profile.isin("digital_magazine", "academic_whitepaper"), 0.12).otherwise(0.22)
    orphan = F.when(digital & (profile == "academic_whitepaper"), 0.65).when(digital, 0.25).otherwise(0.30)
    return micro, F.when(digital, 0.01).otherwise(0.02), orphan


def report(counts: DataFrame, version: str, versions: DataFrame | None = None, residues: bool = True) -> DataFrame:
    """doc_id, content_type, fails (the sections that fail) and verdict, from counters with profile, doc_class and is_form.

    Unless residues, list numbers within sentences and control characters are no failure.
    """
    rows = counts.withColumn("content_type", content_type(counts))
    micro, oversize, orphan = _limits(F.col("profile"), F.col("doc_class"))
    form = F.col("is_form")
    images, tables = F.col("image_chunks") > 0, F.col("table_chunks") > 0
    stubs, described = _ratio("image_stubs", "image_chunks"), _ratio("images_described", "image_chunks", 1.0)
    short = ~form & (_ratio("micro_non_label", "text_chunks") > micro)
    heavy = F.col("content_type") == "code_heavy"
    sections = {
        "STRUCTURAL": (F.col("untyped") > 0) | (F.col("bad_boxes") > 0) | (F.col("empty") > 0) | (F.col("no_modality") > 0) | (F.col("boxes_without_page") > 0),
        "IMAGE": images & (stubs < 1.0) & ((stubs > 0.20) | (described < 0.80)),
        "TABLE": tables & ((_ratio("table_stubs", "table_chunks") > 0.20) | (_ratio("table_markdown", "table_chunks") < 0.80)),
        "TEXT": (F.col("artifacts") >= 5) | (F.lit(residues) & ((F.col("infix") > 0) | (F.col("control_chunks") > 0))) | short | (~form & (_ratio("oversize", "text_chunks") > oversize)),
        "CODE": heavy & (((F.col("code") >= 3) & ((_ratio("code_flat", "code") > 0.35) | (_ratio("code_indented", "code", 1.0) < 0.90))) | ((F.col("code_like") >= 3) & (_ratio("code_fragments", "code_like") > 0.05))),
        "LABEL": ~form & (F.col("labels") >= 5) & (_ratio("orphans", "labels") > orphan),
        "HEADING": ~form & ((F.col("long_headings") > 0) | (F.col("sentence_headings") > 0) | (F.col("caption_headings") > 0) | (F.col("titled") / F.greatest(F.col("text_chunks"), F.lit(1)) < 0.80)),
    }
    if versions is not None:
        rows = rows.join(versions.select("doc_id", (F.col("schema_version") != version).alias("__other")), "doc_id", "left")
        sections["SCHEMA"] = F.coalesce("__other", F.lit(False))
    fails = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(k)) for k, bad in sections.items())), lambda x: x.isNotNull())
    name = F.when(form, "FORM_AUDIT").otherwise("AUDIT")
    return rows.withColumn("fails", fails).select("doc_id", "content_type", "fails", F.concat(name, F.when(F.size("fails") == 0, "_PASS").otherwise("_FAIL")).alias("verdict"))


def is_form(counts: DataFrame) -> Column:
    """A short scanned document with almost no headings."""
    return F.col("total_pages").between(1, 5) & (F.col("doc_class") == "scanned") & (_ratio("titled", "text_chunks") < 0.10)


def manual_gate(counts: DataFrame, residues: bool = True) -> DataFrame:
    """doc_id, fails and verdict of a manual's limits, from counters with profile, doc_class and total_pages.

    Unless residues, list numbers within sentences are no failure.
    """
    micro, oversize, orphan = _limits(F.col("profile"), F.col("doc_class"))
    form = is_form(counts)
    orphans = F.when(F.col("labels") >= 5, _ratio("orphans", "labels")).otherwise(0.0)
    digital = F.col("doc_class") == "digital"
    checks = {
        "infix_strict": F.lit(residues) & (F.col("infix") > 0),
        "micro_non_label_ratio": ~form & (_ratio("micro_non_label", "text_chunks") > micro),
        "oversize_ratio": _ratio("oversize", "text_chunks") > F.when(form, 0.02).otherwise(oversize),
        "orphan_label_ratio": ~form & (orphans > orphan),
        "code_fragmentation_ratio": ~form & digital & (_ratio("code_fragments", "code_like") > 0.05),
    }
    return _checked(counts, checks, "GATE")


def fidelity_gate(counts: DataFrame) -> DataFrame:
    """doc_id, the ratios of images, tables, code and labels, fails and verdict."""
    ratios = {
        "image_stub_ratio": _ratio("image_stubs", "image_chunks"), "image_coverage": _ratio("images_described", "image_chunks", 1.0), "table_stub_ratio": _ratio("table_stubs", "table_chunks"),
        "table_markdown_ratio": _ratio("table_markdown", "table_chunks", 1.0), "code_flat_ratio": _ratio("code_flat", "code"), "code_fidelity": _ratio("code_indented", "code", 1.0), "risk_ratio": _ratio("risky_labels", "text_chunks"),
    }
    rows = counts.withColumns(ratios)
    images, tables, code = F.col("image_chunks") > 0, F.col("table_chunks") > 0, F.col("code") >= 3
    checks = {
        "image_placeholder_ratio": F.col("image_stub_ratio") > 0.20, "image_description_coverage": images & (F.col("image_coverage") < 0.80), "table_placeholder_ratio": tables & (F.col("table_stub_ratio") > 0.20),
        "table_markdown_ratio": tables & (F.col("table_markdown_ratio") < 0.80), "code_flat_ratio": code & (F.col("code_flat_ratio") > 0.35), "code_indentation_fidelity": code & (F.col("code_fidelity") < 0.90),
        "cross_page_label_anchor_risk_ratio": F.col("risk_ratio") > 0.10,
    }
    return _checked(rows, checks, "SEMANTIC", *ratios)


def _checked(rows: DataFrame, checks: dict[str, Column], name: str, *more: str) -> DataFrame:
    fails = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(k)) for k, bad in checks.items())), lambda x: x.isNotNull())
    return rows.withColumn("fails", fails).select("doc_id", *more, "fails", F.when(F.size("fails") == 0, f"{name}_PASS").otherwise(f"{name}_FAIL").alias("verdict"))

"""Quality gates: violations as issue rows (doc_id, severity, code, n) and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.classify import asset_complexity
from ..functions.text import strip_text
from .audit import PLACEHOLDER_IMAGE, documented_fallback, known
from .dedup import repeated_long_texts

#: Codes of warnings that a release may have, two of them on conditions (fixed values).
ADVISORIES = ("ASSET_TINY", "PAGE_COUNT_UNKNOWN", "SCRIPT_ADVISORY_FAIL", "VISION_HARD_FALLBACK_RATE", "MISSING_CHAPTERS")
SHORT_ANSWER = "complex_asset_short_response_after_retry"
EDGE_CHAPTER = "edge low-content structural spine item"


def issue(df: DataFrame, severity: str, code: str, n="n") -> DataFrame:
    return df.select("doc_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col(n).cast("long").alias("n"))


def missing_pages(chunks: DataFrame, totals: DataFrame, blank: DataFrame | None = None, allow_missing: bool = False) -> DataFrame:
    """Pages from 1 to total_pages without a chunk: FAIL, or WARN where that is allowed; INFO for blank ones (doc_id, page_number).

    A document whose number of pages is unknown or 0 gets PAGE_COUNT_UNKNOWN.
    """
    known = F.coalesce("total_pages", F.lit(0)) > 0
    want = totals.filter(known).select("doc_id", F.explode(F.sequence(F.lit(1), F.col("total_pages"))).alias("page_number"))
    gone = want.join(chunks.select("doc_id", "page_number").distinct(), ["doc_id", "page_number"], "left_anti")
    if blank is None:
        gone = gone.withColumn("blank", F.lit(False))
    else:
        gone = gone.join(blank.select("doc_id", "page_number", F.lit(True).alias("blank")).distinct(), ["doc_id", "page_number"], "left").withColumn("blank", F.coalesce("blank", F.lit(False)))
    sums = gone.groupBy("doc_id", "blank").agg(F.count("*").alias("n"))
    severity = F.when(F.col("blank"), "INFO").otherwise("WARN" if allow_missing else "FAIL")
    rows = sums.select("doc_id", severity.alias("severity"), F.when(F.col("blank"), "MISSING_PAGES_BLANK").otherwise("MISSING_PAGES").alias("code"), "n")
    return rows.unionByName(issue(totals.filter(~known).withColumn("n", F.lit(1)), "WARN", "PAGE_COUNT_UNKNOWN"))


def invariants(chunks: DataFrame) -> DataFrame:
    """Issues that no conversion may have, for chunks as audit.known describes them: untyped or empty text, no modality, boxes off the
    grid, texts that a page repeats, text beyond repair (FAIL); boxes without a page size (WARN)."""
    rows = known(chunks)
    c = strip_text(F.coalesce("content", F.lit("")))
    text = F.coalesce(F.col("modality") == "text", F.lit(False))
    box = F.col("bbox")
    fits = (F.size(box) == 4) & F.forall(box, lambda x: x.between(0, 1000)) & (F.get(box, 2) > F.get(box, 0)) & (F.get(box, 3) > F.get(box, 1))
    per_doc = rows.groupBy("doc_id").agg(
        F.count_if(text & (F.coalesce("chunk_type", F.lit("")) == "")).alias("untyped"), F.count_if(box.isNotNull() & ~F.coalesce(fits, F.lit(False))).alias("boxes"), F.count_if(text & (c == "")).alias("empty"),
        F.count_if(F.coalesce("modality", F.lit("")) == "").alias("kinds"), F.count_if(text & P.is_corrupt(F.col("content"))).alias("corrupt"),
        F.count_if(box.isNotNull() & (F.coalesce("page_width", F.lit(0)) * F.coalesce("page_height", F.lit(0)) == 0)).alias("unsized"),
    )
    copies = rows.filter(text & (c != "")).groupBy("doc_id", "page_number", c.alias("t")).agg((F.count("*") - 1).alias("x")).groupBy("doc_id").agg(F.sum("x").alias("n"))
    found = {"untyped": "NULL_CHUNK_TYPE", "boxes": "INVALID_BBOX", "empty": "EMPTY_TEXT", "kinds": "MISSING_MODALITY", "corrupt": "IRREPARABLY_CORRUPT"}
    issues = [issue(per_doc.filter(F.col(k) > 0), "FAIL", code, k) for k, code in found.items()]
    return reduce(DataFrame.unionByName, [*issues, issue(per_doc.filter("unsized > 0"), "WARN", "BBOX_MISSING_PAGE_DIMS", "unsized"), issue(copies.filter("n > 0"), "FAIL", "DUPLICATE_TEXT")])


def corruption(chunks: DataFrame) -> DataFrame:
    """FAIL for text and tables with over 0.5 % replacement characters or text beyond repair."""
    c = F.col("content")
    share = F.regexp_count(c, F.lit(r"\x{FFFD}")) / F.greatest(F.char_length(c), F.lit(1))
    bad = F.col("modality").isin("text", "table") & ((share > 0.005) | c.rlike(P.BEYOND_REPAIR))
    return issue(chunks.filter(bad).groupBy("doc_id").agg(F.count("*").alias("n")), "FAIL", "LOCALIZED_CORRUPTION")


def images(chunks: DataFrame, most_fallbacks: float = 0.05, need_descriptions: bool = True) -> DataFrame:
    """Issues of image chunks: pending, too many hard fallbacks, unusable descriptions and placeholder contents.

    A short description without the word layout is unusable unless the asset (area_share, asset_bytes) is simple.
    """
    rows = known(chunks).filter("modality = 'image'")
    told = strip_text(F.coalesce("description", F.lit("")))
    simple = asset_complexity(F.col("area_share"), F.col("asset_bytes")) == "simple"
    unusable = ~documented_fallback() & ((told == "") | told.rlike(PLACEHOLDER_IMAGE) | ((F.char_length(told) < 20) & ~F.lower(told).contains("layout") & ~simple))
    sums = rows.groupBy("doc_id").agg(
        F.count("*").alias("all"), F.count_if(F.col("vision_status") == "pending").alias("pending"), F.count_if(F.col("vision_status") == "hard_fallback").alias("hard"), F.count_if(unusable).alias("unusable"),
        F.count_if(F.coalesce("content", F.lit("")).rlike(PLACEHOLDER_IMAGE) & ~documented_fallback()).alias("stubs"),
    )
    return reduce(
        DataFrame.unionByName,
        (
            issue(sums.filter("pending > 0"), "FAIL", "VISION_PENDING", "pending"), issue(sums.filter(F.col("hard") / F.col("all") > most_fallbacks), "WARN", "VISION_HARD_FALLBACK_RATE", "hard"),
            issue(sums.filter("unusable > 0"), "FAIL" if need_descriptions else "WARN", "IMAGE_DESCRIPTION_UNUSABLE", "unusable"), issue(sums.filter("stubs > 0"), "WARN", "IMAGE_CONTENT_PLACEHOLDER", "stubs"),
        ),
    )


def assets(chunks: DataFrame) -> DataFrame:
    """Chunks with an asset (has_asset) whose file is not there (asset_bytes null): FAIL; files under 1000 bytes: WARN."""
    sums = chunks.filter("has_asset").groupBy("doc_id").agg(F.count_if(F.col("asset_bytes").isNull()).alias("missing"), F.count_if(F.col("asset_bytes") < 1000).alias("tiny"))
    return issue(sums.filter("missing > 0"), "FAIL", "ASSET_MISSING", "missing").unionByName(issue(sums.filter("tiny > 0"), "WARN", "ASSET_TINY", "tiny"))


def tables(chunks: DataFrame) -> DataFrame:
    """FAIL for tables that are empty, have over 0.1 % replacement characters, are over 30000 characters or have one row far over the others."""
    c = F.coalesce("content", F.lit(""))
    rows = F.transform(P.lines_of(c), F.char_length)
    mean = F.aggregate(rows, F.lit(0), lambda s, x: s + x) / F.greatest(F.size(rows), F.lit(1))
    wide = F.coalesce(F.array_max(rows), F.lit(0)) > F.greatest(F.lit(3000.0), mean * 6)
    bad = (c == "") | (F.regexp_count(c, F.lit(r"\x{FFFD}")) / F.greatest(F.char_length(c), F.lit(1)) > 0.001) | (F.char_length(c) > 30000) | wide
    return issue(chunks.filter((F.col("modality") == "table") & bad).groupBy("doc_id").agg(F.count("*").alias("n")), "FAIL", "TABLE_CORRUPTION")


def duplicates(chunks: DataFrame, least: int = 120) -> DataFrame:
    return issue(repeated_long_texts(chunks.filter("modality = 'text'"), least).groupBy("doc_id").agg(F.sum("excess").alias("n")), "FAIL", "DUPLICATE_LONG_TEXT")


def outliers(chunks: DataFrame, least_chunks: int = 30, least_chars: int = 50_000, times_chunks: float = 8, times_chars: float = 12) -> DataFrame:
    """FAIL for pages with over 8 times the median chunks or 12 times the median characters of text, from a least number on."""
    pages = chunks.groupBy("doc_id", "page_number").agg(F.count("*").alias("chunks"), F.sum(F.when(F.col("modality") == "text", F.char_length("content")).otherwise(0)).alias("chars"))
    middle = pages.groupBy("doc_id").agg(F.median("chunks").alias("mc"), F.median(F.when(F.col("chars") > 0, F.col("chars"))).alias("mt"))
    both = pages.join(middle, "doc_id").groupBy("doc_id").agg(
        F.count_if(F.col("chunks") > F.greatest(F.lit(least_chunks), F.floor(F.col("mc") * times_chunks))).alias("c"), F.count_if(F.col("chars") > F.greatest(F.lit(least_chars), F.floor(F.col("mt") * times_chars))).alias("t")
    )
    return issue(both.filter("c > 0"), "FAIL", "PAGE_CHUNK_OUTLIER", "c").unionByName(issue(both.filter("t > 0"), "FAIL", "PAGE_TEXT_OUTLIER", "t"))


#: Names and texts of chapters that carry no content (fixed values).
EDGE_NAMES = r"(?i)(?:^|[/_.-])(?:cover|titlepage|title|colophon|copyright|dedication|imprint|toc|contents|nav)(?:[/_.-]|$)"
EDGE_TEXTS = r"(?i)©|\b(?:colofon|colophon|copyright|all rights reserved|alle rechten voorbehouden|isbn|uitgever|publisher|published by|cover|omslag|title page|inhoudsopgave)\b"


def missing_chapters(chunks: DataFrame, chapters: DataFrame) -> DataFrame:
    """Chapters (doc_id, chapter, name, text_len, sample) without a chunk, the chapter of a chunk being page_number // 1000.

    WARN, with a message that says so, if those missing are all chapters before the first or behind the last that is covered
    and each is empty, or short with a name or text of an edge item; else FAIL. Chapters count from 1.
    """
    got = chunks.select("doc_id", F.floor(F.col("page_number") / 1000).cast("int").alias("chapter")).distinct().withColumn("__got", F.lit(True))
    rows = chapters.join(got, ["doc_id", "chapter"], "left").withColumn("__got", F.coalesce("__got", F.lit(False)))
    w = Window.partitionBy("doc_id")
    first, last = F.min(F.when(F.col("__got"), F.col("chapter"))).over(w), F.max(F.when(F.col("__got"), F.col("chapter"))).over(w)
    edge = (F.col("chapter") < first) | (F.col("chapter") > last)
    slight = (F.col("text_len") == 0) | ((F.col("text_len") <= 1200) & (F.col("name").rlike(EDGE_NAMES) | F.col("sample").rlike(EDGE_TEXTS)))
    gone = rows.withColumn("__fine", F.coalesce(edge & slight, F.lit(False))).filter("NOT __got").groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("__fine").alias("fine"))
    message = F.when(F.col("fine"), f"{EDGE_CHAPTER}(s)").otherwise("internal or content-bearing spine item(s)")
    return gone.select("doc_id", F.when(F.col("fine"), "WARN").otherwise("FAIL").alias("severity"), F.lit("MISSING_CHAPTERS").alias("code"), "n", message.alias("message"))


def blank_pages(pages: DataFrame) -> DataFrame:
    """Pages (text, images, blocks, render_mean, render_std) that are blank: without anything, with the phrase for blank pages
    only, or almost white with under 200 characters (without text: whiter still)."""
    n = F.char_length(strip_text(F.coalesce("text", F.lit(""))))
    nothing = (n == 0) & (F.coalesce("images", F.lit(0)) == 0) & (F.coalesce("blocks", F.lit(0)) == 0)
    white = (F.col("render_std") <= 20) & F.when(n == 0, F.col("render_mean") >= 250).otherwise((F.col("render_mean") >= 245) & (n <= 200))
    return pages.filter(nothing | P.blank_page(F.col("text")) | F.coalesce(white, F.lit(False)))


def verdicts(issues: DataFrame, docs: DataFrame, fallbacks: DataFrame | None = None) -> DataFrame:
    """QA_FAIL with a failure, QA_WARN with a warning that is no advisory, QA_PASS_WITH_ADVISORIES with advisories only, else QA_PASS.

    Missing chapters are an advisory if their message tells edge items; the rate of hard fallbacks is one if all
    fallbacks (doc_id, vision_error) of the document are short answers.
    """
    rows = issues if "message" in issues.columns else issues.withColumn("message", F.lit(""))
    if fallbacks is None:
        rows = rows.withColumn("__short", F.lit(False))
    else:
        short = fallbacks.groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("vision_error") == SHORT_ANSWER, F.lit(False))).alias("__short"))
        rows = rows.join(short, "doc_id", "left").withColumn("__short", F.coalesce("__short", F.lit(False)))
    allowed = F.when(F.col("code") == "MISSING_CHAPTERS", F.col("message").contains(EDGE_CHAPTER)).when(F.col("code") == "VISION_HARD_FALLBACK_RATE", F.col("__short")).otherwise(F.col("code").isin(*ADVISORIES))
    warn = F.col("severity") == "WARN"
    sums = rows.groupBy("doc_id").agg(F.count_if(F.col("severity") == "FAIL").alias("fails"), F.count_if(warn & ~allowed).alias("warns"), F.count_if(warn).alias("advisories"))
    both = docs.select("doc_id").join(sums, "doc_id", "left")
    verdict = F.when(F.col("fails") > 0, "QA_FAIL").when(F.col("warns") > 0, "QA_WARN").when(F.col("advisories") > 0, "QA_PASS_WITH_ADVISORIES").otherwise("QA_PASS")
    return both.select("doc_id", verdict.alias("verdict"))

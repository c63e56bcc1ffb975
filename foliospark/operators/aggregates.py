"""Rollups of chunks by document, page and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import predicates as P
from ..functions.text import strip_text

#: Share of the tokens that filters may remove, by profile (fixed values).
NOISE_ALLOWANCE = {"academic_whitepaper": 0.25, "technical_manual": 0.15, "digital_magazine": 0.10, "scanned_degraded": 0.05, "scanned": 0.05, "unknown": 0.10}
OVERLAP = 0.15
TOLERANCE = 0.10


def filter_summary(chunks: DataFrame, category: Column) -> DataFrame:
    """Chunks and tokens by document and category; kept ones count as KEPT."""
    rows = chunks.select("doc_id", F.coalesce(category, F.lit("KEPT")).alias("category"), C.tokens_stripped(F.col("content")).alias("t"))
    return rows.groupBy("doc_id", "category").agg(F.count("*").alias("n_chunks"), F.sum("t").alias("n_tokens"))


def token_balance(totals: DataFrame, tolerance: float = TOLERANCE, profile: Column | None = None) -> DataFrame:
    """variance and valid, from source_tokens, chunk_tokens and filtered_tokens of each document; noise is what its profile allows.

    Overlap is allowed for only where chunks have no fewer tokens than the source. Shortfall is allowed up to the larger
    of tolerance and noise, surplus up to tolerance, and filters may take no more than noise.
    """
    s, c, f = F.col("source_tokens"), F.col("chunk_tokens"), F.col("filtered_tokens")
    overlap = F.when(c < s, 0).otherwise(F.floor(s * OVERLAP))
    adjusted = F.greatest(F.lit(0), s - f)
    variance = F.when(adjusted == 0, 0.0).otherwise((c - overlap - adjusted) / adjusted)
    noise = F.lit(NOISE_ALLOWANCE["unknown"])
    for name, share in NOISE_ALLOWANCE.items():
        noise = noise if profile is None else F.when(profile == name, share).otherwise(noise)
    fine = variance.between(-F.greatest(F.lit(tolerance), noise), F.lit(tolerance)) & (f / s <= noise)
    return totals.withColumn("variance", variance).withColumn("valid", F.when(s == 0, True).otherwise(fine))


def batch_shortfall(source: DataFrame, chunks: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches of pages (doc_id, batch, start_page, end_page) whose chunks hold too little of the source's characters."""
    got = chunks.groupBy("doc_id", "page_number").agg(F.sum(F.char_length("content")).alias("chunk_chars"))
    both = source.join(got, ["doc_id", "page_number"], "left").withColumn("chunk_chars", F.coalesce("chunk_chars", F.lit(0)))
    placed = both.join(batches, "doc_id").filter(F.col("page_number").between(F.col("start_page"), F.col("end_page")))
    missing = (F.col("source_chars") >= 100) & (F.col("chunk_chars") < 50)
    sums = placed.groupBy("doc_id", "batch").agg(F.sum("source_chars").alias("source_chars"), F.sum("chunk_chars").alias("chunk_chars"), F.count_if(missing).alias("missing_pages"))
    variance = (F.col("source_chars") - F.col("chunk_chars")) / F.col("source_chars")
    return sums.withColumn("variance", variance).filter((F.col("source_chars") >= 500) & ((F.col("variance") >= 0.30) | (F.col("missing_pages") >= 2)))


def text_per_page(chunks: DataFrame) -> DataFrame:
    pages = chunks.groupBy("doc_id", "page_number").agg(F.sum(F.char_length("content")).alias("chars"))
    return pages.groupBy("doc_id").agg(F.avg("chars").alias("avg_text_per_page"), F.count("*").alias("n_pages"))


def page_quality(pages: DataFrame, confidence: Column) -> DataFrame:
    rows = pages.withColumn("__c", confidence)
    out = rows.groupBy("doc_id").agg(F.avg("__c").alias("avg_confidence"), F.min("__c").alias("min_confidence"), F.max("__c").alias("max_confidence"), F.count("*").alias("n"), F.count_if(F.col("__c") < 0.7).alias("needs_ocr"))
    return out.withColumn("tier", C.tier(F.col("avg_confidence")))


def page_outliers(chunks: DataFrame) -> DataFrame:
    """Pages with far more chunks or characters than the median page of their document."""
    pages = chunks.groupBy("doc_id", "page_number").agg(F.count("*").alias("n_chunks"), F.sum(F.char_length("content")).alias("chars"))
    middle = pages.groupBy("doc_id").agg(F.median("n_chunks").alias("mc"), F.median("chars").alias("mt"))
    limits = middle.select("doc_id", F.greatest(F.lit(30), F.floor(F.col("mc") * 8)).alias("most_chunks"), F.greatest(F.lit(50000), F.floor(F.col("mt") * 12)).alias("most_chars"))
    return pages.join(limits, "doc_id").filter("n_chunks > most_chunks OR chars > most_chars").select("doc_id", "page_number", "n_chunks", "chars")


def bbox_stats(chunks: DataFrame) -> DataFrame:
    """Boxes by modality: how many there are, missing or invalid, and their extremes."""
    b = lambda k: F.get("bbox", k)
    area = (b(2) - b(0)) * (b(3) - b(1))
    valid = (F.size("bbox") == 4) & (b(2) > b(0)) & (b(3) > b(1)) & F.forall("bbox", lambda x: x.between(0, 1000))
    return chunks.groupBy("modality").agg(
        F.count("*").alias("total"), F.count("bbox").alias("with_bbox"), F.count_if(F.col("bbox").isNull()).alias("missing"), F.count_if(~valid).alias("invalid"),
        F.min(b(0)).alias("min_x"), F.max(b(2)).alias("max_x"), F.min(b(1)).alias("min_y"), F.max(b(3)).alias("max_y"),
        F.min(area).alias("min_area"), F.avg(area).alias("avg_area"), F.max(area).alias("max_area"),
    )


def conversion_audit(chunks: DataFrame) -> DataFrame:
    """One row a language of counters over all chunks, in one pass."""
    c = F.col("content")
    return chunks.groupBy("lang").agg(
        F.count("*").alias("n_chunks"), F.sum(F.char_length(c)).alias("chars"), F.max(F.char_length(c)).alias("longest"),
        F.count_if(P.skip_category(c).isNotNull()).alias("skipped"), F.count_if(F.trim(c) == "").alias("empty"),
        F.count_if(c.contains("|")).alias("piped"), F.count_if(P.is_label(c)).alias("labels"), F.count_if(P.has_artifacts(c)).alias("artifacts"),
        F.count_if(C.text_class(c) == "advertisement").alias("advertisements"), F.sum(C.tokens_plain(c)).alias("tokens"),
    )


def collection_stats(chunks: DataFrame) -> DataFrame:
    """Per source: share of all chunks, median and mean length."""
    rows = chunks.groupBy("source").agg(F.count("*").alias("n"), F.median(F.char_length("content")).alias("median_chars"), F.avg(F.char_length("content")).alias("mean_chars"))
    total = chunks.agg(F.count("*").alias("total"))
    return rows.join(F.broadcast(total)).select("source", "n", (F.col("n") / F.col("total") * 100).alias("percent"), "median_chars", "mean_chars")


def document_profile(pages: DataFrame) -> DataFrame:
    """Per document: pages, text and image density, median image sizes."""
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("n_pages"), F.avg("chars").alias("avg_text"), F.avg("images").alias("image_density"), F.median("image_width").alias("median_width"), F.median("image_height").alias("median_height")
    )


def scan_check(pages: DataFrame) -> DataFrame:
    """Per document: average text, image coverage, flat text and the first rule that tells a scan."""
    rich = F.col("words") > 30
    rows = pages.groupBy("doc_id").agg(
        F.avg("chars").alias("avg_text"), F.avg("coverage").alias("avg_coverage"), F.avg((F.col("coverage") > 0.95).cast("double")).alias("full_pages"),
        (F.count_if(rich & (F.col("words") / F.greatest(F.col("newlines"), F.lit(1)) > 50)) / F.greatest(F.count_if(rich), F.lit(1))).alias("flat_share"),
    )
    sandwich = (F.col("avg_text") < 500) & (F.col("full_pages") > 0.7)
    scan = F.when(sandwich, True).when(F.col("avg_text") >= 500, False).otherwise((F.col("avg_text") < 100) & (F.col("avg_coverage") > 0.5))
    rows = rows.withColumn("is_scan", scan)
    kind = F.when(F.col("is_scan") & (F.col("avg_text") > 50), "scanned_clean").when(F.col("is_scan"), "scanned_degraded").when(F.col("avg_coverage") > 0.5, "image_heavy")
    return rows.withColumn("modality", kind.otherwise("native_digital"))


def recall(queries: DataFrame) -> DataFrame:
    """Recall at 1 and 5 of chunks and at 5 of documents, from gold ids and ranked arrays of ids."""
    return queries.agg(
        F.count("*").alias("n"), F.avg((F.get("top_chunks", 0) == F.col("gold_chunk")).cast("int")).alias("chunk_at_1"),
        F.avg(F.array_contains(F.slice("top_chunks", 1, 5), F.col("gold_chunk")).cast("int")).alias("chunk_at_5"),
        F.avg(F.array_contains(F.slice("top_docs", 1, 5), F.col("gold_doc")).cast("int")).alias("doc_at_5"),
    )


def regression(before: DataFrame, after: DataFrame) -> DataFrame:
    """FAIL where the first document differs, DRIFT where the first three chunks do, else PASS."""
    b, a = (x.select("query_id", F.col("top_chunks").alias(f"c_{s}"), F.get("top_docs", 0).alias(f"d_{s}")) for x, s in ((before, "b"), (after, "a")))
    verdict = F.when(~F.col("d_a").eqNullSafe(F.col("d_b")), "FAIL").when(F.slice("c_a", 1, 3) != F.slice("c_b", 1, 3), "DRIFT").otherwise("PASS")
    return b.join(a, "query_id").select("query_id", verdict.alias("verdict"))


#: Labels of cells and list items (fixed values).
SHORT_ITEMS = ("tablecell", "table_cell", "listitem", "list_item")


def dense_pages(items: DataFrame) -> DataFrame:
    """Pages (doc_id, page_number) of layout items (label, text) that are dense contents or index pages.

    The label document_index tells one; else references, leaders and short cells must be frequent enough, in one of four ways.
    """
    text = strip_text(F.coalesce("text", F.lit("")))
    label = F.lower(F.coalesce("label", F.lit("")))
    short = label.isin(*SHORT_ITEMS) & (text != "") & (F.char_length(text) <= 12) & ~text.contains("\n")
    pages = items.filter(F.col("page_number").isNotNull()).groupBy("doc_id", "page_number").agg(
        F.max(label.isin("document_index", "documentindex")).alias("told"), F.count_if(text != "").alias("texts"), F.count_if(text.rlike(P.INDEX_REFERENCE)).alias("refs"),
        F.count_if(text.rlike(P.CONTENTS_LEADER)).alias("leaders"), F.count_if(short).alias("short"), F.count_if(short & text.rlike(r"^\d{1,4}$")).alias("digits"),
    )
    refs, leaders, cells, texts = F.col("refs"), F.col("leaders"), F.col("short"), F.col("texts")
    share = (refs + leaders + cells) / F.greatest(texts, F.lit(1))
    many = (texts >= 18) & (3 * refs + 3 * leaders + cells >= 14) & (share >= 0.35) & ((refs + leaders >= 2) | (F.col("digits") >= 6))
    dense = many | ((refs >= 4) & (cells >= 8)) | ((leaders >= 5) & (share >= 0.30)) | ((leaders >= 4) & (share >= 0.80))
    return pages.filter(F.col("told") | ((texts >= 5) & dense)).select("doc_id", "page_number")


def document_domain(chunks: DataFrame, headers: DataFrame) -> DataFrame:
    """domain of each document of headers (doc_id, domain): its own, else that of the first chunk that has one, else unknown."""
    first = chunks.filter(F.coalesce("domain", F.lit("")) != "").groupBy("doc_id").agg(F.min_by("domain", "pos").alias("__d"))
    own = F.when(F.col("domain") != "", F.col("domain"))
    return headers.join(first, "doc_id", "left").select("doc_id", F.lower(F.coalesce(own, "__d", F.lit("unknown"))).alias("domain"))


def simple_balance(totals: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """variance of chunk_tokens against source_tokens and whether it is within tolerance; empty documents are valid."""
    s = F.col("source_tokens")
    variance = F.when(s > 0, F.abs(F.col("chunk_tokens") - s) / s).otherwise(0.0)
    return totals.withColumn("variance", variance).withColumn("valid", variance <= tolerance)

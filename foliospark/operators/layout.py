"""Repairs across chunks, reading order, contents pages and document classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import any_of, let, strip_text
from .windows import reading_order

#: Share of the page width that parts two columns.
COLUMN_GAP = 0.04
#: Words of spaced headings (fixed values).
HEADING_WORDS = (
    "CHAPTER PART BOOK SECTION APPENDIX EPILOGUE PROLOGUE ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN ELEVEN TWELVE THIRTEEN FOURTEEN "
    "FIFTEEN SIXTEEN SEVENTEEN EIGHTEEN NINETEEN TWENTY THIRTY THE AND OF"
).split()
#: Atomic, as the split takes the longest word and never goes back.
_WORD = f"(?>{'|'.join(sorted(HEADING_WORDS, key=len, reverse=True))})"
#: White space as Python's \s and strip know it.
_BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
_SPACED = rf"[A-Z](?:{_BLANK}{{1,2}}[A-Z]){{3,}}+"
#: Openings of descriptions, in the order in which they go (fixed values).
OPENINGS = (
    "(?:This|The) image (?:shows?|appears to be|is|depicts|displays)", "(?:This|The) page (?:contains?|shows?|displays?)", "(?:This|The) document (?:shows?|discusses?|presents?)",
    *(f"(?:An? |The )?{x} of" for x in ("image", "photograph", "photo", "illustration", "picture", "drawing", "depiction", "rendering", "graphic")),
    "(?:An? |The )?figure (?:showing|depicting|illustrating|of)", "(?:An? |The )?visual (?:representation )?of", "(?:This|It) (?:is|appears to be)", "Here (?:is|we see)",
)
#: A run of white space, tried at its beginning only.
_GAP = rf"(?<!{_BLANK}){_BLANK}++"
_ENDS = rf"^{_BLANK}+|{_GAP}\z"
_MANUAL = rf"(?:a|an|the) (?:technical{_BLANK}+)?(?:manual|instructional guide|guide|book|document)"
#: Clauses at the end of descriptions that go (fixed values).
TRAILERS = (
    rf"{_GAP}(?:in|on|from) (?:the|this) (?:page|document|image|photograph)", rf",?{_GAP}(?:as shown|as seen|as depicted|as illustrated) (?:in|on) (?:the|this) (?:image|page|figure)",
    rf",?{_GAP}(?:from|in) {_MANUAL}", rf",?{_GAP}appears to be from {_MANUAL}",
)
#: Reasons for which a document counts as full of code.
CODE_HEAVY, CODE_SOME = 0.15, 3


def _move_head(chunks: DataFrame, takes: Column, head: Column, own: Column, separator: str) -> DataFrame:
    """Moves the head of the next chunk to this one's end where `takes` holds; each chunk looks at its neighbours as they were."""
    rows = chunks.withColumn("__takes", F.coalesce(takes, F.lit(False))).withColumn("__head", F.when(F.col("__takes"), head)).withColumn("__own", own)
    lost = F.lag("__head").over(reading_order())
    rest = F.when(lost.isNotNull(), F.ltrim(F.substr(F.ltrim("content"), F.char_length(lost) + 1))).otherwise(F.col("content"))
    ended = F.when(F.col("__takes"), F.concat(F.when(lost.isNotNull(), rest).otherwise(F.col("__own")), F.lit(separator), F.col("__head"))).otherwise(rest)
    return rows.withColumn("__new", ended).withColumn("content", F.col("__new")).drop("__takes", "__head", "__own", "__new")


def rejoin_hyphenated(chunks: DataFrame, ascii_words: bool = False) -> DataFrame:
    """A word broken by a hyphen at a chunk's end is completed from the next chunk; if ascii_words, a letter beyond ASCII ends it."""
    nxt = F.lead("content").over(reading_order())
    end = "(?![A-Za-z0-9_])" if ascii_words else r"\b"
    head = F.regexp_extract(nxt, rf"^\s*([a-z]{{2,}}){end}", 1)
    takes = F.col("content").rlike(r"[a-zA-Z]{2,}-\s*$") & (head != "")
    return _move_head(chunks, takes, head, F.regexp_replace("content", r"-\s*$", ""), "")


def _split_blob(blob: Column) -> Column:
    """The words of HEADING_WORDS that begin the text, the longest first, one after another; then the rest."""
    rest = F.regexp_replace(blob, rf"^(?:{_WORD})++", "")
    known = F.regexp_extract_all(F.substr(blob, F.lit(1), F.char_length(blob) - F.char_length(rest)), F.lit(f"({_WORD})"), F.lit(1))
    return F.array_join(F.when(rest == "", known).otherwise(F.concat(known, F.array(rest))), " ")


def _collapsed(run: Column) -> Column:
    """A spaced run without its blanks; two blanks or more part words, and a long one without them is split by known words."""
    joined = F.array_join(F.transform(F.split(run, r" {2,}"), lambda x: F.replace(x, F.lit(" "), F.lit(""))), " ")
    return F.when(~run.contains("  ") & (F.char_length(joined) > 7), _split_blob(joined)).otherwise(joined)


def collapse_spaced_heading(text: Column) -> Column:
    """Each run of four or more capitals set apart by one or two blanks joins; two blanks part words: `C H A P T E R  O N E`.

    A run of more than seven letters without two blanks is split by HEADING_WORDS, as far as they go.
    """
    between = F.split(text, _SPACED, -1)
    runs = F.transform(F.regexp_extract_all(text, F.lit(f"({_SPACED})"), F.lit(1)), _collapsed)
    pieces = F.transform(between, lambda x, i: F.concat(x, F.coalesce(F.get(runs, i), F.lit(""))))
    return F.when(text.rlike(_SPACED), F.array_join(pieces, "")).otherwise(text)


def _halved(text: Column) -> Column:
    """The first half, third or quarter of a text, of 30 characters or more, if what follows begins as it does; else the text."""
    out = text
    for parts in (4, 3, 2):
        size = F.floor(F.char_length(text) / parts).cast("int")
        head = F.regexp_replace(F.left(text, size), r"(?U)\s+\z", "")
        rest = F.regexp_replace(F.substr(text, size + 1, F.lit(400)), r"(?U)^\s+", "")
        rest = F.when(F.char_length(rest) >= 40, rest).otherwise(F.regexp_replace(F.substr(text, size + 1), r"(?U)^\s+", ""))
        out = F.when((size >= 30) & rest.startswith(F.left(head, F.lit(40))), head).otherwise(out)
    return F.when(F.char_length(text) > 60, out).otherwise(text)


def drop_repeats(text: Column) -> Column:
    """Of texts of four lines or more: the start alone if the text repeats it, cut again until it does not; else without lines
    over five characters that came before, whatever their case."""
    bare = strip_text(text)
    turns = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.char_length(bare), F.lit(1)) / 30.0)).cast("int")))
    cut = let(_halved(bare), lambda once: F.when(once == bare, F.lit(None)).otherwise(F.aggregate(turns, once, lambda t, _: _halved(t))))
    return F.when(F.size(F.split(text, "\n", -1)) >= 4, F.coalesce(cut, _without_repeated_lines(text))).otherwise(text)


def _without_repeated_lines(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    keys = F.transform(lines, lambda x: F.lower(strip_text(x)))
    kept = F.filter(lines, lambda x, i: let(F.lower(strip_text(x)), lambda key: (F.char_length(key) <= 5) | (F.array_position(keys, key) == i + 1)))
    joined = strip_text(F.array_join(kept, "\n"))
    return F.when(joined != strip_text(text), joined).otherwise(text)


def heal_drop_cap(text: Column) -> Column:
    """A single capital at the end belongs before the lower-case beginning: `nce upon a time O`."""
    return F.regexp_replace(text, r"(?s)^(\p{Ll}.*\S)\s+(\p{Lu})$", "$2$1")


def order_in_page(boxes: DataFrame) -> DataFrame:
    """position of each box in the reading order of its page: by column where the two halves stand apart, then top and left.

    Boxes without a place come last, in their own order.
    """
    page = Window.partitionBy("doc_id", "page_number")
    centre = (F.col("x0") + F.col("x1")) / 2
    ranked = boxes.withColumn("__c", centre)
    split = F.when(F.count("__c").over(page) >= 2, F.percentile("__c", 0.5).over(page))
    rows = ranked.withColumn("__split", split).withColumn("__left", F.col("__c") <= F.col("__split"))
    gap = F.min(F.when(~F.col("__left"), F.col("x0"))).over(page) - F.max(F.when(F.col("__left"), F.col("x1"))).over(page)
    width = F.when(F.col("page_width") > 1, F.col("page_width")).otherwise(F.greatest(F.max("x1").over(page) - F.min("x0").over(page), F.lit(1)))
    column = F.when(F.col("__c").isNull(), 99).when(F.coalesce(gap > width * COLUMN_GAP, F.lit(False)) & ~F.col("__left"), 1).otherwise(0)
    rows = rows.withColumn("__col", column)
    order = Window.partitionBy("doc_id", "page_number").orderBy("__col", F.asc_nulls_last("y0"), F.asc_nulls_last("x0"), "item")
    return rows.withColumn("position", F.row_number().over(order)).drop("__c", "__split", "__left", "__col")


def contents_ranges(entries: DataFrame, slack: int = 50) -> DataFrame:
    """first_page and last_page of each entry (doc_id, start_page, title) of a table of contents: up to the next entry."""
    w = Window.partitionBy("doc_id").orderBy("start_page", "title")
    end = F.coalesce(F.lead("start_page").over(w) - 1, F.col("start_page") + slack)
    return entries.select("doc_id", "title", F.col("start_page").alias("first_page"), F.greatest(end, F.col("start_page")).alias("last_page"))


def content_entries(chunks: DataFrame) -> DataFrame:
    """Entries `number title` in the chunks, as a table of contents has them."""
    c = F.col("content")
    number, title = F.regexp_extract(c, r"^(\d{1,3})\s+(.{5,60})$", 1), F.regexp_extract(c, r"^(\d{1,3})\s+(.{5,60})$", 2)
    return chunks.filter(title != "").select("doc_id", number.cast("int").alias("start_page"), title.alias("title"))


def code_evidence(chunks: DataFrame) -> DataFrame:
    """Per document: chunks of code, their share and whether the document is code_heavy, mixed or prose."""
    rows = chunks.groupBy("doc_id").agg(F.count_if(P.looks_like_code(F.col("content"))).alias("code_chunks"), F.count("*").alias("n_chunks"))
    share = F.col("code_chunks") / F.col("n_chunks")
    kind = F.when(share >= CODE_HEAVY, "code_heavy").when(F.col("code_chunks") >= CODE_SOME, "mixed").otherwise("prose")
    return rows.select("doc_id", "code_chunks", "n_chunks", kind.alias("content_type"))


def content_domain(docs: DataFrame) -> DataFrame:
    """domain of each document from pages, density, dialogue_share, tables, code_pages, coverage_share and image_heavy.

    The highest score of at least 0.3 wins; ties go in the order literature, academic, editorial, technical.
    """
    no_tables, few_code = ~F.col("tables"), F.col("code_pages") < 2
    density, pages = F.col("density"), F.col("n_pages")
    literature = (
        F.when((F.col("dialogue_share") > 0.3) & (pages > 50) & no_tables & few_code, 0.8).otherwise(0.0)
        + F.when((F.col("dialogue_share") > 0) & (pages > 20) & no_tables & density.between(500, 2500) & few_code, 0.4).otherwise(0.0)
        + F.when((pages > 100) & no_tables & (density < 2500), 0.3).otherwise(0.0)
    )
    academic = F.when(density > 3000, 0.7 + F.when(F.col("image_heavy"), 0.0).otherwise(0.2)).otherwise(0.0)
    editorial = F.when(F.col("coverage_share") >= 0.6, 0.6).otherwise(0.0) + F.when(density.between(500, 2500) & (F.col("coverage_share") >= 0.6), 0.2).otherwise(0.0)
    technical = F.when(F.col("tables"), 0.5).otherwise(0.0) + F.when(~F.col("image_heavy") & (density > 1000), 0.3).otherwise(0.0)
    best = F.greatest(literature, academic, editorial, technical)
    domain = F.when(best < 0.3, "unknown").when(literature == best, "literature").when(academic == best, "academic").when(editorial == best, "editorial").otherwise("technical")
    return docs.withColumn("domain", domain)


def profile_rank(scores: DataFrame) -> DataFrame:
    """The profile of each document with the highest score times confidence; below 0.6 confidence counts half, ties go by name."""
    worth = F.when(F.col("confidence") < 0.6, F.col("score") * (0.5 + 0.5 * F.col("confidence"))).otherwise(F.col("score") * F.col("confidence"))
    best = scores.groupBy("doc_id").agg(F.min_by("profile", F.struct((-worth).alias("w"), "profile")).alias("profile"), F.max(worth).alias("worth"))
    return best


def full_page_guard(images: DataFrame, strict: bool = False) -> DataFrame:
    """Images over 0.95 of the page: dropped if strict, else marked as editorial or, without a description, pending."""
    big = F.col("area_share") > 0.95
    text = F.when(big & F.col("description").isNull(), "pending").when(big, F.concat(F.lit("[FULL-PAGE EDITORIAL IMAGE] "), F.col("description"))).otherwise(F.col("description"))
    return images.filter(~big | F.lit(not strict)).withColumn("description", text)


#: What a model says when it has nothing to say (fixed values).
NO_ANSWERS = ("unable to describe", "cannot describe", "no description available", "description unavailable")


def description_class(description: Column) -> Column:
    """Why the answer of a vision model is no description, or null: empty, reading of text, echo of the prompt, no answer, or under ten characters once clean.

    Reading of text is told by how the answer begins; the other signs of it are not looked for.
    """
    clean = clean_description(description)
    low = F.lower(strip_text(F.coalesce(description, F.lit(""))))
    reading = low.rlike(r"^(?:the )?(?:text|page|image) (?:reads|says|contains the text)|^transcription")
    echo = F.regexp_count(clean, F.lit(r"\[[A-Z][a-zA-Z ]{2,}\]")) >= 2
    return (
        F.when(low == "", "empty").when(reading, "text_reading").when(F.coalesce(strip_text(clean), F.lit("")) == "", "empty").when(echo, "prompt_echo")
        .when(any_of(F.lower(clean), NO_ANSWERS), "fallback").when(F.char_length(clean) < 10, "short")
    )


def clean_description(description: Column) -> Column:
    """Without thoughts, ended or not, quotation marks, openings and trailing clauses; capitalised, at most 400 characters."""
    x = F.regexp_replace(description, r"(?s)<think>(?:.*?</think>|.*)", "")
    x = F.regexp_replace(x, r"(?s)<think>.*", "")
    x = F.translate(F.regexp_replace(x, _ENDS, ""), "\"'", "")
    for opening in OPENINGS:
        x = F.regexp_replace(x, rf"(?iu)^{opening}{_BLANK}+", "")
    for trailer in TRAILERS:
        x = F.regexp_replace(x, rf"(?iu){trailer}\.?(?=\n?\z)", "")
    x = F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))
    return F.substring(F.regexp_replace(x, _ENDS, ""), 1, 400)

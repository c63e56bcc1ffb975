"""Predicates that decide what stays in a corpus, as boolean or category columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, chars_of, count_of, drop_controls, let, strip_text

#: Words of advertisements (fixed values).
AD_WORDS = (
    "subscription", "subscribe", "buy now", "purchase", "shop now", "click here", "limited time", "special offer", "discount", "save now", "order today", "call now", "visit our", "www.",
    "http://", "https://", "facebook.com", "twitter.com", "instagram.com", "youtube.com", "linkedin.com", "mental health", "finances", "reach out", "price", "special price", "sale", "deal",
    "offer ends", "hurry", "act now",
)
#: Words that keep a chunk out of the question sample (fixed values).
SOAK_AD_WORDS = ("subscribe", "buy now", "click here", "limited time", "discount")
#: Shortest text by profile (fixed values).
LEAST_CHARS = {"academic_whitepaper": 10, "technical_manual": 5, "digital_magazine": 3, "scanned_degraded": 2, "scanned": 3, "unknown": 5}
#: Signs of faulty encoding, of faulty recognition and of text beyond repair (fixed values).
ARTIFACTS = r"/C\d{1,3}|/uni[A-F0-9]{4,}|\\x[0-9a-f]{2}|\x{FFFD}"
FILLER = r"—{6,}|[CS]{10,}"
BEYOND_REPAIR = r"(?U)—{6,}|™{2,}|[CS]{10,}|\b[BSQ][0-9]th|\bFe35\b|\bF1SC\b|\bNCOCOC\b"
NO_VISUALS = "no distinct non-text visuals"
#: Imprints (fixed values).
BOILERPLATE = r"(?iu)(?U:\b)ISBN(?U:\b)|(?U:\b)ISSN(?U:\b)|Library of Congress|All rights reserved|Printed in [^\n]{2,20}(?=\n?\z)|First [^\n]{2,20} edition|©(?U:\s)*(?U:\d){4}"
STOP_WORDS = "the a an of in on at for and or but to with from by as is are was were be been being via into onto upon".split()
#: Words with which the rest of a title begins, and marks that end a line (fixed values).
SUBTITLE_LEADS = "and or the a an of in to on at by for with from into onto upon".split()
#: Texts that stand for a table without content and words of invented tables (fixed values).
TABLE_STUBS = r"(?iu)^\[table on page \d+\]$|^\[table extraction unavailable on page \d+\]$|^\[table\]$|^table$"
INVENTED = (
    "lorem ipsum", "placeholder", "example row", "sample data", "generated content", "the matrix", "movie", "findwindowexa", "was passing", "htrm", "pulse length",
)


def lines_of(text: Column) -> Column:
    """The lines of a text that are not blank."""
    return F.filter(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]", -1), lambda x: x.rlike(r"(?U)\S"))


def _share(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def skip_category(content: Column, profile: str = "unknown", bbox_area: Column | None = None) -> Column:
    """Why a chunk of text is left out, or null. Only academic papers lose short texts and noise lines."""
    text = strip_text(F.coalesce(content, F.lit("")))
    academic = F.lit(profile == "academic_whitepaper")
    short = F.char_length(text) < LEAST_CHARS.get(profile, 5)
    digits = text.rlike(r"^\d+$")
    noise = F.lower(text).rlike(r"^page\s*\d+$|^\d+\s*/\s*\d+$|^[ivxlcdm]+$|^©\s*\d{4}")
    tiny = F.lit(False) if bbox_area is None else F.coalesce((bbox_area < 50) & (F.char_length(text) < 5), F.lit(False))
    long_text = (
        F.when(text.rlike(r"^[\s\-_=•·…]+$"), "DECORATION").when(academic & noise, "NOISE_PATTERN").when(academic & tiny, "TINY_BBOX")
    )
    short_text = (
        F.when(digits & academic, "PAGE_NUMBER").when(~digits & (F.char_length(text) < 2), "DECORATION").when(academic, "TOO_SHORT")
    )
    return F.when(text == "", "EMPTY").when(short, short_text).otherwise(long_text)


def is_noise(content: Column) -> Column:
    """Blank, only dots and dashes, one character, a page number or without letters; code is no noise."""
    text = strip_text(F.coalesce(content, F.lit("")))
    bare = (text == "") | text.rlike(r"^[· \-.]+$")
    short = (F.char_length(text) < 2) | text.rlike(r"(?iu)^(?:page(?U:\s)*)?(?U:\d)+$") | ~text.rlike(r"\p{L}")
    return bare | (~looks_like_code(text) & short)


def is_advertisement(content: Column) -> Column:
    """Two words of advertisements in under 200 characters, or three."""
    hits = count_of(F.lower(content), AD_WORDS)
    size = F.char_length(content)
    return (size >= 10) & (((hits >= 2) & (size < 200)) | (hits >= 3))


def has_artifacts(content: Column) -> Column:
    return content.rlike(ARTIFACTS) | content.rlike(FILLER)


def is_corrupt(content: Column, share: float = 0.10) -> Column:
    """Too many artifact characters (a replacement character counts twice) or filler runs."""
    matched = F.aggregate(F.regexp_extract_all(content, F.lit(f"({ARTIFACTS})"), F.lit(1)), F.lit(0), lambda s, x: s + F.char_length(x))
    count = matched + chars_of(content, r"\x{FFFD}")
    return (count / F.greatest(F.char_length(content), F.lit(1)) > share) | content.rlike(FILLER)


def drop_corrupt_chunk(content: Column, method: Column, modality: Column | None = None, ascii_words: bool = False) -> Column:
    """Text and tables with over 0.5 % replacement characters, text beyond repair, or very long and almost without words; whole-page rescues are exempt.

    If ascii_words, a letter beyond ASCII ends a word.
    """
    n = F.greatest(F.char_length(content), F.lit(1))
    share = chars_of(content, r"\x{FFFD}") / n
    word = r"(?<![A-Za-z0-9_])[A-Za-z]{4,}+(?![A-Za-z0-9_])" if ascii_words else r"(?U)\b[A-Za-z]{4,}\b"
    words = F.regexp_count(content, F.lit(word))
    bad = (share > 0.005) | content.rlike(BEYOND_REPAIR) | ((n > 30000) & (words / n * 1000 < 10))
    kind = F.lit(True) if modality is None else modality.isin("text", "table")
    return kind & ~F.coalesce(method.startswith("hybrid_chunker_pageskip"), F.lit(False)) & F.coalesce(bad, F.lit(False))


def repeats_first_token(content: Column) -> Column:
    """The same token five times at the start."""
    return content.rlike(r"^\s*(\S+)(?:\s+\1){4}(?:\s|$)")


def is_contents_page(content: Column) -> Column:
    """Six lines or more that begin like a table of contents or an index, or that mostly end in page numbers, leaders or references."""
    return let(F.transform(lines_of(drop_controls(content)), strip_text), _lists_contents)


def _lists_contents(lines: Column) -> Column:
    # each pattern has one place where it can begin for each of its ends, so long lines take no longer by the character
    n = F.size(lines)
    head = F.lower(F.array_join(F.slice(lines, 1, 3), "\n"))
    leader, ends = _share(lines, r"\.\.\s*+\d{1,4}\s*$"), _share(lines, r"(?<=.{6})\s\d{1,4}\s*$")
    index, digit = _share(lines, r"\b\d{1,4},\s*+\d{1,4}\b"), _share(lines, r"^\d{1,4}$")
    named = head.contains("table of contents") | head.startswith("contents") | head.startswith("index")
    counted = F.struct(leader.alias("leader"), ends.alias("ends"), index.alias("index"), digit.alias("digit"))

    def fits(x: Column) -> Column:
        score, ratio = 2 * x["leader"] + x["ends"] + 2 * x["index"] + x["digit"], (x["leader"] + x["ends"] + x["index"] + x["digit"]) / n
        return ((score >= 8) & (ratio >= 0.35)) | ((x["leader"] >= 3) & (ratio >= 0.25))

    return F.when(n >= 6, named | let(counted, fits)).otherwise(False)


def looks_like_code(content: Column) -> Column:
    """A fence; in one line a prompt, a definition or an import; in several lines indentation, prompts, statements or many symbols."""
    return let(F.regexp_replace(F.coalesce(content, F.lit("")), r"^\n+|\n+\z", ""), lambda text: let(lines_of(text), lambda lines: _code_like(text, lines)))


def _code_like(text: Column, lines: Column) -> Column:
    one_line = (
        text.contains(">>>") | text.rlike(r"(?U)^\s*\.\.\.") | text.rlike(r"(?U)^\s*(?:def|class|import|from)\b")
        | text.rlike(r"(?U)\bfrom\s+[A-Za-z_][\w.]*\s+import\b") | text.rlike(r"(?U)\bimport\s+[A-Za-z_]")
    )
    indented, prompts = _share(lines, r"^(?: {4}|\t)"), _share(lines, r"(?U)^\s*(?:>>>|\.\.\.)")
    statement = text.rlike(r"(?Umd)^\s*(?:def|class|import|from|return|yield|async\s+def|await|try|except|with|for|while|if|elif|else)\b")
    symbols, letters = chars_of(text, r"{}\[\]()<>:=/*+\-#.,;\\|"), chars_of(text, r"\p{L}\p{N}")
    several = (indented / F.greatest(F.size(lines), F.lit(1)) >= 0.3) | (prompts >= 1) | statement | ((symbols >= 20) & (symbols > letters * 0.10))
    return text.contains("```") | F.when(F.size(lines) < 2, one_line).otherwise(several)


def code_lines(content: Column) -> Column:
    """The audit's two patterns for code: a statement at a line's start, or a sign of code anywhere."""
    start = content.rlike(r"(?Umd)^\s*(?:def|class|import|from|return|yield|if\s+__name__|async\s+def)\b")
    inside = content.rlike(r"(?U)```|::|\bdef\s+\w+\(|\bclass\s+\w+|\bimport\s+\w+|\bfrom\s+\w+\s+import\b|[{}<>]=?|==|!=|:=|->|=>|\breturn\b")
    return content.rlike(r"(?U)\S") & (start | inside)


#: Shapes of labels: of a manual's export, of the audit and of the fidelity report (fixed values).
LABELS = {
    "manual": r"^[A-Z][A-Za-z0-9/&()' .,-]{1,59}:?$",
    "audit": r"^(?:\d[\d.]*\s+)?[A-Z][A-Za-z0-9/&()' .,-]{1,55}:?$",
    "fidelity": r"^[A-Z][A-Za-z0-9/&()' .,-]{1,50}:?$",
}


def is_label(content: Column, kind: str = "manual") -> Column:
    """A short line in title shape: with a colon at its end at most, else up to six words none of which ends a sentence."""
    text = strip_text(F.coalesce(content, F.lit("")))
    words = F.size(F.split(text, r"(?U)\s+"))
    plain = (words <= 6) & ~text.rlike(r"(?U)[.?!](?:\s|$)")
    fit = (F.char_length(text) <= 60) & ~text.contains("\n") & text.rlike(LABELS[kind]) & (text.endswith(":") | (~text.contains(":") & plain))
    if kind == "audit":
        fit = fit & ~text.rlike(r"(?U)\s\d{1,4}$")
    return fit & ~text.rlike(r"(?U)^\d{1,4}$")


#: What a heading never begins with: captions and code (fixed values).
_CAPTION = r"^(this chapter covers|\(continued\)|listing \d|figure \d|table \d|example \d[\d.-]*\.)"
_STATEMENT = r"^(def|class|return|import|from|>>>|\{|\[|```)\b"


def is_heading(content: Column) -> Column:
    """Whether a line can be a heading: short, no sentence, caption, code, label with value, quotation or repetition."""
    text = strip_text(F.coalesce(content, F.lit("")))
    # only short texts are looked at further, and what several rules need is computed once
    return F.coalesce(let(F.when(F.char_length(text).between(2, 80), text), _short_heading), F.lit(False))


def _short_heading(text: Column) -> Column:
    low = F.lower(text)
    n_words = F.regexp_count(text, F.lit(r"(?U)\w+"))
    numbered = text.rlike(r"^\d+(?:\.\d+)*\.?\s+")
    after = F.regexp_extract_all(F.regexp_replace(text, r"^\d+(?:\.\d+)*\.?\s+", ""), F.lit(r"(?U)(\w+)"), F.lit(1))
    lower_content = F.size(F.filter(after, lambda w: w.rlike(r"^\p{Ll}") & ~F.lower(w).isin(STOP_WORDS)))
    bad = (
        (F.regexp_count(text, F.lit(r"\.[ \n]")) > 1)
        | (text.endswith(".") & (n_words >= 5))
        | F.when(numbered, lower_content >= 2).otherwise(False)
        | text.rlike(r"^[\s\-·•\.\d\*]+$")
        | low.rlike(r"^\d+$|^page\s*\d+$")
        | low.rlike(_CAPTION)
        | low.rlike(_STATEMENT)
        | text.rlike(r"^[A-Z_][A-Z0-9_\s-]{1,40}:\s*[\[{]")
        | text.rlike(r"^[A-Za-z\s]{3,30}:\s+[A-Z]")
        | text.contains("©")
        | text.rlike(r"(?i)\bISBN\b|\bISSN\b")
        | ((F.regexp_count(text, F.lit(r"\.")) > 5) & text.contains("...."))
        | (text.rlike("^['\"‘“]") & text.rlike("(?:['\"’”])$"))
        | ~text.rlike(r"\p{L}")
    )
    latin = F.transform(F.regexp_extract_all(text, F.lit(r"([A-Za-z][A-Za-z0-9_]*)"), F.lit(1)), F.lower)
    return F.when(bad, False).otherwise(~let(latin, lambda words: let(F.lower(F.regexp_replace(text, "[^A-Za-z]+", "")), lambda letters: _repetitive(words, letters))))


def _repetitive(words: Column, letters: Column) -> Column:
    """One word is half of all and stands three times, or the text is one word of three letters or more again and again."""
    most = F.coalesce(F.array_max(F.transform(F.array_distinct(words), lambda w: F.size(F.filter(words, lambda v: v == w)))), F.lit(0))
    echo = F.exists(F.array_distinct(words), lambda w: (F.char_length(w) >= 3) & (F.char_length(letters) >= 3 * F.char_length(w)) & (F.replace(letters, w, F.lit("")) == ""))
    return echo | ((F.size(words) >= 3) & (most >= 3) & (most / F.size(words) >= 0.5))


def continues_subtitle(content: Column, chunk_type: Column, parent: Column) -> Column:
    """A paragraph of under 30 characters below a heading of other wording that begins like the rest of a title and has no end mark."""
    text, above = strip_text(F.coalesce(content, F.lit(""))), strip_text(F.coalesce(parent, F.lit("")))
    lead = F.lower(F.regexp_extract(text, r"^([A-Za-z]+)", 1)).isin(SUBTITLE_LEADS)
    return (chunk_type == "paragraph") & (F.char_length(text) < 30) & lead & ~text.rlike(r"[.?!:;,]\z") & (above != "") & (above != text)


# ---- tables


def is_table_stub(content: Column) -> Column:
    """Without content: blank, or a text that only says that a table was there."""
    text = strip_text(F.coalesce(content, F.lit("")))
    return (text == "") | text.rlike(TABLE_STUBS)


def is_markdown_table(content: Column) -> Column:
    """The first line has a bar and one of the next two a rule of dashes behind one."""
    lines = lines_of(strip_text(F.coalesce(content, F.lit(""))))
    return (F.size(lines) >= 2) & F.get(lines, F.lit(0)).contains("|") & F.exists(F.slice(lines, 2, 2), lambda x: x.rlike(r"(?U)\|\s*-{2,}"))


def is_sound_table(content: Column, prose_cells: bool = True) -> Column:
    """A markdown table of three lines, two columns and even rows, without invented words and (if asked) without prose in its cells."""
    text = strip_text(F.coalesce(content, F.lit("")))
    lines = F.transform(lines_of(text), strip_text)
    columns = F.transform(lines, lambda x: F.greatest(F.lit(0), F.regexp_count(x, F.lit(r"\|")) - 1))
    even = (F.array_min(columns) >= 2) & (F.array_max(columns) - F.array_min(columns) <= 2)
    sound = is_markdown_table(text) & (F.size(lines) >= 3) & even & ~any_of(F.lower(text), INVENTED if prose_cells else INVENTED[:5])
    if prose_cells:
        cells = F.flatten(F.transform(F.filter(lines, lambda x: x.contains("|")), lambda x: F.slice(F.split(x, r"\|", -1), F.lit(2), F.greatest(F.lit(0), F.regexp_count(x, F.lit(r"\|")) - 1))))
        bare = F.transform(cells, lambda x: F.regexp_replace(strip_text(x), "^[`*_ ]+|[`*_ ]+$", ""))
        sound = sound & ~F.exists(bare, lambda x: (F.char_length(x) > 60) & (F.regexp_count(x, F.lit("[.!?]")) >= 2))
    return sound


def is_loose_table(content: Column) -> Column:
    """No markdown table, and a stub, one line, or lines that are mostly short or begin with numbers."""
    text = strip_text(F.coalesce(content, F.lit("")))
    lines = F.transform(lines_of(text), strip_text)
    n = F.size(lines)
    numbers, short = _share(lines, r"(?U)^\d+(?:\.\d+)?\b"), F.size(F.filter(lines, lambda x: F.char_length(x) <= 120))
    loose = (n < 2) | (numbers >= F.greatest(F.lit(2), F.floor(n / 3))) | (short >= F.greatest(F.lit(3), F.floor(n * 0.8)))
    return is_table_stub(text) | (~is_markdown_table(text) & loose)


def is_placeholder(content: Column) -> Column:
    """Stands for a figure or table without saying anything about it."""
    text = F.lower(strip_text(F.coalesce(content, F.lit(""))))
    return (
        (text == "") | text.contains("extraction unavailable") | text.rlike(r"(?U)^\[(?:figure|image|table)\b") | text.startswith("[vlm_failed")
        | ((F.char_length(text) < 80) & (text.contains("figure on page") | text.contains("table on page")))
    )


def is_boilerplate(content: Column) -> Column:
    """Two signs of an imprint or more."""
    return F.regexp_count(content, F.lit(BOILERPLATE)) >= 2


def soak_eligible(content: Column, modality: Column | None = None) -> Column:
    """Text of 150 characters or more, at most 0.4 of its lines code-like, no advertisement: fit to ask questions about."""
    text = strip_text(F.coalesce(content, F.lit("")))
    lines = F.split(text, "\n", -1)
    code = _share(lines, r"(?U)^(?:  |\t)|^\s*(?:>>>|\.\.\.)") / F.size(lines)
    kind = F.lit(True) if modality is None else modality == "text"
    return kind & (F.char_length(text) >= 150) & (code <= 0.4) & ~any_of(F.lower(text), SOAK_AD_WORDS)


def blank_page(content: Column) -> Column:
    text = strip_text(F.coalesce(content, F.lit("")))
    return text.rlike(r"(?iU)this\s+page\s+(?:is\s+)?intentionally\s+left\s+blank") & (F.char_length(text) <= 120)


def keyword_of(query: Column) -> Column:
    """The longest capitalised word that is no stop word, else the longest word."""
    words = F.regexp_extract_all(query, F.lit(r"(?U)(\w{3,})"), F.lit(1))
    plain = F.filter(words, lambda w: ~F.lower(w).isin(STOP_WORDS))
    capital = F.filter(plain, lambda w: w.rlike(r"^\p{Lu}"))
    best = lambda a: F.element_at(F.array_sort(F.transform(a, lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w")))), 1)["w"]
    return F.when(F.size(capital) > 0, best(capital)).when(F.size(plain) > 0, best(plain))


# ---- pages of an index

#: References, leaders and entries of contents and index pages (fixed values).
INDEX_REFERENCE = r"\b\d{1,4}(?:,\s*\d{1,4}){2,}\b"
CONTENTS_LEADER = r"(?:\.|\x{FFFD}){2,}\s*\d{1,4}\s*$"
BACK_INDEX_ENTRY = r"^\s*[A-Za-z][^,\n]{1,80}?,\s*\d{1,4}(?:\s*[-,]\s*\d{1,4})*\s*$"
BACK_INDEX_MARK = r"^(?:\d{1,4}\s*\|\s*Index|Index\s*\|\s*\d{1,4}|Index)\s*$"


def is_back_index_page(lines: Column) -> Column:
    """Of 20 lines or more, 65 % are index entries, or half of them beside a line that names the index."""
    kept = F.filter(lines, lambda x: x.rlike(r"(?U)\S"))
    bare = F.transform(kept, strip_text)
    share = _share(bare, BACK_INDEX_ENTRY) / F.greatest(F.size(kept), F.lit(1))
    return (F.size(kept) >= 20) & ((share >= 0.65) | ((share >= 0.50) & (_share(bare, BACK_INDEX_MARK) > 0)))


def sanitise_contents(text: Column) -> Column:
    """Cell marks, runs of replacement characters and wide gaps of a contents page become blanks."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r",\s*\d+\s*=", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, "[ \t]*�[� \t]*", " "), r"[ \t]{2,}", " ")
    return strip_text(F.regexp_replace(plain, r"\n{3,}", "\n\n"))

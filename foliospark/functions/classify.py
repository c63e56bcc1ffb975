"""Classifiers and scores of texts, pages and documents as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import looks_like_code
from .text import any_of, chars_of, count_of, let, strip_text

AD_MARKS = ("buy now", "special offer", "discount", "order now", "limited time", "subscribe")
TECHNICAL = ("api", "schema", "algorithm", "function", "class", "module", "pipeline", "configuration", "implementation", "model")
#: Signs of corrupted text with their weights, each worth at most three times that, and the language they are for (fixed values).
CORRUPTION = (
    (r"(?U)\b\w{1,2}\s+\w{1,2}\s+\w{1,2}\b", 0.3, None),
    (r"\s-\s|\s-$|^-\s", 0.2, None),
    (r"(?U)(\w)\s{2,}(\w)", 0.25, None),
    (r"[|lI1]{3,}|[O0]{3,}", 0.3, None),
    (r"fi\s|fl\s|ff\s", 0.15, None),
    (r'[aou]\s*[¨"]', 0.2, "de"),
    (r"(?U)i\s+j\b", 0.2, "nl"),
    (r"\s+[.,;:!?]", 0.1, None),
    (r"[O0]{1}[lI1]{1}|[lI1]{1}[O0]{1}", 0.2, None),
    (r"[a-z]{3,}[a-z][A-Z][a-z]|[a-z]{2,}i[a-z]{3,}|[A-Z]{2,}[A-Z][a-z]{3,}", 0.3, None),
    (r"[@~§¢£¥]\s*[a-zA-Z]|[a-zA-Z]\s*[@~§]", 0.25, None),
    (r"[éèêëàâäùûüôöîï][a-z]{2,}", 0.2, None),
    (r"[a-z]\.[a-z]{2,}", 0.15, None),
    (r"(?U)(?:^|\n)[a-z]{1,3}\b\s+[a-z]", 0.2, None),
    (r"/C\d{1,3}\b|\\x[0-9a-f]{2}", 0.4, None),
)
#: Parts of texts that no edit may touch (fixed values); the pattern of addresses asks for a backslash and brackets behind one character.
PROTECTED = (
    r"\b[A-Z]{2,}-\d{2,}[A-Z0-9-]*\b", r"\b[A-Z]{2,}\d{2,}[A-Z0-9-]*\b", r"P/N:?\s*\S+", r"ECU-[A-Z0-9-]+", r"SN:?\s*\S+", r"ID:?\s*\S+",
    r"https?://[^\s)\\]\\}>;,]+", r"\d{4}-\d{2}-\d{2}",
)
MOST_EDITS = 0.35


def text_class(content: Column) -> Column:
    low = F.lower(content)
    return F.when(any_of(low, AD_MARKS), "advertisement").when(count_of(low, TECHNICAL) >= 2, "technical").otherwise("editorial")


def recovery_class(content: Column) -> Column:
    return F.when(looks_like_code(content), "code").otherwise(text_class(content))


def confidence_level(confidence: Column) -> Column:
    return F.when(confidence >= 0.85, "high").when(confidence >= 0.70, "medium").otherwise("low")


def page_class(chars: Column) -> Column:
    return F.when(chars >= 100, "digital").when(chars <= 20, "scanned").otherwise("hybrid")


def page_class_batch(chars: Column) -> Column:
    return F.when(chars < 100, "scanned").otherwise("digital")


def text_confidence(content: Column, runs: bool = True) -> Column:
    """How likely a text was read right: by marks, blanks, letters, runs of one character (unless they are not to count) and length."""
    n = F.char_length(F.trim(content)).cast("double")
    marks = chars_of(content, r"@#$%^&*()_+=\[\]{}|\\<>~`") / n
    blanks = chars_of(content, r" \n\t") / n
    alnum = chars_of(content, r"\p{L}\p{N}") / n
    run = lambda pattern: content.rlike(pattern) if runs else F.lit(False)
    return (
        F.when(content.isNull() | (n == 0), 0.1).when(n < 5, 0.3).when(marks > 0.3, 0.2).when(marks > 0.15, 0.5).when(blanks > 0.5, 0.6)
        .when(alnum < 0.3, 0.4).when(alnum < 0.5, 0.6).when(run(r"(?s)(.)\1{10}"), 0.3).when(run(r"(?s)(.)\1{5}"), 0.6)
        .when(n > 500, 0.95).when(n > 200, 0.85).when(n > 50, 0.75).otherwise(0.65)
    )


def tier(confidence: Column) -> Column:
    return F.when(confidence >= 0.85, "excellent").when(confidence >= 0.7, "good").when(confidence >= 0.5, "fair").otherwise("poor")


def needs_ocr(confidence: Column) -> Column:
    return confidence < 0.7


def recognition_artifacts(content: Column) -> Column:
    """Two or more signs of faulty recognition."""
    hits = count_of(content, ("l1", "0O", "rn", "|||", "..."))
    other = F.regexp_count(content, F.lit(r"[^\p{L}\p{N} .,;:!?\-'\"]")) / F.char_length(content)
    return (F.char_length(content) > 0) & (hits + (other > 0.1).cast("int") >= 2)


def noise_level(content: Column, density: Column) -> Column:
    words = F.regexp_count(content, F.lit(r"\S+"))
    letters = F.regexp_count(content, F.lit(r"\S"))
    special = F.regexp_count(content, F.lit("[·•—–□■●○◊]")) / F.char_length(content)
    score = F.when(density < 0.001, 0.3).otherwise(0.0) + F.when((words > 0) & (letters / words < 3), 0.2).otherwise(0.0) + F.when(special > 0.05, 0.3).otherwise(0.0)
    return F.when(F.char_length(content) == 0, 0.5).otherwise(F.least(F.lit(1.0), score))


def _worth(weight: float):
    return lambda hits: F.when(hits >= 2, F.least(hits * weight, F.lit(weight * 3))).otherwise(0.0)


def corruption_score(content: Column, hint: str | None = None) -> Column:
    """Sum of the weights of signs that occur twice or more, at most 1; a hint of de or nl leaves only its own signs."""
    total = F.lit(0.0)
    for pattern, weight, language in CORRUPTION:
        if (hint in ("de", "nl") and language != hint) or (hint == "en" and language):
            continue
        total = total + let(F.regexp_count(content, F.lit(pattern)), _worth(weight))
    return F.when(F.char_length(content) < 10, 0.0).otherwise(F.least(total, F.lit(1.0)))


def disorder_score(content: Column) -> Column:
    """Signs that lines are out of order: short lines, a heading at the end, many abbreviations."""
    lines = F.filter(F.transform(F.split(content, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    short = F.size(F.filter(lines, lambda x: F.char_length(x) <= 42)) / F.size(lines)
    last = F.element_at(lines, -1)
    tail = last.rlike(r"(?i)\b(?:section|chapter)\b") | last.rlike(r"^\d+(?:\.\d+)*\s+")
    tokens = F.regexp_extract_all(content, F.lit(r"((?U)\b[\w\-/]+\b)"), F.lit(1))
    abbreviations = F.size(F.filter(tokens, lambda t: t.rlike(r"^[A-Z]{2,}(?:-[A-Z0-9]{1,})+$")))
    score = F.when(short >= 0.6, 0.25).otherwise(0.0) + F.when(tail, 0.45).otherwise(0.0) + F.when((F.size(tokens) > 0) & (abbreviations / F.size(tokens) >= 0.2), 0.2).otherwise(0.0)
    return F.when(F.size(lines) < 3, 0.0).otherwise(F.least(score, F.lit(1.0)))


def protected_tokens(content: Column) -> Column:
    return F.array_distinct(F.concat(*(F.regexp_extract_all(content, F.lit(f"({p})"), F.lit(1)) for p in PROTECTED)))


#: What an edit of blanks leaves as it is, and the blanks before each of these.
_PIECES, _GAPS = r"([^\s.,;:!?]++|[.,;:!?])", r"(\s*+)(?:[^\s.,;:!?]++|[.,;:!?]|\z)"


def _few_edits(before: Column, after: Column, most: float) -> Column:
    """Whether `after` is at most `most` edits by character of `before` away.

    The difference in length is the fewest that it can take. Where only blanks differ, the edits of the gaps are the most. The
    distance of the whole texts, which grows with the square of their length, decides only where these two leave it open.
    """
    bar = F.greatest(F.char_length(before), F.lit(1)) * most
    fewest = F.abs(F.char_length(before) - F.char_length(after))
    pieces = lambda x: F.regexp_extract_all(x, F.lit(_PIECES), F.lit(1))
    gaps = lambda x: F.regexp_extract_all(x, F.lit(_GAPS), F.lit(1))
    of_gaps = F.aggregate(F.zip_with(gaps(before), gaps(after), lambda a, b: F.when(a == b, 0).otherwise(F.levenshtein(a, b))), F.lit(0), lambda s, x: s + x)
    return (
        F.when(fewest > bar, False).when(F.when(pieces(before) == pieces(after), of_gaps <= bar), True)
        .otherwise(F.levenshtein(before, after) / F.greatest(F.char_length(before), F.lit(1)) <= most)
    )


def edit_allowed(before: Column, after: Column, most: float = MOST_EDITS, tokens: Column | None = None) -> Column:
    """Few edits, the same protected tokens (those of `before` may be given) and no more list marks than before."""
    marks = lambda x: F.regexp_count(x, F.lit(r"(?m)^\s*(?:[-*•]|\d+[.)])\s"))
    tokens = protected_tokens(before) if tokens is None else tokens
    same = lambda a, b: (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    fits = lambda x, y: _few_edits(x, y, most) & let(protected_tokens(y), lambda b: same(tokens, b)) & (marks(y) <= marks(x))
    return let(before, lambda x: let(after, lambda y: F.when(x == y, True).otherwise(fits(x, y))))


def refine_route(content: Column, threshold: float = 0.15, score: Column | None = None, tokens: Column | None = None) -> Column:
    """What happens to a text: left, blocked, repaired by rule, or handed to a model. Its corruption_score and protected_tokens may be given."""
    disorder = disorder_score(content)
    dense = F.size(protected_tokens(content) if tokens is None else tokens) / F.greatest(F.regexp_count(content, F.lit(r"\S+")), F.lit(1))
    technical = count_of(F.lower(content), TECHNICAL) / float(len(TECHNICAL))
    bar = F.lit(threshold) - F.when(dense >= 0.08, 0.05).otherwise(0.0)
    by_score = lambda score: F.when((score >= 0.7) & (technical >= 0.3), "rule").when(score < bar, "keep").otherwise("model")
    return F.when(disorder >= 0.6, "blocked").otherwise(let(corruption_score(content) if score is None else score, by_score))


def tokens_stripped(content: Column) -> Column:
    """A quarter of the stripped characters, rounded, at least one; none for a blank text."""
    text = strip_text(F.coalesce(content, F.lit("")))
    return F.when(text == "", 0).otherwise(F.greatest(F.lit(1), F.floor(F.char_length(text) / 4 + 0.5))).cast("long")


def tokens_plain(content: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.char_length(content) / 4).cast("long"))


def vision_status(description: Column, provider: Column | None = None) -> Column:
    """done; without a description failed if a model was asked, else pending; pending where extraction was unavailable."""
    asked = F.lit(False) if provider is None else F.coalesce(provider != "none", F.lit(False))
    none = F.coalesce(description, F.lit("")).rlike(r"^$|^\[Figure on page|^\[VLM_FAILED")
    return F.when(none, F.when(asked, "failed").otherwise("pending")).when(F.lower(description).contains("extraction unavailable"), "pending").otherwise("done")


#: Priority by modality, ranks, and headings of contents, references and back matter (fixed values).
PRIORITY = {"text": "high", "table": "medium", "image": "low"}
CONTENTS = r"(?i)^\s*(?:table\s+of\s+contents|contents)\s*$"
REFERENCES = r"(?i)^\s*(?:references|bibliography|works\s+cited)\s*$"
BACK_MATTER = r"(?i)^\s*(?:index|appendix(?:\s+[a-z0-9]+)?|appendices)\b"


def search_priority(modality: Column, domain: Column, page: Column, contents_page: Column, headings: Column, given: Column | None = None) -> Column:
    """The given priority, or that of the modality, lowered by domain: literature before its contents, references, back matter.

    headings is the array of a chunk's headings. Nothing raises a priority.
    """
    own = F.lit(None).cast("string") if given is None else F.lower(given)
    base = F.when(own.isin("high", "medium", "low"), own)
    for kind, value in PRIORITY.items():
        base = F.coalesce(base, F.when(modality == kind, value))
    base = F.coalesce(base, F.lit("medium"))
    has = lambda pattern: F.coalesce(F.exists(headings, lambda h: h.rlike(pattern)), F.lit(False))
    low = (domain == "literature") & (page > 0) & (page < contents_page)
    medium = ((domain == "academic") & has(REFERENCES)) | ((domain == "technical") & has(BACK_MATTER))
    return F.when(F.coalesce(low, F.lit(False)), "low").when(F.coalesce(medium, F.lit(False)) & (base == "high"), "medium").otherwise(base)


def min_dimension(sensitivity: Column) -> Column:
    return F.greatest(F.lit(0), (400 - 300 * sensitivity).cast("int"))


def asset_complexity(area_share: Column, size: Column) -> Column:
    """By the share of the page and the file's bytes, either of which may be unknown: text_heavy, simple or complex."""
    heavy = F.coalesce(area_share >= 0.50, F.lit(False)) | F.coalesce(size >= 100_000, F.lit(False))
    tiny = F.coalesce(area_share < 0.01, F.lit(False))
    small = F.coalesce(area_share < 0.15, F.lit(False)) & F.coalesce(size <= 5_000, F.lit(True))
    return F.when(heavy, "text_heavy").when(tiny | small, "simple").otherwise("complex")


def image_type(colours: Column, white: Column, saturation: Column) -> Column:
    diagram = (colours < 120) & (white > 0.30) & (saturation < 0.25)
    photo = (colours > 400) & (saturation > 0.20) & (white < 0.40)
    return F.struct(diagram.alias("is_diagram"), photo.alias("is_photo"))


# ---- classes and confidences of the extraction lanes

#: Words of technical texts as the element lane counts them (fixed values).
TECHNICAL_WORDS = (
    "algorithm", "architecture", "api", "class", "function", "method", "parameter", "configuration", "schema", "pipeline", "module", "implementation", "dataset", "model", "token",
)
#: Parts of layout labels and the chunk types that they mean, in the order in which they count (fixed values).
LABEL_TYPES = (("title", "title"), ("heading", "heading"), ("section", "heading"), ("list", "list_item"), ("caption", "caption"), ("footnote", "footnote"), ("quote", "quote"), ("code", "code"))


def element_class(content: Column, chunk_type: Column) -> Column:
    """code by type, technical with two technical words or more, else editorial."""
    hits = count_of(F.lower(F.coalesce(content, F.lit(""))), TECHNICAL_WORDS)
    return F.when(F.coalesce(chunk_type == "code", F.lit(False)), "code").when(hits >= 2, "technical").otherwise("editorial")


def label_type(label: Column) -> Column:
    low, found = F.lower(label), F.lit("paragraph")
    for part, kind in reversed(LABEL_TYPES):
        found = F.when(low.contains(part), kind).otherwise(found)
    return found


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _plus(x: Column, more: float, when: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.least(F.lit(1.0), x + more)).otherwise(x)


def length_confidence(chars: Column) -> Column:
    return F.when(chars > 2000, 0.9).when(chars > 500, 0.8).when(chars > 100, 0.7).when(chars > 20, 0.5).otherwise(0.2)


def pdf_confidence(score: Column, chars: Column, image_share: Column) -> Column:
    base = F.coalesce(score.cast("double"), length_confidence(chars)) * F.when(image_share > 0.5, 0.9).otherwise(1.0)
    return _unit(base * F.when(chars < 50, 0.5).when(chars < 100, 0.7).otherwise(1.0))


def book_confidence(chars: Column, has_contents: Column, chapters: Column, errors: Column) -> Column:
    base = _plus(_plus(length_confidence(chars), 0.1, has_contents), 0.05, chapters > 3)
    return _unit(base - F.when(errors > 0, F.least(F.lit(0.3), errors * 0.05)).otherwise(0.0))


def html_confidence(score: Column, chars: Column, article: Column, main: Column, boilerplate: Column) -> Column:
    """score is out of 100, or null."""
    base = _plus(_plus(F.coalesce(score.cast("double") / 100, length_confidence(chars)), 0.05, article), 0.05, main)
    return _unit(base * F.when(boilerplate > 0.7, 0.9).otherwise(1.0))


def text_document_confidence(chars: Column, paragraphs: Column, styles: Column) -> Column:
    base = F.when(chars > 100, F.greatest(length_confidence(chars), F.lit(0.85))).otherwise(length_confidence(chars))
    return _unit(_plus(_plus(base, 0.05, paragraphs > 5), 0.03, styles))


def slides_confidence(slides: Column, chars: Column, notes: Column) -> Column:
    each = chars / F.greatest(slides, F.lit(1))
    return F.when(slides == 0, 0.0).otherwise(_unit(_plus(F.when(each > 200, 0.85).when(each > 50, 0.7).otherwise(0.5), 0.1, notes)))


def sheet_confidence(cells: Column) -> Column:
    return F.when(cells == 0, 0.0).when(cells > 100, 0.9).when(cells > 10, 0.8).otherwise(0.6)


def word_reading_confidence(mean: Column, words: Column) -> Column:
    """mean is out of 100, over words."""
    return _unit(mean / 100.0 * F.when(words < 5, 0.7).otherwise(1.0))


def line_reading_confidence(mean: Column, lines: Column) -> Column:
    return _unit(_plus(mean.cast("double"), 0.05, lines > 0))


def element_confidence(extraction: Column, layout: Column, classification: Column) -> Column:
    """A struct of the weighted confidence, its tier and whether the extraction needs recognition."""
    whole = extraction * 0.6 + layout * 0.2 + classification * 0.2
    return F.struct(whole.alias("combined"), tier(whole).alias("tier"), needs_ocr(extraction).alias("needs_ocr"))


#: Words with which no section begins, words of sections and what begins one (fixed values).
NO_SECTION = (
    "the and but or for with from into by of page continued see also more next prev previous advertisement advert sponsor subscribe subscription"
).split()
SECTION_WORDS = (
    "news", "feature", "report", "analysis", "interview", "review", "special", "gallery", "inside", "profile", "cutting edge", "frontline", "airpower", "combat", "mission", "operation",
    "squadron", "unit", "history", "heritage", "archive", "technology", "weapons", "systems",
)
SECTION_START = r"(?i)^(News|Feature|Report|Analysis|Interview|Review|Special|Gallery|Inside|Profile)\b"


def section_of(text: Column, first_on_page: Column) -> Column:
    """A struct (method, name, confidence) for a line that begins a section of a magazine, else null.

    The shapes count in turn: number and title, capitals, title with colon, known beginning; then words of sections, which a
    line must begin with or be short for; then, first on its page, a short line in title case.
    """
    t = strip_text(F.coalesce(text, F.lit("")))
    low, n = F.lower(t), F.char_length(t)
    usable = n.between(3, 60) & t.rlike(r"\p{L}") & ~F.regexp_extract(low, r"(?U)^(\S+)", 1).isin(*NO_SECTION)
    told = lambda method, name, confidence: F.struct(F.lit(method).alias("method"), _section_name(name).alias("name"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).alias("confidence"))
    numbered, capitals, titled = r"^\d{1,3}\s+([A-Z][A-Za-z\s&-]{2,40})$", r"^([A-Z][A-Z\s&-]{3,40})$", r"^([A-Za-z\s]{2,20}):\s*(.+)$"
    word = F.lit(False)
    for w in SECTION_WORDS:
        word = word | (low.contains(w) & (low.startswith(w) | (n < 30)))
    words = F.split(t, r"(?U)\s+")
    title_case = F.forall(words, lambda w: ~w.rlike(r"^\p{L}") | w.rlike(r"^\p{Lu}")) & (F.size(words) <= 5)
    return F.when(
        usable,
        F.when(t.rlike(numbered), told("numbered_section", F.regexp_extract(t, numbered, 1), 0.9))
        .when(t.rlike(capitals), told("caps_section", F.regexp_extract(t, capitals, 1), 0.85))
        .when(t.rlike(titled), told("titled_section", F.regexp_extract(t, titled, 1), 0.95))
        .when(t.rlike(SECTION_START), told("keyword_section", F.regexp_extract(t, SECTION_START, 1), 0.8))
        .when(word, told("keyword_match", t, F.when(first_on_page, 0.75).otherwise(0.5)))
        .when(first_on_page & (n < 40) & title_case, told("position_titlecase", t, 0.6)),
    )


def _section_name(name: Column) -> Column:
    """Single blanks, without a leading number; capitals become title case."""
    plain = F.regexp_replace(F.regexp_replace(strip_text(name), r"(?U)\s+", " "), r"^\d+ ?(?=.)", "")
    return F.when((plain == F.upper(plain)) & (plain != F.lower(plain)), F.initcap(plain)).otherwise(plain)


def wants_refiner(disabled: Column, enabled: Column, default: Column, corrupt: Column) -> Column:
    """What was said explicitly counts, no before yes; else the default, for documents with faulty encoding only."""
    return ~disabled & (enabled | (default & corrupt))

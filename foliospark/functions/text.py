"""Row-local text repair as column expressions; null stays null.

Java's classes are ASCII; patterns that need letters or white space of all scripts begin with (?U).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What shows that control characters stand within code (fixed values).
CODE_TOKENS = (" = ", "def ", "class ", "import ", "if ", "for ", "while ", "return ", "print(", "elif ", "else:", ":=", "->", "lambda ")
#: Symbol-font characters and what they show (fixed values).
PRIVATE_FROM, PRIVATE_TO = "\uf02d\uf0b7\uf0e0\uf070\uf071\uf074\uf075", "••→◄►▲▼"
CONTROLS = r" *[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]+ *"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once for each row however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def any_of(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


def count_of(text: Column, words) -> Column:
    """How many of the words the text contains."""
    return reduce(lambda a, b: a + b, (text.contains(w).cast("int") for w in words))


def chars_of(text: Column, kinds: str) -> Column:
    """How many characters of a text are of the kinds, which are the inside of a pattern's brackets."""
    return F.char_length(F.regexp_replace(text, f"[^{kinds}]++", ""))


def strip_text(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def separate_controls(text: Column) -> Column:
    """Runs of control characters become one space in code and `; ` elsewhere."""
    code = F.regexp_replace(text, CONTROLS, " ")
    return F.when(any_of(text, CODE_TOKENS), code).otherwise(F.regexp_replace(text, CONTROLS, "; "))


def collapse_replacements(text: Column) -> Column:
    """Runs of the replacement character, with the blanks around them, become one space."""
    return F.regexp_replace(text, "[ \t]*�[� \t]*", " ")


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F\x7F]", "")


def map_private_use(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, PRIVATE_FROM, PRIVATE_TO), r"[\x{E000}-\x{F8FF}]", " ")


def normalise_chunk(text: Column, is_code: Column) -> Column:
    """Private-use characters everywhere; blanks, hyphens at line ends and joined capitals only outside code."""
    plain = map_private_use(text)
    prose = F.regexp_replace(plain, r"(?U)[^\S\n]{2,}", " ")
    prose = F.regexp_replace(prose, r"(?U)(\w)-\n\s*(\w)", "$1$2")
    prose = F.regexp_replace(prose, r"(?U)(\w)-\s*$", "$1")
    return F.when(is_code, plain).otherwise(F.regexp_replace(prose, r"([A-Z]{2,})([A-Z][a-z]{2,})", "$1 $2"))


def repair_numbers(text: Column) -> Column:
    """Decimals, times signs, per cent, units and plus-minus signs that recognition tore apart."""
    for pattern, to in (
        (r"(\d+)\s+\.\s+(\d+)", "$1.$2"), (r"(\d+\.?\d*)\s+×", "$1×"), (r"(\d+\.?\d*)\s+%", "$1%"),
        (r"(?i)(\d+\.?\d*)\s+(GHz|MHz|KB|MB|GB|TB|ms|μs|ns)", "$1$2"), (r"([±≈])\s+(\d)", "$1$2"),
    ):
        text = F.regexp_replace(text, pattern, to)
    return text


def drop_page_number_lines(text: Column) -> Column:
    """Lines of one to four digits go if there are two of them or a line beside them has six characters of other text."""
    lines = F.split(text, "\n", -1)
    number = lambda x: F.trim(x).rlike(r"^\d{1,4}$")
    prose = lambda x: (F.char_length(F.trim(x)) >= 6) & ~number(x)
    several = F.size(F.filter(lines, number)) >= 2
    kept = F.filter(
        lines,
        lambda x, i: ~(number(x) & (several | F.coalesce(prose(F.get(lines, i - 1)), F.lit(False)) | F.coalesce(prose(F.get(lines, i + 1)), F.lit(False)))),
    )
    return F.when(F.size(lines) < 2, text).otherwise(F.trim(F.array_join(kept, "\n"), F.lit("\n")))


def drop_digit_lines(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?m)^\s*\d{1,4}\s*$\n?", ""), F.lit("\n"))


def join_hyphenation(text: Column) -> Column:
    """Soft hyphens at a line end vanish, hard ones stay; the lines join."""
    return F.regexp_replace(F.regexp_replace(text, "([A-Za-z0-9])­\\s*\\n\\s*([a-z])", "$1$2"), r"([A-Za-z0-9])-\s*\n\s*([a-z])", "$1-$2")


def drop_infix_numbers(text: Column) -> Column:
    """List numbers from 1 to 40 between two lower-case words go."""
    return F.regexp_replace(text, r"(\b[a-z][a-z'\-]{0,15})\s+(?:[1-9]|[12]\d|3\d|40)\.\s+([a-z][A-Za-z'\-]*)", "$1 $2")


def break_infix_steps(text: Column) -> Column:
    """A list number between words starts a line, but not in ranges and enumerations."""
    return F.regexp_replace(
        text, r"\b(?!(?:bis|to|from|through|vom|von|and|or)\s)([a-z][a-z'\-]+)[ \t]+((?:[1-9]|[12]\d|3\d|40)\.)[ \t]+(?!(?:bis|to|through)\b)([a-z][A-Za-z'\-]+)", "$1\n$2 $3"
    )


def sanitise_manual(text: Column) -> Column:
    """Controls, page numbers, digit lines and hyphenation in turn; null where nothing is left."""
    clean = join_hyphenation(drop_digit_lines(drop_page_number_lines(drop_controls(text))))
    return F.when(strip_text(clean) == "", F.lit(None)).otherwise(clean)


def strip_cell_marks(text: Column) -> Column:
    """Texts with three or more cell marks such as `, 3 = ` lose them."""
    marks = r",\s*\d+\s*="
    return F.when(F.regexp_count(text, F.lit(marks)) >= 3, F.trim(F.regexp_replace(F.regexp_replace(text, marks, " "), r"[ \t]{2,}", " "))).otherwise(text)


def tidy_spaces(text: Column) -> Column:
    """Single blanks, none before punctuation, none at line ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"\s+([.,;:!?])", "$1"), r"(?m)[ \t]+$", "")


def truncate_at_sentence(text: Column, most: int = 400) -> Column:
    """At most so many characters: up to a sentence end in the last two fifths, else to a blank in the last fifth and dots."""
    head = F.substring(text, 1, most)
    place = lambda mark: F.when(F.locate(mark, F.reverse(head)) > 0, most + 1 - F.locate(mark, F.reverse(head))).otherwise(0)
    found, blank = F.greatest(*(place(m) for m in ".!?")), place(" ")
    return (
        F.when(F.char_length(text) <= most, text)
        .when(found > most * 0.6, F.substr(head, F.lit(1), found))
        .when(blank > most * 0.8, F.concat(F.rtrim(F.substr(head, F.lit(1), blank)), F.lit("...")))
        .otherwise(F.concat(head, F.lit("...")))
    )


def table_markdown(text: Column) -> Column:
    """Two piped lines stay as they are; else lines are split at tabs and double blanks and padded, or make one column."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    piped = F.size(F.filter(lines, lambda x: x.contains("|"))) >= 2
    cells = F.transform(lines, lambda x: F.split(x, r"\t+| {2,}", -1))
    width = F.array_max(F.transform(cells, F.size))
    padded = F.transform(cells, lambda c: F.concat(F.lit("| "), F.array_join(F.concat(c, F.array_repeat(F.lit(""), width - F.size(c))), " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    wide = F.array_join(F.concat(F.slice(padded, 1, 1), F.array(rule), F.slice(padded, F.lit(2), F.size(padded))), "\n")
    single = F.array_join(F.concat(F.array(F.lit("| Content |"), F.lit("| --- |")), F.transform(lines, lambda x: F.concat(F.lit("| "), x, F.lit(" |")))), "\n")
    return F.when(piped | (F.size(lines) == 0), text).when(width > 1, wide).otherwise(single)


def strip_fences(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"^\s*```[a-zA-Z]*\s*\n?", ""), r"\n?```\s*$", ""))


def embedding_text(content: Column, breadcrumb: Column) -> Column:
    return F.when(F.size(breadcrumb) > 0, F.concat(F.lit("["), F.array_join(breadcrumb, " > "), F.lit("] "), content)).otherwise(content)


def contextual_text(content: Column, breadcrumb: Column, heading: Column, before: Column, after: Column, modality: Column) -> Column:
    """A line for each part of the context that is not blank, then the content."""
    line = lambda name, x: F.when(F.trim(x) != "", F.concat(F.lit(f"[{name}: "), x, F.lit("]")))
    path = F.when(F.size(breadcrumb) > 0, F.array_join(breadcrumb, " > "))
    return F.concat_ws(
        "\n", line("Context", path), line("Heading", heading), line("Previous", F.substring(before, 1, 300)), line("Next", F.substring(after, 1, 300)),
        F.when(modality != "text", F.concat(F.lit("[Modality: "), modality, F.lit("]"))), content,
    )


def truncate_heading(text: Column, most: int = 100) -> Column:
    return F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def section_name(text: Column) -> Column:
    """Without its number; capitals become title case."""
    plain = F.trim(F.regexp_replace(text, r"^\d+(?:\.\d+)*\.?\s+", ""))
    return F.when(plain == F.upper(plain), F.initcap(plain)).otherwise(plain)

"""Operators over the reading order of chunks. Each partitions by document (and page), so tasks hold one document's order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import break_infix_steps, strip_text

SNIPPET = 300
LEVELS = 5


def reading_order():
    return Window.partitionBy("doc_id").orderBy("pos")


def so_far():
    return reading_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_snippets(chunks: DataFrame) -> DataFrame:
    """prev_snippet and next_snippet: the ends of the chunk before and the start of the one after."""
    return chunks.withColumns(
        {"prev_snippet": F.substring(F.lag("content").over(reading_order()), -SNIPPET, SNIPPET), "next_snippet": F.substring(F.lead("content").over(reading_order()), 1, SNIPPET)}
    )


def carry_heading(chunks: DataFrame, heading: Column) -> DataFrame:
    """parent_heading: the last heading at or before each chunk."""
    return chunks.withColumn("parent_heading", F.last(heading, ignorenulls=True).over(so_far()))


def breadcrumbs(chunks: DataFrame, level: Column, heading: Column) -> DataFrame:
    """breadcrumb: the open headings of levels 1 to 5. A heading closes those of its level and deeper ones."""
    lv = F.when(level.isNotNull(), F.least(F.greatest(level, F.lit(1)), F.lit(LEVELS)))
    own = [F.last(F.when(lv <= k, F.struct((lv == k).alias("is"), heading.alias("text"))), ignorenulls=True).over(so_far()) for k in range(1, LEVELS + 1)]
    open_ = F.array(*(F.when(x["is"], x["text"]) for x in own))
    return chunks.withColumn("breadcrumb", F.filter(open_, lambda x: x.isNotNull()))


def positions(chunks: DataFrame, *order: str) -> DataFrame:
    return chunks.withColumn("position", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))


def page_context(chunks: DataFrame, heading: Column) -> DataFrame:
    """page_heading: the first heading of the page, else the last one of earlier pages."""
    page = Window.partitionBy("doc_id", "page_number").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(heading, ignorenulls=True).over(page)
    return chunks.withColumn("__first", first).withColumn("page_heading", F.coalesce("__first", F.last("__first", ignorenulls=True).over(so_far()))).drop("__first")


def orphan_labels(chunks: DataFrame, is_label: Column, ahead: int = 4) -> DataFrame:
    """orphan: labels without running text among the next chunks of this page or the following one."""
    frame = reading_order().rowsBetween(1, ahead)
    rows = chunks.withColumn("__label", is_label)
    near = F.collect_list(F.struct("page_number", "content", "__label")).over(frame)
    body = F.exists(near, lambda x: x["page_number"].between(F.col("page_number"), F.col("page_number") + 1) & (F.char_length(x["content"]) >= 20) & ~x["__label"])
    return rows.withColumn("orphan", F.col("__label") & ~body).drop("__label")


def cross_page_labels(chunks: DataFrame, is_label: Column) -> DataFrame:
    """split_label: a label as the last chunk of a page."""
    return chunks.withColumn("split_label", is_label & F.coalesce(F.lead("page_number").over(reading_order()) == F.col("page_number") + 1, F.lit(False)))


def page_of_marker(chunks: DataFrame, marker: Column, per_page: int = 5) -> DataFrame:
    """Synthetic pages of a book without pages, for chunks of which `marker` tells the chapter that begins there.

    synthetic_page is chapter * 1000 + place // per_page, the place counting the chapter's chunks from 0. Content is stripped
    and blank chunks go, as do those that repeat one of their page, before places are counted. Chunks before the first
    marker belong to the chapter before it (at least 1); without any marker all are of chapter 1.
    """
    w = Window.partitionBy("doc_id")
    rows = chunks.withColumn("__marker", marker).withColumn("content", strip_text(F.coalesce("content", F.lit(""))))
    first = F.min_by("__marker", F.when(F.col("__marker").isNotNull(), F.col("pos"))).over(w)
    rows = rows.withColumn("__own", F.last("__marker", ignorenulls=True).over(so_far())).withColumn("__first", first)
    rows = rows.withColumn("chapter", F.coalesce("__own", F.greatest(F.lit(1), F.col("__first") - 1), F.lit(1)).cast("int"))
    # a chapter that is marked again after another one counts its places anew
    again = F.coalesce("__own", F.lit(-1)) != F.coalesce(F.lag(F.coalesce("__own", F.lit(-1))).over(reading_order()), F.lit(-2))
    rows = rows.withColumn("__part", F.sum(again.cast("int")).over(so_far())).filter("content <> ''")
    grouped = rows.groupBy("doc_id", "chapter").agg(F.sort_array(F.collect_list(F.struct("pos", "__part", "content"))).alias("__rows"))
    placed = F.expr(
        f"""aggregate(__rows, named_struct('part', cast(-1 AS bigint), 'n', 0, 'out', cast(array() AS array<struct<pos: bigint, content: string, page: bigint>>)), (a, r) ->
            transform(array(IF(a.part = r.__part, a.n, 0)), n -> transform(array(cast(chapter * 1000 + n DIV {per_page} AS bigint)), page ->
              IF(exists(a.out, o -> o.page = page AND o.content = r.content), named_struct('part', r.__part, 'n', n, 'out', a.out),
                 named_struct('part', r.__part, 'n', n + 1, 'out', concat(a.out, array(named_struct('pos', r.pos, 'content', r.content, 'page', page))))))[0])[0], a -> a.out)"""
    )
    kept = grouped.select("doc_id", "chapter", F.explode(placed).alias("__o")).select("doc_id", F.col("__o.pos").alias("pos"), F.col("__o.page").alias("synthetic_page"))
    return rows.join(kept, ["doc_id", "pos"]).select(*chunks.columns, "chapter", "synthetic_page")


def front_matter(chunks: DataFrame, is_chapter: Column) -> DataFrame:
    """front: chunks on pages before the first chapter heading of their document."""
    first = F.min(F.when(is_chapter, F.col("page_number"))).over(Window.partitionBy("doc_id"))
    return chunks.withColumn("front", F.coalesce(F.col("page_number") < first, F.lit(False)))


def section_number(heading: Column) -> Column:
    found = F.regexp_extract(heading, r"^(\d+(?:\.\d+)*)\s*\.?\s+.+$", 1)
    return F.when(found != "", F.transform(F.split(found, r"\."), lambda x: x.cast("int")))


def trim_overlap(chunks: DataFrame, least: int = 10, most: int = 300) -> DataFrame:
    """content without the longest start, of 10 to 300 characters, that ends the (already trimmed) chunk before on its page.

    Empty chunks are passed over. After a chunk that trimming empties, nothing more of its document is trimmed.
    """
    rows = chunks.filter("content <> ''").groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("pos", "content"))).alias("__rows"))
    folded = F.expr(
        f"""aggregate(__rows, array(cast(null AS struct<pos: bigint, content: string, given: string>)), (acc, r) -> concat(acc, array(named_struct(
            'pos', r.pos, 'content', transform(array(coalesce(array_max(filter(sequence(0, least({most}, length(r.content), coalesce(length(element_at(acc, -1).content), 0))),
            k -> k >= {least} AND right(element_at(acc, -1).content, k) = left(r.content, k))), 0)),
            k -> IF(k = 0, r.content, regexp_replace(substr(r.content, 1 + k), '(?U)^\\\\s+', '')))[0], 'given', r.content))))"""
    )
    out = rows.select("doc_id", "page_number", F.explode(F.filter(folded, lambda x: x.isNotNull())).alias("r")).select("doc_id", "page_number", "r.*")
    ended = F.min(F.when(F.col("content") == "", F.col("pos"))).over(Window.partitionBy("doc_id"))
    kept = F.when(F.col("pos") > F.col("__ended"), F.col("given")).otherwise(F.col("content"))
    trimmed = out.withColumn("__ended", ended).select("doc_id", "page_number", "pos", kept.alias("content"))
    return trimmed.unionByName(chunks.filter("content = ''").select("doc_id", "page_number", "pos", "content"))


def merge_pairs(chunks: DataFrame, joins: Column, text: Column) -> DataFrame:
    """Each chunk for which `joins` holds becomes `text` and the next chunk goes. A chunk that went joins no other.

    `joins` and `text` may use the columns of the next chunk as next_<column>. Of a run of chunks that would all join,
    every second one does, from the first on.
    """
    w = reading_order()
    ahead = {f"next_{c}": F.lead(c).over(w) for c in chunks.columns if c not in ("doc_id", "pos")}
    rows = chunks.withColumns(ahead).withColumn("__joins", F.coalesce(joins, F.lit(False)))
    rows = rows.withColumn("__run", F.sum((~F.col("__joins")).cast("int")).over(so_far()))
    place = F.sum(F.col("__joins").cast("int")).over(Window.partitionBy("doc_id", "__run").orderBy("pos"))
    rows = rows.withColumn("__joins", F.col("__joins") & (place % 2 == 1))
    rows = rows.withColumn("__gone", F.coalesce(F.lag("__joins").over(w), F.lit(False))).filter("NOT __gone")
    return rows.withColumn("content", F.when(F.col("__joins"), text).otherwise(F.col("content"))).select(*chunks.columns)


def _right(text: str) -> Column:
    return F.regexp_replace(text, r"(?U)\s+\z", "")


def _left(text: str) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+", "")


def merge_sentences(chunks: DataFrame) -> DataFrame:
    """Joins a chunk that ends amid a sentence with the next one of its page if that begins in lower case; a joined chunk joins no other in the same pass."""
    rows = chunks.select("doc_id", "page_number", "pos", "content").filter("content <> ''")
    joins = (F.col("page_number") == F.col("next_page_number")) & ~_right("content").rlike(r"(?U)[.!?:;\"')\]}\d]\z") & _left("next_content").rlike(r"^\p{Ll}")
    return merge_pairs(rows, joins, F.concat(_right("content"), F.lit(" "), _left("next_content")))


#: Ends of words that a column break tears off (fixed values).
SUFFIXES = (
    "ment", "ments", "ness", "tion", "tions", "sion", "sions", "ing", "ings", "ated", "ates", "ized", "izes", "ance", "ences", "ence", "ances", "ible", "able", "ward", "wards", "wise", "ure", "ures",
    "ive", "ives", "ary", "ory", "ery", "nge", "uce", "rames", "ted", "ent", "ers", "ler", "ding", "king", "ling", "ring", "sing", "ting", "ched", "shed", "ies", "ied",
)


def rejoin_fragments(chunks: DataFrame) -> DataFrame:
    """A chunk that ends in a small letter takes the whole next one of its page if that begins with a torn-off word end and goes on."""
    first = F.regexp_extract(F.col("next_content"), r"(?U)^\s*(\S+)\s+\S", 1)
    torn = F.regexp_replace(first, r"[.,;:!?]+\z", "").isin(*SUFFIXES)
    joins = (F.col("page_number") == F.col("next_page_number")) & _right("content").rlike(r"[a-z]\z") & torn
    return merge_pairs(chunks, joins, F.concat(_right("content"), _left("next_content")))


#: Prepositions that wait for their noun (fixed values).
HUNGRY = (
    "by", "for", "of", "with", "from", "to", "in", "at", "on", "von", "für", "mit", "aus", "bei", "nach", "zu",
    "van", "voor", "met", "uit", "bij", "naar", "door", "par", "pour", "de", "avec",
)


def move_prepositions(chunks: DataFrame) -> DataFrame:
    """A preposition alone on a chunk's last line goes to the next chunk, on this page or the one after, if that begins with a capital.

    Empty chunks are passed over, and a chunk that this empties goes. A chunk of one line that was given a preposition
    keeps it, as its line then has two words.
    """
    w = reading_order()
    rows = chunks.filter("content <> ''").withColumn("__text", _right("content"))
    rows = rows.withColumn("__last", F.regexp_replace(F.element_at(F.split("__text", "\n", -1), -1), r"(?U)^\s+|\s+\z", "")).withColumn("__word", F.regexp_replace("__last", r"^[.,;:!?]+|[.,;:!?]+\z", ""))
    gap = F.abs(F.lead("page_number").over(w) - F.col("page_number"))
    base = F.lower("__word").isin(*HUNGRY) & ~F.col("__last").rlike(r"(?U)\s") & (gap <= 1) & F.lead("content").over(w).rlike(r"(?U)^\s*\p{Lu}")
    rows = rows.withColumn("__base", F.coalesce(base, F.lit(False))).withColumn("__one", F.col("__base") & ~F.col("__text").contains("\n"))
    # a run of one-line chunks takes turns, which the chunk before it begins
    rows = rows.withColumn("__run", F.sum((~F.col("__one")).cast("int")).over(so_far()))
    run = Window.partitionBy("doc_id", "__run").orderBy("pos")
    rows = rows.withColumn("__turn", F.sum(F.col("__one").cast("int")).over(run)).withColumn("__began", F.first(F.when(~F.col("__one"), F.col("__base")), ignorenulls=True).over(run))
    odd = F.when(F.coalesce("__began", F.lit(False)), 0).otherwise(1)
    rows = rows.withColumn("__moves", F.when(F.col("__one"), F.col("__turn") % 2 == odd).otherwise(F.col("__base")))
    rows = rows.withColumn("__got", F.lag(F.when(F.col("__moves"), F.col("__word"))).over(w))
    given = F.when(F.col("__got").isNotNull(), F.concat("__got", F.lit(" "), _left("content"))).otherwise(F.col("content"))
    rows = rows.withColumn("__given", given)
    cut = F.regexp_replace(F.regexp_replace(_right("__given"), r"(?:^|\n)[^\n]*\z", ""), r"(?U)\s+\z", "")
    rows = rows.withColumn("content", F.when(F.col("__moves"), cut).otherwise(F.col("__given"))).filter("NOT (__moves AND content = '')")
    return rows.select(*chunks.columns).unionByName(chunks.filter("content = ''"))


def strip_trailing_heading(chunks: DataFrame, most: int = 40) -> DataFrame:
    """The last of several lines goes if it is short and, whatever its case, a parent heading of the document of three characters or more."""
    blank = r"(?U)^\s+|\s+\z"
    headings = chunks.filter(F.char_length("parent_heading") > 2).select("doc_id", F.regexp_replace(F.lower("parent_heading"), blank, "").alias("__last")).distinct().withColumn("__is", F.lit(True))
    rows = chunks.withColumn("__text", F.regexp_replace("content", r"(?U)\s+\z", ""))
    rows = rows.withColumn("__last", F.lower(F.regexp_replace(F.element_at(F.split("__text", "\n", -1), -1), blank, "")))
    hit = rows.join(headings, ["doc_id", "__last"], "left")
    several = F.col("__text").contains("\n") & (F.char_length("__last") < most)
    cut = F.regexp_replace(F.regexp_replace("__text", r"\n[^\n]*\z", ""), r"(?U)\s+\z", "")
    return hit.withColumn("content", F.when(F.coalesce("__is", F.lit(False)) & several, cut).otherwise(F.col("content"))).select(*chunks.columns)


def merge_by_place(chunks: DataFrame, most_gap: int = 20, least_overlap: float = 0.4, most_chars: int = 8000) -> DataFrame:
    """Joins chunks of text that stand closely below each other on a page: doc_id, page_number, pos, is_code, content and bbox.

    In order of top and left edge, a chunk is joined to the one before (or to what that has become) if both are code or
    neither is, the gap is 0 to 20 units, they overlap by over 0.4 of the narrower one's width and the text stays within 8000
    characters; the box becomes the union of both. Missing boxes count as [0, 0, 0, 0].
    """
    box = F.coalesce("bbox", F.array(*[F.lit(0)] * 4)).cast("array<int>")
    row = F.struct(box[1].alias("y"), box[0].alias("x"), F.col("pos").alias("pos"), F.col("is_code").alias("code"), F.col("content").alias("content"), box.alias("b"))
    pages = chunks.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(row)).alias("__rows"))
    folded = F.expr(
        f"""aggregate(slice(__rows, 2, size(__rows)), named_struct('out', cast(array() AS array<struct<y: int, x: int, pos: bigint, code: boolean, content: string, b: array<int>>>), 'cur', __rows[0]), (a, r) ->
            IF(a.cur.code = r.code AND r.b[1] - a.cur.b[3] BETWEEN 0 AND {most_gap}
                 AND greatest(0, least(a.cur.b[2], r.b[2]) - greatest(a.cur.b[0], r.b[0])) / greatest(1, least(a.cur.b[2] - a.cur.b[0], r.b[2] - r.b[0])) > {least_overlap}
                 AND length(regexp_replace(a.cur.content, '(?U)\\\\s+\\\\z', '')) + length(regexp_replace(r.content, '(?U)^\\\\s+', '')) + 1 <= {most_chars},
               named_struct('out', a.out, 'cur', named_struct('y', a.cur.y, 'x', a.cur.x, 'pos', a.cur.pos, 'code', a.cur.code,
                 'content', regexp_replace(concat(regexp_replace(a.cur.content, '(?U)\\\\s+\\\\z', ''), '\\n', regexp_replace(r.content, '(?U)^\\\\s+', '')), '(?U)^\\\\s+|\\\\s+\\\\z', ''),
                 'b', array(least(a.cur.b[0], r.b[0]), least(a.cur.b[1], r.b[1]), greatest(a.cur.b[2], r.b[2]), greatest(a.cur.b[3], r.b[3])))),
               named_struct('out', concat(a.out, array(a.cur)), 'cur', r)), a -> concat(a.out, array(a.cur)))"""
    )
    return pages.select("doc_id", "page_number", F.explode(folded).alias("r")).select("doc_id", "page_number", "r.pos", F.col("r.code").alias("is_code"), "r.content", F.col("r.b").alias("bbox"))


def final_repairs(chunks: DataFrame) -> DataFrame:
    """The last repairs of chunk boundaries, in their order: list numbers, trailing headings, prepositions, sentences, overlaps."""
    rows = strip_trailing_heading(chunks.withColumn("content", break_infix_steps(F.col("content"))))
    return trim_overlap(merge_sentences(move_prepositions(rows)))


def inferred_headings(chunks: DataFrame, source_file: str = "source_file") -> DataFrame:
    """parent_heading of chunks that have none, or the file's name, from first lines in capitals or that name a model: the last one so far."""
    line = F.regexp_replace(F.element_at(F.split(strip_text(F.col("content")), "\n", -1), 1), r"(?U)^\s+|\s+\z", "")
    capitals = F.char_length(line).between(4, 59) & (line == F.upper(line)) & line.rlike(r"\p{L}") & ~line.rlike(r"^(?:THE|A|IN|ON|TO) ")
    model = line.rlike(r"^[A-Z][a-z].*(?:No\.|Model|Mk|Type|Mark)\s")
    found = F.last(F.when(capitals | model, line), ignorenulls=True).over(so_far())
    none = (F.coalesce("parent_heading", F.lit("")) == "") | (F.col("parent_heading") == F.col(source_file))
    return chunks.withColumn("parent_heading", F.when(none & found.isNotNull(), found).otherwise(F.col("parent_heading")))


def promote_drop_caps(items: DataFrame) -> DataFrame:
    """A single capital (doc_id, page_number, pos, text, y0, y1) goes before the next text of its page, else the one before, that
    begins in lower case and overlaps it in height; the capital's own row goes.

    A text that was given a capital begins with it and takes no other.
    """
    w = reading_order()
    rows = items.withColumn("__cap", F.coalesce(F.trim("text").rlike(r"^\p{Lu}$"), F.lit(False)))

    def fits(step) -> Column:
        low = F.coalesce(step("text").rlike(r"^\s*\p{Ll}"), F.lit(False))
        beside = (step("page_number") == F.col("page_number")) & (F.least(step("y1"), F.col("y1")) > F.greatest(step("y0"), F.col("y0")))
        return F.col("__cap") & low & F.coalesce(beside, F.lit(False))

    ahead, behind = fits(lambda x: F.lead(x).over(w)), fits(lambda x: F.lag(x).over(w))
    rows = rows.withColumns({"__ahead": ahead, "__behind": behind})
    # the text between two capitals is given the first one's, which stands before it
    taken = F.coalesce(F.lag("__ahead", 2).over(w), F.lit(False))
    rows = rows.withColumn("__back", F.col("__behind") & ~F.col("__ahead") & ~taken)
    cap = F.coalesce(F.when(F.lag("__ahead").over(w), F.trim(F.lag("text").over(w))), F.when(F.lead("__back").over(w), F.trim(F.lead("text").over(w))))
    rows = rows.withColumn("text", F.concat(F.coalesce(cap, F.lit("")), "text"))
    return rows.filter(~(F.col("__ahead") | F.col("__back"))).select(*items.columns)

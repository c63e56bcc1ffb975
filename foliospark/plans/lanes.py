"""Queries of sources, classes of the extraction lanes, index pages, boxes, retrieval and sinks."""

from __future__ import annotations

import html
import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import geometry as G
from ..functions import predicates as P
from ..operators import aggregates as A
from ..operators import external as E
from ..operators import retrieval as V
from ..operators import windows as W
from ..sources import archives as Z
from ..sources import readers as S
from ..sources import sinks as K
from .catalog import _BOXES, CHUNKS, boxes, chunks, docs, query
from .rules import PLANTED, planted

c = F.col


# ---- sources


def _zip(members: dict[str, str]) -> bytes:
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return data.getvalue()


def _book(lines: list[str]) -> bytes:
    """A book with five lines to a chapter, the first of them a heading, and an empty chapter at the end."""
    chapters = [lines[k : k + 5] for k in range(0, len(lines), 5)] + [[]]
    body = lambda own: "".join(f"<{t}>{html.escape(x)}</{t}>" for t, x in zip(["h2"] + ["p"] * 4, own, strict=False))
    items = "".join(f'<item id="c{k}" href="text/c%20{k}.xhtml"/>' for k in range(len(chapters)))
    refs = "".join(f'<itemref idref="c{k}"/>' for k in range(len(chapters)))
    return _zip(
        {"mimetype": "application/epub+zip", "META-INF/container.xml": '<c xmlns="urn:x"><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></c>', "OPS/p.opf": f'<package xmlns="urn:o"><manifest>{items}</manifest><spine>{refs}</spine></package>'}
        | {f"OPS/text/c {k}.xhtml": f"<html><head><title>no</title><style>p</style></head><body>{body(own)}<script>no</script></body></html>" for k, own in enumerate(chapters)}
    )


def _letters(lines: list[str]) -> bytes:
    x = html.escape
    w = 'xmlns:w="urn:w"'
    paragraphs = "".join(f'<w:p><w:pPr>{"<w:pStyle w:val=" + chr(34) + "Heading2" + chr(34) + "/>" if k % 7 == 0 else ""}</w:pPr><w:r><w:t>{x(t)}</w:t></w:r></w:p>' for k, t in enumerate(lines))
    return _zip({"word/document.xml": f"<w:document {w}><w:body>{paragraphs}</w:body></w:document>"})


def _slides(lines: list[str]) -> bytes:
    return _zip({f"ppt/slides/slide{k + 1}.xml": f'<p:sld xmlns:p="urn:p" xmlns:a="urn:a"><a:p><a:r><a:t>{html.escape(t)}</a:t></a:r></a:p></p:sld>' for k, t in enumerate(lines)})


def _sheets(lines: list[str]) -> bytes:
    rows = "".join(f'<row><c r="A{k + 1}" t="s"><v>{k}</v></c><c r="C{k + 1}"><v>{k}</v></c></row>' for k in range(len(lines)))
    shared = "".join(f"<si><t>{html.escape(t)}</t></si>" for t in lines)
    return _zip({"xl/sharedStrings.xml": f'<sst xmlns="urn:s">{shared}</sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="urn:s"><sheetData>{rows}</sheetData></worksheet>'})


def _files(spark, d, make):
    """One file for each document, made of its lines with single blanks."""

    def run(frames):
        for frame in frames:
            made = [make([" ".join(x.split()) for x in (t or "").split("\n") if x.strip()]) for t in frame["text"]]
            yield pd.DataFrame({"path": frame["doc_id"].astype(str), "content": made})

    return docs(spark, d).select("doc_id", "text").mapInPandas(run, "path string, content binary")


_LINES_SQL = f"""ln AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, t FROM (SELECT doc_id, i, trim(regexp_replace(string_split(text, chr(10))[i], '\\s+', ' ', 'g')) AS t
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)) WHERE t <> '')"""


@query(
    "s04_book_blocks",
    f"""WITH {_LINES_SQL} SELECT doc_id::VARCHAR AS path, (k // 5 + 1)::INT AS part, (k % 5)::INT AS pos, CASE WHEN k % 5 = 0 THEN 'heading' ELSE 'paragraph' END AS kind, CASE WHEN k % 5 = 0 THEN 2 END::INT AS level, t AS text FROM ln
UNION ALL SELECT doc_id::VARCHAR, ((max(k) + 5) // 5 + 1)::INT, 0, 'blank', NULL, '' FROM ln GROUP BY doc_id""",
)
def s04(spark, d):
    return Z.archive_blocks(_files(spark, d, _book), "epub").select("path", "part", "pos", "kind", "level", "text")


@query(
    "s06_office_blocks",
    f"""WITH {_LINES_SQL} SELECT 'docx' AS format, doc_id::VARCHAR AS path, 1 AS part, k::INT AS pos, CASE WHEN k % 7 = 0 THEN 'heading' ELSE 'paragraph' END AS kind, t AS text FROM ln
UNION ALL SELECT 'pptx', doc_id::VARCHAR, (k + 1)::INT, 0, 'paragraph', t FROM ln
UNION ALL SELECT 'xlsx', doc_id::VARCHAR, 1, 0, 'table', string_agg('| ' || t || ' |  | ' || k || ' |' || CASE WHEN k = 0 THEN chr(10) || '| --- | --- | --- |' ELSE '' END, chr(10) ORDER BY k) FROM ln GROUP BY doc_id""",
)
def s06(spark, d):
    found = [Z.archive_blocks(_files(spark, d, make), kind).select(F.lit(kind).alias("format"), "path", "part", "pos", "kind", "text") for kind, make in (("docx", _letters), ("pptx", _slides), ("xlsx", _sheets))]
    return found[0].unionByName(found[1]).unionByName(found[2])


_MARK = "CASE WHEN pos % 9 = 4 THEN (pos // 9 + 3) END"
_REPEATED = "CASE WHEN pos % 4 = 2 THEN 'same' WHEN pos % 11 = 7 THEN '  ' ELSE content END"


@query(
    "s05_synthetic_pages",
    f"""WITH RECURSIVE {CHUNKS}, x AS (SELECT doc_id, pos, {_REPEATED} AS content, {_MARK} AS marker FROM chunks),
y AS (SELECT *, trim(content) AS t, coalesce(last_value(marker IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), CASE WHEN min(marker) OVER (PARTITION BY doc_id) IS NULL THEN 1 ELSE greatest(1, min(marker) OVER (PARTITION BY doc_id) - 1) END) AS chapter FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chapter ORDER BY pos) AS rn FROM y WHERE t <> ''),
w AS (SELECT doc_id, chapter, rn, pos, t, 0 AS n, [t] AS page, true AS kept FROM z WHERE rn = 1
  UNION ALL SELECT z.doc_id, z.chapter, z.rn, z.pos, z.t, CASE WHEN w.kept THEN w.n + 1 ELSE w.n END,
    CASE WHEN (CASE WHEN w.kept THEN w.n + 1 ELSE w.n END) % 5 = 0 AND w.kept THEN [z.t] ELSE list_append(w.page, z.t) END,
    NOT ((CASE WHEN w.kept THEN w.n + 1 ELSE w.n END) % 5 > 0 AND list_contains(w.page, z.t)) AND NOT ((CASE WHEN w.kept THEN w.n + 1 ELSE w.n END) % 5 = 0 AND NOT w.kept AND list_contains(w.page, z.t))
  FROM w JOIN z ON z.doc_id = w.doc_id AND z.chapter = w.chapter AND z.rn = w.rn + 1)
SELECT doc_id, pos, chapter::INT AS chapter, (chapter * 1000 + n // 5)::BIGINT AS synthetic_page, t AS content FROM w WHERE kept""",
)
def s05(spark, d):
    rows = chunks(spark, d).select("doc_id", "pos", F.expr(_REPEATED).alias("content"), F.expr(_MARK.replace("//", "DIV")).cast("int").alias("marker"))
    return W.page_of_marker(rows, c("marker")).select("doc_id", "pos", "chapter", "synthetic_page", "content")


@query(
    "s01_formats",
    """SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'pdf' WHEN 1 THEN 'epub' WHEN 2 THEN 'docx' WHEN 3 THEN 'pptx' WHEN 4 THEN 'xlsx' WHEN 5 THEN 'markdown' WHEN 6 THEN 'html' WHEN 7 THEN 'unknown' ELSE CASE WHEN regexp_matches(lower(left(html, 400)), '^\\s*(<!doctype html|<html)') THEN 'html' ELSE 'text' END END AS format FROM pages""",
)
def s01(spark, d):
    k = c("page_id") % 9
    head = F.when(k == 0, F.lit(b"%PDF-1.7 html").cast("binary"))
    for n, inner in ((1, "mimetypeapplication/epub+zip"), (2, "word/document.xml"), (3, "ppt/slides"), (4, "xl/workbook.xml")):
        head = F.when(k == n, F.concat(F.unhex(F.lit("504B0304")), F.lit("0000").cast("binary"), F.lit(inner).cast("binary"))).otherwise(head)
    content = F.when(k < 5, head).when(k < 8, F.lit("plain").cast("binary")).otherwise(c("html").cast("binary"))
    path = F.when(k == 5, "a/b.MD").when(k == 8, "x.txt").otherwise("file")
    mime = F.when(k == 6, "text/HTML; charset=utf-8").when(k == 7, "image/png")
    return S.table(spark, d, "pages").select("page_id", S.format_of(content, path, mime).alias("format"))


# ---- classes and confidences

_N = "(pos * 37 + doc_id) % 2600"


@query(
    "c02_c03_lane_classes",
    f"""WITH {PLANTED}, s AS (SELECT doc_id, pos, content, lower(content || CASE pos % 5 WHEN 0 THEN ' token dataset' WHEN 1 THEN ' Method' ELSE '' END) AS l, CASE pos % 8 WHEN 0 THEN 'Section_Header' WHEN 1 THEN 'doc_title' WHEN 2 THEN 'list_item' WHEN 3 THEN 'picture_caption' WHEN 4 THEN 'footnote' WHEN 5 THEN 'quote' WHEN 6 THEN 'Code' ELSE 'text' END AS label FROM planted)
SELECT doc_id, pos, CASE WHEN pos % 8 = 6 THEN 'code' WHEN {' + '.join(f"contains(l, '{w}')::INT" for w in ('algorithm', 'architecture', 'api', 'class', 'function', 'method', 'parameter', 'configuration', 'schema', 'pipeline', 'module', 'implementation', 'dataset', 'model', 'token'))} >= 2 THEN 'technical' ELSE 'editorial' END AS element_class,
  CASE pos % 8 WHEN 0 THEN 'heading' WHEN 1 THEN 'title' WHEN 2 THEN 'list_item' WHEN 3 THEN 'caption' WHEN 4 THEN 'footnote' WHEN 5 THEN 'quote' WHEN 6 THEN 'code' ELSE 'paragraph' END AS chunk_type FROM s""",
)
def c02(spark, d):
    label = F.lit("text")
    for k, name in enumerate(("Section_Header", "doc_title", "list_item", "picture_caption", "footnote", "quote", "Code")):
        label = F.when(c("pos") % 8 == k, name).otherwise(label)
    rows = planted(spark, d).withColumn("chunk_type", C.label_type(label))
    text = F.concat("content", F.when(c("pos") % 5 == 0, " token dataset").when(c("pos") % 5 == 1, " Method").otherwise(""))
    return rows.select("doc_id", "pos", C.element_class(text, c("chunk_type")).alias("element_class"), "chunk_type")


_LEN = "CASE WHEN n > 2000 THEN 0.9 WHEN n > 500 THEN 0.8 WHEN n > 100 THEN 0.7 WHEN n > 20 THEN 0.5 ELSE 0.2 END"


@query(
    "c07_c09_confidences",
    f"""WITH {CHUNKS}, s AS (SELECT doc_id, pos, {_N} AS n, pos % 12 AS k, pos % 2 = 0 AS even, doc_id % 3 = 0 AS third FROM chunks), l AS (SELECT *, {_LEN} AS b FROM s),
v AS (SELECT *, greatest(0, least(1, CASE WHEN third THEN 0.8 ELSE b END * CASE WHEN k > 6 THEN 0.9 ELSE 1 END * CASE WHEN n < 50 THEN 0.5 WHEN n < 100 THEN 0.7 ELSE 1 END)) AS pdf FROM l)
SELECT doc_id, pos, round(pdf, 6) AS pdf, round(greatest(0, least(1, b + CASE WHEN even THEN 0.1 ELSE 0 END) + CASE WHEN k > 3 THEN least(0.05, 1 - least(1, b + CASE WHEN even THEN 0.1 ELSE 0 END)) ELSE 0 END - CASE WHEN k > 0 THEN least(0.3, k * 0.05) ELSE 0 END), 6) AS epub,
  round(least(1, least(1, CASE WHEN third THEN n / 2600.0 ELSE b END + CASE WHEN even THEN 0.05 ELSE 0 END) + CASE WHEN third THEN 0.05 ELSE 0 END) * CASE WHEN k > 7 THEN 0.9 ELSE 1 END, 6) AS html,
  round(least(1, least(1, CASE WHEN n > 100 THEN greatest(b, 0.85) ELSE b END + CASE WHEN k > 5 THEN 0.05 ELSE 0 END) + CASE WHEN even THEN 0.03 ELSE 0 END), 6) AS docx,
  round(CASE WHEN k = 0 THEN 0 ELSE least(1, CASE WHEN n / k > 200 THEN 0.85 WHEN n / k > 50 THEN 0.7 ELSE 0.5 END + CASE WHEN even THEN 0.1 ELSE 0 END) END, 6) AS pptx,
  round(CASE WHEN n = 0 THEN 0 WHEN n > 100 THEN 0.9 WHEN n > 10 THEN 0.8 ELSE 0.6 END, 6) AS xlsx, round(n / 2600.0 * CASE WHEN k < 5 THEN 0.7 ELSE 1 END, 6) AS words, round(least(1, n / 2600.0 + CASE WHEN k > 0 THEN 0.05 ELSE 0 END), 6) AS read_lines,
  round(pdf * 0.6 + b * 0.2 + 0.2, 6) AS combined, CASE WHEN round(pdf * 0.6 + b * 0.2 + 0.2, 9) >= 0.85 THEN 'excellent' WHEN round(pdf * 0.6 + b * 0.2 + 0.2, 9) >= 0.7 THEN 'good' WHEN round(pdf * 0.6 + b * 0.2 + 0.2, 9) >= 0.5 THEN 'fair' ELSE 'poor' END AS tier FROM v""",
)
def c07(spark, d):
    n, k, even, third = F.expr(_N), c("pos") % 12, c("pos") % 2 == 0, c("doc_id") % 3 == 0
    pdf = C.pdf_confidence(F.when(third, 0.8), n, F.when(k > 6, 0.6).otherwise(0.1))
    whole = C.element_confidence(pdf, C.length_confidence(n), F.lit(1.0))
    values = {
        "pdf": pdf, "epub": C.book_confidence(n, even, k, k), "html": C.html_confidence(F.when(third, n / 26.0), n, even, third, F.when(k > 7, 0.8).otherwise(0.5)), "docx": C.text_document_confidence(n, k, even),
        "pptx": C.slides_confidence(k, n, even), "xlsx": C.sheet_confidence(n), "words": C.word_reading_confidence(n / 26.0, k), "read_lines": C.line_reading_confidence(n / 2600.0, k), "combined": whole["combined"],
    }
    return chunks(spark, d).select("doc_id", "pos", *(F.round(v.cast("double"), 6).alias(x) for x, v in values.items()), C.tier(F.round(whole["combined"], 9)).alias("tier"))


_SECTION_LINES = (
    "'96 Cutting Edge'", "'IN THE NEWS'", "'Feature: The F-35 Story'", "'Review of the year and of many other things here'", "'the news'", "'Great heritage'", "'Blue Skies Over Us'", "'words in small case'", "'Advertisement'",
    "'About a long squadron of birds in the wild'", "'12'", "'ab'", "'History told here at some length by all of us'", "'  Two   Words '",
)
_SECTION = "CASE (pos + doc_id) % 15 " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(_SECTION_LINES)) + " ELSE left(content, 50) END"
_SECTION_WORDS = "('" + "'), ('".join(C.SECTION_WORDS) + "')"


@query(
    "c20_sections",
    f"""WITH {CHUNKS}, x AS (SELECT doc_id, pos, trim({_SECTION}) AS t, pos % 2 = 0 AS first FROM chunks), sw(w) AS (VALUES {_SECTION_WORDS}),
k AS (SELECT doc_id, pos, bool_or(contains(lower(t), w) AND (starts_with(lower(t), w) OR length(t) < 30)) AS word FROM x, sw GROUP BY ALL),
y AS (SELECT x.*, word, length(t) BETWEEN 3 AND 60 AND regexp_matches(t, '\\pL') AND lower(string_split_regex(t, '\\s+')[1]) NOT IN ({', '.join(f"'{w}'" for w in C.NO_SECTION)}) AS usable FROM x JOIN k USING (doc_id, pos)),
m AS (SELECT *, CASE WHEN NOT usable THEN NULL WHEN regexp_matches(t, '^\\d{{1,3}}\\s+[A-Z][A-Za-z\\s&-]{{2,40}}$') THEN 'numbered_section' WHEN regexp_matches(t, '^[A-Z][A-Z\\s&-]{{3,40}}$') THEN 'caps_section' WHEN regexp_matches(t, '^[A-Za-z\\s]{{2,20}}:\\s*.+$') THEN 'titled_section'
  WHEN regexp_matches(t, '(?i)^(News|Feature|Report|Analysis|Interview|Review|Special|Gallery|Inside|Profile)\\b') THEN 'keyword_section' WHEN word THEN 'keyword_match'
  WHEN first AND length(t) < 40 AND len(string_split_regex(t, '\\s+')) <= 5 AND len(list_filter(string_split_regex(t, '\\s+'), lambda w: regexp_matches(w, '^\\pL') AND NOT regexp_matches(w, '^\\p{{Lu}}'))) = 0 THEN 'position_titlecase' END AS method FROM y)
SELECT doc_id, pos, method, CASE method WHEN 'numbered_section' THEN 0.9 WHEN 'caps_section' THEN 0.85 WHEN 'titled_section' THEN 0.95 WHEN 'keyword_section' THEN 0.8 WHEN 'keyword_match' THEN CASE WHEN first THEN 0.75 ELSE 0.5 END WHEN 'position_titlecase' THEN 0.6 END::DOUBLE AS confidence,
  CASE method WHEN 'numbered_section' THEN regexp_extract(t, '^\\d+\\s+(.*)$', 1) WHEN 'caps_section' THEN CASE t WHEN 'IN THE NEWS' THEN 'In The News' ELSE t END WHEN 'titled_section' THEN string_split(t, ':')[1] WHEN 'keyword_section' THEN string_split(t, ' ')[1] WHEN 'keyword_match' THEN t WHEN 'position_titlecase' THEN CASE WHEN t = upper(t) THEN array_to_string(list_transform(string_split_regex(lower(t), '\\s+'), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') ELSE regexp_replace(t, '\\s+', ' ', 'g') END END AS name
FROM m WHERE method IS NOT NULL""",
)
def c20(spark, d):
    rows = chunks(spark, d).select("doc_id", "pos", C.section_of(F.expr(_SECTION), c("pos") % 2 == 0).alias("s")).filter("s IS NOT NULL")
    return rows.select("doc_id", "pos", "s.method", c("s")["confidence"].cast("double").alias("confidence"), "s.name")


@query(
    "c22_c25_domains",
    f"""WITH {CHUNKS}, f AS (SELECT doc_id, min(pos) AS p FROM chunks WHERE pos % 5 = 3 GROUP BY doc_id)
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'own' WHEN p IS NOT NULL THEN 'chunk ' || p ELSE 'unknown' END AS domain, NOT (doc_id % 2 = 0) AND (doc_id % 3 = 0 OR (doc_id % 5 = 0 AND doc_id % 7 = 0)) AS refine FROM documents LEFT JOIN f USING (doc_id)""",
)
def c22(spark, d):
    headers = docs(spark, d).select("doc_id", F.when(c("doc_id") % 4 == 0, "Own").when(c("doc_id") % 4 == 1, "").alias("domain"))
    rows = chunks(spark, d).select("doc_id", "pos", F.when(c("pos") % 5 == 3, F.concat(F.lit("Chunk "), "pos")).alias("domain"))
    k = c("doc_id")
    return A.document_domain(rows, headers).select("doc_id", "domain", C.wants_refiner(k % 2 == 0, k % 3 == 0, k % 5 == 0, k % 7 == 0).alias("refine"))


@query(
    "f15_f16_index_pages",
    f"""WITH {CHUNKS}, i AS (SELECT doc_id, (pos // 24 + 1)::INT AS page_number, CASE (pos + doc_id) % 6 WHEN 0 THEN 'list_item' WHEN 1 THEN 'table_cell' ELSE 'text' END AS label, CASE WHEN doc_id % 3 = 0 AND pos % 3 > 0 THEN 'Argilla, 157' WHEN (pos + doc_id) % 6 = 0 THEN '12' WHEN (pos + doc_id) % 6 = 1 THEN 'a' WHEN doc_id % 2 = 0 AND pos % 4 = 2 THEN 'x 1, 2, 3' WHEN doc_id % 5 = 0 AND pos % 4 = 3 THEN 'Chapter ..... 7' ELSE left(content, 30) END AS text, pos FROM chunks),
p AS (SELECT doc_id, page_number, count(*) FILTER (trim(text) <> '') AS t, count(*) FILTER (regexp_matches(text, '\\b\\d{{1,4}}(,\\s*\\d{{1,4}}){{2,}}\\b')) AS r, count(*) FILTER (regexp_matches(text, '(\\.|\\x{{FFFD}}){{2,}}\\s*\\d{{1,4}}\\s*$')) AS l,
  count(*) FILTER (label <> 'text' AND trim(text) <> '' AND length(trim(text)) <= 12) AS s, count(*) FILTER (label <> 'text' AND regexp_matches(trim(text), '^\\d{{1,4}}$')) AS g,
  count(*) FILTER (regexp_matches(text, '^\\s*[A-Za-z][^,\\n]{{1,80}}?,\\s*\\d{{1,4}}(\\s*[-,]\\s*\\d{{1,4}})*\\s*$')) AS e, bool_or(trim(text) = 'Index') AS mark FROM i GROUP BY ALL)
SELECT doc_id, page_number, t >= 5 AND ((t >= 18 AND 3 * r + 3 * l + s >= 14 AND (r + l + s) / t >= 0.35 AND (r + l >= 2 OR g >= 6)) OR (r >= 4 AND s >= 8) OR (l >= 5 AND (r + l + s) / t >= 0.30) OR (l >= 4 AND (r + l + s) / t >= 0.80)) AS dense,
  t >= 20 AND (e / t >= 0.65 OR (e / t >= 0.50 AND mark)) AS back_index FROM p""",
)
def f15(spark, d):
    k = (c("pos") + c("doc_id")) % 6
    label = F.when(k == 0, "list_item").when(k == 1, "table_cell").otherwise("text")
    text = (
        F.when((c("doc_id") % 3 == 0) & (c("pos") % 3 > 0), "Argilla, 157").when(k == 0, "12").when(k == 1, "a").when((c("doc_id") % 2 == 0) & (c("pos") % 4 == 2), "x 1, 2, 3")
        .when((c("doc_id") % 5 == 0) & (c("pos") % 4 == 3), "Chapter ..... 7").otherwise(F.left("content", F.lit(30)))
    )
    items = chunks(spark, d).select("doc_id", (F.floor(c("pos") / 24) + 1).cast("int").alias("page_number"), label.alias("label"), text.alias("text"), "pos")
    pages = items.groupBy("doc_id", "page_number").agg(F.collect_list("text").alias("lines")).select("doc_id", "page_number", P.is_back_index_page(c("lines")).alias("back_index"))
    dense = A.dense_pages(items).withColumn("dense", F.lit(True))
    return pages.join(dense, ["doc_id", "page_number"], "left").select("doc_id", "page_number", F.coalesce("dense", F.lit(False)).alias("dense"), "back_index")


@query("p15_contents_text", f"WITH {PLANTED}, s AS (SELECT doc_id, pos, CASE WHEN pos % 2 = 0 THEN replace(content, ' ', ', 3 = ') ELSE content || ' �� ' || chr(10) || chr(10) || chr(10) || chr(10) || 'x' END AS content FROM planted) SELECT doc_id, pos, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content, ',\\s*\\d+\\s*=', ' ', 'g'), '[ \\t]*�[� \\t]*', ' ', 'g'), '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10)) AS p15 FROM s")
def p15(spark, d):
    text = F.when(c("pos") % 2 == 0, F.replace("content", F.lit(" "), F.lit(", 3 = "))).otherwise(F.concat("content", F.lit(" �� \n\n\n\nx")))
    return planted(spark, d).select("doc_id", "pos", P.sanitise_contents(text).alias("p15"))


@query(
    "a04_a07_quality",
    f"""WITH {CHUNKS}, t AS (SELECT doc_id, greatest(1, length(text) // 4) * (doc_id % 9 + 92) // 100 AS s FROM documents), k AS (SELECT doc_id, sum(greatest(1, length(content) // 4))::BIGINT AS n, avg(least(1.0, length(content) / 400.0)) AS a, min(least(1.0, length(content) / 400.0)) AS lo, max(least(1.0, length(content) / 400.0)) AS hi, count(*) AS pages, count(*) FILTER (length(content) / 400.0 < 0.7) AS ocr FROM chunks GROUP BY doc_id)
SELECT doc_id, round(CASE WHEN s > 0 THEN abs(n - s) / s ELSE 0 END, 6) AS variance, CASE WHEN s > 0 THEN abs(n - s) / s ELSE 0 END <= 0.10 AS valid, round(a, 6) AS avg_confidence, round(lo, 6) AS min_confidence, round(hi, 6) AS max_confidence, pages AS n, ocr AS needs_ocr,
  CASE WHEN a >= 0.85 THEN 'excellent' WHEN a >= 0.7 THEN 'good' WHEN a >= 0.5 THEN 'fair' ELSE 'poor' END AS tier FROM t JOIN k USING (doc_id)""",
)
def a04(spark, d):
    source = docs(spark, d).select("doc_id", F.expr("greatest(1, length(text) DIV 4) * (doc_id % 9 + 92) DIV 100").alias("source_tokens"))
    rows = chunks(spark, d)
    got = rows.groupBy("doc_id").agg(F.sum(C.tokens_plain(c("content"))).alias("chunk_tokens"))
    quality = A.page_quality(rows, F.least(F.lit(1.0), F.char_length("content") / 400.0))
    out = A.simple_balance(source.join(got, "doc_id")).join(quality, "doc_id")
    return out.select("doc_id", F.round("variance", 6).alias("variance"), "valid", *(F.round(x, 6).alias(x) for x in ("avg_confidence", "min_confidence", "max_confidence")), "n", "needs_ocr", "tier")


# ---- boxes


@query(
    "g_more_boxes",
    f"""WITH x AS ({_BOXES}), w AS (SELECT l_orderkey, l_linenumber, a, greatest(0, least(1000, a[1])) AS x0, greatest(0, least(1000, a[2])) AS y0, greatest(0, least(1000, a[3])) AS x1, greatest(0, least(1000, a[4])) AS y1 FROM x)
SELECT l_orderkey, l_linenumber, CASE WHEN x0 = x1 AND x1 >= 1000 THEN x0 - 1 ELSE x0 END::INT AS left_, CASE WHEN y0 = y1 AND y1 >= 1000 THEN y0 - 1 ELSE y0 END::INT AS top_, CASE WHEN x1 <= x0 AND x0 < 1000 THEN x0 + 1 ELSE x1 END::INT AS right_, CASE WHEN y1 <= y0 AND y0 < 1000 THEN y0 + 1 ELSE y1 END::INT AS bottom_,
  round(a[1] / 1000.0 * 612, 6)::DOUBLE AS page_x, round(a[4] / 1000.0 * 792, 6)::DOUBLE AS page_y, (a[3] - a[1]) * (a[4] - a[2]) / 1000000.0 > 0.95 AS full_page,
  greatest(0, least(1000, round_even(a[1] / 1200.0::DOUBLE * 1000, 0)))::INT AS n0, greatest(0, least(1000, round_even(a[2] / 1600.0::DOUBLE * 1000, 0)))::INT AS n1, greatest(0, least(1000, round_even(a[3] / 1200.0::DOUBLE * 1000, 0)))::INT AS n2, greatest(0, least(1000, round_even(a[4] / 1600.0::DOUBLE * 1000, 0)))::INT AS n3 FROM w""",
)
def g_more(spark, d):
    wide, page, norm = G.widen(c("a")), G.denormalise(c("a"), F.lit(612), F.lit(792)), G.normalise(c("a"), F.lit(1200.0), F.lit(1600.0))
    return boxes(spark, d).select(
        "l_orderkey", "l_linenumber", *(wide[k].alias(x) for k, x in enumerate(("left_", "top_", "right_", "bottom_"))), F.round(page[0], 6).alias("page_x"), F.round(page[3], 6).alias("page_y"),
        G.is_full_page(c("a")).alias("full_page"), *(norm[k].alias(f"n{k}") for k in range(4)),
    )


# ---- retrieval

_SIMILAR = "s AS (SELECT q.vec_id AS query_id, q.label AS asked, v.vec_id, v.label, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0)"


def _asked(spark, d):
    vectors = S.table(spark, d, "embeddings")
    return vectors, vectors.filter("vec_id % 20 = 0").select(c("vec_id").alias("query_id"), "embedding")


@query("r01_dense_top_k", f"WITH {_SIMILAR} SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 5")
def r01(spark, d):
    vectors, asked = _asked(spark, d)
    return V.dense_search(vectors, asked, 5)


@query(
    "a17_recall",
    f"""WITH {_SIMILAR}, t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s WHERE vec_id <> query_id), g AS (SELECT query_id, arg_min(vec_id, r) AS gold, arg_min(label, r) AS gold_label FROM t WHERE vec_id % 3 = 0 GROUP BY query_id),
h AS (SELECT query_id, max((r = 1 AND vec_id = gold)::INT) AS one, max((r <= 5 AND vec_id = gold)::INT) AS five, max((r <= 5 AND label = gold_label)::INT) AS docs FROM t JOIN g USING (query_id) GROUP BY query_id)
SELECT count(*) AS n, round(avg(one), 6) AS chunk_at_1, round(avg(five), 6) AS chunk_at_5, round(avg(docs), 6) AS doc_at_5 FROM h""",
)
def a17(spark, d):
    vectors, asked = _asked(spark, d)
    found = V.dense_search(vectors, asked, 6).filter("vec_id <> query_id").join(vectors.select("vec_id", "label"), "vec_id")
    order = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "label")))
    top = found.groupBy("query_id").agg(order.alias("o")).select("query_id", F.transform("o", lambda x: x["vec_id"]).alias("top_chunks"), F.transform("o", lambda x: x["label"]).alias("top_docs"))
    gold = V.dense_search(vectors.filter("vec_id % 3 = 0"), asked, 2).filter("vec_id <> query_id").groupBy("query_id").agg(F.min_by("vec_id", "rank").alias("gold_chunk"))
    gold = gold.join(vectors.select(c("vec_id").alias("gold_chunk"), c("label").alias("gold_doc")), "gold_chunk")
    return A.recall(top.join(gold, "query_id")).select("n", *(F.round(x, 6).alias(x) for x in ("chunk_at_1", "chunk_at_5", "doc_at_5")))


@query(
    "a18_regression",
    f"""WITH {_SIMILAR}, b AS (SELECT query_id, list(vec_id ORDER BY r) AS ids, arg_min(label, r) AS top FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 3 GROUP BY query_id),
a AS (SELECT query_id, list(vec_id ORDER BY r) AS ids, arg_min(label, r) AS top FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s WHERE (vec_id + query_id) % 3 > 0 OR vec_id % 40 = 0) WHERE r <= 3 GROUP BY query_id)
SELECT query_id, CASE WHEN a.top IS DISTINCT FROM b.top THEN 'FAIL' WHEN a.ids <> b.ids THEN 'DRIFT' ELSE 'PASS' END AS verdict FROM a JOIN b USING (query_id)""",
)
def a18(spark, d):
    vectors, asked = _asked(spark, d)
    labels = vectors.select("vec_id", "label")

    def top(found):
        order = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "label")))
        return found.join(labels, "vec_id").groupBy("query_id").agg(order.alias("o")).select("query_id", F.transform("o", lambda x: x["vec_id"]).alias("top_chunks"), F.transform("o", lambda x: x["label"]).alias("top_docs"))

    every = V.dense_search(vectors, asked, 3)
    # what stays in the index depends on the query by its rest alone, so there are three indexes
    parts = [V.dense_search(vectors.filter(f"(vec_id + {r}) % 3 > 0 OR vec_id % 40 = 0"), asked.filter(f"query_id % 3 = {r}"), 3) for r in range(3)]
    some = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return A.regression(top(every), top(some))


#: Vectors of texts by their letters, which both engines can compute.
_LETTERS = "etaoinsrhldcumfp"


def _letter_vector(text):
    return F.array(*(F.regexp_count(F.lower(text), F.lit(x)).cast("double") for x in _LETTERS))


@query(
    "r02_hybrid",
    f"""WITH dv AS (SELECT doc_id, [{', '.join(f"(length(lower(text)) - length(replace(lower(text), '{x}', '')))::DOUBLE" for x in _LETTERS)}] AS v FROM documents),
qv AS (SELECT item_id, [{', '.join(f"(length(lower(text)) - length(replace(lower(text), '{x}', '')))::DOUBLE" for x in _LETTERS)}] AS v FROM benchmark),
den AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(qv.v, dv.v), 6) DESC, doc_id) AS r FROM qv, dv WHERE list_sum(dv.v) > 0 QUALIFY r <= 10),
tk AS (SELECT 'd' AS kind, doc_id AS id, unnest(string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')) AS token FROM documents UNION ALL SELECT 'q', item_id, unnest(string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')) FROM benchmark),
tf AS (SELECT kind, id, token, count(*) AS n FROM tk WHERE token <> '' GROUP BY ALL), nm AS (SELECT kind, id, sqrt(sum(n * n)) AS size FROM tf GROUP BY ALL), wt AS (SELECT tf.kind, tf.id, token, n / size AS w FROM tf JOIN nm ON nm.kind = tf.kind AND nm.id = tf.id),
sp AS (SELECT q.id AS item_id, d.id AS doc_id, row_number() OVER (PARTITION BY q.id ORDER BY round(sum(q.w * d.w), 9) DESC, d.id) AS r FROM wt q JOIN wt d ON q.kind = 'q' AND d.kind = 'd' AND q.token = d.token GROUP BY q.id, d.id QUALIFY r <= 10),
f AS (SELECT coalesce(den.item_id, sp.item_id) AS query_id, coalesce(den.doc_id, sp.doc_id) AS doc_id, coalesce(1.0 / (60 + den.r), 0) + coalesce(1.0 / (60 + sp.r), 0) AS score FROM den FULL JOIN sp ON den.item_id = sp.item_id AND den.doc_id = sp.doc_id)
SELECT query_id, doc_id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) AS rank FROM f QUALIFY rank <= 5""",
)
def r02(spark, d):
    index = V.sparse_vectors(docs(spark, d))
    asked = S.table(spark, d, "benchmark")
    sparse = V.sparse_search(index, V.sparse_vectors(asked.select(c("item_id").alias("doc_id"), "text")).withColumnRenamed("doc_id", "query_id"), 10)
    vectors = docs(spark, d).select(c("doc_id").alias("vec_id"), _letter_vector(c("text")).alias("embedding")).filter(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x) > 0)
    dense = V.dense_search(vectors, asked.select(c("item_id").alias("query_id"), _letter_vector(c("text")).alias("embedding")), 10).withColumnRenamed("vec_id", "doc_id")
    return V.hybrid_search(dense, sparse, 5).select("query_id", "doc_id", F.round("score", 9).alias("score"), "rank")


@query(
    "r05_r08_boosts",
    f"""WITH {_SIMILAR}, b AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r, score FROM s QUALIFY r <= CASE WHEN query_id % 60 = 0 THEN 1 ELSE 5 END),
n AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n FROM b), z AS (SELECT query_id, vec_id, r, CASE WHEN n > 1 THEN score + least(0.02 * (vec_id % 8), 0.1) + CASE WHEN vec_id % 3 = 0 AND vec_id % 2 = 0 THEN 0.05 ELSE 0 END ELSE score END AS score FROM n)
SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, r) AS rank FROM z QUALIFY rank <= 3""",
)
def r05(spark, d):
    vectors, asked = _asked(spark, d)
    found = V.dense_search(vectors, asked, 5).filter("rank <= CASE WHEN query_id % 60 = 0 THEN 1 ELSE 5 END")
    rows = found.withColumns({"breadcrumb": F.array_repeat(F.lit("x"), (c("vec_id") % 8).cast("int")), "modality": F.when(c("vec_id") % 3 == 0, "image").otherwise("text"), "description": F.when(c("vec_id") % 2 == 0, "d")})
    return V.reranked(rows, F.round("score", 9), 3).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query(
    "r04_r10_search",
    f"""WITH {_SIMILAR}, p AS (SELECT *, CASE vec_id % 4 WHEN 0 THEN 'the Alpha case' WHEN 1 THEN 'a beta' ELSE 'nothing' END AS content, CASE query_id % 60 WHEN 0 THEN 'alpha' WHEN 20 THEN 'gamma' END AS keyword FROM s WHERE vec_id % 2 = 0 OR vec_id % 4 = 1),
h AS (SELECT *, keyword IS NOT NULL AND contains(lower(content), keyword) AS hit FROM p WHERE score >= 0.2), k AS (SELECT query_id, bool_or(hit) AS worded FROM h GROUP BY query_id)
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM h JOIN k USING (query_id) WHERE NOT worded OR hit QUALIFY rank <= 4""",
)
def r04(spark, d):
    vectors, asked = _asked(spark, d)
    content = F.when(c("vec_id") % 4 == 0, "the Alpha case").when(c("vec_id") % 4 == 1, "a beta").otherwise("nothing")
    points = vectors.select("vec_id", content.alias("content"), F.when((c("vec_id") % 2 == 0) | (c("vec_id") % 4 == 1), "text").otherwise("image").alias("modality"))
    keyword = F.when(c("query_id") % 60 == 0, "alpha").when(c("query_id") % 60 == 20, "gamma")
    return V.search_points(vectors.drop("content"), points, asked.withColumn("keyword", keyword), 4, "text")


_BUDGET = "CASE WHEN turn % 2 = 0 THEN '[Section: a > b]' || chr(10) ELSE '' END || text || chr(10) || chr(10)"


@query(
    "r07_context_budget",
    f"""WITH t AS (SELECT conv_id, turn, {_BUDGET} AS x FROM conversations WHERE text IS NOT NULL), s AS (SELECT conv_id, turn, x, sum(length(x) // 4) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS spent FROM t)
SELECT conv_id AS query_id, string_agg(x, '' ORDER BY turn) AS text_context FROM s WHERE spent <= 200 GROUP BY conv_id""",
)
def r07(spark, d):
    path = F.when(c("turn") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    turns = S.table(spark, d, "conversations").filter("text IS NOT NULL").select(c("conv_id").alias("query_id"), c("turn").alias("rank"), c("text").alias("content"), path.alias("breadcrumb"))
    return V.contexts(V.within_budget(turns, 200))


@query(
    "r07_images",
    f"""WITH {_SIMILAR}, r AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s), l AS (SELECT query_id, 0 AS l, r, CASE WHEN vec_id % 5 > 0 THEN 'a' || (vec_id % 4) END AS p FROM r WHERE r <= 2 UNION ALL SELECT query_id, 1, r, 'a' || (vec_id % 4) FROM r WHERE r <= 6),
o AS (SELECT query_id, p, l, r FROM l WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id, p ORDER BY l, r) = 1) SELECT query_id, p AS asset_path, row_number() OVER (PARTITION BY query_id ORDER BY l, r, p) AS rank FROM o QUALIFY rank <= 3""",
)
def r07b(spark, d):
    vectors, asked = _asked(spark, d)
    found = V.dense_search(vectors, asked, 6).withColumn("p", F.concat(F.lit("a"), (c("vec_id") % 4).cast("string")))
    cross = found.filter("rank <= 2").select("query_id", "rank", F.when(c("vec_id") % 5 > 0, c("p")).alias("asset_path"))
    return V.context_images(cross, found.select("query_id", "rank", c("p").alias("asset_path"))).select("query_id", "asset_path", "rank")


@query("r09_chat_requests", "SELECT conv_id, json_extract_string(r, '$.model') AS model, json_extract_string(r, '$.messages[1].content') AS prompt, json_extract_string(r, '$.messages[0].role') AS first_role, json_extract(r, '$.max_tokens')::INT AS most FROM (SELECT conv_id, json_object('model', 'local-model', 'messages', [json_object('role', 'system', 'content', 'x'), json_object('role', 'user', 'content', 'Context:' || chr(10) || text || chr(10) || chr(10) || 'Question: ' || role || chr(10) || chr(10) || 'Answer based on the context above. Cite specific sources.')], 'max_tokens', 1024) AS r FROM conversations WHERE text IS NOT NULL AND turn = 1)")
def r09(spark, d):
    rows = S.table(spark, d, "conversations").filter("text IS NOT NULL AND turn = 1").select("conv_id", V.chat_request(c("text"), c("role")).alias("r"))
    get = lambda p: F.get_json_object("r", p)
    return rows.select("conv_id", get("$.model").alias("model"), get("$.messages[1].content").alias("prompt"), get("$.messages[0].role").alias("first_role"), get("$.max_tokens").cast("int").alias("most"))


@query(
    "r11_browse",
    f"""WITH {CHUNKS} SELECT doc_id, page_number, doc_id || '_' || lpad(pos::VARCHAR, 5, '0') AS chunk_id, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY CASE pos % 4 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 0 THEN 2 ELSE 3 END, doc_id || '_' || lpad(pos::VARCHAR, 5, '0')) AS place
FROM chunks WHERE page_number = 2 AND contains(lower(content), 'en')""",
)
def r11(spark, d):
    kind = F.when(c("pos") % 4 == 1, "text").when(c("pos") % 4 == 2, "table").when(c("pos") % 4 == 0, "image").otherwise("other")
    points = chunks(spark, d).select("doc_id", "page_number", F.concat(c("doc_id").cast("string"), F.lit("_"), F.lpad(c("pos").cast("string"), 5, "0")).alias("chunk_id"), kind.alias("modality"), "content")
    return V.browse(points, F.lit(2), F.lit("EN")).select("doc_id", "page_number", "chunk_id", "place")


# ---- sinks


@query(
    "k03_k06_export",
    f"""WITH {PLANTED}, s AS (SELECT *, pos % 3 AS m, CASE pos % 4 WHEN 0 THEN repeat('h', 90) ELSE 'Heading' END AS h FROM planted)
SELECT doc_id, pos, regexp_replace(content, '[\\x00-\\x08\\x0B-\\x1F\\x7F]', '', 'g') AS content, CASE WHEN length(h) <= 80 THEN h END AS parent_heading, CASE WHEN length(h) <= 80 THEN 'a > ' || h ELSE 'a' END AS path,
  CASE WHEN len(regexp_extract_all(content, '(?i)\\bISBN\\b|\\bISSN\\b|Library of Congress|All rights reserved|Printed in .{{2,20}}$|First .{{2,20}} edition|©\\s*\\d{{4}}')) >= 2 THEN 'low' ELSE 'high' END AS search_priority,
  CASE WHEN m = 0 THEN regexp_replace(content, '[\\x00-\\x08\\x0B-\\x1F\\x7F]', '', 'g') END AS refined_content, CASE WHEN m = 1 THEN CASE WHEN pos % 2 = 0 THEN 'pending' ELSE 'done' END END AS vision_status, CASE WHEN m > 0 THEN '0,0,1000,1000' END AS bbox FROM s""",
)
def k03(spark, d):
    m = c("pos") % 3
    heading = F.when(c("pos") % 4 == 0, F.lit("h" * 90)).otherwise("Heading")
    rows = planted(spark, d).withColumns(
        {
            "modality": F.when(m == 0, "text").when(m == 1, "image").otherwise("table"), "parent_heading": heading, "breadcrumb": F.array(F.lit("a"), heading), "bbox": F.lit(None).cast("array<int>"), "page_width": F.lit(612), "page_height": F.lit(792),
            "search_priority": F.lit("high"), "refined_content": F.lit(None).cast("string"), "description": F.when(c("pos") % 2 == 0, "[Figure on page 1]").otherwise("A photo"),
        }
    )
    out = K.export_fields(rows)
    return out.select("doc_id", "pos", "content", "parent_heading", F.array_join("breadcrumb", " > ").alias("path"), "search_priority", "refined_content", "vision_status", F.array_join(c("bbox").cast("array<string>"), ",").alias("bbox"))


@query(
    "k07_k10_rest",
    f"""WITH {CHUNKS} SELECT 'orphan' AS kind, 'a' || doc_id AS name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM chunks WHERE pos = 9)
UNION ALL SELECT 'unwritten', doc_id::VARCHAR FROM chunks WHERE pos % 13 = 5 GROUP BY doc_id UNION ALL SELECT 'last', (doc_id % 40) || ':' || max(doc_id) FROM documents GROUP BY doc_id % 40""",
)
def k07(spark, d):
    rows, known = chunks(spark, d), docs(spark, d)
    files = known.select(F.concat(F.lit("a"), c("doc_id").cast("string")).alias("path"))
    orphans = K.orphans(files, rows.filter("pos = 9").select(F.concat(F.lit("a"), c("doc_id").cast("string")).alias("asset_path")))
    ids = rows.withColumn("chunk_id", F.concat_ws("_", "doc_id", "pos"))
    left = K.unwritten(known.select("doc_id"), ids, ids.filter("pos % 13 <> 5"))
    points = known.select((c("doc_id") % 40).cast("string").alias("point_id"), c("doc_id").cast("string").alias("value"), c("doc_id").alias("version"))
    last = K.last_by_id(points, c("version"))
    return (
        orphans.select(F.lit("orphan").alias("kind"), c("path").alias("name")).unionByName(left.select(F.lit("unwritten").alias("kind"), c("doc_id").cast("string").alias("name")))
        .unionByName(last.select(F.lit("last").alias("kind"), F.concat_ws(":", "point_id", "value").alias("name")))
    )


@query(
    "e01_best_reading",
    f"""WITH {CHUNKS} SELECT doc_id, pos, CASE WHEN (pos * 7 + doc_id) % 100 >= 70 THEN 'one' WHEN (pos * 3 + doc_id) % 90 >= 70 THEN 'two' WHEN (pos * 7 + doc_id) % 100 > (pos * 3 + doc_id) % 90 THEN 'one' ELSE 'two' END AS reading FROM chunks""",
)
def e01(spark, d):
    a, b = (c("pos") * 7 + c("doc_id")) % 100 / 100, (c("pos") * 3 + c("doc_id")) % 90 / 100
    return chunks(spark, d).select("doc_id", "pos", E.best_reading((F.lit("one"), a), (F.lit("two"), b)).alias("reading"))

"""Queries of image filters, coverage, front matter, inferred headings and drop caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assets as I
from ..operators import micro as M
from ..operators import windows as W
from .audits import EXPORTED, exported
from .catalog import CHUNKS, chunks, query
from .rules import _S, planted

c = F.col


@query(
    "f07_f12_images",
    f"""WITH {EXPORTED}, g AS (SELECT *, (pos * 53 + doc_id) % 260 AS mean, (pos * 7) % 20 AS spread, (pos * 41) % 400 AS w, (doc_id * 17) % 400 AS h FROM exported)
SELECT doc_id, pos, spread < 10 AND (mean > 250 OR mean < 5) AS blank, w >= 50 AND h >= 50 AS large, (w >= CASE WHEN pos % 2 = 0 THEN 200 ELSE 300 END AND h >= CASE WHEN pos % 2 = 0 THEN 200 ELSE 300 END) OR area_share >= 0.2 * 2 AS extract_it FROM g
WHERE NOT (modality = 'text' AND NOT extraction_method LIKE 'hybrid%' AND ((length(content) - length(replace(content, '�', '')) + coalesce(list_sum(list_transform(regexp_extract_all(content, '/C\\d{{1,3}}|/uni[A-F0-9]{{4,}}|\\\\x[0-9a-f]{{2}}|\\x{{FFFD}}'), lambda x: length(x))), 0)) / greatest(1, length(content)) > 0.10 OR regexp_matches(content, '—{{6,}}|[CS]{{10,}}')))
  AND NOT (pos % 3 = 1 AND pos % 2 = 0)""",
)
def f07(spark, d):
    rows = I.quarantined(exported(spark, d)).withColumn("description", F.when((c("pos") % 3 == 1) & (c("pos") % 2 == 0), "No distinct non-text visuals here").otherwise("x"))
    mean, spread, w, h = (c("pos") * 53 + c("doc_id")) % 260, (c("pos") * 7) % 20, (c("pos") * 41) % 400, (c("doc_id") * 17) % 400
    return I.with_visuals(rows).select(
        "doc_id", "pos", I.is_blank_asset(mean, spread).alias("blank"), I.large_enough(w, h).alias("large"), I.worth_extracting(w, h, c("area_share"), c("pos") % 2 == 0).alias("extract_it")
    )


@query(
    "d05_coverage",
    f"""WITH {EXPORTED}, i AS (SELECT doc_id, page_number, pos, pos % 3 > 0 OR doc_id % 2 = 0 AS repeated FROM exported WHERE pos % 2 = 1), t AS (SELECT DISTINCT doc_id, page_number FROM exported WHERE doc_id % 5 = 0 AND page_number = 1),
o AS (SELECT *, bool_or(NOT repeated) OVER (PARTITION BY doc_id, page_number) AS own, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY repeated, pos) AS n FROM i)
SELECT o.doc_id, o.page_number, pos AS image_id FROM o LEFT JOIN t ON t.doc_id = o.doc_id AND t.page_number = o.page_number WHERE NOT repeated OR (t.doc_id IS NULL AND NOT own AND n = 1)""",
)
def d05(spark, d):
    rows = exported(spark, d)
    images = rows.filter("pos % 2 = 1").select("doc_id", "page_number", c("pos").alias("image_id"), ((c("pos") % 3 > 0) | (c("doc_id") % 2 == 0)).alias("repeated"))
    return I.keep_for_coverage(images, rows.filter("doc_id % 5 = 0 AND page_number = 1")).select("doc_id", "page_number", "image_id")


@query(
    "a19_vision_summary",
    f"""WITH {EXPORTED}, k AS (SELECT CASE WHEN pos % 5 = 0 THEN 'hard_fallback' WHEN trim(description) = '' THEN 'empty' WHEN starts_with(description, '[Figure on page') THEN 'placeholder' WHEN starts_with(description, 'Dense typographic layout') THEN 'hard_fallback' ELSE 'described' END AS kind, vision_status FROM exported WHERE modality = 'image')
SELECT kind, vision_status, count(*) AS n, round(count(*) / (SELECT count(*) FROM k), 6) AS share FROM k GROUP BY ALL""",
)
def a19(spark, d):
    rows = exported(spark, d).withColumn("description", F.when(c("pos") % 5 == 0, "Dense typographic layout of words").otherwise(c("description")))
    return I.vision_summary(rows.filter("modality = 'image'")).withColumn("share", F.round("share", 6))


_HEADS = "CASE (pos + doc_id) % 8 WHEN 0 THEN 'Chapter ' || (pos % 4) WHEN 1 THEN '2.1 Parts' WHEN 2 THEN '' ELSE 'Preface' END"


@query(
    "w15_front_matter",
    f"""WITH {CHUNKS}, x AS (SELECT doc_id, pos, page_number, content, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN (pos + doc_id) % 8 > 1 THEN 'Preface' END ELSE {_HEADS} END AS h FROM chunks), y AS (SELECT *, trim(CASE WHEN coalesce(h, '') <> '' THEN h ELSE string_split(trim(content), chr(10))[1] END) AS t FROM x),
z AS (SELECT *, regexp_matches(t, '(?i)(^|\\b)(chapter|chapitre|hoofdstuk|teil)\\s+[A-Za-z0-9ivxlcdm]+|^\\s*\\d+(\\.\\d+)*\\s+\\S') AS ch FROM y), f AS (SELECT *, min(CASE WHEN ch THEN page_number END) OVER (PARTITION BY doc_id) AS first FROM z),
i AS (SELECT doc_id, page_number, bool_or(doc_id % 2 = 0) AS strong FROM chunks WHERE pos % 4 = 1 AND page_number < 4 AND doc_id % 7 > 0 GROUP BY ALL)
SELECT f.doc_id, pos, CASE WHEN strong IS NOT NULL AND t <> '' AND NOT ch AND CASE WHEN first IS NULL THEN strong ELSE f.page_number < first END THEN 'Front Matter' ELSE h END AS parent_heading FROM f LEFT JOIN i ON i.doc_id = f.doc_id AND i.page_number = f.page_number""",
)
def w15(spark, d):
    rows = chunks(spark, d)
    heading = F.when(c("doc_id") % 3 == 0, F.when((c("pos") + c("doc_id")) % 8 > 1, "Preface")).otherwise(F.expr(_HEADS))
    images = rows.filter("pos % 4 = 1 AND page_number < 4 AND doc_id % 7 > 0").select("doc_id", "page_number", F.lit("Shadow").alias("extraction_method"), F.when(c("doc_id") % 2 == 0, "A Cover").otherwise("a chart").alias("description"))
    return I.front_matter(rows.withColumn("parent_heading", heading).select("doc_id", "pos", "page_number", "content", "parent_heading"), images).select("doc_id", "pos", "parent_heading")


_LINES = "CASE (pos + doc_id) % 11 WHEN 0 THEN 'MAUSER 1898' || chr(10) || content WHEN 1 THEN 'THE END OF IT' WHEN 2 THEN 'British SMLE No. 1, MKIII' WHEN 3 THEN 'ABC' WHEN 4 THEN '1898' ELSE content END"


@query(
    "w06_inferred_headings",
    f"""WITH {CHUNKS}, x AS (SELECT doc_id, pos, {_LINES} AS content, CASE pos % 3 WHEN 0 THEN 'file' WHEN 1 THEN 'Own' END AS h FROM chunks), l AS (SELECT *, trim(string_split({_S}, chr(10))[1]) AS line FROM x),
f AS (SELECT *, CASE WHEN (length(line) BETWEEN 4 AND 59 AND line = upper(line) AND regexp_matches(line, '\\pL') AND NOT regexp_matches(line, '^(THE|A|IN|ON|TO) ')) OR regexp_matches(line, '^[A-Z][a-z].*(No\\.|Model|Mk|Type|Mark)\\s') THEN line END AS found FROM l),
r AS (SELECT *, last_value(found IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS last FROM f) SELECT doc_id, pos, CASE WHEN (h IS NULL OR h = 'file') AND last IS NOT NULL THEN last ELSE h END AS parent_heading FROM r""",
)
def w06(spark, d):
    rows = chunks(spark, d).select("doc_id", "pos", F.expr(_LINES).alias("content"), F.when(c("pos") % 3 == 0, "file").when(c("pos") % 3 == 1, "Own").alias("parent_heading"), F.lit("file").alias("source_file"))
    return W.inferred_headings(rows).select("doc_id", "pos", "parent_heading")


_ITEMS = "CASE (pos * 5 + doc_id) % 4 WHEN 0 THEN 'M' WHEN 1 THEN lower(left(content, 20)) ELSE left(content, 20) END"


@query(
    "m15_drop_caps",
    f"""WITH RECURSIVE {CHUNKS}, x AS (SELECT doc_id, pos, page_number, {_ITEMS} AS text, pos * 10 AS y0, pos * 10 + CASE WHEN pos % 3 = 0 THEN 25 ELSE 9 END AS y1 FROM chunks),
b AS (SELECT *, regexp_matches(trim(text), '^\\p{{Lu}}$') AS cap, lead(text) OVER w AS nt, lead(page_number) OVER w AS np, lead(y0) OVER w AS n0, lead(y1) OVER w AS n1, lag(text) OVER w AS pt, lag(page_number) OVER w AS pp, lag(y0) OVER w AS p0, lag(y1) OVER w AS p1, row_number() OVER w AS rn FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
a AS (SELECT *, coalesce(cap AND regexp_matches(nt, '^\\s*\\p{{Ll}}') AND np = page_number AND least(n1, y1) > greatest(n0, y0), false) AS ahead, coalesce(cap AND regexp_matches(pt, '^\\s*\\p{{Ll}}') AND pp = page_number AND least(p1, y1) > greatest(p0, y0), false) AS behind FROM b),
w AS (SELECT doc_id, rn, pos, text, ahead, behind AND NOT ahead AS back, false AS given, NULL::VARCHAR AS before FROM a WHERE rn = 1
  UNION ALL SELECT a.doc_id, a.rn, a.pos, a.text, a.ahead, a.behind AND NOT a.ahead AND NOT w.given, w.ahead, CASE WHEN w.ahead THEN trim(w.text) END FROM w JOIN a ON a.doc_id = w.doc_id AND a.rn = w.rn + 1),
n AS (SELECT *, lead(back) OVER (PARTITION BY doc_id ORDER BY rn) AS nb, lead(text) OVER (PARTITION BY doc_id ORDER BY rn) AS nx FROM w)
SELECT doc_id, pos, coalesce(before, CASE WHEN nb THEN trim(nx) END, '') || text AS text FROM n WHERE NOT (ahead OR back)""",
)
def m15(spark, d):
    rows = chunks(spark, d).select("doc_id", "pos", "page_number", F.expr(_ITEMS).alias("text"), (c("pos") * 10).alias("y0"), (c("pos") * 10 + F.when(c("pos") % 3 == 0, 25).otherwise(9)).alias("y1"))
    return W.promote_drop_caps(rows).select("doc_id", "pos", "text")




_KINDS = "CASE (pos + doc_id) % 7 WHEN 0 THEN 'code' WHEN 1 THEN 'list_item' WHEN 2 THEN 'list_item' WHEN 3 THEN 'list_item' WHEN 5 THEN CASE WHEN pos % 4 = 0 THEN 'marker' ELSE 'paragraph' END ELSE 'paragraph' END AS kind"


@query("m02_merge_tiny")
def m02(spark, d):
    return M.merge_tiny(planted(spark, d).selectExpr("doc_id", "page_number", "pos", "content", _KINDS))

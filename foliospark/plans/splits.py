"""Queries of the chunkers, held against folds and walks in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chunking as X
from .catalog import CHUNKS, docs, query

c = F.col
_NL = "chr(10)"
#: White space that is stripped, in the other engine's SQL.
_W = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def exploded(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.posexplode("chunks").alias("part", "chunk"))


def _fold(pieces: str, full: str, opened: str, grown: str, most: int, limit: str | None = None) -> str:
    """SQL: pieces packed by a fold over structs; `full` tells when a chunk closes, `opened` and `grown` what the next holds."""
    whole = limit or f"length(text) <= {most}"
    return f"""f AS (SELECT doc_id, text, list_reduce(list_transform({pieces}, lambda s: {{'out': []::VARCHAR[], 'cur': s}}),
    lambda a, b: CASE WHEN {full} THEN {{'out': list_append(a.out, trim(a.cur, {_W})), 'cur': {opened}}} ELSE {{'out': a.out, 'cur': {grown}}} END) AS r FROM t),
g AS (SELECT doc_id, CASE WHEN {whole} OR r IS NULL THEN [text] WHEN trim(r.cur, {_W}) = '' THEN r.out ELSE list_append(r.out, trim(r.cur, {_W})) END AS chunks FROM f)
SELECT doc_id, (i - 1)::INT AS part, chunks[i] AS chunk FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM g)"""


_SPLIT = "string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"
_GROWN = "CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || ' ' || b.cur END"
_TAIL = f"CASE WHEN length(a.cur) <= 60 THEN a.cur WHEN regexp_matches(right(a.cur, 60), '[ \\n\\t]') THEN trim(regexp_extract(right(a.cur, 60), '(?s)[ \\n\\t].*'), {_W}) ELSE trim(right(a.cur, 60), {_W}) END"
_TEXTS = "WITH t AS (SELECT doc_id, text FROM documents), "


@query("x07_mapper_chunks", _TEXTS + _fold(_SPLIT, "length(a.cur) + length(b.cur) + 1 > 400 AND a.cur <> ''", "right(a.cur, 60) || ' ' || b.cur", _GROWN, 400))
def x07(spark, d):
    return exploded(X.mapper_chunks(docs(spark, d).select("doc_id", "text")))


@query("x02_sentence_chunks", _TEXTS + _fold(f"list_filter(list_transform({_SPLIT}, lambda x: trim(x, {_W})), lambda x: x <> '')", "length(a.cur) + length(b.cur) + 1 > 400 AND a.cur <> ''", f"({_TAIL}) || ' ' || b.cur", _GROWN, 400))
def x02(spark, d):
    return exploded(X.sentence_chunks(docs(spark, d).select("doc_id", "text")))


@query("x03_word_chunks", _TEXTS + _fold("list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')", "length(a.cur) + length(b.cur) + 1 > 1200 AND a.cur <> ''", f"({_TAIL}) || ' ' || b.cur", _GROWN, 1200))
def x03(spark, d):
    return exploded(X.word_chunks(docs(spark, d).select("doc_id", "text"), most=1200))


@query(
    "x13_index_chunks",
    f"""WITH t AS (SELECT doc_id, text FROM documents), f AS (SELECT doc_id, text, list_reduce(list_transform(list_filter(string_split(text, {_NL}), lambda x: trim(x, {_W}) <> ''), lambda s: {{'out': []::VARCHAR[], 'cur': s}}),
    lambda a, b: CASE WHEN length(a.cur) + length(b.cur) + 1 > 1200 THEN {{'out': list_append(a.out, trim(a.cur, {_W})), 'cur': b.cur}} ELSE {{'out': a.out, 'cur': a.cur || {_NL} || b.cur}} END) AS r FROM t),
h AS (SELECT doc_id, text, r.out AS o, trim(r.cur, {_W}) AS last, r FROM f),
g AS (SELECT doc_id, CASE WHEN length(text) <= 1200 OR r IS NULL THEN [text] WHEN len(o) > 0 AND length(last) < 200 THEN list_append(list_slice(o, 1, -2), o[-1] || {_NL} || last) ELSE list_append(o, last) END AS chunks FROM h)
SELECT doc_id, (i - 1)::INT AS part, chunks[i] AS chunk FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM g)""",
)
def x13(spark, d):
    return exploded(X.index_chunks(docs(spark, d).select("doc_id", "text")))


@query(
    "x10_line_chunks",
    f"""WITH RECURSIVE p AS (SELECT doc_id, i, j, length(line) > 300 AS hard, CASE WHEN length(line) > 300 THEN substr(line, j * 300 + 1, 300) ELSE line END AS s
  FROM (SELECT doc_id, i, line, unnest(range(0, CASE WHEN length(line) > 300 THEN (length(line) - 1) // 300 + 1 ELSE 1 END)) AS j
    FROM (SELECT doc_id, i, string_split(text, {_NL})[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, {_NL})) + 1)) AS i FROM documents)))),
x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS rn FROM p),
w AS (SELECT doc_id, rn, hard, s, 1 AS grp, length(s)::BIGINT AS held FROM x WHERE rn = 1
  UNION ALL SELECT x.doc_id, x.rn, x.hard, x.s, CASE WHEN x.hard OR w.hard OR w.held + length(x.s) + 1 > 300 THEN w.grp + 1 ELSE w.grp END,
    CASE WHEN x.hard OR w.hard OR w.held + length(x.s) + 1 > 300 THEN length(x.s) ELSE w.held + length(x.s) + 1 END FROM w JOIN x ON x.doc_id = w.doc_id AND x.rn = w.rn + 1),
g AS (SELECT doc_id, grp, CASE WHEN bool_or(hard) AND max(length(s)) = 300 THEN rtrim(string_agg(s, {_NL} ORDER BY rn), {_W}) ELSE trim(string_agg(s, {_NL} ORDER BY rn), {_W}) END AS chunk FROM w GROUP BY doc_id, grp)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1)::INT AS part, chunk FROM g WHERE chunk <> ''""",
)
def x10(spark, d):
    return exploded(X.line_chunks(docs(spark, d).select("doc_id", "text"), most=300))


_CODE_TEXT = "replace(replace(text, '. ', chr(10) || '    '), ', ', chr(10))"


def _window(sql_text: str, most: str, overlap: int, blank: str, strip: str, alone: bool) -> str:
    """SQL of a walk over lines: the window of each step and the chunks that close there."""
    tail = f"CASE WHEN len(w.win) > {overlap} THEN list_slice(w.win, -{overlap}, -1) ELSE {blank} END"
    size = lambda x: f"(length(array_to_string({x}, {_NL})) + 1 + length(l.s))"
    closes = f"len(w.win) > 0 AND {size('w.win')} {most}"
    second = f"CASE WHEN {closes} AND len({tail}) > 0 AND {size(tail)} {most} THEN true ELSE false END" if alone else "false"
    return f"""l AS (SELECT doc_id, i, string_split(t, {_NL})[i] AS s FROM (SELECT doc_id, t, unnest(range(1, len(string_split(t, {_NL})) + 1)) AS i FROM (SELECT doc_id, {sql_text} AS t FROM documents))),
w AS (SELECT doc_id, i, [s] AS win, NULL::VARCHAR AS one, NULL::VARCHAR AS two FROM l WHERE i = 1
  UNION ALL SELECT l.doc_id, l.i, CASE WHEN NOT ({closes}) THEN list_append(w.win, l.s) WHEN {second} THEN [l.s] ELSE list_append({tail}, l.s) END,
    CASE WHEN {closes} THEN trim(array_to_string(w.win, {_NL}), {strip}) END, CASE WHEN {second} THEN trim(array_to_string({tail}, {_NL}), {strip}) END FROM w JOIN l ON l.doc_id = w.doc_id AND l.i = w.i + 1),
o AS (SELECT doc_id, i, 0 AS k, one AS chunk FROM w UNION ALL SELECT doc_id, i, 1, two FROM w
  UNION ALL SELECT doc_id, max(i) + 1, 0, trim(array_to_string(max_by(win, i), {_NL}), {strip}) FROM w GROUP BY doc_id)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1)::INT AS part, chunk FROM o WHERE trim(chunk, {_W}) <> ''"""


@query("x05_code_chunks", "WITH RECURSIVE " + _window(_CODE_TEXT, "> 400", 4, "[]::VARCHAR[]", _NL, True))
def x05(spark, d):
    return exploded(X.code_chunks(docs(spark, d).select("doc_id", F.expr(_CODE_TEXT).alias("text"))))


@query(
    "x12_token_code",
    "WITH RECURSIVE " + _window(_CODE_TEXT, "// 4 > 100", 5, "w.win", _W, False),
)
def x12(spark, d):
    rows = X.token_code_chunks(docs(spark, d).select("doc_id", F.expr(_CODE_TEXT).alias("text")).filter("length(text) DIV 4 > 100"), most_tokens=100)
    short = docs(spark, d).select("doc_id", F.expr(_CODE_TEXT).alias("text")).filter("length(text) DIV 4 <= 100").select("doc_id", F.lit(0).alias("part"), F.regexp_replace("text", r"^\s+|\s+\z", "").alias("chunk")).filter("chunk <> ''")
    return exploded(rows).unionByName(short)


#: A first sentence over the limit is cut by words.
_FORCED = f"""list_reduce(list_transform(list_filter(string_split_regex(s, '\\s+'), lambda w: w <> ''), lambda w: {{'out': []::VARCHAR[], 'cur': w}}),
    lambda a, b: CASE WHEN length(a.cur) + 1 + length(b.cur) > 1998 THEN {{'out': list_append(a.out, trim(a.cur, {_W})), 'cur': CASE WHEN length(a.cur) > 60 THEN right(a.cur, 60) ELSE '' END || ' ' || b.cur}}
      ELSE {{'out': a.out, 'cur': a.cur || ' ' || b.cur}} END)"""


@query(
    "x11_token_chunks",
    (_TEXTS + _fold(_SPLIT, "(length(a.cur) + length(b.cur) + 1) // 4 > 512 AND a.cur <> ''", "right(a.cur, 60) || ' ' || b.cur", _GROWN, 0, "length(text) // 4 <= 512")).replace(
        "lambda s: {'out': []::VARCHAR[], 'cur': s}", f"lambda s, i: CASE WHEN i = 1 AND length(s) // 4 > 512 THEN {_FORCED} ELSE {{'out': []::VARCHAR[], 'cur': s}} END"
    ),
)
def x11(spark, d):
    return exploded(X.token_chunks(docs(spark, d).select("doc_id", "text")))


_PARAGRAPHS = "CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN replace(text, '. ', chr(10)) ELSE replace(replace(text, chr(10), chr(10) || chr(10)), '. ', ' ') END"


def _break(most: int) -> str:
    """SQL of a walk over what is left of each text."""
    blank = f"(CASE WHEN contains(left(rest, {most + 2}), {_NL} || {_NL}) THEN least(length(rest), {most + 2}) - instr(reverse(left(rest, {most + 2})), {_NL} || {_NL}) - 1 ELSE -1 END)"
    line = f"(CASE WHEN contains(left(rest, {most + 1}), {_NL}) THEN {most + 1} - instr(reverse(left(rest, {most + 1})), {_NL}) ELSE -1 END)"
    mark = f"(CASE WHEN regexp_matches(left(rest, {most + 1}), '[.?!]') THEN {most + 1} - length(regexp_extract(left(rest, {most + 1}), '[^.?!]*$')) ELSE 0 END)"
    least = most // 5
    return f"""r AS (SELECT doc_id, 0 AS part, trim(text, {_W}) AS rest, NULL::VARCHAR AS chunk FROM t
  UNION ALL SELECT doc_id, part + 1, trim(substr(rest, cut + skip + 1), {_W}), trim(left(rest, cut), {_W}) FROM (
    SELECT doc_id, part, rest, CASE WHEN moved THEN space ELSE cut END AS cut, CASE WHEN moved THEN 1 ELSE skip END AS skip FROM (
      SELECT *, regexp_matches(substr(rest, cut, 2), '^\\pL\\pL') AND space > {least} AS moved FROM (
        SELECT *, CASE WHEN contains(left(rest, cut), ' ') THEN cut - instr(reverse(left(rest, cut)), ' ') ELSE -1 END AS space FROM (
          SELECT doc_id, part, rest, CASE WHEN length(rest) <= {most} THEN length(rest) WHEN b >= {least} THEN b WHEN l >= {least} THEN l WHEN m >= {least} THEN least(m, {most}) ELSE {most} END::BIGINT AS cut,
            CASE WHEN length(rest) <= {most} THEN 0 WHEN b >= {least} THEN 2 WHEN l >= {least} THEN 1 ELSE 0 END AS skip
          FROM (SELECT doc_id, part, rest, {blank} AS b, {line} AS l, {mark} AS m FROM r WHERE rest <> ''))))))"""


@query(
    "x09_paragraph_chunks",
    f"""WITH RECURSIVE t AS (SELECT doc_id, {_PARAGRAPHS} AS text FROM documents), {_break(700)}
SELECT r.doc_id, (part - 1)::INT AS part, CASE WHEN length(t.text) <= 700 THEN t.text ELSE chunk END AS chunk FROM r JOIN t USING (doc_id) WHERE chunk IS NOT NULL""",
)
def x09(spark, d):
    return exploded(X.paragraph_chunks(docs(spark, d).select("doc_id", F.expr(_PARAGRAPHS).alias("text")), most=700))


_OVERSIZE = "CASE WHEN (pos + doc_id) % 5 = 0 THEN 'code' ELSE 'paragraph' END AS chunk_type, CASE WHEN (pos + doc_id) % 7 = 0 THEN 'table' ELSE 'text' END AS modality"


@query(
    "x08_oversize_parts",
    f"""WITH RECURSIVE {CHUNKS}, s AS (SELECT doc_id, pos, content AS text, {_OVERSIZE} FROM chunks),
t AS (SELECT doc_id || '_' || pos AS doc_id, text FROM s WHERE modality = 'text' AND chunk_type <> 'code' AND length(text) > 1500), {_break(1500)},
p AS (SELECT doc_id AS key, part, chunk, count(*) OVER (PARTITION BY doc_id) AS n FROM r WHERE chunk IS NOT NULL)
SELECT key || CASE WHEN part > 1 THEN '_o' || part ELSE '' END AS chunk_id, CASE WHEN part > 1 THEN 'doc > [Oversize Split ' || part || '/' || n || ']' ELSE 'doc' END AS path, CASE WHEN part > 1 THEN 3 ELSE 2 END AS level, chunk AS content FROM p
UNION ALL SELECT doc_id || '_' || pos, 'doc', 2, text FROM s WHERE NOT (modality = 'text' AND length(text) > 1500)""",
)
def x08(spark, d):
    from .catalog import chunks

    rows = chunks(spark, d).selectExpr("doc_id", "pos", "content", *_OVERSIZE.split(", CASE")[:1], "CASE" + _OVERSIZE.split(", CASE")[1])
    rows = rows.filter("NOT (modality = 'text' AND chunk_type = 'code' AND length(content) > 1500)")  # x10_line_chunks has these
    rows = rows.select(F.concat_ws("_", "doc_id", "pos").alias("chunk_id"), "modality", "chunk_type", "content", F.array(F.lit("doc")).alias("breadcrumb"), F.lit(2).alias("level"))
    return X.break_oversize(rows).select("chunk_id", F.array_join("breadcrumb", " > ").alias("path"), "level", "content")


_MIXED = "replace(text, chr(10), chr(10) || chr(10) || 'def f(x):' || chr(10) || '    return x' || chr(10) || chr(10) || 'import os' || chr(10) || ' ' || chr(10))"


@query("x04_mixed_chunks")
def x04(spark, d):
    return X.mixed_chunks(docs(spark, d).select("doc_id", F.expr(_MIXED).alias("text")))

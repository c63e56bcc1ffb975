"""SQL for queries of the catalog that had none, and the merge by place."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import ids as I
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import layout as O
from ..operators import windows as W
from ..sources import sinks as K
from .catalog import _BOXES, CHUNKS, P, boxes, chunks, docs, query
from .rules import _CODE, _S, _SHAPE, PLANTED, planted, _sql_label

c = F.col

_FILTER = """CASE WHEN t = '' THEN 'EMPTY' WHEN length(t) < 10 THEN CASE WHEN regexp_matches(t, '^\\d+$') THEN 'PAGE_NUMBER' WHEN length(t) < 2 THEN 'DECORATION' ELSE 'TOO_SHORT' END
  WHEN regexp_matches(t, '^[\\s\\-_=•·…]+$') THEN 'DECORATION' WHEN regexp_matches(lower(t), '^page\\s*\\d+$|^\\d+\\s*/\\s*\\d+$|^[ivxlcdm]+$|^©\\s*\\d{4}') THEN 'NOISE_PATTERN' END"""


@query("a01_filter_summary", f"WITH {PLANTED}, s AS (SELECT doc_id, {_S} AS t FROM planted) SELECT doc_id, coalesce({_FILTER}, 'KEPT') AS category, count(*) AS n_chunks, sum(CASE WHEN t = '' THEN 0 ELSE greatest(1, floor(length(t) / 4.0 + 0.5)) END)::BIGINT AS n_tokens FROM s GROUP BY ALL")
def a01(spark, d):
    return A.filter_summary(planted(spark, d), P.skip_category(c("content"), "academic_whitepaper"))


@query(
    "w09_orphan_labels",
    f"""WITH {PLANTED}, s AS (SELECT *, {_S} AS t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM planted), l AS (SELECT *, {_sql_label(f'^{_SHAPE}{{1,59}}:?$')} AS label FROM s),
a AS (SELECT x.doc_id, x.pos, count(y.rn) AS n FROM l x LEFT JOIN l y ON y.doc_id = x.doc_id AND y.rn BETWEEN x.rn + 1 AND x.rn + 4 AND y.page_number BETWEEN x.page_number AND x.page_number + 1 AND length(y.content) >= 20 AND NOT y.label GROUP BY ALL)
SELECT doc_id, pos, label AND n = 0 AS orphan FROM l JOIN a USING (doc_id, pos)""",
)
def w09(spark, d):
    return W.orphan_labels(planted(spark, d), P.is_label(c("content"))).select("doc_id", "pos", "orphan")


_WORDS = "list_sort(list_distinct(regexp_extract_all(lower(content), '[a-z]{3,}')))"
#: Chunks of which every fifth repeats words of the one before.
_ECHO = "CASE WHEN pos % 5 = 2 THEN left(before, 120) WHEN pos % 5 = 4 THEN before || ' more' ELSE content END"


def _echoes(spark, d):
    from pyspark.sql import Window

    before = F.coalesce(F.lag("content").over(Window.partitionBy("doc_id").orderBy("pos")), F.lit(""))
    return chunks(spark, d).withColumn("before", before).select("doc_id", "page_number", "pos", F.expr(_ECHO).alias("content"))


_ECHOES = f"{CHUNKS}, e AS (SELECT doc_id, page_number, pos, {_ECHO} AS content FROM (SELECT *, coalesce(lag(content) OVER (PARTITION BY doc_id ORDER BY pos), '') AS before FROM chunks))"


@query(
    "d01_subsets_dropped",
    f"""WITH RECURSIVE {_ECHOES}, v AS (SELECT *, {_WORDS} AS w FROM e),
p AS (SELECT a.doc_id, a.page_number, a.pos AS pa, b.pos AS pb, CASE WHEN len(a.w) < len(b.w) THEN a.pos ELSE b.pos END AS lost, row_number() OVER (PARTITION BY a.doc_id, a.page_number ORDER BY a.pos, b.pos) AS rn
  FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.page_number = b.page_number AND a.pos < b.pos WHERE len(a.w) > 0 AND len(b.w) > 0 AND len(list_intersect(a.w, b.w)) / least(len(a.w), len(b.w)) > 0.80),
g AS (SELECT doc_id, page_number, rn, [lost] AS gone FROM p WHERE rn = 1 UNION ALL SELECT p.doc_id, p.page_number, p.rn, CASE WHEN list_contains(g.gone, p.pa) OR list_contains(g.gone, p.pb) THEN g.gone ELSE list_append(g.gone, p.lost) END FROM g JOIN p ON p.doc_id = g.doc_id AND p.page_number = g.page_number AND p.rn = g.rn + 1),
l AS (SELECT doc_id, page_number, arg_max(gone, rn) AS gone FROM g GROUP BY ALL)
SELECT e.doc_id, e.page_number, e.pos FROM e LEFT JOIN l ON l.doc_id = e.doc_id AND l.page_number = e.page_number WHERE NOT coalesce(list_contains(gone, pos), false)""",
)
def d01b(spark, d):
    return D.drop_subsets(_echoes(spark, d)).select("doc_id", "page_number", "pos")


@query(
    "d02_near_repeats",
    f"""WITH RECURSIVE {_ECHOES}, v AS (SELECT doc_id, page_number, pos, {_WORDS} AS w, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY pos) AS rn FROM e),
g AS (SELECT doc_id, page_number, pos, rn, CASE WHEN len(w) >= 5 THEN [w] ELSE []::VARCHAR[][] END AS kept, true AS stays FROM v WHERE rn = 1
  UNION ALL SELECT v.doc_id, v.page_number, v.pos, v.rn, CASE WHEN len(v.w) >= 5 AND len(list_filter(g.kept, lambda k: len(list_intersect(k, v.w)) > 0.95 * len(v.w))) = 0 THEN list_append(g.kept, v.w) ELSE g.kept END,
    len(v.w) < 5 OR len(list_filter(g.kept, lambda k: len(list_intersect(k, v.w)) > 0.95 * len(v.w))) = 0 FROM g JOIN v ON v.doc_id = g.doc_id AND v.page_number = g.page_number AND v.rn = g.rn + 1)
SELECT doc_id, page_number, pos FROM g WHERE stays""",
)
def d02(spark, d):
    return D.drop_near_repeats(_echoes(spark, d)).select("doc_id", "page_number", "pos")


@query(
    "w11_reading_order",
    f"""WITH x AS ({_BOXES}), b AS (SELECT l_orderkey AS doc_id, l_linenumber AS item, a[1] AS x0, a[2] AS y0, a[3] AS x1, (a[1] + a[3]) / 2 AS mid FROM x), m AS (SELECT doc_id, median(mid) AS split, count(*) AS n FROM b GROUP BY doc_id),
s AS (SELECT b.*, mid <= split AS l, n FROM b JOIN m USING (doc_id)), g AS (SELECT doc_id, min(x0) FILTER (NOT l) - max(x1) FILTER (l) AS gap FROM s GROUP BY doc_id)
SELECT doc_id, item, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN n >= 2 AND coalesce(gap > 40, false) AND NOT l THEN 1 ELSE 0 END, y0, x0, item) AS position FROM s JOIN g USING (doc_id)""",
)
def w11(spark, d):
    rows = boxes(spark, d).select(c("l_orderkey").alias("doc_id"), F.lit(1).alias("page_number"), c("l_linenumber").alias("item"), c("a")[0].alias("x0"), c("a")[1].alias("y0"), c("a")[2].alias("x1"), F.lit(1000).alias("page_width"))
    return O.order_in_page(rows).select("doc_id", "item", "position")


_BOX = "[(doc_id % 3) * 100 + pos % 4 * 60, pos * 30, (doc_id % 3) * 100 + pos % 4 * 60 + 150, pos * 30 + 15 + (pos * doc_id) % 31]"


@query(
    "m01_merge_by_place",
    f"""WITH RECURSIVE {PLANTED}, x AS (SELECT doc_id, page_number, pos, content, {_BOX} AS b, {_CODE} AS code FROM planted), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY b[2], b[1], pos) AS rn FROM x),
w AS (SELECT doc_id, page_number, rn, pos, code, content, b, 0 AS grp FROM r WHERE rn = 1
  UNION ALL SELECT doc_id, page_number, rn, CASE WHEN j THEN pos ELSE npos END, ncode, CASE WHEN j THEN trim(rtrim(content, ' ' || chr(9) || chr(10)) || chr(10) || ltrim(ncontent, ' ' || chr(9) || chr(10)), ' ' || chr(9) || chr(10)) ELSE ncontent END,
    CASE WHEN j THEN [least(b[1], nb[1]), least(b[2], nb[2]), greatest(b[3], nb[3]), greatest(b[4], nb[4])] ELSE nb END, CASE WHEN j THEN grp ELSE grp + 1 END FROM (
    SELECT r.doc_id, r.page_number, r.rn, w.pos, r.pos AS npos, r.code AS ncode, w.content, r.content AS ncontent, w.b, r.b AS nb, w.grp,
      w.code = r.code AND r.b[2] - w.b[4] BETWEEN 0 AND 20 AND greatest(0, least(w.b[3], r.b[3]) - greatest(w.b[1], r.b[1])) / greatest(1, least(w.b[3] - w.b[1], r.b[3] - r.b[1])) > 0.4
        AND length(rtrim(w.content, ' ' || chr(9) || chr(10))) + length(ltrim(r.content, ' ' || chr(9) || chr(10))) + 1 <= 600 AS j FROM w JOIN r ON r.doc_id = w.doc_id AND r.page_number = w.page_number AND r.rn = w.rn + 1))
SELECT doc_id, page_number, arg_max(pos, rn) AS pos, arg_max(content, rn) AS content, array_to_string(arg_max(b, rn), ',') AS bbox FROM w GROUP BY doc_id, page_number, grp""",
)
def m01(spark, d):
    box = F.array(*(F.expr(x).cast("int") for x in _BOX[1:-1].split(", ")))
    rows = planted(spark, d).withColumns({"bbox": box, "is_code": P.looks_like_code(c("content"))})
    return W.merge_by_place(rows, most_chars=600).select("doc_id", "page_number", "pos", "content", F.array_join(c("bbox").cast("array<string>"), ",").alias("bbox"))


_POINTS = "left(coalesce(CASE WHEN pos % 2 = 0 THEN replace(content, 'e', 'E') END, content), 10000)"


@query("k_points", f"WITH {CHUNKS}, p AS (SELECT (doc_id % 20) || ':' || (pos % 6) AS key, doc_id, page_number, 'text' AS modality, {_POINTS} AS content FROM chunks) SELECT key, doc_id, page_number, modality, content FROM p QUALIFY row_number() OVER (PARTITION BY key ORDER BY page_number DESC, doc_id DESC, content DESC) = 1")
def k_points(spark, d):
    rows = chunks(spark, d).withColumns({"chunk_id": F.concat((c("doc_id") % 20).cast("string"), F.lit(":"), (c("pos") % 6).cast("string")), "modality": F.lit("text"), "refined_content": F.when(c("pos") % 2 == 0, F.replace("content", F.lit("e"), F.lit("E"))), "source_file": c("source")})
    made = K.payload(rows)
    keys = rows.select("chunk_id").distinct().select(c("chunk_id").alias("key"), K.I.point_id(c("chunk_id")).alias("point_id"))
    return K.last_by_id(made.select("point_id", "doc_id", "page_number", "modality", "content"), c("page_number")).join(keys, "point_id").select("key", "doc_id", "page_number", "modality", "content")


_NUMBERED = "replace(replace(content, '. ', chr(10) || (pos * 7) || chr(10)), ', ', ' 3. ')"
_IS = "regexp_matches(trim(x), '^\\d{1,4}$')"


@query(
    "p08_p13_lines",
    f"""WITH {CHUNKS}, s AS (SELECT doc_id, pos, regexp_replace({_NUMBERED}, '[^\\n -~]', 'e', 'g') AS t FROM chunks), l AS (SELECT *, string_split(t, chr(10)) AS ls, len(list_filter(string_split(t, chr(10)), lambda x: {_IS})) >= 2 AS several FROM s)
SELECT doc_id, pos, CASE WHEN len(ls) < 2 THEN t ELSE trim(array_to_string(list_filter(ls, lambda x, i: NOT ({_IS} AND (several OR coalesce(length(trim(ls[i - 1])) >= 6 AND i > 1 AND NOT regexp_matches(trim(ls[i - 1]), '^\\d{{1,4}}$'), false) OR coalesce(length(trim(ls[i + 1])) >= 6 AND NOT regexp_matches(trim(ls[i + 1]), '^\\d{{1,4}}$'), false)))), chr(10)), chr(10)) END AS p08,
  trim(regexp_replace(t, '(?m)^\\s*\\d{{1,4}}\\s*$\\n?', '', 'g'), chr(10)) AS p09,
  regexp_replace(t, '(\\b[a-z][a-z''\\-]{{0,15}})\\s+(?:[1-9]|[12]\\d|3\\d|40)\\.\\s+([a-z][A-Za-z''\\-]*)', '\\1 \\2', 'g') AS p11 FROM l""",
)
def p08(spark, d):
    text = F.regexp_replace(F.expr(_NUMBERED), "[^\n -~]", "e")  # word boundaries mean the same in both engines
    return chunks(spark, d).select("doc_id", "pos", T.drop_page_number_lines(text).alias("p08"), T.drop_digit_lines(text).alias("p09"), T.drop_infix_numbers(text).alias("p11"))


_LAST = "CASE WHEN contains(h, '{0}') THEN 121 - instr(reverse(h), '{0}') ELSE 0 END"


@query(
    "p23_p30_more",
    f"""WITH {CHUNKS}, s AS (SELECT doc_id, pos, content, rpad(left(content, 120), 120, 'x') AS h, string_split_regex(trim(replace(content, ', ', '  ')), '\\t+| {{2,}}') AS cells FROM chunks),
f AS (SELECT *, greatest({_LAST.format('.')}, {_LAST.format('!')}, {_LAST.format('?')}) AS m, {_LAST.format(' ')} AS b FROM s)
SELECT doc_id, pos, CASE WHEN length(content) <= 120 THEN content WHEN m > 72 THEN left(h, m) WHEN b > 96 THEN rtrim(left(h, b)) || '...' ELSE h || '...' END AS p23,
  CASE WHEN trim(replace(content, ', ', '  ')) = '' THEN replace(content, ', ', '  ') WHEN len(cells) > 1 THEN '| ' || array_to_string(cells, ' | ') || ' |' || chr(10) || '| ' || array_to_string(list_transform(cells, lambda x: '---'), ' | ') || ' |' ELSE '| Content |' || chr(10) || '| --- |' || chr(10) || '| ' || cells[1] || ' |' END AS p25,
  trim(content) AS p26 FROM f""",
)
def p23(spark, d):
    return chunks(spark, d).select("doc_id", "pos", T.truncate_at_sentence(c("content"), 120).alias("p23"), T.table_markdown(F.replace("content", F.lit(", "), F.lit("  "))).alias("p25"), T.strip_fences(F.concat(F.lit("```md\n"), "content", F.lit("\n```"))).alias("p26"))


@query(
    "c24_code_evidence",
    f"""WITH {PLANTED}, g AS (SELECT doc_id, count(*) FILTER ({_CODE}) AS code_chunks, count(*) AS n_chunks FROM planted GROUP BY doc_id)
SELECT doc_id, code_chunks, n_chunks, CASE WHEN code_chunks / n_chunks >= 0.15 THEN 'code_heavy' WHEN code_chunks >= 3 THEN 'mixed' ELSE 'prose' END AS content_type FROM g""",
)
def c24(spark, d):
    return O.code_evidence(planted(spark, d))


# ---- ids, repeats, domains and refinement

_HEX = "sha1(unhex('8b7c5e3a1f4d4b2a9c1e6d8a3f0b9c2e') || encode(source || '#' || doc_id))"


@query(
    "point_ids",
    f"""WITH h AS (SELECT doc_id, {_HEX} AS h FROM documents)
SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id FROM h""",
)
def point_ids(spark, d):
    return docs(spark, d).select("doc_id", I.point_id(F.concat_ws("#", "source", c("doc_id").cast("string"))).alias("point_id"))


_REPEAT = "CASE doc_id % 4 WHEN 0 THEN left(text, 200) || ' ' || left(text, 200) || ' ' || left(text, 200) || chr(10) || chr(10) || chr(10) || left(text, 200) WHEN 1 THEN text || chr(10) || left(text, 90) || chr(10) || replace(left(text, 90), 'e', 'E') ELSE text END"
_TRIM = "trim({}, ' ' || chr(9) || chr(10))"


def _part(n: int) -> str:
    """SQL: whether what follows the n-th part of t begins as that part does."""
    size = f"(length(t) // {n})"
    head = f"rtrim(left(t, {size}), ' ' || chr(9) || chr(10))"
    return f"({size} >= 30 AND starts_with(ltrim(substr(t, {size} + 1), ' ' || chr(9) || chr(10)), left({head}, 40)))"


_CUT = "rtrim(left(t, length(t) // {}), ' ' || chr(9) || chr(10))"


@query(
    "p16_repeats",
    f"""WITH RECURSIVE x AS (SELECT doc_id, {_REPEAT} AS text FROM documents), r AS (SELECT doc_id, 0 AS k, {_TRIM.format('text')} AS t FROM x
  UNION ALL SELECT doc_id, k + 1, CASE WHEN {_part(2)} THEN {_CUT.format(2)} WHEN {_part(3)} THEN {_CUT.format(3)} ELSE {_CUT.format(4)} END FROM r WHERE length(t) > 60 AND ({_part(2)} OR {_part(3)} OR {_part(4)})),
e AS (SELECT doc_id, max(k) AS k, arg_max(t, k) AS t FROM r GROUP BY doc_id),
l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM x)),
n AS (SELECT *, lower(trim(line)) AS key, row_number() OVER (PARTITION BY doc_id, lower(trim(line)) ORDER BY i) AS seen FROM l),
j AS (SELECT doc_id, {_TRIM.format("string_agg(line, chr(10) ORDER BY i)")} AS t FROM n WHERE seen = 1 OR length(key) <= 5 GROUP BY doc_id)
SELECT x.doc_id, CASE WHEN len(string_split(x.text, chr(10))) < 4 THEN x.text WHEN e.k > 0 THEN e.t WHEN j.t <> {_TRIM.format('x.text')} THEN j.t ELSE x.text END AS p16 FROM x JOIN e USING (doc_id) JOIN j USING (doc_id)""",
)
def p16(spark, d):
    return docs(spark, d).select("doc_id", O.drop_repeats(F.expr(_REPEAT)).alias("p16"))


_SCORES = """(CASE WHEN talk > 0.3 AND n > 50 AND NOT tab AND code < 2 THEN 0.8 ELSE 0 END + CASE WHEN talk > 0 AND n > 20 AND NOT tab AND dens BETWEEN 500 AND 2500 AND code < 2 THEN 0.4 ELSE 0 END + CASE WHEN n > 100 AND NOT tab AND dens < 2500 THEN 0.3 ELSE 0 END) AS lit,
  (CASE WHEN dens > 3000 THEN 0.7 + CASE WHEN img THEN 0 ELSE 0.2 END ELSE 0 END) AS aca, (CASE WHEN cov >= 0.6 THEN 0.6 ELSE 0 END + CASE WHEN dens BETWEEN 500 AND 2500 AND cov >= 0.6 THEN 0.2 ELSE 0 END) AS edi, (CASE WHEN tab THEN 0.5 ELSE 0 END + CASE WHEN NOT img AND dens > 1000 THEN 0.3 ELSE 0 END) AS tec"""


@query(
    "c13_domains",
    f"""WITH f AS (SELECT doc_id, (doc_id * 13) % 130 AS n, (doc_id * 37) % 3700 AS dens, doc_id % 5 = 0 AS tab, (doc_id % 7) / 10.0 AS talk, doc_id % 4 AS code, (doc_id % 9) / 10.0 AS cov, doc_id % 3 = 0 AS img FROM documents), s AS (SELECT doc_id, {_SCORES} FROM f)
SELECT doc_id, CASE WHEN greatest(lit, aca, edi, tec) < 0.3 THEN 'unknown' WHEN lit = greatest(lit, aca, edi, tec) THEN 'literature' WHEN aca = greatest(lit, aca, edi, tec) THEN 'academic' WHEN edi = greatest(lit, aca, edi, tec) THEN 'editorial' ELSE 'technical' END AS domain FROM s""",
)
def c13(spark, d):
    k = c("doc_id")
    rows = docs(spark, d).select(
        "doc_id", ((k * 13) % 130).alias("n_pages"), ((k * 37) % 3700).alias("density"), (k % 5 == 0).alias("tables"), ((k % 7) / 10).alias("dialogue_share"), (k % 4).alias("code_pages"), ((k % 9) / 10).alias("coverage_share"), (k % 3 == 0).alias("image_heavy")
    )
    return O.content_domain(rows).select("doc_id", "domain")


#: Signs of corruption planted into plain ASCII, which has the same word boundaries in both engines.
_TORN = "CASE pos % 6 WHEN 0 THEN replace(content, ' the ', ' t h e ') WHEN 1 THEN replace(content, ', ', ' , ') || ' part ABC-123 and P/N: 77x on 2024-01-31' WHEN 2 THEN replace(content, 'e', 'l1I0O') WHEN 3 THEN replace(content, ' ', '  ') WHEN 4 THEN replace(content, '. ', chr(10) || 'API model schema class' || chr(10)) ELSE content || ' ECU-001-A SN: 5' END"


def _hits(pattern: str, weight: float) -> str:
    n = f"len(regexp_extract_all(t, '{pattern}'))"
    return f"CASE WHEN {n} >= 2 THEN least({n} * {weight}, {weight * 3}) ELSE 0 END"


_SUM = " + ".join(_hits(p.replace("(?U)", "").replace("'", "''"), w) for p, w, _ in C.CORRUPTION)
def _kept(text: str) -> str:
    return "list_sort(list_distinct(" + " || ".join(f"regexp_extract_all({text}, '{p}')" for p in C.PROTECTED) + "))"


_TIDY = "regexp_replace(regexp_replace(regexp_replace(t, '[ \\t]{2,}', ' ', 'g'), '\\s+([.,;:!?])', '\\1', 'g'), '(?m)[ \\t]+$', '', 'g')"
_TERMS = " + ".join(f"contains(lower(t), '{w}')::INT" for w in C.TECHNICAL)


@query(
    "z_refine",
    f"""WITH {CHUNKS}, x AS (SELECT doc_id, pos, regexp_replace({_TORN}, '[^\n -~]', 'e', 'g') AS t FROM chunks), s AS (SELECT *, CASE WHEN length(t) < 10 THEN 0 ELSE least({_SUM}, 1) END AS z1, list_filter(list_transform(string_split(t, chr(10)), lambda v: trim(v)), lambda v: v <> '') AS ls,
  regexp_extract_all(t, '\\b[\\w\\-/]+\\b') AS tk, {_kept('t')} AS z3, {_TIDY} AS tidy FROM x),
q AS (SELECT *, CASE WHEN len(ls) < 3 THEN 0 ELSE least(1, CASE WHEN len(list_filter(ls, lambda v: length(v) <= 42)) / len(ls) >= 0.6 THEN 0.25 ELSE 0 END + CASE WHEN regexp_matches(ls[-1], '(?i)\\b(section|chapter)\\b') OR regexp_matches(ls[-1], '^\\d+(\\.\\d+)*\\s+') THEN 0.45 ELSE 0 END
  + CASE WHEN len(tk) > 0 AND len(list_filter(tk, lambda v: regexp_matches(v, '^[A-Z]{{2,}}(-[A-Z0-9]+)+$'))) / len(tk) >= 0.2 THEN 0.2 ELSE 0 END) END AS z2 FROM s)
SELECT doc_id, pos, round(z1, 6)::DOUBLE AS z1, round(z2, 6)::DOUBLE AS z2, array_to_string(z3, '|') AS z3, levenshtein(t, tidy) / greatest(1, length(t)) <= 0.35 AND z3 = {_kept('tidy')} AND len(regexp_extract_all(tidy, '(?m)^\\s*([-*•]|\\d+[.)])\\s')) <= len(regexp_extract_all(t, '(?m)^\\s*([-*•]|\\d+[.)])\\s')) AS z4,
  CASE WHEN z2 >= 0.6 THEN 'blocked' WHEN round(z1, 9) >= 0.7 AND ({_TERMS}) / 10.0 >= 0.3 THEN 'rule' WHEN round(z1, 9) < round(0.15 - CASE WHEN len(z3) / greatest(1, len(regexp_extract_all(t, '\\S+'))) >= 0.08 THEN 0.05 ELSE 0 END, 9) THEN 'keep' ELSE 'model' END AS z5 FROM q""",
)
def z_refine(spark, d):
    rows = chunks(spark, d).select("doc_id", "pos", F.regexp_replace(F.expr(_TORN), "[^\n -~]", "e").alias("t"))
    x, score, tokens = c("t"), c("score"), c("tokens")
    rows = rows.withColumns({"score": C.corruption_score(x), "tokens": C.protected_tokens(x)})
    return rows.select(
        "doc_id", "pos", F.round(score, 6).alias("z1"), F.round(C.disorder_score(x), 6).alias("z2"), F.array_join(F.array_sort(tokens), "|").alias("z3"),
        C.edit_allowed(x, T.tidy_spaces(x), tokens=tokens).alias("z4"), C.refine_route(x, score=score, tokens=tokens).alias("z5"),
    )

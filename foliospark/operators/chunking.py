"""Chunkers: 1 to N splits of texts as columns of arrays, and their expansion to rows.

The packers are folds over the pieces of one text, so they run inside the scan's stage and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import lines_of, looks_like_code
from ..functions.text import let, strip_text

MOST_CHARS = 400
OVERLAP = 60


def overlap_tail(text: str, n: int = OVERLAP) -> str:
    """SQL for the last n characters of a text from a word boundary on, or all n where there is none."""
    tail = f"right({text}, {n})"
    at = f"regexp_instr({tail}, '[ \\n\\t]')"
    return f"IF(length({text}) <= {n}, {text}, IF({at} > 0, trim(BOTH ' \\n\\t' FROM substr({tail}, {at})), trim(BOTH ' \\n\\t' FROM {tail})))"


def pack(most: int, overlap: str | None) -> str:
    """SQL of the greedy packing of __pieces, joined by blanks, into chunks of at most `most` characters; one longer piece is a chunk.

    overlap is SQL for what the next chunk begins with, made from `cur`, the chunk just closed.
    """
    carry = f"concat({overlap}, ' ', s)" if overlap else "s"
    return f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'cur', ''), (a, s) ->
        IF(length(a.cur) + length(s) + 1 > {most} AND a.cur <> '',
           named_struct('out', concat(a.out, array(trim(a.cur))), 'cur', {carry.replace('cur', 'a.cur')}),
           named_struct('out', a.out, 'cur', IF(a.cur = '', s, concat(a.cur, ' ', s)))),
        a -> IF(trim(a.cur) = '', a.out, concat(a.out, array(trim(a.cur)))))"""


def _packed(df: DataFrame, text: str, pieces: Column, most: int, overlap: str | None, to: str) -> DataFrame:
    rows = df.withColumn("__pieces", pieces)
    whole = F.array(F.col(text))
    folded = let(F.expr(pack(most, overlap)), lambda x: F.when(F.size(x) > 0, x).otherwise(whole))
    chosen = F.when(F.char_length(text) <= most, whole).otherwise(folded)
    return rows.withColumn(to, chosen).drop("__pieces")


def mapper_chunks(df: DataFrame, text: str = "text", most: int = MOST_CHARS, to: str = "chunks") -> DataFrame:
    """Sentences (split behind . ! ?) packed with the last 60 characters of the chunk before."""
    return _packed(df, text, F.split(text, r"(?<=[.!?])\s+", -1), most, f"right(cur, {OVERLAP})", to)


def sentence_chunks(df: DataFrame, text: str = "text", most: int = MOST_CHARS, overlap: int = OVERLAP, to: str = "chunks") -> DataFrame:
    """Sentences packed with an overlap from a word boundary; words where there are no sentences."""
    sentences = F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+", -1), lambda x: F.trim(x)), lambda x: x != "")
    return _packed(df, text, sentences, most, overlap_tail("cur", overlap), to)


def word_chunks(df: DataFrame, text: str = "text", most: int = MOST_CHARS, overlap: int = OVERLAP, to: str = "chunks") -> DataFrame:
    words = F.filter(F.split(text, r"\s+", -1), lambda x: x != "")
    return _packed(df, text, words, most, overlap_tail("cur", overlap), to)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '(?U)^\\\\s+|\\\\s+\\\\z', '')"


def line_chunks(df: DataFrame, text: str = "text", most: int = 1500, to: str = "chunks") -> DataFrame:
    """Lines packed whole and without overlap; a longer line is cut hard into parts of its own."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("t"), (F.char_length(x) > most).alias("hard")))
    parts = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.char_length(x["t"]) - 1) / most).cast("int")), lambda i: F.struct(F.substr(x["t"], i * most + 1, F.lit(most)).alias("t"), F.lit(True).alias("hard")))
    rows = df.withColumn("__pieces", F.flatten(F.transform(lines, lambda x: F.when(x["hard"], parts(x)).otherwise(F.array(x)))))
    closed = f"IF(a.cur IS NULL, a.out, concat(a.out, array({_strip('a.cur')})))"
    sql = f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'cur', cast(null AS string)), (a, s) ->
        CASE WHEN s.hard THEN named_struct('out', concat({closed}, array(IF(length(s.t) = {most}, regexp_replace(s.t, '(?U)\\\\s+\\\\z', ''), {_strip('s.t')}))), 'cur', cast(null AS string))
             WHEN a.cur IS NOT NULL AND length(a.cur) + length(s.t) + 1 > {most} THEN named_struct('out', {closed}, 'cur', s.t)
             ELSE named_struct('out', a.out, 'cur', IF(a.cur IS NULL, s.t, concat(a.cur, '\\n', s.t))) END,
        a -> filter({closed}, x -> x <> ''))"""
    return rows.withColumn(to, F.expr(sql)).drop("__pieces")


def code_chunks(df: DataFrame, text: str = "text", most: int = MOST_CHARS, overlap: int = 4, to: str = "chunks") -> DataFrame:
    """Lines packed whole, at least one to a chunk; a chunk begins with the last lines of the one before.

    Chunks of no more lines than the overlap are not repeated. Where the repeated lines leave no room for the next one they
    stand as a chunk by themselves.
    """
    rows = df.withColumn("__pieces", F.split(text, r"\r\n|[\n\r]", -1))
    joined = "regexp_replace(array_join({}, '\\n'), '^\\\\n+|\\\\n+\\\\z', '')"
    tail = f"IF(size(a.win) > {overlap}, slice(a.win, -{overlap}, {overlap}), cast(array() AS array<string>))"
    fits = f"length(array_join({{}}, '\\n')) + length(s) + 1 <= {most}"
    sql = f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'win', cast(array() AS array<string>)), (a, s) ->
        CASE WHEN size(a.win) = 0 OR {fits.format('a.win')} THEN named_struct('out', a.out, 'win', concat(a.win, array(s)))
             WHEN size(a.win) <= {overlap} OR {fits.format(tail)} THEN named_struct('out', concat(a.out, array({joined.format('a.win')})), 'win', concat({tail}, array(s)))
             ELSE named_struct('out', concat(a.out, array({joined.format('a.win')}, {joined.format(tail)})), 'win', array(s)) END,
        a -> filter(IF(size(a.win) = 0, a.out, concat(a.out, array({joined.format('a.win')}))), x -> trim(x) <> ''))"""
    return rows.withColumn(to, F.expr(sql)).drop("__pieces")


def mixed_chunks(df: DataFrame, text: str = "text", most: int = MOST_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """A row for each chunk of prose or code: the columns but text, part, chunk and kind (code or paragraph).

    Blocks set apart by blank lines that are of one kind and follow each other are one. Code is cut by lines, prose by sentences.
    """
    keys = [x for x in df.columns if x != text]
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.when(x.rlike(r"(?U)\S"), x).otherwise(F.lit("")))
    blocks = F.filter(F.split(F.array_join(lines, "\n"), r"\n{2,}", -1), lambda x: x.rlike(r"(?U)\S"))
    rows = df.withColumn("__b", F.transform(F.transform(blocks, lambda x: F.regexp_replace(x, r"^\n+|\n+\z", "")), lambda x: F.struct(x.alias("t"), looks_like_code(x).alias("code"))))
    merged = F.expr(
        """aggregate(__b, cast(array() AS array<struct<t: string, code: boolean>>), (a, s) -> IF(size(a) > 0 AND element_at(a, -1).code = s.code,
            concat(slice(a, 1, size(a) - 1), array(named_struct('t', concat(element_at(a, -1).t, '\\n\\n', s.t), 'code', s.code))), concat(a, array(s))))"""
    )
    none = F.array(F.struct(F.col(text).alias("t"), F.lit(False).alias("code")))
    rows = rows.select(*keys, F.posexplode(F.when(F.size("__b") > 0, merged).otherwise(none)).alias("__at", "__m")).select(*keys, "__at", F.col("__m.t").alias("__t"), F.col("__m.code").alias("__code"))
    prose = sentence_chunks(rows.filter("NOT __code"), "__t", most, overlap, "__c")
    code = code_chunks(rows.filter("__code"), "__t", most, to="__c").withColumn("__c", F.when(F.char_length("__t") <= most, F.array("__t")).otherwise(F.col("__c")))
    both = prose.unionByName(code).select(*keys, "__at", "__code", F.posexplode("__c").alias("__in", "chunk"))
    order = Window.partitionBy(*keys).orderBy("__at", "__in")
    return both.select(*keys, (F.row_number().over(order) - 1).alias("part"), "chunk", F.when(F.col("__code"), "code").otherwise("paragraph").alias("kind"))


def break_point(rest: str, most: int) -> str:
    """SQL of a struct (cut, skip): how much of a text over `most` characters is the next part, and how much behind it goes.

    The last blank line within reach counts, else the last line end, else the last sentence mark, each only if a fifth of
    `most` lies before it; else the cut is hard. A cut within a word moves back to the last blank.
    """
    least = most // 5

    def last(mark: str, size: int, reach: int) -> str:
        head = f"left({rest}, {reach})"
        return f"IF(instr({head}, {mark}) > 0, length({head}) - length(substring_index({head}, {mark}, -1)) - {size}, -1)"

    blank, line = last("concat(chr(10), chr(10))", 2, most + 2), last("chr(10)", 1, most + 1)
    marked = f"length(regexp_extract(left({rest}, {most + 1}), '(?s)^(.*[.?!])', 1))"
    first = f"""CASE WHEN {blank} >= {least} THEN named_struct('cut', {blank}, 'skip', 2) WHEN {line} >= {least} THEN named_struct('cut', {line}, 'skip', 1)
        WHEN {marked} >= {least} THEN named_struct('cut', least({marked}, {most}), 'skip', 0) ELSE named_struct('cut', {most}, 'skip', 0) END"""
    space = f"(length(left({rest}, c.cut)) - length(substring_index(left({rest}, c.cut), ' ', -1)) - 1)"
    within = f"substr({rest}, c.cut, 2) RLIKE '^\\\\p{{L}}{{2}}' AND instr(left({rest}, c.cut), ' ') > 0 AND {space} > {least}"
    return f"transform(array({first}), c -> IF({within}, named_struct('cut', {space}, 'skip', 1), c))[0]"


def paragraph_chunks(df: DataFrame, text: str = "text", most: int = 1500, to: str = "chunks") -> DataFrame:
    """Texts over `most` characters cut at blank lines, line ends, sentence ends or blanks, in this order of choice, without overlap."""
    rows = df.withColumn("__rest", strip_text(F.col(text)))
    step = f"""transform(array({break_point('a.rest', most)}), b -> transform(array({_strip('left(a.rest, b.cut)')}), h -> IF(h = '',
        named_struct('out', concat(a.out, array({_strip(f'left(a.rest, {most})')})), 'rest', {_strip(f'substr(a.rest, {most} + 1)')}),
        named_struct('out', concat(a.out, array(h)), 'rest', {_strip('substr(a.rest, b.cut + b.skip + 1)')})))[0])[0]"""
    sql = f"""aggregate(sequence(1, 2 + cast(5 * length(__rest) / {most} AS int)), named_struct('out', cast(array() AS array<string>), 'rest', __rest), (a, i) ->
        CASE WHEN a.rest = '' THEN a WHEN length(a.rest) <= {most} THEN named_struct('out', concat(a.out, array(a.rest)), 'rest', '') ELSE {step} END, a -> filter(a.out, x -> x <> ''))"""
    return rows.withColumn(to, F.when(F.char_length(text) <= most, F.array(F.col(text))).otherwise(F.expr(sql))).drop("__rest")


def index_chunks(df: DataFrame, text: str = "text", most: int = 1200, tail: int = 200, to: str = "chunks") -> DataFrame:
    """Of texts over the limit the lines that are not blank, packed whole; a last chunk under `tail` characters goes back to the one before."""
    rows = df.withColumn("__pieces", lines_of(F.col(text)))
    sql = f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'cur', cast(null AS string)), (a, s) ->
        IF(a.cur IS NOT NULL AND length(a.cur) + length(s) + 1 > {most}, named_struct('out', concat(a.out, array(a.cur)), 'cur', s),
           named_struct('out', a.out, 'cur', IF(a.cur IS NULL, s, concat(a.cur, '\\n', s)))),
        a -> IF(a.cur IS NULL, a.out, concat(a.out, array(a.cur))))"""
    rows = rows.withColumn("__c", F.transform(F.expr(sql), strip_text))
    last, n = F.element_at("__c", -1), F.size("__c")
    merged = F.concat(F.slice("__c", F.lit(1), F.greatest(n - 2, F.lit(0))), F.array(strip_text(F.concat(F.element_at("__c", -2), F.lit("\n"), last))))
    packed = F.when((n > 1) & (F.char_length(last) < tail), merged).when(n > 0, F.col("__c")).otherwise(F.array(F.col(text)))
    return rows.withColumn(to, F.when(F.char_length(text) <= most, F.array(F.col(text))).otherwise(packed)).drop("__pieces", "__c")


def token_chunks(df: DataFrame, text: str = "text", most_tokens: int = 512, overlap: int = OVERLAP, to: str = "chunks") -> DataFrame:
    """Texts over the limit (a token is four characters) in sentences, each chunk with the end of the one before.

    A sentence over the limit that begins a chunk is cut by words, 50 characters below the limit.
    """
    words = f"""aggregate(filter(split(s, '(?U)\\\\s+', -1), w -> w <> ''), named_struct('out', cast(array() AS array<string>), 'cur', ''), (f, w) ->
        CASE WHEN length(f.cur) + length(w) + IF(f.cur = '', 0, 1) <= {4 * most_tokens - 50} THEN named_struct('out', f.out, 'cur', IF(f.cur = '', w, concat(f.cur, ' ', w)))
             WHEN f.cur = '' THEN named_struct('out', f.out, 'cur', w)
             ELSE named_struct('out', concat(f.out, array({_strip('f.cur')})), 'cur', concat(IF(length(f.cur) > {overlap}, right(f.cur, {overlap}), ''), ' ', w)) END)"""
    sql = f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'cur', ''), (a, s) ->
        CASE WHEN (length(a.cur) + length(s) + IF(a.cur = '', 0, 1)) DIV 4 <= {most_tokens} THEN named_struct('out', a.out, 'cur', IF(a.cur = '', s, concat(a.cur, ' ', s)))
             WHEN a.cur <> '' THEN named_struct('out', concat(a.out, array({_strip('a.cur')})), 'cur', concat(right(a.cur, {overlap}), ' ', s))
             ELSE transform(array({words}), f -> named_struct('out', concat(a.out, f.out), 'cur', f.cur))[0] END,
        a -> IF({_strip('a.cur')} = '', a.out, concat(a.out, array({_strip('a.cur')}))))"""
    rows = df.withColumn("__pieces", F.split(text, r"(?U)(?<=[.!?])\s+", -1))
    return rows.withColumn(to, F.when(F.floor(F.char_length(text) / 4) <= most_tokens, F.array(F.col(text))).otherwise(F.expr(sql))).drop("__pieces")


def token_code_chunks(df: DataFrame, text: str = "text", most_tokens: int = 512, overlap: int = 5, to: str = "chunks") -> DataFrame:
    """Code over the limit in whole lines, each chunk with the last lines of the one before."""
    sql = f"""aggregate(__pieces, named_struct('out', cast(array() AS array<string>), 'win', cast(array() AS array<string>)), (a, s) ->
        IF(size(a.win) = 0 OR (length(array_join(a.win, '\\n')) + 1 + length(s)) DIV 4 <= {most_tokens}, named_struct('out', a.out, 'win', concat(a.win, array(s))),
           named_struct('out', concat(a.out, array({_strip("array_join(a.win, chr(10))")})), 'win', concat(slice(a.win, -least({overlap}, size(a.win)), {overlap}), array(s)))),
        a -> filter(concat(a.out, array({_strip("array_join(a.win, chr(10))")})), x -> x <> ''))"""
    rows = df.withColumn("__pieces", F.split(text, "\n", -1))
    return rows.withColumn(to, F.when(F.floor(F.char_length(text) / 4) <= most_tokens, F.array(F.col(text))).otherwise(F.expr(sql))).drop("__pieces")


def sentences(text: Column) -> Column:
    """Sentences without their marks; line ends count as sentence ends."""
    return F.filter(F.transform(F.split(F.replace(text, F.lit("\n"), F.lit(" . ")), r"[.!?]\s+", -1), lambda x: F.trim(x)), lambda x: x != "")


def overlap_size(base: Column, next_chars: Column) -> Column:
    return F.least(base, F.floor(next_chars * 0.25).cast("int"))


def expand(df: DataFrame, chunks: str = "chunks", suffix: str = "o", name: str = "Oversize Split", keep_first: bool = True) -> DataFrame:
    """A row for each chunk of a split one (chunk_id, breadcrumb, level and chunks); content that was not split stays a row.

    The parts get the suffix and their number, [name i/n] in the breadcrumb and the next level; the first part keeps its row
    as it is if keep_first.
    """
    rows = df.select("*", F.size(chunks).alias("__n"), F.posexplode(chunks).alias("__at", "__part"))
    number = F.col("__at") + 1
    marked = (F.col("__n") > 1) & ((F.col("__at") > 0) | F.lit(not keep_first))
    step = F.concat(F.lit(f"[{name} "), number.cast("string"), F.lit("/"), F.col("__n").cast("string"), F.lit("]"))
    return rows.withColumns(
        {
            "chunk_id": F.when(marked, F.concat("chunk_id", F.lit(f"_{suffix}"), number.cast("string"))).otherwise(F.col("chunk_id")),
            "breadcrumb": F.when(marked, F.concat(F.coalesce("breadcrumb", F.array().cast("array<string>")), F.array(step))).otherwise(F.col("breadcrumb")),
            "level": F.when(marked, F.coalesce("level", F.lit(2)) + 1).otherwise(F.col("level")),
            "content": F.col("__part"),
        }
    ).drop("__n", "__at", "__part", chunks)


def break_oversize(df: DataFrame, most: int = 1500) -> DataFrame:
    """Chunks of text (chunk_id, modality, chunk_type, content, breadcrumb, level) with those over `most` characters in parts: code by lines, prose by paragraphs."""
    text = df.filter((F.col("modality") == "text") & (F.char_length("content") > most))
    other = df.filter(~F.coalesce((F.col("modality") == "text") & (F.char_length("content") > most), F.lit(False)))
    code = F.coalesce(F.col("chunk_type") == "code", F.lit(False))
    cut = line_chunks(text.filter(code), "content", most, "__parts").unionByName(paragraph_chunks(text.filter(~code), "content", most, "__parts"))
    return other.unionByName(expand(cut, "__parts"))

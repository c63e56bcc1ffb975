"""Rules of single rows, by hand-made cases."""

import uuid

import pytest
from foliospark.functions import classify as C
from foliospark.functions import geometry as G
from foliospark.functions import ids as I
from foliospark.functions import predicates as P
from foliospark.functions import text as T
from foliospark.sources import readers as S
from pyspark.sql import functions as F


def one(spark, f, *values):
    """The value of an expression over literals."""
    return spark.range(1).select(f(*(F.lit(v) for v in values)).alias("x")).first()["x"]


CASES = [
    (T.separate_controls, ("Hybrid vehicle\x01Storage",), "Hybrid vehicle; Storage"),
    (T.separate_controls, ("x = 1\x012",), "x = 1 2"),
    (T.collapse_replacements, ("a � � b",), "a b"),
    (T.drop_controls, ("a\x08b\tc\nd\x7f",), "ab\tc\nd"),
    (T.map_private_use, (" ab",), "• a b"),
    (T.repair_numbers, ("3 . 14 and 5 GHz",), "3.14 and 5GHz"),
    (T.repair_numbers, ("± 5 of 10 % and 1 2 3",), "±5 of 10% and 1 2 3"),
    (T.drop_page_number_lines, ("Some text here\n171\nmore text here",), "Some text here\nmore text here"),
    (T.drop_page_number_lines, ("a\n1\nb",), "a\n1\nb"),
    (T.drop_digit_lines, ("a\n 12 \nb",), "a\nb"),
    (T.join_hyphenation, ("multi-\nstep and soft\xad\nly",), "multi-step and softly"),
    (T.drop_infix_numbers, ("this set from 2. brownells is",), "this set from brownells is"),
    (T.drop_infix_numbers, ("chapter 3. Note",), "chapter 3. Note"),
    (T.break_infix_steps, ("turn it 7. open the lid",), "turn it\n7. open the lid"),
    (T.break_infix_steps, ("from 3. to",), "from 3. to"),
    (T.strip_cell_marks, ("a, 1 = x, 2 = y, 3 = z",), "a x y z"),
    (T.tidy_spaces, ("a  b , c  \nd",), "a b, c\nd"),
    (T.truncate_heading, ("x" * 120,), "x" * 97 + "..."),
    (T.section_name, ("3.2 SOME PART",), "Some Part"),
    (T.strip_fences, ("```md\n| a |\n```",), "| a |"),
    (T.table_markdown, ("a\tb\nc",), "| a | b |\n| --- | --- |\n| c |  |"),
    (T.table_markdown, ("only words",), "| Content |\n| --- |\n| only words |"),
    (P.is_heading, ("Getting Started",), True),
    (P.is_heading, ("Figure 3 A caption",), False),
    (P.is_heading, ("This is a full sentence that ends.",), False),
    (P.is_heading, ("buy buy buy",), False),
    (P.is_heading, ("Name: Value",), False),
    (P.is_heading, ("x",), False),
    (P.is_corrupt, ("�" * 6 + "a" * 94,), True),
    (P.is_corrupt, ("�" * 4 + "a" * 96,), False),
    (P.is_corrupt, ("CCCCCCCCCC",), True),
    (P.repeats_first_token, ("ab ab ab ab ab c",), True),
    (P.repeats_first_token, ("ab ab ab ab c",), False),
    (P.is_noise, ("· · ·",), True),
    (P.is_noise, ("page 12",), True),
    (P.is_noise, ("word",), False),
    (P.looks_like_code, (">>> x = 1",), True),
    (P.is_label, ("Spare Parts",), True),
    (P.blank_page, ("This page intentionally left blank",), True),
    (P.keyword_of, ("what does Catalyst do in the engine",), "Catalyst"),
    (C.tokens_stripped, ("0123456789",), 3),
    (C.tokens_stripped, ("  ",), 0),
    (C.tokens_plain, ("",), 1),
    (P.is_label, ("Reassembly Tips:",), True),
    (P.is_label, ("Origin: United States",), False),
    (P.is_advertisement, ("Hurry and subscribe",), True),
    (P.is_advertisement, ("a calm and plain text",), False),
    (P.has_artifacts, ("/uniFB01 x",), True),
    (P.has_artifacts, (r"\xC3 x",), False),
    (P.blank_page, ("Page left blank",), False),
    (P.looks_like_code, ("one\n    two",), True),
    (P.looks_like_code, ("from here to there",), True),
    (P.looks_like_code, ("plain words\nmore words",), False),
    (C.edit_allowed, ("part ABC-123 is ok", "part ABC-124 is ok"), False),
    (C.edit_allowed, ("a  part", "a part"), True),
    (C.corruption_score, ("clean words only",), 0.0),
    (S.html_text, ("<title>T</title><script>var x='</p>';</script><p>a &amp; b<br>c</p>",), "T\na & b\nc"),
]


@pytest.mark.parametrize("f,values,want", CASES, ids=lambda v: getattr(v, "__name__", None))
def test_cases(spark, f, values, want):
    assert one(spark, f, *values) == want


@pytest.mark.parametrize("f", [c[0] for c in CASES if len(c[1]) == 1], ids=lambda f: f.__name__)
def test_null_and_empty_do_not_fail(spark, f):
    rows = spark.createDataFrame([(None,), ("",), ("x" * 50_000,)], "t string")
    assert len(rows.select(f(F.col("t")).alias("x")).collect()) == 3


def test_boxes(spark):
    box = lambda f, *v: one(spark, f, *v)
    assert box(G.normalise, [0, 0, 306, 396], 612.0, 792.0) == [0, 0, 500, 500]
    assert box(G.widen, [5, 9, 5, 3]) == [5, 3, 6, 9]
    assert box(G.ensure_normalised, [0.1, 0.2, 0.5, 0.9], 0.0, 0.0) == [100, 200, 500, 900]
    assert box(G.iou, [0, 0, 10, 10], [20, 20, 30, 30]) == 0.0
    assert box(G.is_full_page, [0, 0, 1000, 990]) is True


def test_ids(spark):
    assert one(spark, I.point_id, "doc#1") == str(uuid.uuid5(uuid.UUID(I.POINT_NAMESPACE), "doc#1"))
    assert one(spark, I.chunk_id, "d", 1003, "text", 4, "c").startswith("d_1003_text_")


def test_context(spark):
    path = F.array(F.lit("A"), F.lit("B"))
    none = F.lit(None).cast("string")
    row = spark.range(1).select(T.contextual_text(F.lit("x"), path, F.lit("H"), none, F.lit(" "), F.lit("image")).alias("x")).first()
    assert row.x == "[Context: A > B]\n[Heading: H]\n[Modality: image]\nx"

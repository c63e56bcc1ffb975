"""Bounding boxes [left, top, right, bottom] in whole units of a 0 to 1000 grid, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 1000
#: Page size where none is known, in points.
DEFAULT_PAGE = (612.0, 792.0)
FULL_PAGE_SHARE = 0.95


def _at(box: Column, k: int) -> Column:
    return F.get(box, k)


def widen(box: Column) -> Column:
    """Orders the ends of each side, clamps them to the grid and keeps an extent of one unit at least."""
    ends = []
    for low, high in ((0, 2), (1, 3)):
        a, b = F.least(_at(box, low), _at(box, high)), F.greatest(_at(box, low), _at(box, high))
        a, b = F.greatest(F.lit(0), F.least(F.lit(GRID), a)), F.greatest(F.lit(0), F.least(F.lit(GRID), b))
        a = F.when((a == b) & (b >= GRID), a - 1).otherwise(a)
        ends.append((a, F.when(b <= a, a + 1).otherwise(b)))
    return F.array(ends[0][0], ends[1][0], ends[0][1], ends[1][1]).cast("array<int>")


def normalise(box: Column, width: Column, height: Column) -> Column:
    """From page units to the grid, rounded half to even; unknown page sizes count as the default page."""
    w = F.when(width > 0, width.cast("double")).otherwise(DEFAULT_PAGE[0])
    h = F.when(height > 0, height.cast("double")).otherwise(DEFAULT_PAGE[1])
    scaled = [F.bround(_at(box, k) / (w if k % 2 == 0 else h) * GRID).cast("int") for k in range(4)]
    return widen(F.array(*scaled))


def is_normalised(box: Column) -> Column:
    whole = F.forall(box, lambda x: (x == F.floor(x)) & (x >= 0) & (x <= GRID))
    return (F.size(box) == 4) & whole & (_at(box, 2) > _at(box, 0)) & (_at(box, 3) > _at(box, 1))


def ensure_normalised(box: Column, width: Column, height: Column) -> Column:
    """Boxes on the grid stay; those within 0 to 1 are scaled; others are in page units."""
    unit = F.forall(box, lambda x: (x >= 0) & (x <= 1))
    grid = F.forall(box, lambda x: (x == F.floor(x)) & (x >= 0) & (x <= GRID))
    scaled = widen(F.transform(box, lambda x: F.bround(x * GRID).cast("int")))
    return F.when(unit & ~F.forall(box, lambda x: x == 0), scaled).when(grid, widen(box)).otherwise(normalise(box, width, height))


def denormalise(box: Column, width: Column, height: Column) -> Column:
    return F.transform(box, lambda x, i: x / GRID * F.when(i % 2 == 0, width).otherwise(height))


def area(box: Column) -> Column:
    return (_at(box, 2) - _at(box, 0)) * (_at(box, 3) - _at(box, 1))


def area_share(box: Column) -> Column:
    return area(box) / float(GRID * GRID)


def is_full_page(box: Column) -> Column:
    return area_share(box) > FULL_PAGE_SHARE


def intersection(a: Column, b: Column) -> Column:
    w = F.least(_at(a, 2), _at(b, 2)) - F.greatest(_at(a, 0), _at(b, 0))
    h = F.least(_at(a, 3), _at(b, 3)) - F.greatest(_at(a, 1), _at(b, 1))
    return F.when((w > 0) & (h > 0), w * h).otherwise(0)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for boxes apart."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when((both > 0) & (union > 0), both / union.cast("double")).otherwise(0.0)


def overlap_shares(a: Column, b: Column) -> Column:
    """The share of each box that the other one covers."""
    both = intersection(a, b)
    part = lambda x: F.when(area(x) > 0, both / area(x).cast("double")).otherwise(0.0)
    return F.struct(part(a).alias("of_a"), part(b).alias("of_b"))


def union_box(a: Column, b: Column) -> Column:
    return F.array(F.least(_at(a, 0), _at(b, 0)), F.least(_at(a, 1), _at(b, 1)), F.greatest(_at(a, 2), _at(b, 2)), F.greatest(_at(a, 3), _at(b, 3)))


def page_sizes(chunks, pages):
    """Chunks with page sizes filled in from a table of pages that is small: one row a page of the documents at hand."""
    sizes = pages.select("doc_id", "page_number", F.col("width").alias("__w"), F.col("height").alias("__h"))
    joined = chunks.join(sizes, ["doc_id", "page_number"], "left")
    filled = {"page_width": F.coalesce("page_width", "__w"), "page_height": F.coalesce("page_height", "__h")}
    return joined.withColumns(filled).drop("__w", "__h")

"""Tiny chunks of a page go to their neighbours.

What a row becomes depends on what the rows before it became, so a page's rows are settled one after another; a page is one
group, and a group is as large as a page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import LABELS

#: Chunks of fewer characters are tiny; items of a list run are at most so long, and a run has so many of them.
TINY, ITEM_CHARS, RUN_LEAST, RUN_MOST = 30, 90, 3, 8
_SHAPE = re.compile(LABELS["manual"])


def label_like(text: str) -> bool:
    """As predicates.is_label, for one text."""
    text = text.strip()
    if not 0 < len(text) <= 60 or "\n" in text or re.fullmatch(r"\d{1,4}", text) or not _SHAPE.search(text):
        return False
    words = text.split()
    return text.endswith(":") or (":" not in text and len(words) <= 6 and not any(w.endswith((".", "?", "!")) for w in words))


@dataclass
class _Row:
    pos: int
    kind: str  # code, list_item, marker (stands for a page that goes on, and is left alone) or anything else
    text: str

    def is_prose(self) -> bool:
        return self.kind != "code" and bool(self.text.strip())

    def is_item(self) -> bool:
        return self.kind == "list_item" and 0 < len(self.text.strip()) <= ITEM_CHARS


def settled(rows: list[_Row], tiny: int = TINY) -> list[_Row]:
    """The rows of a page in order: labels go before code, else behind the text above; short list items in runs are one; other
    tiny texts go before the next text, else behind the one above. A page of labels alone loses them."""
    has_body = any(r.kind != "code" and len(r.text.strip()) >= 20 and not label_like(r.text) for r in rows)
    out: list[_Row] = []
    at = 0
    while at < len(rows):
        row, after = rows[at], rows[at + 1] if at + 1 < len(rows) else None
        above = out[-1] if out and out[-1].is_prose() else None
        text = row.text.strip()
        step, stays = 1, True
        if row.kind not in ("code", "marker") and text:
            label = label_like(text)
            run = list(takewhile(_Row.is_item, rows[at : at + RUN_MOST]))
            if label and after and after.kind == "code" and after.text.strip():
                after.text, stays = f"{text}\n{after.text.lstrip()}".strip(), False
            elif len(run) >= RUN_LEAST:
                row.text, step = "\n".join(r.text.strip() for r in run), len(run)
            elif label and above:
                above.text, stays = f"{above.text.rstrip()}\n{text}".strip(), False
            elif label:
                stays = has_body
            elif len(text) < tiny and after and after.is_prose() and after.kind != "marker":
                after.text, stays = f"{text} {after.text.lstrip()}".strip(), False
            elif len(text) < tiny and above and above.kind != "marker":
                above.text, stays = f"{above.text.rstrip()} {text}".strip(), False
        if stays:
            out.append(row)
        at += step
    return out


def merge_tiny(chunks: DataFrame, tiny: int = TINY) -> DataFrame:
    """doc_id, page_number, pos, kind and content of the settled chunks of text (doc_id, page_number, pos, kind, content); order is by pos."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "page_number", "pos", "kind", "content"]
        for frame in frames:
            found = []
            for doc, page, places, kinds, texts in frame.itertuples(index=False, name=None):
                rows = [_Row(int(p), k or "", t or "") for p, k, t in zip(places, kinds, texts, strict=True)]
                found += [(doc, page, r.pos, r.kind, r.text) for r in settled(rows, tiny)]
            yield pd.DataFrame(found, columns=names, dtype=object)

    rows = chunks.select(F.col("doc_id").cast("long"), F.col("page_number").cast("int"), F.col("pos").cast("long"), "kind", "content").filter("doc_id IS NOT NULL AND page_number IS NOT NULL")
    # a batch holds many pages, as a call for each page costs more than its rows
    pages = rows.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("pos", "kind", "content"))).alias("r"))
    return pages.select("doc_id", "page_number", "r.pos", "r.kind", "r.content").mapInPandas(run, "doc_id long, page_number int, pos long, kind string, content string")

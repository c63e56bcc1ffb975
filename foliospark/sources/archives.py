"""Documents that are ZIP archives of XML: books by spine, and office files by paragraph, slide and sheet.

Each file is one row of `readers.files` (path, content); a task parses one file at a time and yields blocks by the thousand, so
what a task holds is one file and these.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

#: Elements whose text is not read, and those that end a line (fixed values).
SILENT = {"script", "style", "svg", "noscript", "head"}
BLOCKS = {"p", "div", "li", "ul", "ol", "table", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header", "footer", "nav", "br", "title", "blockquote", "pre", "figure", "figcaption", "body"}

#: Blocks after which a task hands on what it has; a table for each file costs more than its blocks.
ROWS_AT_ONCE = 1000
BLOCK_SCHEMA = "path string, part int, pos int, name string, kind string, level int, text string"


class _Blocks(HTMLParser):
    """Collects (kind, level, text) of the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int | None, str]] = []
        self.silent, self.parts, self.tag = 0, [], "p"

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            heading = re.fullmatch(r"h([1-6])", self.tag)
            kind = "heading" if heading else "list_item" if self.tag == "li" else "paragraph"
            self.found.append((kind, int(heading[1]) if heading else None, text))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag in BLOCKS:
            self.end_block()
            self.tag = tag

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCKS:
            self.end_block()
            self.tag = "p"

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def html_blocks(html: str) -> list[tuple[str, int | None, str]]:
    """kind, level and text of each block of a page in order, without scripts, styles and drawings."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.found


def _local(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _attribute(element, name: str) -> str | None:
    return next((v for k, v in element.attrib.items() if k.rsplit("}", 1)[-1] == name), None)


def _xml(archive: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(archive.read(name))


def spine(archive: zipfile.ZipFile) -> list[str]:
    """The names of a book's content files in reading order."""
    package = next(_attribute(e, "full-path") for e in _xml(archive, "META-INF/container.xml").iter() if _local(e) == "rootfile")
    root = _xml(archive, package)
    items = {_attribute(e, "id"): _attribute(e, "href") for e in root.iter() if _local(e) == "item"}
    base = posixpath.dirname(package)
    order = [items.get(_attribute(e, "idref")) for e in root.iter() if _local(e) == "itemref"]
    return [posixpath.normpath(posixpath.join(base, unquote(href))) for href in order if href]


def book_blocks(data: bytes) -> Iterator[tuple]:
    """part (the chapter, from 1), pos, name, kind, level and text of each block; a chapter without text has one blank block."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        known = set(archive.namelist())
        for chapter, name in enumerate((n for n in spine(archive) if n in known), 1):
            blocks = html_blocks(archive.read(name).decode("utf-8", "replace"))
            for pos, (kind, level, text) in enumerate(blocks or [("blank", None, "")]):
                yield chapter, pos, name, kind, level, text


def _text_of(element, wanted: str = "t") -> str:
    return "".join("\t" if _local(e) == "tab" else e.text or "" for e in element.iter() if _local(e) in (wanted, "tab"))


def _row(cells: list[str]) -> str:
    return "| " + " | ".join(" ".join(c.split()) for c in cells) + " |"


def _grid(rows: list[list[str]]) -> str:
    """A markdown table; short rows are filled up."""
    width = max(map(len, rows))
    full = [r + [""] * (width - len(r)) for r in rows]
    return "\n".join([_row(full[0]), "| " + " | ".join(["---"] * width) + " |", *map(_row, full[1:])])


def text_document_blocks(data: bytes) -> Iterator[tuple]:
    """Paragraphs and tables of a word processor's file; a heading's level is that of its style."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        body = next(e for e in _xml(archive, "word/document.xml").iter() if _local(e) == "body")
        pos = 0
        for element in body:
            kind, level, text = "paragraph", None, ""
            if _local(element) == "tbl":
                rows = [[_text_of(c) for c in r if _local(c) == "tc"] for r in element if _local(r) == "tr"]
                rows = [r for r in rows if r]
                kind, text = "table", _grid(rows) if rows else ""
            elif _local(element) == "p":
                text = _text_of(element).strip()
                style = next((_attribute(e, "val") or "" for e in element.iter() if _local(e) == "pStyle"), "")
                found = re.fullmatch(r"(?i)heading\s*([1-9])|(title)", style)
                if found:
                    kind, level = "heading", int(found[1] or 1)
                elif any(_local(e) == "numPr" for e in element.iter()):
                    kind = "list_item"
            if text:
                yield 1, pos, "word/document.xml", kind, level, text
                pos += 1


def _numbered(archive: zipfile.ZipFile, pattern: str) -> list[tuple[int, str]]:
    return sorted((int(m[1]), n) for n in archive.namelist() if (m := re.fullmatch(pattern, n)))


def slide_blocks(data: bytes) -> Iterator[tuple]:
    """Paragraphs of each slide, the part being its number, and then those of its notes."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        notes = dict(_numbered(archive, r"ppt/notesSlides/notesSlide(\d+)\.xml"))
        for number, name in _numbered(archive, r"ppt/slides/slide(\d+)\.xml"):
            pos = 0
            for source, kind in ((name, "paragraph"), (notes.get(number), "note")):
                for paragraph in (e for e in _xml(archive, source).iter() if _local(e) == "p") if source else ():
                    text = _text_of(paragraph).strip()
                    if text:
                        yield number, pos, source, kind, None, text
                        pos += 1


def _column(reference: str) -> int:
    found = 0
    for c in re.match("[A-Z]*", reference)[0]:
        found = found * 26 + ord(c) - 64
    return found - 1


def sheet_blocks(data: bytes) -> Iterator[tuple]:
    """A markdown table for each sheet that has cells; formulas count by their stored values."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        shared = [_text_of(e) for e in _xml(archive, "xl/sharedStrings.xml") if _local(e) == "si"] if "xl/sharedStrings.xml" in archive.namelist() else []
        for number, name in _numbered(archive, r"xl/worksheets/sheet(\d+)\.xml"):
            rows = []
            for row in (e for e in _xml(archive, name).iter() if _local(e) == "row"):
                cells: list[str] = []
                for cell in (e for e in row if _local(e) == "c"):
                    value = next((e.text or "" for e in cell if _local(e) == "v"), None)
                    kind = cell.attrib.get("t")
                    text = shared[int(value)] if kind == "s" and value else _text_of(cell) if kind == "inlineStr" else value or ""
                    at = _column(cell.attrib.get("r", "")) if cell.attrib.get("r") else len(cells)
                    cells += [""] * (at + 1 - len(cells))
                    cells[at] = text
                if any(cells):
                    rows.append(cells)
            if rows:
                yield number, 0, name, "table", None, _grid(rows)


PARSERS: dict[str, Callable[[bytes], Iterator[tuple]]] = {"epub": book_blocks, "docx": text_document_blocks, "pptx": slide_blocks, "xlsx": sheet_blocks}


def archive_blocks(files: DataFrame, kind: str) -> DataFrame:
    """path, part, pos, name, kind, level and text of the blocks of files (path, content) of one format of PARSERS.

    A file that cannot be read gives one row of kind `error` with the reason as its text.
    """
    parse = PARSERS[kind]

    def table(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["path", "part", "pos", "name", "kind", "level", "text"]).astype({"level": "Int32"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                before = len(rows)
                try:
                    rows.extend((path, *block) for block in parse(bytes(content)))
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration, ValueError, TypeError) as why:
                    rows[before:] = [(path, 0, 0, None, "error", None, f"{type(why).__name__}: {why}")]
                if len(rows) >= ROWS_AT_ONCE:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)

    return files.select("path", "content").mapInPandas(run, BLOCK_SCHEMA)

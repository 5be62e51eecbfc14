"""HTML: title by expression; links, headings, text, table cells and blocks by one reading of a page in Arrow batches."""

from __future__ import annotations

from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.text import text_or_empty

_SILENT = {"script", "style", "template", "noscript"}
_HEADINGS = {"h1", "h2", "h3", "h4"}
_BLOCKS = {"article", "li", "tr", "h2", "h3", "h4", "p", "a"}


def title(html: Column) -> Column:
    """Text of the title element with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_extract(text_or_empty(html), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


class _Reader(HTMLParser):
    """Collects links, text nodes, table cells and blocks in one pass."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.silent = 0
        self.texts: list[str] = []
        self.links: list[tuple[str, list[str]]] = []
        self.open_links: list[int] = []
        self.tables: list[list[list[tuple[bool, list[str]]]]] = []
        self.open_tables: list[int] = []
        self.cell: list[str] | None = None
        self.blocks: list[tuple[str, list[str], list[str]]] = []
        self.open_blocks: list[tuple[str, int]] = []
        self.headings: list[tuple[str, list[str]]] = []
        self.in_heading = ""

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        href = dict(attrs).get("href")
        if tag == "a" and href is not None:
            self.links.append((href, []))
            self.open_links.append(len(self.links) - 1)
            for _, i in self.open_blocks:
                self.blocks[i][2].append(href)
        if tag in _BLOCKS:
            self.blocks.append((tag, [], [href] if tag == "a" and href else []))
            self.open_blocks.append((tag, len(self.blocks) - 1))
        if tag in _HEADINGS:
            self.headings.append((tag, []))
            self.in_heading = tag
        if tag == "table":
            self.tables.append([])
            self.open_tables.append(len(self.tables) - 1)
        elif tag == "tr" and self.open_tables:
            self.tables[self.open_tables[-1]].append([])
        elif tag in ("td", "th") and self.open_tables and self.tables[self.open_tables[-1]]:
            self.cell = []
            self.tables[self.open_tables[-1]][-1].append((tag == "th", self.cell))

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        if tag == "a" and self.open_links:
            self.open_links.pop()
        if tag == "table" and self.open_tables:
            self.open_tables.pop()
        if tag in ("td", "th"):
            self.cell = None
        if tag == self.in_heading:
            self.in_heading = ""
        if tag in _BLOCKS:
            for k in range(len(self.open_blocks) - 1, -1, -1):
                if self.open_blocks[k][0] == tag:
                    del self.open_blocks[k:]
                    break

    def handle_data(self, data):
        if self.silent or not data.strip():
            return
        self.texts.append(data)
        if self.in_heading:
            self.headings[-1][1].append(data)
        for i in self.open_links:
            self.links[i][1].append(data)
        if self.cell is not None:
            self.cell.append(data)
        for _, i in self.open_blocks:
            self.blocks[i][1].append(data)


def read(html: str) -> _Reader:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader


def _ws(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


#: What one reading of a page gives: name -> type, and how it is taken from the reader.
PARTS = {
    "links": ("array<struct<href:string,text:string>>", lambda r: [{"href": h, "text": _ws(t)} for h, t in r.links]),
    "headings": ("array<struct<tag:string,text:string>>", lambda r: [{"tag": tag, "text": _ws(t)} for tag, t in r.headings]),
    "cells": (
        "array<struct<table:int,row:int,cell:int,is_header:boolean,text:string>>",
        lambda r: [
            {"table": t, "row": i, "cell": j, "is_header": head, "text": _ws(text)}
            for t, rows in enumerate(r.tables) for i, row in enumerate(rows) for j, (head, text) in enumerate(row)
        ],
    ),
    "blocks": (
        "array<struct<pos:int,tag:string,text:string,href:string>>",
        lambda r: [{"pos": n, "tag": tag, "text": _ws(t), "href": h[0] if h else ""} for n, (tag, t, h) in enumerate(r.blocks)],
    ),
    "text": ("string", lambda r: "\n".join(x.strip() for x in r.texts)),
}


@lru_cache(maxsize=32)
def _parser(names: tuple[str, ...]):
    @F.pandas_udf(", ".join(f"{n} {PARTS[n][0]}" for n in names))
    def parse(html: pd.Series) -> pd.DataFrame:
        rows = [[PARTS[n][1](page) for n in names] for page in map(read, html)]
        return pd.DataFrame(rows, columns=list(names), dtype=object)

    return parse


def parts(html: Column, *names: str) -> Column:
    """A struct with the named :data:`PARTS` of a page, from one reading of it; a null page is an empty one.

    All that a plan needs of a page should be asked for at once: each distinct call is a parse of its own. Links,
    headings, cells and blocks are in document order; the text is the text nodes joined by line ends, without scripts,
    styles and comments; a block has the first link inside it, or its own.
    """
    return _parser(names)(text_or_empty(html))


def _each(df: DataFrame, key: str, html: str, part: str) -> DataFrame:
    # outer and then filtered: an inner generator would have the page parsed again by an inferred filter
    rows = df.select(key, parts(F.col(html), part)[part].alias("__part")).select(key, F.inline_outer("__part"))
    return rows.filter(F.col(rows.columns[1]).isNotNull())


def links(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, href, text)`` of every link, in document order."""
    return _each(df, key, html, "links")


def visible_text(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, text)``: text nodes joined by line ends, without scripts, styles and comments."""
    return df.select(key, parts(F.col(html), "text")["text"].alias("text"))


def table_cells(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, table, row, cell, is_header, text)`` of every table cell."""
    return _each(df, key, html, "cells")


def blocks(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, pos, tag, text, href)`` of block elements, with the first link inside (or their own)."""
    return _each(df, key, html, "blocks")


def first_heading(found: Column, *tags: str) -> Column:
    """Text of the first heading of one of ``tags`` in ``headings`` of :func:`parts`, else empty."""
    return F.coalesce(F.try_element_at(F.filter(found, lambda x: x["tag"].isin(*tags)), F.lit(1))["text"], F.lit(""))

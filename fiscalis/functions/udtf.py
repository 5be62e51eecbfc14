"""Table functions for SQL: text, links and table cells of a page, and the spans of a pattern in a text."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from fiscalis.sources.html import read


def _ws(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


class HtmlText:
    """``(text)``: the visible text of a page."""

    def eval(self, html: str):
        yield ("\n".join(x.strip() for x in read(html or "").texts),)


class HtmlLinks:
    """``(pos, href, text)`` of every link, in document order."""

    def eval(self, html: str):
        for i, (href, text) in enumerate(read(html or "").links):
            yield i, href, _ws(text)


class HtmlTableCells:
    """``(table_ix, row_ix, cell_ix, is_header, text)`` of every table cell."""

    def eval(self, html: str):
        for t, rows in enumerate(read(html or "").tables):
            for r, row in enumerate(rows):
                for c, (head, text) in enumerate(row):
                    yield t, r, c, head, _ws(text)


class EntitySpans:
    """``(start, found, around)`` of every match of a pattern, with ``radius`` characters around it in lower case."""

    def eval(self, text: str, pattern: str, radius: int):
        t = text or ""
        for m in re.finditer(pattern, t):
            yield m.start(), m[1] if m.re.groups else m[0], t[max(0, m.start() - radius) : m.end() + radius].lower()


TABLE_FUNCTIONS = {
    "html_text": (HtmlText, "text: string"),
    "html_links": (HtmlLinks, "pos: int, href: string, text: string"),
    "html_table_cells": (HtmlTableCells, "table_ix: int, row_ix: int, cell_ix: int, is_header: boolean, text: string"),
    "entity_spans": (EntitySpans, "start: int, found: string, around: string"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the table functions known to SQL: ``select * from pages, lateral html_links(html)``."""
    for name, (cls, schema) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, udtf(cls, returnType=schema))
    return sorted(TABLE_FUNCTIONS)

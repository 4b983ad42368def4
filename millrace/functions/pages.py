"""Records of catalogue pages. A page is parsed whole or not at all: one that can't be read gives one error row."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an error's text that are kept.
ERROR_CHARS = 1000
RECORDS = "page_id long, record string, ordinal long, label string, value string"
ROW = pa.struct([("section", pa.string()), ("label", pa.string()), ("cells", pa.list_(pa.string())), ("links", pa.list_(pa.string()))])
TABLES = "page_id long, title string, rows array<struct<section: string, label: string, cells: array<string>, links: array<string>>>, error string"
#: White space, but for the control separators, which make a page invalid.
BLANK = re.compile(r"[^\S\x1C-\x1F]+")
#: Pages of a task that parses them.
TASK_PAGES = 5000


class PageParser(HTMLParser):
    """Title, headings, links and paragraphs in page order."""

    KEPT = {"title": "title", "h1": "heading", "h2": "heading", "h3": "heading", "a": "link", "p": "paragraph"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.records: list[tuple[str, str | None, list[str]]] = []
        self.open: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self.handle_endtag("p")
        if tag in self.KEPT:
            text: list[str] = []
            self.records.append((self.KEPT[tag], dict(attrs).get("href") if tag == "a" else tag, text))
            self.open.append((tag, text))

    def handle_endtag(self, tag):
        if tag == "article":
            self.open = [o for o in self.open if o[0] != "p"]
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if self.open:
            self.open[-1][1].append(data)


def parse_page(html: str) -> list[tuple[str, int, str | None, str]]:
    parser = PageParser()
    parser.feed(html)
    parser.close()
    counts: dict[str, int] = {}
    out = []
    for record, label, text in parser.records:
        counts[record] = counts.get(record, 0) + 1
        out.append((record, counts[record], label, " ".join("".join(text).split())))
    if counts.get("title", 0) != 1:
        raise ValueError(f"{counts.get('title', 0)} titles")
    return out


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, record, ordinal, label, value; record is ``error`` for a page that can't be parsed, and then its only row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                try:
                    if html is None:
                        raise ValueError("no html")
                    rows += [(page_id, *r) for r in parse_page(html)]
                except Exception as e:  # any page may be broken in any way; the row says how
                    rows.append((page_id, "error", 1, type(e).__name__, str(e)[:ERROR_CHARS]))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "record", "ordinal", "label", "value"])

    return pages.select("page_id", "html").mapInArrow(run, RECORDS)


def lineage_links(records: DataFrame) -> DataFrame:
    """page_id, ordinal and target of the links that stay on the site."""
    return records.where("record = 'link' AND label LIKE '/%'").select("page_id", "ordinal", F.substring("label", 2, 1 << 20).alias("target"))


class TableParser(HTMLParser):
    """The title and the table rows of a page: heading above, label (``th``), cells (``td``) and where each cell's last link
    leads; ``br`` is a new line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.section = ""
        self.rows: list[dict] = []
        self.tag: str | None = None
        self.link: str | None = None
        self.text: list[str] = []

    def close_cell(self):
        tag, self.tag = self.tag, None
        value = "\n".join(" ".join(filter(None, BLANK.split(line))) for line in "".join(self.text).split("\n")).strip("\n")
        if tag == "title":
            if self.title is not None:
                raise ValueError("two titles")
            self.title = value
        elif tag == "h2":
            self.section = value
        elif tag in ("th", "td"):
            if not self.rows:
                raise ValueError("a cell outside a row")
            if tag == "th":
                self.rows[-1]["label"] = value
            else:
                self.rows[-1]["cells"].append(value)
                self.rows[-1]["links"].append(self.link)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append("\n")
        elif tag == "a":
            self.link = dict(attrs).get("href") or self.link
        elif tag in ("title", "h2", "th", "td", "tr"):
            self.close_cell()
            if tag == "tr":
                self.rows.append({"section": self.section, "label": None, "cells": [], "links": []})
            else:
                self.tag, self.text, self.link = tag, [], None

    def handle_endtag(self, tag):
        if tag in (self.tag, "tr", "table"):
            self.close_cell()

    def handle_data(self, data):
        if self.tag:
            self.text.append(data.replace("\n", " "))


def page_tables(pages: DataFrame) -> DataFrame:
    """page_id, title, rows and error, one row for each page; a page that can't be parsed has an error and nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                try:
                    parser = TableParser()
                    parser.feed(html)
                    parser.close()
                    parser.close_cell()
                    if parser.title is None:
                        raise ValueError("no title")
                    out.append((page_id, parser.title, parser.rows, None))
                except Exception as e:  # any page may be broken in any way; the row says how
                    out.append((page_id, None, None, f"{type(e).__name__}: {e}"[:ERROR_CHARS]))
            kinds = (pa.int64(), pa.string(), pa.list_(ROW), pa.string())
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "title", "rows", "error"])

    return pages.select("page_id", "html").mapInArrow(run, TABLES)


def spread(pages: DataFrame, number: int | None = None) -> DataFrame:
    """Pages dealt out by id to as many tasks as their number calls for: parsing is dear, and small tables would be one task.
    Pages that are dear to make should come with their number, as they are made once more to be counted."""
    number = pages.count() if number is None else number
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, -(-number // TASK_PAGES))
    return pages.repartition(tasks, "page_id")


def cell(rows: Column, label: str) -> Column:
    """The first cell of the first row with a label; null if there is none."""
    return F.get(F.get(F.filter(rows, lambda r: r["label"] == label), F.lit(0))["cells"], F.lit(0))


def rows_of(rows: Column, section: str) -> Column:
    return F.filter(rows, lambda r: r["section"] == section)

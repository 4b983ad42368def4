"""Slots of lineage on pages: what an item came from and what came from it, as a page's definition lists say it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOT = pa.struct([("label", pa.string()), ("filled", pa.bool_()), ("href", pa.string()), ("name", pa.string())])
SLOTS = "page_id string, slots array<struct<label: string, filled: boolean, href: string, name: string>>"
# How a slot is labelled, what kinds there are, and what an item's address looks like.
KINDS = ("reforge", "awakening", "enlightening")
LABEL = rf"^(before|after) ({'|'.join(KINDS)})$"
ITEM = r"^/item/([A-Za-z0-9_-]+)$"


class SlotParser(HTMLParser):
    """Each ``dt`` with the ``dd`` after it, if that follows before the next ``dt``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.slots: list[dict] = []
        self.part: str | None = None
        self.text: list[str] = []
        self.name: list[str] | None = None

    def finish(self):
        if self.part == "dt":
            self.slots[-1]["label"] = " ".join("".join(self.text).split()).lower()
        elif self.part == "dd" and self.name is not None:
            self.slots[-1]["name"] = " ".join("".join(self.name).split())
        self.part, self.name = None, None

    def handle_starttag(self, tag, attrs):
        if tag in ("dt", "dd"):
            self.finish()
            if tag == "dt":
                self.slots.append({"label": "", "filled": False, "href": None, "name": None})
                self.part, self.text = "dt", []
            elif self.slots and not self.slots[-1]["filled"]:
                self.part, self.slots[-1]["filled"] = "dd", True
        elif tag == "a" and self.part == "dd" and self.slots[-1]["href"] is None:
            self.slots[-1]["href"], self.name = dict(attrs).get("href"), []

    def handle_endtag(self, tag):
        if tag in ("dt", "dd", "dl"):
            self.finish()
        elif tag == "a" and self.name is not None:
            self.slots[-1]["name"], self.name = " ".join("".join(self.name).split()), None

    def handle_data(self, data):
        if self.part == "dt":
            self.text.append(data)
        elif self.name is not None:
            self.name.append(data)


def read_slots(html: str | None) -> list[dict]:
    parser = SlotParser()
    parser.feed(re.sub("\x00", "", html or ""))
    parser.close()
    parser.finish()
    return parser.slots


def page_slots(pages: DataFrame) -> DataFrame:
    """page_id (text) and slots in page order, one row for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_slots(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(found, pa.list_(SLOT))], names=["page_id", "slots"])

    return pages.select(F.col("page_id").cast("string").alias("page_id"), "html").mapInArrow(run, SLOTS)

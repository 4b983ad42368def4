import pytest
from pyspark.sql import functions as F

from millrace.functions.slots import page_slots, read_slots
from millrace.operators import lineage


def page(*slots):
    return "<dl>" + "".join(f"<dt>{label}</dt>" + ("" if link is None else f"<dd>{'none' if link == '' else f'<a href={link!r}><i>N</i> x</a>'}</dd>") for label, link in slots) + "</dl>"


@pytest.fixture
def read(spark):
    def make(*pages):
        return page_slots(spark.createDataFrame(pages, "page_id string, html string"))

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_slots_are_read_in_page_order():
    slot = lambda label, filled, href, name: {"label": label, "filled": filled, "href": href, "name": name}
    assert read_slots("<dl><dt>Before\n <b>Reforge</b><dd><a href='/item/1'>One &amp; only</a> more<dd>second<dt>after reforge<dt>x</dt><dd>none</dd></dl>") == [
        slot("before reforge", True, "/item/1", "One & only"), slot("after reforge", False, None, None), slot("x", True, None, None),
    ]
    assert read_slots(None) == read_slots("") == read_slots("<dd>alone</dd>") == []


@pytest.mark.parametrize(
    ("slots", "error"),
    [
        ([("before reforge", "/item/2"), ("after reforge", "/item/3"), ("before awakening", "")], None),
        ([("before fusion", "")], "unknown label 'before fusion'"), ([("after awakening", None)], "'after awakening' has no slot"), ([("before reforge", "/gear/2")], "'before reforge' links to /gear/2"),
        ([("before reforge", "/item/1")], "'before reforge' links to itself"), ([("before reforge", "/item/2"), ("before reforge", "/item/3")], "two slots 'before reforge'"),
        ([("after reforge", "/item/2"), ("after reforge", "/item/3")], None), ([("before reforge", ""), ("before reforge", "/item/3")], None), ([("x", ""), ("before reforge", None)], "unknown label 'x'"),
    ],
)
def test_markup_errors(read, slots, error):
    assert rows(lineage.errors(read(("1", page(*slots))))) == ([("1", error)] if error else [])


def test_claims_of_two_pages(read):
    found = lineage.claims(read(("1", page(("after reforge", "/item/2"))), ("2", page(("before reforge", "/item/1"))), ("3", page(("before reforge", "/item/1"), ("zzz", ""))), ("4", page(("after awakening", "/item/5"))), ("4", None)))
    assert rows(found) == [("awakening", "4", "5", False, True), ("reforge", "1", "2", True, True)]


@pytest.mark.parametrize(
    ("claims", "stands"),
    [
        ([("a", True, False), ("b", True, True), ("c", False, True)], "b"), ([("b", False, True), ("a", False, True)], "a"), ([("a", False, True), ("z", True, False)], "z"), ([("q", False, True)], "q"),
    ],
)
def test_contradicting_claims_are_settled(spark, claims, stands):
    frame = spark.createDataFrame([("reforge", f, "x", t, e) for f, t, e in claims], "kind string, from_uid string, to_uid string, of_to boolean, of_from boolean")
    got = lineage.settled(frame.union(frame.withColumn("kind", F.lit("awakening")))).collect()
    assert [r.from_uid for r in got if r.stands] == [stands] * 2 and len(got) == 2 * len(claims)
    assert {r.rivals for r in got} == {len(claims) - 1}


def test_no_pages(read):
    none = read()
    assert rows(lineage.errors(none)) == rows(lineage.settled(lineage.claims(none))) == []

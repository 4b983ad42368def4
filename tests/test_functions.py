import pytest
from pyspark.sql import functions as F

from millrace.functions import pages
from millrace.functions import text as tx


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "want"),
    [("  a\t\n b  ", "a b"), ("a\x0bb", "ab"), ("​x\xa0　y", "x y"), ("   ", None), ("", None), (None, None), ("é­é", "éé")],
)
def test_clean_text(spark, given, want):
    assert one(spark, tx.clean_text("t"), t=given) == want
    if want is None and given is not None:
        assert one(spark, tx.clean_text("t", empty_as_null=False), t=given) == ""


def test_hash_id_vectors(spark):
    empty = 7183457195969485844
    assert one(spark, tx.hash_id("a"), a="") == empty == one(spark, tx.hash_id("a"), a=None)
    assert one(spark, tx.hash_id("a", "b"), a=None, b="") == 9216187533725832630


def test_row_text_tells_null_from_text(spark):
    assert one(spark, tx.row_text(["a", "b"]), a=None, b="n") == "n\x1fvn"
    assert one(spark, tx.row_text([]), a="x") == ""


@pytest.mark.parametrize(
    ("given", "good"), [("2024-02-29T10:00:00Z", True), ("2023-02-29T10:00:00Z", False), ("2024-01-01", False), ("2024-1-01T00:00:00Z", False), (" 2024-01-01T00:00:00Z", False), (None, False)]
)
def test_iso_ts(spark, given, good):
    assert (one(spark, tx.iso_ts("t"), t=given) is not None) == good


@pytest.mark.parametrize(("given", "good"), [("0", True), ("7", True), ("9223372036854775807", True), ("9223372036854775808", False), ("-1", False), ("01", False), ("", False), ("1\n", False)])
def test_is_id(spark, given, good):
    assert one(spark, tx.is_id("t"), t=given) is good


def test_slug_and_tokens(spark):
    assert one(spark, tx.slug("t"), t="  Ability Power -- (max) ") == "ability_power_max"
    assert one(spark, tx.slug("t"), t="--") is None
    assert one(spark, tx.first_token("t", ["zz", "Xeno", "sopho"]), t="old SOPHO xeno") == "Xeno"
    assert one(spark, tx.first_token("t", ["zz"]), t="abc") is None


def test_json_keeps_nulls(spark):
    assert one(spark, tx.json_text(a=F.col("a"), b=F.col("b")), a="x", b=None) == '{"a":"x","b":null}'


def test_percent_change(spark):
    frame = spark.createDataFrame([(3, 2), (3, 0), (3, None)], "new int, old int")
    assert [r.x for r in frame.select(tx.percent_change("new", "old").alias("x")).collect()] == [50.0, None, None]


def test_conform(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert tx.conform(frame, {"v": "string", "k": "long"}).dtypes == [("v", "string"), ("k", "bigint")]
    with pytest.raises(Exception, match="v is null"):
        tx.conform(frame, {"v": "string"}, required=["v"]).collect()
    with pytest.raises(ValueError, match="missing"):
        tx.conform(frame, {"z": "string"})


def test_effect_hash_is_ordered_and_tagged(spark):
    make = lambda *lines: spark.createDataFrame([([{"tag": t, "fields": f} for t, f in lines],)], "x array<struct<tag:string,fields:array<string>>>").select(tx.effect_hash("x").alias("h")).first()["h"]
    a, b = ("e", ["self", "up"]), ("c", ["hp"])
    assert make(a, b) == make(a, b) != make(b, a)
    assert make(("e", ["ab", ""])) != make(("e", ["a", "b"]))


def test_pages_parse_whole_or_not_at_all(spark):
    good = "<html><title>A &amp; B</title><h1>Head</h1><a href='/x'>go  on</a><p>one<p>two</html>"
    frame = spark.createDataFrame([(1, good), (2, "<p>no title"), (3, None), (4, "<title>a</title><title>b</title>")], "page_id long, html string")
    rows = {(r.page_id, r.record, r.ordinal): (r.label, r.value) for r in pages.page_records(frame).collect()}
    assert rows[1, "title", 1] == ("title", "A & B") and rows[1, "link", 1] == ("/x", "go on")
    assert rows[1, "paragraph", 1][1] == "one" and rows[1, "paragraph", 2][1] == "two"
    assert {k[0] for k in rows if k[1] == "error"} == {2, 3, 4}
    assert len([k for k in rows if k[0] == 2]) == 1

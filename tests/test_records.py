"""Effects, page tables, the frontier, strict JSON, contracts and exports on odd cases."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions import effects as fx
from millrace.functions import text as tx
from millrace.functions.pages import cell, page_tables
from millrace.operators import lifecycle
from millrace.operators.hashes import named_digest
from millrace.operators.quality import contract_violations, exactly_shipped
from millrace.sources import files

FRONTIER = "item_id long, depth int, state string, attempts int, last_error string"


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", ["Straße", "ΣΊΣΥΦΟΣ ς", "ÀÉ", "İ", "ﬁn", ""])
def test_casefold_is_pythons(spark, text):
    assert one(spark, text, tx.casefold("t")) == text.casefold()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("-a b -c-d\n- e", ["a b", "c-d", "- e"]),
        ("x  ability power boosted by 12 for each increase in skill level. ", ["x", "ability power boosted by 12 for each increase in skill level."]),
        ("ability power boosted by 1 for each increase in skill level.", ["ability power boosted by 1 for each increase in skill level."]),
        (" \n\n - ", ["-"]),
        ("", []),
        (None, None),
    ],
)
def test_effect_lines(spark, text, want):
    assert one(spark, text, fx.effect_lines("t")) == want


def test_sections_and_procs(spark):
    text = "first\n[rate]\n[activation rate]\nscales with x\n5%\n[activation]\nhp\n-target: all foes . hit\n[rate]\nlate"
    got = [(s["name"], s["lines"]) for s in one(spark, text, fx.sections("t"))]
    assert got == [("effects", ["first"]), ("rate", []), ("activation rate", ["scales with x", "5%"]), ("activation", ["hp", "target: all foes . hit"]), ("rate", ["late"])]
    p = one(spark, text, fx.proc("t"))
    assert ([tuple(e) for e in p["effects"]], p["condition"], p["rate"], p["scaling"]) == ([(None, "first")], ["hp", "target: all foes . hit"], "5%", ["scales with x"])
    assert one(spark, text, fx.section(fx.sections("t"), "rate")) == ["late"]
    assert [tuple(e) for e in one(spark, "target:  all . a.b", fx.effect_structs(fx.effect_lines("t")))] == [("all", "a.b")]
    assert one(spark, "", fx.sections("t")) == [] and one(spark, None, fx.sections("t")) is None


def test_numbers_and_levels(spark):
    assert [one(spark, t, fx.whole_number("t")) for t in ("1,234", " 7 ", "-", None)] == [1234, 7, 0, 0]
    assert [one(spark, t, fx.potential_level("t")) for t in ("lv 20", "lv3 x", "level 3", None)] == [20, 3, None, None]


def test_page_tables(spark):
    pages = spark.createDataFrame(
        [(1, "<title>a &amp; b</title><h2>s</h2><table><tr><th>x<td>1<br>2<td>3<tr><td>free</table>"), (2, None), (3, "<title>a</title><title>b</title>"), (4, "<title>a</title><td>1</td>"), (5, "")],
        "page_id long, html string",
    )
    got = {r["page_id"]: r for r in page_tables(pages).withColumn("x", cell(F.col("rows"), "x")).collect()}
    assert got[1]["title"] == "a & b" and got[1]["x"] == "1\n2" and got[1]["error"] is None
    assert [(r["section"], r["label"], r["cells"]) for r in got[1]["rows"]] == [("s", "x", ["1\n2", "3"]), ("s", None, ["free"])]
    assert [got[i]["rows"] for i in (2, 3, 4, 5)] == [None] * 4
    assert [got[i]["error"] for i in (3, 4, 5)] == ["ValueError: two titles", "ValueError: a cell outside a row", "ValueError: no title"]


def test_frontier(spark):
    rows = [(1, 2, "pending", 0, None), (2, 1, "pending", 2, "old"), (3, 0, "done", 1, None), (4, 1, "pending", 0, None)]
    frontier = spark.createDataFrame(rows, FRONTIER)
    claimed = lifecycle.claim(frontier, 2)
    assert {r["item_id"]: (r["state"], r["attempts"]) for r in claimed.collect()} == {1: ("pending", 0), 2: ("in_flight", 3), 3: ("done", 1), 4: ("in_flight", 1)}
    outcomes = spark.createDataFrame([(2, "failed", "e"), (4, "failed", "f")], "item_id long, outcome string, error string")
    after = lifecycle.settle(claimed, outcomes, 3)
    assert {r["item_id"]: (r["state"], r["last_error"]) for r in after.collect()} == {1: ("pending", None), 2: ("failed", "e"), 3: ("done", None), 4: ("pending", "f")}
    assert {r["item_id"]: (r["state"], r["attempts"]) for r in lifecycle.retry_failed(after).collect()}[2] == ("pending", 0)
    assert {r["item_id"]: (r["state"], r["attempts"]) for r in lifecycle.reset_in_flight(claimed).collect()}[4] == ("pending", 0)
    for stray in (3, 9):
        with pytest.raises(Exception, match="is not in flight"):
            lifecycle.settle(claimed, spark.createDataFrame([(stray, "done", None)], outcomes.schema), 3).collect()
    with pytest.raises(ValueError):
        lifecycle.settle(claimed, outcomes, 0)
    assert lifecycle.claim(frontier.limit(0), 5).count() == 0


@pytest.mark.parametrize(
    ("raw", "fault"),
    [('{"a":{"b":1,"b":1}}', "duplicate key b"), ('{"a":Infinity}', "non-finite number Infinity"), ("[]", "not an object"), ("", "invalid"), (None, "invalid"), ('{"a":[1,{"b":null}]}', None)],
)
def test_strict_json(spark, raw, fault):
    assert one(spark, raw, tx.json_fault("t")) == fault


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 2), (5, None, 3)], "n int, s string, more int")
    got = contract_violations(df, {"n": {"required": True, "minimum": 2}, "s": {"enum": ["a"]}, "gone": {"required": True}})
    assert sorted(map(tuple, got.collect())) == [("gone", "required", 3), ("more", "unknown", 3), ("n", "minimum", 1), ("n", "required", 1), ("s", "enum", 1)]
    empty = contract_violations(df.limit(0), {"n": {"required": True}, "s": {}, "more": {}})
    assert list(map(tuple, empty.collect())) == [("n", "required", 0)]
    assert exactly_shipped(["a", "b"], ["b", "c"]) == [("c", "missing"), ("a", "unexpected")]


def test_digest_knows_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    digest = lambda d, t="t": named_digest(d, t).first()["digest"]
    assert digest(df) == digest(df.select("s", "n").orderBy(F.desc("n")))
    assert len({digest(df), digest(df, "u"), digest(df.withColumnRenamed("s", "t")), digest(df.limit(1))}) == 4


def test_export_is_in_order(spark, tmp_path):
    at = str(tmp_path / "out")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(None).cast("string").alias("none"))
    files.ordered_export(df.repartition(8), ["k"], at)
    rows = [json.loads(line) for f in sorted(Path(at).glob("part-*")) for line in f.read_text().splitlines()]
    assert [r["k"] for r in rows] == list(range(1000)) and rows[0] == {"k": 0, "none": None}


def test_clamped_settings(spark):
    wanted = spark.createDataFrame([(10, 50, ["SR", "N"]), (45, 60, ["SR"]), (45, 99, [])], "cost_min int, cost_max int, rarities array<string>")
    got = lifecycle.clamp_settings(wanted, lifecycle.Scope(40, 90, 1, ("SSR", "SR")))
    assert sorted(map(tuple, got.collect())) == sorted([(40, 50, ["SR"], ["cost_min", "rarities"]), (45, 60, ["SR"], []), (45, 90, ["SSR", "SR"], ["cost_max"])])

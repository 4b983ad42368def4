"""Costly values are worked out once, however many rules or fields read them."""

from __future__ import annotations

from millrace.functions import effects as fx
from millrace.functions.pages import spread
from millrace.operators import contracts
from millrace.plans.contracts import EVENT, TURN


def test_json_is_parsed_once(spark):
    docs = spark.createDataFrame([('{"event":{"id":1.5}}',), ("x",), (None,)], "doc string")
    for schema in (EVENT, TURN):
        plan = docs.select(contracts.first_fault("doc", schema))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parse_json") == 1
    assert [r[0] for r in docs.select(contracts.first_fault("doc", EVENT)).collect()] == ["$.event: lacks user", "$: json", "$: json"]


def test_a_procs_cell_is_cut_into_lines_once(spark):
    cells = spark.createDataFrame([("-hits\n[activation rate]\n5%",)], "cell string")
    found = cells.select(fx.proc("cell").alias("p")).select("p.effects", "p.condition", "p.rate", "p.scaling")
    assert found.collect()[0].rate == "5%"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ability power boosted") <= 4  # of one cutting into lines


def test_pages_with_their_number_are_not_made_to_be_counted(spark):
    pages = spark.range(3).selectExpr("id AS page_id", "raise_error('made') AS html").where("html IS NOT NULL")
    assert spread(pages, 12_000).columns == ["page_id", "html"]

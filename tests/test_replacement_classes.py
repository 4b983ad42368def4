"""Copies of an item are compared once: pairs of items are made from pairs of classes."""

from __future__ import annotations

from millrace.operators import lifecycle


def test_copies_are_one_class(spark):
    old = spark.createDataFrame([(f"o{i}", "a") for i in range(30)] + [("p", "a"), ("q", "b")], "uid string, name string")
    new = spark.createDataFrame([(f"n{i}", "a") for i in range(20)] + [("m", "a"), ("r", "b")], "uid string, name string")
    cells = {**{f"o{i}": 4 for i in range(30)}, **{f"n{i}": 4 for i in range(20)}, "p": 3, "m": 9}
    stats = spark.createDataFrame([(u, "s", str(k), k) for u, n in cells.items() for k in range(n)], "uid string, label string, tier string, value long")
    found = lifecycle.replacements(old, new, stats, ["name"], 0.7)
    got = {(r.old_uid, r.new_uid): r.score for r in found.collect()}
    want = {(f"o{i}", f"n{k}"): 1.0 for i in range(30) for k in range(20)} | {("p", f"n{k}"): 0.75 for k in range(20)} | {("q", "r"): 1.0}
    assert got == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [old_uid" not in plan and "Aggregate [new_uid" not in plan, plan

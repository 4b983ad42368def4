"""No table of a build is broadcast: what grows with the input doesn't lie in the driver."""

from __future__ import annotations

from millrace.models import build, checks
from millrace.operators import graph, lifecycle, quality
from millrace.plans import warehouse
from millrace.plans.registry import queries

D = "/root/testdata/sf0.001"
HASH = "BroadcastHashJoin"


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_models_and_checks_are_joined_by_shuffles(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_BUILDS", {})
    monkeypatch.setattr(lifecycle, "SMALL_ROWS", -1)  # it broadcasts tables of groups up to so many rows
    second = warehouse.builds(spark, D)[1]
    asked = {n: f(second) for n, f in build.MODELS.items()} | {"stg_stat": second.raw["stg_stat"]()} | {n: f(second) for n, (_, f) in checks.CHECKS.items()}
    asked |= {"keys": quality.run_expectations(checks.key_checks(second))}
    assert [n for n, df in asked.items() if HASH in planned(df)] == []
    # the gate's policy of a few lines is, and a scope's population
    text = planned(queries()["warehouse_05_gate"](spark, D))
    assert text.count(HASH) == 4, text


def test_steps_of_a_graph_are_joined_by_shuffles(spark, monkeypatch):
    plans = []
    keep = lambda df, make=graph.checkpoint: (plans.append(planned(df)), make(df))[1]
    monkeypatch.setattr(graph, "checkpoint", keep)
    links = [("k", f"n{i}", f"n{i + 1}") for i in range(4)] + [("k", "n9", "n8"), ("k", "n8", "n9"), ("k", "n4", "n8")]
    edges = spark.createDataFrame(links, "kind string, from_uid string, to_uid string")
    assert graph.chains(edges).where("chain_id = 'n0'").count() == 7
    assert {r.uid for r in graph.in_cycles(edges).collect()} == {"n8", "n9"}
    assert len(plans) > 10 and not any(HASH in p for p in plans)

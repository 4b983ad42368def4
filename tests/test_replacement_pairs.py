"""Pairs of items are put out by the task that makes them, and groups of any size meet in parts."""

from __future__ import annotations

import random

import pytest

from millrace.operators import lifecycle


def sent(plan) -> int:
    """Rows that the shuffles of a plan have written."""
    name, below = plan.nodeName(), plan.children()
    if name == "AdaptiveSparkPlan":
        return sent(plan.executedPlan())
    if name.endswith("QueryStage"):
        return sent(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(sent(below.apply(i)) for i in range(below.size()))


def test_pairs_of_different_items_are_not_sent(spark):
    items = [(f"i{i}", "a") for i in range(70)]
    old, new = (spark.createDataFrame(x, "uid string, name string") for x in (items[:30], items[30:]))
    # all items share twelve cells, and each has one of its own
    cells = [(u, "s", str(k), k) for u, _ in items for k in range(12)] + [(u, "own", u, 0) for u, _ in items]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lifecycle.replacements(old, new, spark.createDataFrame(cells, "uid string, label string, tier string, value long"), ["name"], 0.5)
        assert len(found.collect()) == 30 * 40
        assert sent(found._jdf.queryExecution().executedPlan()) <= 10 * 70
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kinds", [3, 200])
def test_large_groups_meet_in_parts(spark, monkeypatch, kinds):
    """kinds: few different cells, which most items share, or many, which few do."""
    monkeypatch.setattr(lifecycle, "TILE", 3)
    monkeypatch.setattr(lifecycle, "MEMBERS", 2)
    rng = random.Random(kinds)
    items = [(i, rng.choice("ab")) for i in range(80)]
    have = {u: frozenset(rng.randrange(kinds) for _ in range(rng.randrange(5))) for u, _ in items}
    for u in range(20, 45):  # copies, on both sides
        have[u], items[u] = frozenset({1, 2}), (u, "a")
    old, new = items[:35], items[30:]
    stats = spark.createDataFrame([(u, "s", "t", k) for u, ks in have.items() for k in ks], "uid long, label string, tier string, value long")
    frames = [spark.createDataFrame(x, "uid long, name string") for x in (old, new)]
    for score in (0.4, 1.0):
        share = lambda u, v: len(have[u] & have[v]) / len(have[u] | have[v]) if have[u] | have[v] else 1.0
        want = {(u, v): share(u, v) for u, n in old for v, m in new if u != v and n == m and share(u, v) >= score}
        got = lifecycle.replacements(*frames, stats, ["name"], score).collect()
        assert {(r.old_uid, r.new_uid): r.score for r in got} == want and len(got) == len(want)

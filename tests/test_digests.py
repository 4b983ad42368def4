import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import digests
from millrace.operators.changes import differences

SHAPE = digests.Shape(width=8, fanout=4)
FIELDS = "k long, a string, b double"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.randrange(-200, 2000), rng.choice(["x", None, "y\x1f", ""]), rng.choice([1.0, None, -2.5])) for _ in range(n)]


def found(spark, one, other, shape=SHAPE):
    a, b = (spark.createDataFrame(r, FIELDS).repartition(3) for r in (one, other))
    leaves = digests.differing(digests.tree(a, "k", shape), digests.tree(b, "k", shape), shape)
    return leaves, sorted(map(tuple, digests.changed_rows(a, b, "k", leaves, shape).collect()), key=str), sorted(map(tuple, differences(a, b).collect()), key=str)


def test_changes_are_those_of_whole_tables(spark):
    old = rows(600)
    new = old[5:] + [old[7], (5000, "far", 0.0), (None, "no key", None), (3, None, None)]
    new[100] = (new[100][0], "changed", new[100][2])
    leaves, got, want = found(spark, old, new)
    assert got == want and got
    touched = {k // 8 for k, *_ in want if k is not None}
    assert {r.node for r in leaves.collect()} == touched | {digests.NO_KEY}


def test_equal_tables_have_equal_trees_whatever_their_order(spark):
    some = rows(300)
    leaves, got, _ = found(spark, some, random.Random(3).sample(some, len(some)))
    assert leaves.count() == 0 and got == []
    swapped = [(1, None, 1.0), (2, "x", None)]
    leaves, got, want = found(spark, swapped, [(1, "x", None), (2, None, 1.0)])
    assert got == want and len(got) == 4


def test_a_repeated_row_and_an_empty_table(spark):
    leaves, got, want = found(spark, [(1, "x", 1.0)] * 2, [(1, "x", 1.0)] * 3)
    assert got == want and len(got) == 1
    assert [(r.node, r.rows_a, r.rows_b) for r in leaves.collect()] == [(0, 2, 3)]
    leaves, got, want = found(spark, [], rows(50))
    assert got == want and len(got) == 50
    assert found(spark, [], [])[0].count() == 0


def test_trees_of_different_height(spark):
    low, high = rows(20), rows(20) + [(k * 8, "h", 0.0) for k in range(3000, 3400)]
    leaves, got, want = found(spark, low, high)
    assert got == want and len(got) == 400


def test_nodes_add_up(spark):
    tree = digests.tree(spark.createDataFrame(rows(500), FIELDS), "k", SHAPE).collect()
    levels = {}
    for r in tree:
        levels.setdefault(r.level, {})[r.node] = r.rows
    assert all(sum(v.values()) == 500 for v in levels.values()) and len(levels[max(levels)]) <= SHAPE.fanout
    for level in range(1, max(levels) + 1):
        below = {}
        for node, n in levels[level - 1].items():
            below[node // SHAPE.fanout] = below.get(node // SHAPE.fanout, 0) + n
        assert below == levels[level]


def test_only_the_ranges_that_differ_are_read(spark, tmp_path):
    spark.range(0, 40_000).selectExpr("id AS k", "cast(id AS string) AS a").repartitionByRange(8, "k").sortWithinPartitions("k").write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/t")
    old = spark.read.parquet(f"{tmp_path}/t")
    new = old.withColumn("a", F.when(F.col("k") == 12_345, "new").otherwise(F.col("a")))
    shape = digests.Shape(width=64)
    leaves = digests.differing(digests.tree(old, "k", shape), digests.tree(new, "k", shape), shape)
    assert [r.node for r in leaves.collect()] == [12_345 // 64]
    part = digests.within(old, "k", leaves, shape)
    assert part.count() == 64
    plan = part._jdf.queryExecution().executedPlan().toString()
    first = 12_345 // 64 * 64
    assert f"GreaterThanOrEqual(k,{first})" in plan and f"LessThanOrEqual(k,{first + 63})" in plan
    assert sorted(r.a for r in digests.changed_rows(old, new, "k", leaves, shape).collect()) == ["12345", "new"]


def test_many_ranges_are_met_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(digests, "RANGES", 2)
    old = rows(400)
    leaves, got, want = found(spark, old, [(k, a, 9.0) if k is not None and k % 50 == 0 else (k, a, b) for k, a, b in old] + [(None, "n", 1.0)])
    assert got == want and leaves.count() > 2


@pytest.mark.parametrize(("nodes", "runs"), [([], []), ([3], [(3, 3)]), ([5, 1, 2, 3, 9, 8], [(1, 3), (5, 5), (8, 9)])])
def test_runs_of_neighbours(nodes, runs):
    assert digests.merged(nodes) == runs

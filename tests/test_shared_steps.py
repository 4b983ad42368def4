"""Steps that many rows of one key go through: their work may not grow with the square of a key's rows."""

from __future__ import annotations

from millrace.models.build import RAW, Build, Run
from millrace.plans import warehouse


def test_icons_that_many_items_share_meet_once(spark):
    uids = [f"p{i}" for i in range(40)]
    raw = {
        "stg_equipment": spark.createDataFrame([(u, "h", "weapon", "a", "ur", "g", 1, "none", 1) for u in uids], RAW["stg_equipment"]),
        "stg_asset": spark.createDataFrame([(f"/{u}", u, "equipment", f"s{i % 2}", "2024-01-02T00:00:00Z", 5) for i, u in enumerate(uids)] + [("/x", "x", "equipment", "other", None, 1)], RAW["stg_asset"]),
    }
    icons = Build(spark, Run(1, "r", "2024-01-10T00:00:00Z"), raw, {})["int_icon"]
    assert sorted(map(tuple, icons.collect())) == [("s0", "equipment", 5), ("s1", "equipment", 5)]
    plan = icons._jdf.queryExecution().optimizedPlan().toString()
    top = plan[: plan.index("Join") + 20]
    assert "Join LeftSemi" in top, plan


def test_parts_are_dealt_out_to_all_cores(spark, tmp_path):
    spark.range(1000).selectExpr("id AS p_partkey", "'a' AS p_name").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    part = warehouse.dealt(spark, str(tmp_path), str(tmp_path / "dealt"))
    assert part.count() == 1000
    assert part.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

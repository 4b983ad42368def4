"""Queries on a build make what they read and no more, and get what the change log and the whole history tell."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.functions.text import PLAIN, clean_text
from millrace.operators.graph import chains
from millrace.plans import warehouse
from millrace.plans.registry import queries

D = "/root/testdata/sf0.001"
LOG = {"int_changes", "int_aggregate_hash_game", "mart_equipment"}


def test_a_query_on_items_asks_for_no_change_log(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_BUILDS", {})
    asked = queries()
    items = ("warehouse_06_census", "warehouse_02_equipment", "warehouse_06_null_rates", "warehouse_06_scope_drift", "warehouse_01_new_and_retired")
    got = {n: sorted(asked[n](spark, D).collect(), key=str) for n in items}
    first, second = warehouse.builds(spark, D)
    assert not LOG & {*first.made, *second.made}
    assert "stg_stat" not in {*first.made, *second.made}  # the order lines are not read for items alone
    asked["warehouse_03_equipment_metrics"](spark, D).collect()
    assert not LOG & {*first.made, *second.made}
    # the whole history says the same
    known = second.prev("entity_current").where("entity_type = 'equipment' AND last_operation <> 'DELETE'").select("entity_key", "state", "retired_revision")
    assert sorted(known.collect()) == sorted(second.known_equipment().collect())
    log = second["int_changes"].where("(entity_type = 'equipment' AND operation = 'INSERT') OR entity_type = 'uid_retired'").select("entity_type", "entity_key", "operation")
    assert sorted(log.collect(), key=str) == got["warehouse_01_new_and_retired"]
    columns = second["int_shipped"].columns
    assert sorted(second["mart_equipment"].select(*columns).collect()) == sorted(second["int_shipped"].collect())


def nearest(edges):
    """Chains by a walk from each root, key by key."""
    out, nodes = {}, {(k, x) for k, a, b in edges for x in (a, b)}
    now = {(k, x): x for k, x in nodes if not any(k == k2 and x == b for k2, _, b in edges)}
    position = 0
    while now:
        out |= {(k, x): (root, position) for (k, x), root in now.items()}
        step = {}
        for k, a, b in edges:
            if (k, a) in now and (k, b) not in out:
                step[k, b] = min(step.get((k, b), now[k, a]), now[k, a])
        now, position = step, position + 1
    return {(k, x, *v) for (k, x), v in out.items()}


def test_chains_of_links_that_meet_again(spark):
    rng = random.Random(5)
    edges = {(rng.choice("ab"), f"n{rng.randrange(40):02}", f"n{rng.randrange(60):02}") for _ in range(70)}
    edges |= {("c", f"m{i:02}", f"m{i + 1:02}") for i in range(12)} | {("c", "m12", "m05"), ("c", "m00", "m09"), ("d", "x", "y"), ("d", "y", "x"), ("d", "z", "z")}
    got = chains(spark.createDataFrame(sorted(edges), "kind string, from_uid string, to_uid string"))
    rows = [(r.kind, r.uid, r.chain_id, r.position) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == nearest(edges)


def test_plain_text_is_what_cleaning_leaves(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab!~ \t\n ​\x7f\x00é ") for _ in range(rng.randrange(5))) for _ in range(1500)] + ["", " ", "a", "a b", "a  b", "a\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    long_way = F.trim(F.regexp_replace(F.regexp_replace("t", r"[\t\n\f\r \p{Z}]+", " "), r"[\p{Cc}\p{Cf}]", ""))
    wrong = df.where(~clean_text("t", empty_as_null=False).eqNullSafe(long_way) | ~clean_text("t").eqNullSafe(F.nullif(long_way, F.lit(""))))
    assert wrong.collect() == [] and 0 < df.where(F.col("t").rlike(PLAIN)).count() < len(texts)

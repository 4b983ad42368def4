"""A small catalogue over several revisions: what changes, what is kept, and what the checks say."""

import pytest
from pyspark.sql import functions as F

from millrace.models import checks, history
from millrace.models.build import RAW, Build, Run
from millrace.operators import gate, quality

ITEM = ("hash", "weapon", "Fire  blade", "ur", "sword", 50, "fire", 80)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, RAW[name])


def world(spark, *, gone=(), names=None, failed=(), confirmed=(), run=1, extra=()):
    names = names or {}
    uids = [u for u in ("a", "b", "c", *extra) if u not in failed]
    equipment = [(u, ITEM[0], "monster" if u == "c" else "weapon", names.get(u, ITEM[2]), *ITEM[3:]) for u in uids]
    weapons = [u for u in uids if u != "c"]
    return {
        "stg_equipment": frame(spark, "stg_equipment", equipment),
        "stg_weapon": frame(spark, "stg_weapon", [(u, 4) for u in weapons]),
        "stg_monster": frame(spark, "stg_monster", [("c", " none ")] if "c" in uids else []),
        "stg_proc": frame(spark, "stg_proc", [(u, "fire storm xl", "e1", "", "x") for u in weapons]),
        "stg_proc_scaling": frame(spark, "stg_proc_scaling", [(u, 1, "ability power scales with the number of fire elemental weapons equipped up to a max of 5xl") for u in weapons]),
        "stg_weapon_ability": frame(spark, "stg_weapon_ability", [(u, "ab", "Cut") for u in weapons]),
        "stg_monster_skill": frame(spark, "stg_monster_skill", [("c", 1, "Roar")] if "c" in uids else []),
        "stg_skill_effect": frame(spark, "stg_skill_effect", [(u, "proc", 1, 1, None, "hits") for u in weapons] + ([("c", "monster_skill", 1, 1, "all", "roars")] if "c" in uids else [])),
        "stg_stat": frame(spark, "stg_stat", [(u, "atk", t, 10, 1, 1) for u in uids for t in ("initial", "max")]),
        "stg_evolution": frame(spark, "stg_evolution", [("b", "awakening", "a", "Fire blade")] if "b" in uids else []),
        "stg_element": frame(spark, "stg_element", [("fire",), ("water",), ("none",)]),
        "stg_page": frame(spark, "stg_page", [(f"/{u}", "detail", u, "h", None, "2024-01-01T00:00:00Z", run) for u in ("a", "b", "c", *extra)]),
        "stg_frontier": frame(spark, "stg_frontier", [(u, "list", "catalog", "cost_band", 0, None, "gone" if u in gone else "done", None, run, "2023-01-01T00:00:00Z") for u in ("a", "b", "c", *extra)]),
        "stg_asset": frame(spark, "stg_asset", [("/i/old", "a", "equipment", "s0", "2024-01-01T00:00:00Z", 3), ("/i/new", "a", "equipment", "s1", "2024-01-02T00:00:00Z", 4)]),
        "stg_parse_error": frame(spark, "stg_parse_error", [(u, "h", 1, "broken", "r") for u in failed]),
        "confirmed_aliases": frame(spark, "confirmed_aliases", [(*p, None) for p in confirmed]),
    }


@pytest.fixture(scope="module")
def revisions(spark, tmp_path_factory):
    """boot; one item gone; its alias confirmed and else nothing new; the item back and another page broken."""
    folder = tmp_path_factory.mktemp("builds")
    steps = [
        world(spark), world(spark, gone=("b",), run=2), world(spark, gone=("b",), confirmed=[(" b ", "a")], run=3), world(spark, failed=("c",), confirmed=[("b", "a")], run=4),
    ]
    past, out = {}, []
    for n, raw in enumerate(steps, 1):
        run = Run(n, f"run{n}", f"2024-0{n}-01T00:00:00Z", bootstrap=n == 1, last_complete_run=n, prev_run_id=f"run{n - 1}" if n > 1 else None, prev_parser_version=1 if n > 1 else None)
        b = Build(spark, run, raw, past, str(folder / f"{n}"))
        out.append(b)
        new = history.additions(b)
        now = {}
        for name, df in {**new, "entity_current": b["entity_current"]}.items():
            all_ = df if name == "entity_current" or name not in past else past[name].unionByName(df)
            all_.write.parquet(str(folder / f"h{n}" / name))
            now[name] = spark.read.schema(df.schema).parquet(str(folder / f"h{n}" / name))
        past = now
    return out


def operations(b, kind="equipment"):
    return {r.entity_key: r.operation for r in b["int_changes"].where(F.col("entity_type") == kind).collect()}


def test_first_revision_inserts_all(revisions):
    assert operations(revisions[0]) == {"a": "INSERT", "b": "INSERT", "c": "INSERT"}
    assert set(operations(revisions[0], "weapon_ability").values()) == {"INSERT"}


def test_nothing_new_changes_nothing(revisions):
    assert {r.operation for r in revisions[2]["int_changes"].where("entity_type NOT IN ('uid_alias')").collect()} == {"ALIAS"}
    assert revisions[2]["mart_equipment"].where("uid <> 'b' AND (last_changed_revision <> 1 OR last_seen <> '2024-01-01T00:00:00Z')").count() == 0


def test_gone_item_is_retired_and_kept(revisions):
    b = revisions[1]
    assert operations(b) == {"b": "RETIRE"} and operations(b, "uid_retired") == {"b": "INSERT"}
    row = b["mart_equipment"].where("uid = 'b'").first()
    assert (row.state, row.retired_revision, row.last_changed_revision, row.last_seen) == ("retired", 2, 2, "2024-01-01T00:00:00Z")
    assert [r.detail for r in checks.retired(b).collect()] == ["gone"]


def test_alias_is_recorded_after_the_retirement(revisions):
    b = revisions[2]
    assert operations(b) == {"b": "ALIAS"} and operations(b, "uid_alias") == {"b": "INSERT"}
    assert [(r.old_uid, r.new_uid, r.since_revision) for r in b["mart_uid_alias"].collect()] == [("b", "a", 3)]


def test_revived_item_is_an_update(revisions):
    b = revisions[3]
    assert operations(b) == {"b": "UPDATE"}
    assert checks.unexplained_churn(b).count() == 0
    assert b["mart_uid_retired"].count() == 1 and checks.ledgers_append_only(b).count() == 0


def test_failed_page_defers_deletes(revisions):
    b = revisions[3]
    assert "DELETE" not in {r.operation for r in b["int_changes"].collect()}
    assert checks.deferred_shared_deletes(b).count() > 0
    assert [r.uid for r in b["shipped_parse_failures"].collect()] == ["c"]
    assert checks.equipment_never_deleted(b).count() == 0
    assert [(r.entity_key, r.is_new_item) for r in checks.parse_failure(b).collect()] == [("c", False)]


def test_additions_are_idempotent(revisions):
    b = revisions[1]
    new = history.additions(b)
    again = Build(b.spark, b.run, b.raw, {n: b.previous[n].unionByName(new[n]) for n in new}, made=dict(b.made))
    for name in ("dataset_changes", "uid_retired", "population", "equipment_seen"):
        assert history.additions(again)[name].count() == 0, name


def test_marts_are_made_of_the_records(revisions):
    b = revisions[0]
    a = b["mart_equipment"].where("uid = 'a'").first()
    assert (a["name"], a.rarity, a.icon_sha, a.first_seen) == ("Fire blade", "UR", "s1", "2023-01-01T00:00:00Z")
    proc = b["mart_proc"].first()
    assert b["mart_proc"].count() == 1 and (proc.raw_name, proc.size, proc.element_id, proc.element_position, proc.activation_rate) == ("fire storm xl", "xl", "fire", "prefix", None)
    assert b["mart_proc_family"].first().name == "storm"
    assert {(r.owner_kind, r.ordinal) for r in b["mart_effect_link"].collect()} == {("proc", 1), ("monster_skill", 1)}
    assert {(r.uid, r.chain_id, r.position) for r in b["mart_evolution_chain"].collect()} == {("a", "a", 0), ("b", "a", 1)}
    assert b["mart_weapon"].where("proc_id IS NULL OR ability_uid <> 'ab'").count() == 0


def test_keys_and_parents_hold(revisions):
    found = quality.run_expectations(checks.key_checks(revisions[0])).where("failures > 0").collect()
    assert found == []


def test_history_and_reports(revisions):
    b = revisions[1]
    metrics = {(r.metric, r.scope): (r.value, r.prev_value) for r in b["obs_data_quality"].collect()}
    assert metrics["count:equipment", "all"] == (3.0, 3.0) and metrics["population", "catalog"] == (2.0, 3.0) and metrics["retirements", "all"] == (1.0, 0.0)
    drop = checks.count_drop(b).first()
    assert (drop.affected, drop.detail) == (1, "live catalog 3 -> 2")
    assert b["rpt_census"].agg(F.sum("items")).first()[0] == 3
    assert b["rpt_trace"].where("operation = 'RETIRE'").count() == 1
    assert b["obs_pipeline_run"].first().crawl_status == "missing"
    assert b["rpt_parse_coverage"].first().asDict() == {"detail_pages": 3, "staged": 3, "parse_errors": 0}


def test_gate_over_a_build(revisions):
    policy = gate.Policy.parse('[check.retired]\nscopes = { catalog = "warning" }\nescalate = { scope = "catalog", level = "blocker", min_count = 1, min_pct = 1.0 }')
    b = revisions[1]
    found = gate.findings(checks.gate_input(b), policy.frame(b.spark), b.prev("population").where("run_id = 'run1'")).collect()
    assert [(r.check, r.level, r.escalated) for r in found if r.check == "retired"] == [("retired", 2, True)]
    # checks that the policy has no rule for are told, as information, and never lost
    others = [r for r in found if r.check != "retired"]
    assert others and all((r.level, r.escalated, r.message) == (0, False, f"no rule for the check {r.check}") for r in others)


VIOLATIONS = [
    ("alias_target_missing", {"confirmed_aliases": [("b", "zz", None)]}, 1),
    ("alias_cycle", {"confirmed_aliases": [("a", "b", None), ("b", "a", None)]}, 2),
    ("alias_confirmed_and_rejected", {"confirmed_aliases": [("b", "a", None)], "rejected_aliases": [("b", " a", None)]}, 1),
    ("alias_old_uid_live", {"confirmed_aliases": [("b", "a", None)]}, 1),
    ("meta_keys", {"stg_meta": [("scope.fingerprint", "x")]}, 2),
    ("crawl_complete", {}, 1),
    ("evolution_no_cycle", {"stg_evolution": [("b", "awakening", "a", None), ("a", "awakening", "b", None)]}, 2),
    ("wiki_contradiction", {"stg_evolution": [("b", "awakening", "a", None), ("b", "awakening", "c", None)]}, 1),
    ("item_name_conflict", {"stg_evolution_material": [("a", "k", 1, "item", "i", "X", 1), ("b", "k", 1, "item", "i", "Y", 1)]}, 1),
    ("evolution_material_dropped", {"stg_evolution_material": [("c", "k", 1, "item", "i", "X", 1)]}, 1),
    ("listing_detail_disagree", {"stg_listing": [("a", "n", "weapon", "UR", 1), ("b", "n", "armor", "UR", 1), ("c", "n", "monster", "ssr", 1)]}, 2),
    ("unlisted_release", {"stg_unlisted_release": [("x", "n", 4)]}, 1),
    ("optional_field_null", {"stg_stat": [("a", "atk", "initial", 1, 1, 1)]}, 1),
    ("frontier_contract_failure", {"stg_frontier": [("a", "list", "catalog", "k", 0, None, "failed", "contract: x", 1, "t")]}, 1),
    ("unknown_vocabulary", {"vocabulary": [("gear_type", "sword"), ("stat_label", "atk"), ("stat_tier", "initial"), ("stat_tier", "max")]}, 1),
    ("icon_missing", {}, 2),
]


@pytest.mark.parametrize(("name", "change", "n"), VIOLATIONS, ids=[v[0] for v in VIOLATIONS])
def test_violation_is_found(spark, name, change, n):
    raw = world(spark) | {t: frame(spark, t, rows) for t, rows in change.items()}
    b = Build(spark, Run(1, "run1", "2024-01-01T00:00:00Z", bootstrap=True, last_complete_run=1), raw, {})
    # the shipped items without what depends on the change log, which no check here looks at
    b.made["mart_equipment"] = b["int_ship_equipment"]
    assert checks.CHECKS[name][1](b).count() == n

"""What must hold of a build. Each check gives the rows that break it; policy checks give rows for the gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.models.build import MEET, Build, together
from millrace.models.catalogue import MARTS, contract
from millrace.models.history import listed
from millrace.operators import changes, graph, quality
from millrace.operators.quality import Expectation, gate_rows
from millrace.operators.selection import mark

CHECKS: dict[str, tuple[str, Callable[[Build], DataFrame]]] = {}


def check(group: str):
    def put(function):
        CHECKS[function.__name__] = (group, function)
        return function

    return put


def known_equipment(b: Build) -> DataFrame:
    return b.prev("entity_current").where("entity_type = 'equipment' AND last_operation <> 'DELETE'")


# --- contract: the input is what a build may start from


@check("contract")
def crawl_complete(b: Build) -> DataFrame:
    done = b["stg_crawl_run"].where((F.col("run_id") == b.run.last_complete_run) & (F.col("status") == "complete")).agg(F.count("*").alias("n"))
    return done.where("n = 0").select(F.lit(b.run.last_complete_run).alias("last_complete_run"))


@check("contract")
def frontier_contract_failure(b: Build) -> DataFrame:
    return b["stg_frontier"].where((F.col("decided_run_id") == b.run.last_complete_run) & F.col("last_error").startswith("contract:")).select("item_id", "last_error")


@check("contract")
def meta_keys(b: Build) -> DataFrame:
    needed = b.spark.createDataFrame([("seed.schema_version",), ("scope.fingerprint",), ("crawl.last_complete_run",)], "key string")
    return needed.join(b["stg_meta"], "key", "left_anti")


@check("contract")
def seed_scope_matches(b: Build) -> DataFrame:
    one = b.spark.range(1).select(F.lit(b.run.scope_fingerprint).alias("seed_fingerprint"), F.lit(b.run.catalog_version).alias("catalog_version"))
    return one.where("seed_fingerprint IS DISTINCT FROM catalog_version")


# --- structural: the shipped tables agree with each other and with the history


@check("structural")
def alias_confirmed_and_rejected(b: Build) -> DataFrame:
    rejected = listed(b, "rejected_aliases").union(b.prev("alias_rejected").select("old_uid", "new_uid"))
    return listed(b, "confirmed_aliases").join(rejected, ["old_uid", "new_uid"], "left_semi")


@check("structural")
def alias_csv_disagrees_with_ledger(b: Build) -> DataFrame:
    ledger = b.prev("uid_alias").select("old_uid", F.col("new_uid").alias("ledger_new_uid"))
    return ledger.join(listed(b, "confirmed_aliases"), "old_uid").where("new_uid <> ledger_new_uid")


@check("structural")
def alias_cycle(b: Build) -> DataFrame:
    links = b.prev("uid_alias").select("old_uid", "new_uid").union(listed(b, "confirmed_aliases"))
    return graph.in_cycles(links.select(F.lit("alias").alias("kind"), F.col("old_uid").alias("from_uid"), F.col("new_uid").alias("to_uid")))


@check("structural")
def alias_old_uid_live(b: Build) -> DataFrame:
    live = b["mart_equipment"].where("state = 'live'").select(F.col("uid").alias("old_uid"))
    return changes.append_new(b.prev("uid_alias"), listed(b, "confirmed_aliases"), ["old_uid"]).join(live, "old_uid", "left_semi")


@check("structural")
def alias_target_missing(b: Build) -> DataFrame:
    return listed(b, "confirmed_aliases").join(b["mart_equipment"].select(F.col("uid").alias("new_uid")), "new_uid", "left_anti")


@check("structural")
def equipment_rarity_closed(b: Build) -> DataFrame:
    e = b["mart_equipment"]
    way = b["int_scope_member"].where("source = 'evolution' AND entry_kind = 'reference' AND keep_reason = 'evolution:awakening'").select("uid", F.col("parent_id").alias("to_uid"))
    edges = b["mart_evolution_edge"].where("kind = 'awakening'").select(F.col("from_uid").alias("uid"), "to_uid")
    live = e.where("state = 'live'").select(F.col("uid").alias("to_uid"))
    progression = way.join(edges, ["uid", "to_uid"]).join(live, "to_uid", "left_semi").select("uid")
    wrong = e.where("rarity NOT IN ('UR', 'SSR')")
    return wrong.where("rarity <> 'SR'").union(wrong.where("rarity = 'SR'").join(progression, "uid", "left_anti").select(*wrong.columns))


@check("structural")
def evolution_endpoint_shipped(b: Build) -> DataFrame:
    shipped = b["mart_equipment"].select("uid")
    rows = lambda n: b[f"mart_{n}"].select(F.lit(n).alias("table_name"), "kind", "from_uid", "to_uid").distinct()
    ends = rows("evolution_edge").union(rows("evolution_material"))
    return ends.join(shipped, F.col("from_uid") == F.col("uid"), "left_anti").join(shipped, F.col("to_uid") == F.col("uid"), "left_anti")


@check("structural")
def evolution_no_cycle(b: Build) -> DataFrame:
    return graph.in_cycles(b["mart_evolution_edge"])


@check("structural")
def one_operation_per_key(b: Build) -> DataFrame:
    return quality.unique_combination(b["int_changes"], ["entity_type", "entity_key"])


@check("structural")
def equipment_never_deleted(b: Build) -> DataFrame:
    there = b["mart_equipment"].select("uid").union(b["stg_parse_error"].select("source_id"))
    return known_equipment(b).select(F.col("entity_key").alias("uid")).join(there, "uid", "left_anti")


@check("structural")
def ledgers_append_only(b: Build) -> DataFrame:
    lost = lambda n, key: changes.missing_from(b.prev(n), b[f"mart_{n}"]).select(F.lit(n).alias("ledger"), F.col(key).alias("entity_key"))
    return lost("uid_retired", "uid").union(lost("uid_alias", "old_uid"))


def key_checks(b: Build) -> list[Expectation]:
    """Columns that must not be null, keys that must not repeat, and parents that must be there."""
    out = []
    for name in MARTS:
        for column in contract(name)[1]:
            out.append(Expectation(f"not_null.{name}.{column}", quality.not_null(b[f"mart_{name}"], column)))
    for name, keys in KEYS.items():
        out.append(Expectation(f"unique.{name}", quality.unique_combination(b[f"mart_{name}"], keys)))
    for child, column, parent, key in PARENTS:
        out.append(Expectation(f"relationship.{child}.{column}", quality.relationships(b[f"mart_{child}"], column, b[f"mart_{parent}"], key)))
    for kind, parent, key in (("proc", "proc", "proc_id"), ("weapon_ability", "weapon_ability", "uid"), ("monster_skill", "monster_skill", "skill_id"), ("passive_skill", "passive_skill", "passive_id")):
        keys = b[f"mart_{parent}"].select(F.col(key).cast("string").alias(key))
        out.append(Expectation(f"owner.{kind}", quality.polymorphic_relationship(b["mart_effect_link"], "owner_kind", kind, "owner_id", keys, key)))
    out.append(Expectation("owner.potential_level", quality.polymorphic_relationship(b["mart_effect_link"], "owner_kind", "potential_level", "owner_id", None, None)))
    return out


KEYS = {
    "equipment": ["uid"], "weapon": ["uid"], "defensive_gear": ["uid"], "monster": ["uid"], "stat": ["uid", "label", "tier"], "proc": ["proc_id"], "proc_family": ["family_id"],
    "proc_condition": ["proc_id", "ordinal"], "proc_scaling": ["proc_id", "ordinal"], "skill_effect": ["effect_id"], "passive_skill": ["passive_id"], "monster_skill": ["skill_id"],
    "weapon_ability": ["uid"], "item": ["uid"], "icon": ["sha256"], "element": ["element_id"], "potential_level": ["uid", "level"], "evolution_edge": ["kind", "from_uid", "to_uid"],
    "evolution_chain": ["kind", "uid"], "uid_retired": ["uid"], "uid_alias": ["old_uid"],
}
PARENTS = [
    ("weapon", "uid", "equipment", "uid"), ("weapon", "proc_id", "proc", "proc_id"), ("weapon", "ability_uid", "weapon_ability", "uid"), ("defensive_gear", "uid", "equipment", "uid"),
    ("defensive_gear", "proc_id", "proc", "proc_id"), ("monster", "uid", "equipment", "uid"), ("monster", "passive_id", "passive_skill", "passive_id"), ("stat", "uid", "equipment", "uid"),
    ("proc", "family_id", "proc_family", "family_id"), ("proc", "element_id", "element", "element_id"), ("proc_condition", "proc_id", "proc", "proc_id"), ("proc_scaling", "proc_id", "proc", "proc_id"),
    ("effect_link", "effect_id", "skill_effect", "effect_id"), ("potential_level", "effect_id", "skill_effect", "effect_id"), ("equipment", "icon_sha", "icon", "sha256"),
    ("equipment", "element_id", "element", "element_id"), ("evolution_chain", "uid", "equipment", "uid"),
]


# --- info: worth knowing


@check("info")
def alias_csv_removed(b: Build) -> DataFrame:
    return b.prev("uid_alias").select("old_uid", "new_uid").join(listed(b, "confirmed_aliases").select("old_uid"), "old_uid", "left_anti")


@check("info")
def alias_deferred(b: Build) -> DataFrame:
    settled = b.prev("uid_alias").select("old_uid").union(b["int_alias_new"].select("old_uid"))
    return listed(b, "confirmed_aliases").join(settled, "old_uid", "left_anti")


@check("info")
def deferred_shared_deletes(b: Build) -> DataFrame:
    from millrace.models.history import DELETABLE

    now = b["int_aggregate_hash_game"].unionByName(b["int_aggregate_hash_ledger"]).select("entity_type", "entity_key")
    failed = known_equipment(b).join(b["stg_parse_error"], F.col("entity_key") == F.col("source_id"), "left_semi").agg((F.count("*") > 0).alias("deferred"))
    gone = b.prev("entity_current").where("last_operation <> 'DELETE'").where(F.col("entity_type").isin(DELETABLE)).select("entity_type", "entity_key").join(now, ["entity_type", "entity_key"], "left_anti")
    return gone.join(F.broadcast(failed)).where("deferred").drop("deferred")


@check("info")
def evolution_material_dropped(b: Build) -> DataFrame:
    return b["int_evolution_material"].where("NOT attributed").select("source_uid", "kind", "ordinal", "ref_uid", "ref_name")


@check("info")
def evolution_unresolved_ref(b: Build) -> DataFrame:
    return b["int_unresolved_ref"]


@check("info")
def item_name_conflict(b: Build) -> DataFrame:
    return b["int_item"].where("name_variants > 1")


@check("info")
def weapon_ability_conflict(b: Build) -> DataFrame:
    return b["int_weapon_ability"].where("name_variants > 1").select("uid", "name", "name_variants")


@check("info")
def listing_detail_disagree(b: Build) -> DataFrame:
    e = b["stg_equipment"].select(F.col("source_uid").alias("item_id"), "model_class", F.col("rarity").alias("detail_rarity"))
    group = F.when(F.col("model_class") == "defensive_gear", "armor").otherwise(F.col("model_class"))
    return b["stg_listing"].join(e, "item_id").where((F.upper("rarity") != F.upper("detail_rarity")) | (F.col("grp") != group)).select("item_id", "grp", "model_class", F.col("rarity").alias("listing_rarity"), "detail_rarity")


@check("info")
def max_potential_iff_hidden_potential(b: Build) -> DataFrame:
    split = mark(b["mart_monster"].select("uid"), ["uid"], b["mart_stat"].where("tier IN ('max1', 'max2')"), "split")
    return mark(split, ["uid"], b["mart_potential_level"], "potential").where("split <> potential")


@check("info")
def proc_name_element_without_scaling(b: Build) -> DataFrame:
    return b["int_proc"].where("name_element IS NOT NULL AND scaling_elements = 0").select("proc_id", "raw_name", "name_element").distinct()


# --- policy: rows that the gate weighs


def of_items(b: Build, rows: DataFrame, detail: Column | None = None, key: str = "uid") -> DataFrame:
    """Gate rows of shipped items."""
    e = b["mart_equipment"].select(F.col("uid").alias("_e"), F.col("entry_kind").alias("_kind"))
    first = b["int_first_seen"].select(F.col("uid").alias("_f"), F.col("is_new_item").alias("_new"))
    joined = rows.join(e, F.col(key) == F.col("_e")).join(first, F.col(key) == F.col("_f"))
    more = {} if detail is None else {"detail": detail}
    return gate_rows(joined, entity_type=F.lit("equipment"), entity_key=F.col(key), entry_kind=F.col("_kind"), is_new_item=F.col("_new"), **more)


def of_procs(b: Build, rows: DataFrame, detail: Column) -> DataFrame:
    """Gate rows of procs; a proc is in the catalog if one of its owners is."""
    scope = b["int_scope_member"].select(F.col("uid").alias("source_uid"), F.coalesce("entry_kind", F.lit("catalog")).alias("_kind"))
    owners = b["int_proc"].select("source_uid", "proc_id").join(scope, "source_uid", "left").groupBy("proc_id").agg(F.min(F.coalesce("_kind", F.lit("catalog"))).alias("_kind"))
    joined = rows.join(owners.hint(MEET), "proc_id")
    return gate_rows(joined, entity_type=F.lit("proc"), entity_key=F.col("proc_id"), entry_kind=F.col("_kind"), detail=detail).distinct()


@check("policy")
def count_drop(b: Build) -> DataFrame:
    was = b.prev("population").where((F.col("run_id") == F.lit(b.run.prev_run_id)) & (F.col("scope") == "catalog")).select(F.col("value").alias("was"))
    now = b["int_population"].where("scope = 'catalog'").select(F.col("value").alias("now"))
    less = was.join(F.broadcast(now)).where("was > now")
    return gate_rows(less, entity_type=F.lit("equipment"), entity_key=F.lit("*"), entry_kind=F.lit("catalog"), affected=F.expr("was - now"), detail=F.expr("concat('live catalog ', was, ' -> ', now)"))


@check("policy")
def icon_missing(b: Build) -> DataFrame:
    return of_items(b, b["mart_equipment"].where("state = 'live' AND icon_sha IS NULL").select("uid"))


@check("policy")
def optional_field_null(b: Build) -> DataFrame:
    gap = lambda df, text: df.select("uid", F.lit(text).alias("gap"))
    tiers = b["mart_stat"].groupBy("uid", "label").agg(F.bool_or(F.col("tier") == "initial").alias("a"), F.bool_or(F.col("tier").startswith("max")).alias("z"))
    gaps = tiers.where("a AND NOT z").select("uid", F.concat(F.lit("stat "), "label", F.lit(" has no max tier")).alias("gap"))
    for more in (
        gap(b["mart_equipment"].where("max_level = 0"), "max_level = 0"), gap(b["mart_weapon"].where("proc_id IS NULL"), "weapon without proc"),
        gap(b["mart_defensive_gear"].where("proc_id IS NULL"), "defensive gear without proc"), gap(b["mart_monster"].join(b["mart_monster_skill"].select("uid"), "uid", "left_anti"), "monster without skills"),
    ):
        gaps = gaps.union(more)
    live = b["mart_equipment"].where("state = 'live'").select("uid")
    # an item has a few gaps: one for each label and four more
    listed_gaps = gaps.join(live, "uid", "left_semi").groupBy("uid").agg(F.array_join(F.sort_array(F.collect_list("gap")), "; ").alias("gaps"))
    return of_items(b, listed_gaps, F.col("gaps"))


@check("policy")
def parse_failure(b: Build) -> DataFrame:
    scope = b["int_scope_member"].select(F.col("uid").alias("source_id"), "entry_kind")
    seen = b.prev("equipment_seen").select(F.col("uid").alias("source_id"))
    rows = mark(b["stg_parse_error"], ["source_id"], seen, "seen").join(scope, "source_id", "left")
    new = ~F.col("seen") & F.lit(not b.run.bootstrap)
    return gate_rows(rows, entity_type=F.lit("equipment"), entity_key=F.col("source_id"), entry_kind=F.coalesce("entry_kind", F.lit("catalog")), is_new_item=new, detail=F.col("error"))


@check("policy")
def retired(b: Build) -> DataFrame:
    return of_items(b, b["int_equipment_status"].where("newly_retired").select("uid", "retire_reason"), F.col("retire_reason"))


@check("policy")
def unexplained_churn(b: Build) -> DataFrame:
    same = b.run.prev_parser_version == b.run.parser_version and b.run.prev_transform_version in (None, b.run.transform_version)
    updated = b["int_changes"].where("entity_type = 'equipment' AND operation = 'UPDATE'").select(F.col("entity_key").alias("uid"))
    steady = b["int_equipment_status"].where("NOT revived").select("uid")
    return of_items(b, updated.join(steady, "uid", "left_semi").where(F.lit(same)))


@check("policy")
def unknown_vocabulary(b: Build) -> DataFrame:
    known = lambda domain: b["vocabulary"].where(F.col("domain") == domain).select(F.col("value").alias("_v"))
    out = []
    for table, column, domain in (("mart_equipment", "gear_type", "gear_type"), ("mart_stat", "label", "stat_label"), ("mart_stat", "tier", "stat_tier")):
        rows = b[table].select("uid", column).distinct().join(known(domain), F.col(column) == F.col("_v"), "left_anti")
        out.append(of_items(b, rows, F.concat(F.lit(f"{column} "), column)))
    kinds = b["mart_proc_scaling"].select("proc_id", "scale_kind").join(known("scale_kind"), F.col("scale_kind") == F.col("_v"), "left_anti")
    out.append(of_procs(b, kinds, F.concat(F.lit("scale_kind "), "scale_kind")))
    odd = b["int_proc"].where(F.col("size").isNull() & F.col("raw_name").rlike(r"(?i)\s[0-9]*x*[sml]\+*\z"))
    out.append(of_procs(b, odd.select("proc_id", "raw_name"), F.col("raw_name")))
    rows = out[0]
    for o in out[1:]:
        rows = rows.unionByName(o)
    return rows


@check("policy")
def unlisted_release(b: Build) -> DataFrame:
    return gate_rows(b["stg_unlisted_release"], entity_type=F.lit("unlisted_release"), entity_key=F.col("item_id"), entry_kind=F.lit("catalog"), runs=F.col("runs"), detail=F.col("name"))


@check("policy")
def wiki_contradiction(b: Build) -> DataFrame:
    several = b["int_evolution_edge"].select("kind", "to_uid", "from_uid").distinct().groupBy("kind", "to_uid").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("from_uid")).alias("from")).where("n > 1")
    scope = b["int_scope_member"].select(F.col("uid").alias("to_uid"), "entry_kind")
    joined = several.join(scope, "to_uid", "left")
    one = gate_rows(joined, entity_type=F.lit("equipment"), entity_key=F.col("to_uid"), entry_kind=F.coalesce("entry_kind", F.lit("catalog")), detail=F.concat("kind", F.lit(": "), F.array_join("from", ", ")))
    p = b["int_proc"].select("proc_id", "raw_name", "name_element", "scaling_element", "scaling_elements")
    two = of_procs(b, p.where("name_element <> scaling_element"), F.concat("raw_name", F.lit(": name "), "name_element", F.lit(", scaling "), "scaling_element"))
    three = of_procs(b, p.where("scaling_elements > 1"), F.col("raw_name"))
    return one.unionByName(two).unionByName(three)


def expectations(b: Build, groups: tuple[str, ...] = ("contract", "structural", "info")) -> list[Expectation]:
    asked = {name: (group, function) for name, (group, function) in CHECKS.items() if group in groups}
    made = together((name, lambda function=function: function(b)) for name, (_, function) in asked.items())
    return [Expectation(name, rows, asked[name][0]) for name, rows in made]


def gate_input(b: Build) -> DataFrame:
    """The rows of all policy checks, with the check's name."""
    made = together((name, lambda function=function: function(b)) for name, (group, function) in CHECKS.items() if group == "policy")
    rows = [found.withColumn("check", F.lit(name)) for name, found in made]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out

"""Items, their parts and their links, cleaned and named; and the tables that are shipped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, conform, hash_id, iso_ts
from millrace.models.build import MEET, Build, model
from millrace.operators import graph, lifecycle, naming
from millrace.operators.selection import latest_by, with_distinct_count


def plain(column: str):
    return clean_text(column, empty_as_null=False)


def elements(b: Build) -> list[str]:
    """Names of the elements but ``none``: a fixed vocabulary of a few words."""
    return [r.element_id for r in b["stg_element"].where("element_id <> 'none'").distinct().orderBy("element_id").collect()]


def fetched(b: Build) -> DataFrame:
    return b["stg_page"].select(F.col("item_id").alias("source_uid"), "fetched_at")


@model()
def int_scope_member(b: Build) -> DataFrame:
    in_scope = F.coalesce(F.col("decided_run_id") == b.run.last_complete_run, F.lit(False))
    return b["stg_frontier"].select(
        F.col("item_id").alias("uid"), "source", "entry_kind", "keep_reason", "depth", "parent_id", F.col("state").alias("frontier_state"),
        "last_error", "decided_run_id", "discovered_at", in_scope.alias("in_scope"),
    )


@model(stored=True)
def int_equipment_status(b: Build) -> DataFrame:
    known = b.known_equipment()
    frontier = b["int_scope_member"].select(F.col("uid").alias("item_id"), "frontier_state", "decided_run_id")
    items = b["stg_equipment"].select(F.col("source_uid").alias("uid"))
    return lifecycle.equipment_status(items, frontier, known, last_complete_run=F.lit(b.run.last_complete_run), revision=b.revision)


@model(stored=True)
def int_first_seen(b: Build) -> DataFrame:
    seen = b.prev("equipment_seen").select(F.col("uid").alias("_s"), F.col("first_seen").alias("_seen"), "first_revision")
    found = b["int_scope_member"].select(F.col("uid").alias("_f"), "discovered_at")
    joined = (
        b["stg_equipment"].select(F.col("source_uid").alias("uid")).join(seen, F.col("uid") == F.col("_s"), "left")
        .join(found, F.col("uid") == F.col("_f"), "left").join(fetched(b), F.col("uid") == F.col("source_uid"), "left")
    )
    first = joined.select(
        "uid", F.coalesce("_seen", "discovered_at", "fetched_at", b.now).alias("first_seen"),
        F.coalesce("first_revision", b.revision).alias("first_revision"), F.col("_s").isNull().alias("is_new"),
    ).withColumn("_at", iso_ts("first_seen"))
    marked = lifecycle.new_items(first, "_at", iso_ts(b.now), b.run.new_item_days).drop("_at")
    return marked.withColumn("is_new_item", F.col("is_new_item") & F.lit(not b.run.bootstrap))


@model(stored=True)
def int_ship_equipment(b: Build) -> DataFrame:
    shown = b["stg_asset"].where("kind = 'equipment' AND sha256 IS NOT NULL")
    icons = latest_by(shown, ["item_id"], [F.desc_nulls_last("fetched_at"), F.asc("url")]).select(F.col("item_id").alias("_i"), F.col("sha256").alias("icon_sha"))
    scope = b["int_scope_member"].select(F.col("uid").alias("_f"), "entry_kind", "keep_reason", "depth")
    status = b["int_equipment_status"].select("uid", "state", "retired_revision")
    first = b["int_first_seen"].select("uid", "first_seen")
    e = b["stg_equipment"].withColumnRenamed("source_uid", "uid").join(status, "uid").join(first, "uid")
    e = e.join(scope, F.col("uid") == F.col("_f"), "left").join(icons, F.col("uid") == F.col("_i"), "left")
    return e.select(
        "uid", clean_text("name").alias("name"), F.upper(clean_text("rarity")).alias("rarity"), clean_text("gear_type").alias("gear_type"), "cost", "element_id", "max_level",
        "icon_sha", F.coalesce("entry_kind", F.lit("reference")).alias("entry_kind"), F.coalesce("keep_reason", F.lit("unknown")).alias("keep_reason"),
        F.coalesce("depth", F.lit(0)).alias("evo_depth"), "state", "retired_revision", "first_seen",
    )


@model()
def int_icon(b: Build) -> DataFrame:
    # many items share an icon: each is taken once from both sides, so that no hash's items meet all its assets
    a = b["stg_asset"].where("kind = 'equipment'").select("sha256", F.lit("equipment").alias("kind"), F.col("body_bytes").alias("bytes")).distinct()
    return a.join(b["int_ship_equipment"].select(F.col("icon_sha").alias("sha256")).distinct(), "sha256", "left_semi")


def newest_name(refs: DataFrame, order: list) -> DataFrame:
    """The newest name of each uid, with the number of different names it has."""
    return latest_by(with_distinct_count(refs.hint(MEET), ["uid"], "name", "name_variants"), ["uid"], order)


@model()
def int_item(b: Build) -> DataFrame:
    m = b["stg_evolution_material"].where("material_kind = 'item' AND ref_uid IS NOT NULL")
    refs = m.join(fetched(b), "source_uid", "left").select(F.col("ref_uid").alias("uid"), F.coalesce(plain("ref_name"), F.lit("")).alias("name"), "fetched_at", "source_uid")
    return newest_name(refs, [F.desc_nulls_last("fetched_at"), F.desc("source_uid"), F.asc("name")]).select("uid", "name", "name_variants")


@model()
def int_weapon_ability(b: Build) -> DataFrame:
    refs = b["stg_weapon_ability"].join(fetched(b), "source_uid", "left").select("uid", plain("name").alias("name"), "fetched_at", "source_uid")
    return newest_name(refs, [F.desc_nulls_last("fetched_at"), F.desc("source_uid")]).select("uid", "name", "source_uid", "name_variants")


@model()
def int_monster_skill(b: Build) -> DataFrame:
    return b["stg_monster_skill"].select(hash_id("source_uid", "ordinal").alias("skill_id"), F.col("source_uid").alias("uid"), "ordinal", plain("name").alias("name"))


@model()
def int_passive_skill(b: Build) -> DataFrame:
    return b["stg_passive_skill"].select("source_uid", plain("name").alias("name"), "effect_hash").withColumn("passive_id", hash_id("name", "effect_hash"))


@model(stored=True)
def int_effect_line(b: Build) -> DataFrame:
    levels = b["stg_potential_level"].select("source_uid", F.lit("potential_level").alias("owner_kind"), F.col("level").alias("owner_ordinal"), F.lit(1).cast("long").alias("ordinal"), "target", "description")
    lines = b["stg_skill_effect"].unionByName(levels)
    cleaned = lines.select("source_uid", "owner_kind", "owner_ordinal", "ordinal", clean_text("target").alias("target"), plain("description").alias("description"))
    return cleaned.withColumn("effect_id", hash_id("target", "description"))


@model()
def int_skill_effect(b: Build) -> DataFrame:
    return b["int_effect_line"].select("effect_id", "target", "description").distinct()


@model()
def int_effect_link(b: Build) -> DataFrame:
    owners = [
        b["int_proc"].select(F.lit("proc").alias("owner_kind"), "source_uid", F.lit(None).cast("long").alias("at"), F.col("proc_id").cast("string").alias("owner_id")),
        b["int_weapon_ability"].select(F.lit("weapon_ability"), "source_uid", F.lit(None).cast("long"), "uid"),
        b["int_monster_skill"].select(F.lit("monster_skill"), "uid", "ordinal", F.col("skill_id").cast("string")),
        b["int_passive_skill"].select(F.lit("passive_skill"), "source_uid", F.lit(None).cast("long"), F.col("passive_id").cast("string")),
    ]
    all_owners = owners[0]
    for o in owners[1:]:
        all_owners = all_owners.union(o)
    joined = b["int_effect_line"].join(all_owners, ["owner_kind", "source_uid"])
    return joined.where("at IS NULL OR at = owner_ordinal").select("owner_kind", "owner_id", "ordinal", "effect_id").distinct()


@model(stored=True)
def int_proc_scaling(b: Build) -> DataFrame:
    procs = b["stg_proc"].select("source_uid", hash_id(plain("name"), "effect_hash").alias("proc_id"))
    lines = b["stg_proc_scaling"].join(procs, "source_uid").withColumn("description", plain("description"))
    return naming.scaling(lines, "description", elements(b)).select("source_uid", "proc_id", "ordinal", "scale_kind", "element_id", "gear_kind", "cap", "pieces_needed", "description")


@model(stored=True)
def int_proc(b: Build) -> DataFrame:
    p = b["stg_proc"].select("source_uid", plain("name").alias("raw_name"), "effect_hash", clean_text("activation_rate").alias("activation_rate"))
    p = naming.decompose(p.withColumn("proc_id", hash_id("raw_name", "effect_hash")), "raw_name", elements(b))
    s = b["int_proc_scaling"].groupBy("source_uid").agg(F.countDistinct("element_id").alias("scaling_elements"), F.min("element_id").alias("_one"))
    p = p.join(s, "source_uid", "left").withColumn("scaling_element", F.when(F.col("scaling_elements") == 1, F.col("_one"))).drop("_one")
    return p.withColumn("scaling_elements", F.coalesce("scaling_elements", F.lit(0))).withColumn("element_id", F.col("scaling_element"))


@model()
def int_proc_condition(b: Build) -> DataFrame:
    return b["stg_proc_condition"].join(b["int_proc"].select("source_uid", "proc_id"), "source_uid").select("source_uid", "proc_id", "ordinal", plain("condition").alias("condition"))


@model(stored=True)
def int_evolution_edge(b: Build) -> DataFrame:
    names = b["stg_equipment"].select(F.col("source_uid").alias("uid"), plain("name").alias("name"))
    claims = b["stg_evolution"].where("before_uid IS NOT NULL").select("kind", F.col("before_uid").alias("from_uid"), F.col("source_uid").alias("to_uid"), F.coalesce(plain("before_name"), F.lit("")).alias("_from"))
    to = names.select(F.col("uid").alias("to_uid"), F.col("name").alias("to_name"))
    from_ = names.select(F.col("uid").alias("from_uid"), F.col("name").alias("_name"))
    return claims.join(to, "to_uid").join(from_, "from_uid", "left").select("kind", "from_uid", "to_uid", F.coalesce("_name", "_from").alias("from_name"), "to_name")


@model()
def int_evolution_material(b: Build) -> DataFrame:
    after = b["int_evolution_edge"].groupBy("kind", F.col("from_uid").alias("source_uid")).agg(F.min("to_uid").alias("_to"), F.count("*").alias("_n"))
    m = b["stg_evolution_material"].join(after, ["kind", "source_uid"], "left")
    one = F.coalesce(F.col("_n") == 1, F.lit(False))
    return m.select(
        "kind", F.when(one, F.col("source_uid")).alias("from_uid"), F.when(one, F.col("_to")).alias("to_uid"), "ordinal", "material_kind", "ref_uid",
        F.coalesce(plain("ref_name"), F.lit("")).alias("ref_name"), "quantity", "source_uid", one.alias("attributed"),
    )


@model(stored=True)
def int_evolution_chain(b: Build) -> DataFrame:
    return graph.chains(b["int_evolution_edge"]).join(b["int_ship_equipment"].select("uid"), "uid", "left_semi").select("kind", "chain_id", "uid", "position")


@model()
def int_unresolved_ref(b: Build) -> DataFrame:
    shipped = b["int_ship_equipment"].select("uid")
    end = lambda own, other, name, role: b["int_evolution_edge"].select("kind", F.col(own).alias("uid"), F.lit(role).alias("role"), F.col(other).alias("other_uid"), F.col(name).alias("name"))
    return end("from_uid", "to_uid", "from_name", "from").union(end("to_uid", "from_uid", "to_name", "to")).join(shipped, "uid", "left_anti").select("kind", "uid", "role", "other_uid", "name")


@model()
def int_source_lineage(b: Build) -> DataFrame:
    page = b["stg_page"].select(F.col("item_id").alias("uid"), F.col("url").alias("source_url"), F.col("html_sha256").alias("source_hash"), "etag", F.col("fetched_at").alias("retrieved_at"), F.col("run_id").alias("crawl_run_id"))
    scope = b["int_scope_member"].select("uid", "keep_reason", "entry_kind", "depth", "parent_id")
    return b["stg_equipment"].select(F.col("source_uid").alias("uid")).join(page, "uid").join(scope, "uid", "left")


@model()
def int_population(b: Build) -> DataFrame:
    live = b["int_ship_equipment"].where("state = 'live'").join(b["int_first_seen"].select("uid", "is_new_item"), "uid")
    counts = live.agg(*[F.count_if(c).alias(n) for n, c in (("catalog", F.col("entry_kind") == "catalog"), ("reference", F.col("entry_kind") == "reference"), ("new_item", F.col("is_new_item")))])
    return counts.unpivot([], ["catalog", "reference", "new_item"], "scope", "value")


#: Shipped tables: where their rows come from, and their columns with types, in order; those marked ! are never null.
MARTS = {
    "element": ("stg_element", "element_id string!"),
    "element_relation": ("stg_element_relation", "element_id string!, related_id string!, kind string!"),
    "item": ("int_item", "uid string!, name string!"),
    "icon": ("int_icon", "sha256 string!, kind string!, bytes long"),
    "skill_effect": ("int_skill_effect", "effect_id long!, target string, description string!"),
    "proc_family": (None, "family_id long!, name string!"),
    "proc": ("int_proc", "proc_id long!, family_id long!, element_id string, size string, raw_name string!, activation_rate string, element_position string"),
    "proc_condition": ("int_proc_condition", "proc_id long!, ordinal long!, condition string!"),
    "proc_scaling": ("int_proc_scaling", "proc_id long!, ordinal long!, scale_kind string!, element_id string, gear_kind string, cap string, pieces_needed long, description string!"),
    "weapon_ability": ("int_weapon_ability", "uid string!, name string!"),
    "passive_skill": ("int_passive_skill", "passive_id long!, name string!, effect_hash string!"),
    "weapon": (None, "uid string!, infusion_count long!, proc_id long, ability_uid string"),
    "defensive_gear": (None, "uid string!, infusion_count long!, proc_id long"),
    "monster": (None, "uid string!, passive_id long, restrictions string"),
    "monster_skill": ("int_monster_skill", "skill_id long!, uid string!, ordinal long!, name string!"),
    "potential_level": (None, "uid string!, level long!, effect_id long!"),
    "effect_link": ("int_effect_link", "owner_kind string!, owner_id string!, ordinal long!, effect_id long!"),
    "stat": (None, "uid string!, label string!, tier string!, value long!"),
    "evolution_edge": ("int_evolution_edge", "kind string!, from_uid string!, to_uid string!, from_name string!, to_name string!"),
    "evolution_chain": ("int_evolution_chain", "kind string!, chain_id string!, uid string!, position long!"),
    "evolution_material": (None, "kind string!, from_uid string!, to_uid string!, ordinal long!, material_kind string!, ref_uid string, ref_name string!, quantity long!"),
    "equipment": (None, "uid string!, name string!, rarity string!, gear_type string!, cost long!, element_id string!, max_level long!, icon_sha string, entry_kind string!, keep_reason string!, evo_depth long!, state string!, retired_revision long, first_seen string!, last_seen string!, last_changed_revision long!"),
    "uid_retired": (None, "uid string!, since_revision long!, reason string!"),
    "uid_alias": (None, "old_uid string!, new_uid string!, since_revision long!, confirmed_commit string!"),
}
#: Tables whose rows several records share: equal rows are one.
SHARED = {"element", "element_relation", "proc", "proc_family", "proc_condition", "proc_scaling", "passive_skill"}


def contract(name: str) -> tuple[dict[str, str], list[str]]:
    fields = [f.split() for f in MARTS[name][1].split(", ")]
    return {n: t.rstrip("!") for n, t in fields}, [n for n, t in fields if t.endswith("!")]


def mart(name: str):
    def decorate(rows):
        def made(b: Build) -> DataFrame:
            types, required = contract(name)
            df = rows(b).select(*types)
            return conform(df.distinct() if name in SHARED else df, types, required)

        made.__name__ = f"mart_{name}"
        return model(stored=True)(made)

    return decorate


for _name, (_source, _) in MARTS.items():
    if _source:
        mart(_name)(lambda b, source=_source: b[source])


def by_source(b: Build, name: str) -> DataFrame:
    """The proc, passive or ability of each item."""
    column = {"int_proc": "proc_id", "int_passive_skill": "passive_id"}[name]
    return b[name].select("source_uid", column)


@model()
def int_shipped(b: Build) -> DataFrame:
    """What mart_equipment has but for the two columns that tell of the change log, under its contract."""
    types, required = contract("equipment")
    kept = {c: t for c, t in types.items() if c not in ("last_seen", "last_changed_revision")}
    return conform(b["int_ship_equipment"], kept, [c for c in required if c in kept])


@mart("proc_family")
def _proc_family(b: Build) -> DataFrame:
    return b["int_proc"].select("family_id", F.col("family_name").alias("name"))


@mart("weapon")
def _weapon(b: Build) -> DataFrame:
    ability = b["stg_weapon_ability"].select("source_uid", F.col("uid").alias("ability_uid"))
    w = b["stg_weapon"].join(by_source(b, "int_proc"), "source_uid", "left").join(ability, "source_uid", "left")
    return w.withColumnRenamed("source_uid", "uid")


@mart("defensive_gear")
def _defensive_gear(b: Build) -> DataFrame:
    return b["stg_defensive_gear"].join(by_source(b, "int_proc"), "source_uid", "left").withColumnRenamed("source_uid", "uid")


@mart("monster")
def _monster(b: Build) -> DataFrame:
    m = b["stg_monster"].join(by_source(b, "int_passive_skill"), "source_uid", "left")
    return m.select(F.col("source_uid").alias("uid"), "passive_id", clean_text("restrictions").alias("restrictions"))


@mart("potential_level")
def _potential_level(b: Build) -> DataFrame:
    return b["int_effect_line"].where("owner_kind = 'potential_level'").select(F.col("source_uid").alias("uid"), F.col("owner_ordinal").alias("level"), "effect_id")


@mart("stat")
def _stat(b: Build) -> DataFrame:
    return b["stg_stat"].select(F.col("source_uid").alias("uid"), plain("label").alias("label"), plain("tier").alias("tier"), "value")


@mart("evolution_material")
def _evolution_material(b: Build) -> DataFrame:
    return b["int_evolution_material"].where("attributed")

"""Catalogue pages to typed records of many tables: each page is parsed once, into one written table of tagged records.

A page gives records of several tables. All are made from its parsed rows by column expressions and lie in one array, so
that a page is judged whole: one whose record keys repeat, whose fields hold control separators, or that has two slots for
one thing, gives an error row and no records; so does every page whose id another page has. The records are written once,
tagged with their table, and each table is a typed selection from what is written; nothing is parsed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import effects as fx
from millrace.functions.pages import cell, page_tables, rows_of, spread
from millrace.sources.versions import Store

#: The fields of each table after ``uid``, and those that tell its records of a page apart.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "equipment": ("name string, model_class string, rarity string, gear_type string, cost long, element string, max_level long", ()),
    "weapon": ("infusion_count long", ()),
    "defensive_gear": ("infusion_count long", ()),
    "monster": ("restrictions string", ()),
    "stat": ("label string, tier string, value long", ("label", "tier")),
    "proc": ("name string, activation_rate string", ()),
    "weapon_ability": ("ability string, name string", ()),
    "monster_skill": ("ordinal long, name string", ("ordinal",)),
    "passive_skill": ("name string", ()),
    "skill_effect": ("owner_kind string, owner_ordinal long, ordinal long, target string, description string", ("owner_kind", "owner_ordinal", "ordinal")),
    "potential_level": ("level long, target string, description string", ("level",)),
    "evolution": ("kind string, before_uid string, before_name string", ("kind",)),
    "evolution_material": ("kind string, ordinal long, material_kind string, ref_uid string, ref_name string, quantity long", ("kind", "ordinal")),
}
RECORD = "array<struct<name: string, key: string, fields: map<string, string>>>"
EVOLUTIONS = ("reforge", "awakening", "enlightening")
ITEM_LINK = "/item/"
#: Characters that separate fields in hashes and may not be in any.
CONTROL = r"[\x1C-\x1F]"
ERROR = "page_id long, error string"


@dataclass(frozen=True)
class Kinds:
    """Which gear types are weapons and which monsters; all others are defensive gear."""

    weapons: tuple[str, ...]
    monsters: tuple[str, ...]


def _text(fields: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])


def _record(table: str, /, **fields: Column) -> Column:
    key = F.concat_ws(" ", F.lit(table), *[fields[k].cast("string") for k in TABLES[table][1]])
    return F.struct(F.lit(table).alias("name"), key.alias("key"), _text(fields).alias("fields"))


def _none() -> Column:
    return F.array().cast(RECORD)


def _if(condition: Column, *records: Column) -> Column:
    return F.when(condition, F.array(*records)).otherwise(_none())


def _each(array: Column, record) -> Column:
    return F.coalesce(F.transform(array, record), _none())


def _effects(lines: Column, kind: str, owner: Column) -> Column:
    return _each(lines, lambda e, i: _record("skill_effect", owner_kind=F.lit(kind), owner_ordinal=owner, ordinal=i + 1, target=e["target"], description=e["description"]))


def _first(row: Column, i: int = 0) -> Column:
    return F.get(row["cells"], F.lit(i))


def _item(row: Column, i: int = 0) -> Column:
    """The id that a cell's link leads to."""
    link = F.get(row["links"], F.lit(i))
    return F.when(F.startswith(link, F.lit(ITEM_LINK)), F.substring(link, len(ITEM_LINK) + 1, 1 << 20))


def _before(rows: Column, kind: str) -> Column:
    return F.filter(rows, lambda r: r["label"] == f"before {kind}")


def _evolution(rows: Column, kind: str) -> Column:
    """The record of what came before, if there is any trace of the evolution, and one for each material."""
    before = F.get(_before(rows, kind), F.lit(0))
    materials = F.filter(rows, lambda r: r["label"].isin(f"{kind} gear material", f"{kind} item material"))
    found = before.isNotNull() | (F.size(materials) > 0)
    one = _record("evolution", kind=F.lit(kind), before_uid=_item(before), before_name=_first(before))
    many = _each(
        materials,
        lambda r, i: _record(
            "evolution_material", kind=F.lit(kind), ordinal=i + 1, material_kind=F.when(r["label"].contains("gear"), "gear").otherwise("item"),
            ref_uid=_item(r), ref_name=_first(r), quantity=fx.whole_number(_first(r, 1), 1),
        ),
    )
    return F.concat(_if(found, one), many)


def records(parsed: DataFrame, kinds: Kinds) -> DataFrame:
    """page_id, records (an array of all of the page's, tagged with their table) and error, one row for each page."""
    rows = F.col("rows")
    named = lambda name: rows_of(rows, name)
    skills = F.filter(rows, lambda r: r["section"].rlike("^skill( [0-9]+)?$"))
    gear = cell(rows, "gear type")
    weapon, monster = gear.isin(*kinds.weapons), gear.isin(*kinds.monsters)
    shield = ~weapon & ~monster
    skill, ability, passive = F.get(skills, F.lit(0)), F.get(named("weapon ability"), F.lit(0)), F.get(named("passive skill"), F.lit(0))
    potentials = F.filter(named("hidden potential"), lambda r: fx.potential_level(r["label"]).isNotNull())
    proc = fx.proc(_first(skill))
    made = [
        F.array(_record("equipment", name=F.col("title"), model_class=F.when(weapon, "weapon").when(monster, "monster").otherwise("defensive_gear"), rarity=cell(rows, "rarity"),
                        gear_type=gear, cost=fx.whole_number(cell(rows, "gear cost")), element=F.coalesce(cell(rows, "element"), F.lit("none")), max_level=fx.whole_number(cell(rows, "max level")))),
        _if(weapon, _record("weapon", infusion_count=fx.whole_number(cell(rows, "infusion count")))),
        _if(shield, _record("defensive_gear", infusion_count=fx.whole_number(cell(rows, "infusion count")))),
        _if(monster, _record("monster", restrictions=cell(named("hidden potential"), "restrictions"))),
        _each(named("stats"), lambda r: _record("stat", label=r["label"], tier=fx.stat_tier(_first(r)), value=fx.whole_number(_first(r, 1)))),
        _if(~monster & skill.isNotNull(), _record("proc", name=skill["label"], activation_rate=proc["rate"])),
        F.when(~monster, _effects(proc["effects"], "proc", F.lit(1))).otherwise(_none()),
        _if(weapon & ability.isNotNull(), _record("weapon_ability", ability=_item(ability), name=ability["label"])),
        F.when(weapon, _effects(fx.effect_structs(fx.effect_lines(_first(ability))), "weapon_ability", F.lit(1))).otherwise(_none()),
        F.when(monster, _each(skills, lambda r, i: _record("monster_skill", ordinal=i + 1, name=r["label"]))).otherwise(_none()),
        F.when(monster, F.flatten(F.transform(skills, lambda r, i: _effects(fx.effect_structs(fx.effect_lines(_first(r))), "monster_skill", i + 1)))).otherwise(_none()),
        _if(monster & passive.isNotNull(), _record("passive_skill", name=passive["label"])),
        F.when(monster, _effects(fx.effect_structs(fx.effect_lines(_first(passive))), "passive_skill", F.lit(1))).otherwise(_none()),
        F.when(monster, F.transform(potentials, lambda r: _potential(r))).otherwise(_none()),
        _evolution(named("reforge"), "reforge"), _evolution(named("special evolution"), "awakening"),
        F.when(monster, _evolution(named("special evolution"), "enlightening")).otherwise(_none()),
    ]
    every = F.concat(*[F.coalesce(m, _none()) for m in made])
    twice = [k for k in EVOLUTIONS if k != "reforge"]
    slots = F.coalesce(*[F.when(F.size(_before(named("reforge" if k == "reforge" else "special evolution"), k)) > 1, F.lit(f"two slots: before {k}")) for k in ("reforge", *twice)])
    whole = parsed.select("page_id", "error", gear.alias("_gear"), slots.alias("_slots"), F.when(F.col("error").isNull(), every).alias("records"))
    # in two steps, so that the array is made once
    keys, has = F.transform("records", lambda r: r["key"]), F.col("records").isNotNull()
    control = F.exists("records", lambda r: F.exists(F.map_values(r["fields"]), lambda v: F.coalesce(v.rlike(CONTROL), F.lit(False))))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.coalesce("_gear", F.lit("")) == "", "no gear type").when(F.col("_slots").isNotNull(), F.col("_slots"))
        .when(has & control, "a control separator in a field").when(has & (F.size(F.array_distinct(keys)) < F.size(keys)), "a repeated key")
    )
    judged = whole.withColumn("_error", error)
    return judged.select("page_id", F.when(F.col("_error").isNull(), F.col("records")).otherwise(_none()).alias("records"), F.col("_error").alias("error"))


def _potential(r: Column) -> Column:
    lines = fx.effect_structs(F.array(_first(r)))
    one = F.get(lines, F.lit(0))
    return _record("potential_level", level=fx.potential_level(r["label"]), target=one["target"], description=one["description"])


class Records:
    """The records of a set of pages, parsed and written once."""

    def __init__(self, pages: DataFrame, folder: str, kinds: Kinds, elements: tuple[str, ...] = ()):
        """pages: page_id and html; what is written lies in ``folder``. elements: rows of the table ``element``."""
        self.spark, self.elements = pages.sparkSession, elements
        store = Store(self.spark, folder)
        ready = records(page_tables(spread(pages)), kinds)
        tagged = ready.select("page_id", F.explode_outer(F.when(F.size("records") > 0, F.col("records"))).alias("r"), "error").select("page_id", "r.name", "r.key", "r.fields", "error")
        change = store.begin()
        change.replace("parsed", tagged)
        self.parsed = change.commit()["parsed"]
        met = self.parsed.where("error IS NOT NULL OR name = 'equipment'").groupBy("page_id").agg(F.count("*").alias("n"))
        self.repeated = met.where("n > 1").select("page_id")

    def tagged(self) -> DataFrame:
        """page_id, name, key and fields of all records of good pages."""
        return self.parsed.where("error IS NULL").join(self.repeated, "page_id", "left_anti").select("page_id", "name", "key", "fields")

    def errors(self) -> DataFrame:
        """page_id and error, a row for each bad page."""
        own = self.parsed.where("error IS NOT NULL").join(self.repeated, "page_id", "left_anti").select("page_id", "error")
        both = self.parsed.where("error IS NOT NULL OR name = 'equipment'").join(self.repeated, "page_id", "left_semi")
        return own.unionByName(both.select("page_id", F.lit("a repeated id").alias("error")))

    def __getitem__(self, name: str) -> DataFrame:
        """A table: uid (the page's id) and its typed fields."""
        if name == "element":
            return self.spark.createDataFrame([(e,) for e in self.elements], "element string")
        fields = T.StructType.fromDDL(TABLES[name][0]).fields
        rows = self.parsed.where((F.col("name") == name) & F.col("error").isNull()).join(self.repeated, "page_id", "left_anti")
        return rows.select(F.col("page_id").alias("uid"), *[F.col("fields")[f.name].cast(f.dataType).alias(f.name) for f in fields])

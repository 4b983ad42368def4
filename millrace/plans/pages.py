"""Queries on typed records of pages: a page for each document, of three kinds, some broken, each parsed once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models.pages import TABLES, Kinds, Records
from millrace.plans.catalog import ELEMENTS, table
from millrace.plans.registry import query
from millrace.plans.sourcing import folder

KINDS = Kinds(("sword",), ("beast",))


def _row(label: str, *cells: str) -> str:
    return f"'<tr><th>{label}</th>" + "".join(f"<td>' || ({c}) || '</td>" for c in cells) + "</tr>'"


def _link(target: str, text: str) -> str:
    return f"'<a href=\"/item/' || ({target}) || '\">' || ({text}) || '</a>'"


def _if(condition: str, *parts: str) -> str:
    return f"CASE WHEN {condition} THEN {' || '.join(parts)} ELSE '' END"


#: The page of a document x, section by section.
HTML = ", ".join(
    [
        _if("x % 10 > 0", "'<title>item ' || x || CASE WHEN x % 26 = 7 THEN chr(31) ELSE '' END || '</title>'"),
        "'<h2>basic data</h2><table>'", _row("rarity", "'r' || x % 4"), _if("x % 38 <> 11", _row("gear type", "gear")), _row("gear cost", "'1,' || lpad(CAST(x % 997 AS STRING), 3, '0')"),
        _if("x % 4 = 0", _row("element", "'red'")), _row("infusion count", "x % 5"), _row("max level", "x % 90"), "'</table><h2>stats</h2><table>'",
        _row("attack", "'+initial'", "n_chars"), _row("attack", "'+max'", "2 * n_chars"), _if("x % 14 = 3", _row("attack", "'+initial'", "n_chars")), "'</table>'",
        _if("x % 3 < 2", "'<h2>skill</h2><table>'", _row("proc ' || x % 7 || '", "'target: foe . hits ' || x || '<br>heals ' || x % 9 || '<br>[activation rate]<br>' || x % 50 || '%'"), "'</table>'"),
        _if("x % 3 = 0", "'<h2>weapon ability</h2><table>'", _row("ability ' || x % 6 || '", _link("'a' || x % 6", "'boosts ' || x")), "'</table>'"),
        _if("x % 3 = 2", "'<h2>skill</h2><table>'", _row("roar", "'target: all . roars ' || x"), "'</table><h2>skill 2</h2><table>'", _row("bite", "'bites'"), "'</table>'"),
        _if("x % 6 = 2", "'<h2>passive skill</h2><table>'", _row("aura", "'shines ' || x"), "'</table>'"),
        _if("x % 3 = 2", "'<h2>hidden potential</h2><table>'", _row("lv ' || x % 30 || '", "'target: self . grows'"), _row("lv 99", "'ends'"), _row("restrictions", "'class ' || x % 8"), "'</table>'"),
        "'<h2>reforge</h2><table>'", _if("x % 5 = 1 OR x % 34 = 9", _row("before reforge", _link("x - 1", "'item ' || (x - 1)"))), _if("x % 34 = 9", _row("before reforge", "'another'")),
        _if("x % 5 = 1", _row("reforge gear material", _link("x % 100", "'gear ' || x % 100"), "x % 4 + 1")), "'</table><h2>special evolution</h2><table>'",
        _if("x % 7 = 2", _row("before awakening", _link("x + 1", "'item ' || (x + 1)")), _row("awakening item material", _link("'i' || x % 9", "'part ' || x % 9"), "x % 6 + 1")),
        _if("x % 11 = 4", _row("before enlightening", "'a friend'")), "'</table>'",
    ]
)
#: Documents as x, with what is wrong with their page.
GIVEN_SQL = """(SELECT *, CASE WHEN x % 22 = 5 THEN 'a repeated id' WHEN x % 10 = 0 THEN 'ValueError: no title' WHEN x % 38 = 11 THEN 'no gear type' WHEN x % 34 = 9 THEN 'two slots: before reforge'
 WHEN x % 26 = 7 THEN 'a control separator in a field' WHEN x % 14 = 3 THEN 'a repeated key' END AS error FROM (SELECT CAST(doc_id AS BIGINT) AS x, n_chars, CASE doc_id % 3 WHEN 0 THEN 'sword' WHEN 1 THEN 'shield' ELSE 'beast' END AS gear FROM documents))"""
#: Table, condition and fields in alphabetical order, for every record of a good page.
RECORDS_SQL = [
    ("equipment", "true", {"cost": "1000 + x % 997", "element": "CASE WHEN x % 4 = 0 THEN 'red' ELSE 'none' END", "gear_type": "gear", "max_level": "x % 90", "model_class": "CASE x % 3 WHEN 0 THEN 'weapon' WHEN 1 THEN 'defensive_gear' ELSE 'monster' END", "name": "'item ' || x", "rarity": "'r' || x % 4"}),
    ("weapon", "x % 3 = 0", {"infusion_count": "x % 5"}),
    ("defensive_gear", "x % 3 = 1", {"infusion_count": "x % 5"}),
    ("monster", "x % 3 = 2", {"restrictions": "'class ' || x % 8"}),
    ("stat", "true", {"label": "'attack'", "tier": "'initial'", "value": "n_chars"}),
    ("stat", "true", {"label": "'attack'", "tier": "'max'", "value": "2 * n_chars"}),
    ("proc", "x % 3 < 2", {"activation_rate": "x % 50 || '%'", "name": "'proc ' || x % 7"}),
    ("skill_effect", "x % 3 < 2", {"description": "'hits ' || x", "ordinal": "1", "owner_kind": "'proc'", "owner_ordinal": "1", "target": "'foe'"}),
    ("skill_effect", "x % 3 < 2", {"description": "'heals ' || x % 9", "ordinal": "2", "owner_kind": "'proc'", "owner_ordinal": "1", "target": "NULL"}),
    ("weapon_ability", "x % 3 = 0", {"ability": "'a' || x % 6", "name": "'ability ' || x % 6"}),
    ("skill_effect", "x % 3 = 0", {"description": "'boosts ' || x", "ordinal": "1", "owner_kind": "'weapon_ability'", "owner_ordinal": "1", "target": "NULL"}),
    ("monster_skill", "x % 3 = 2", {"name": "'roar'", "ordinal": "1"}),
    ("monster_skill", "x % 3 = 2", {"name": "'bite'", "ordinal": "2"}),
    ("skill_effect", "x % 3 = 2", {"description": "'roars ' || x", "ordinal": "1", "owner_kind": "'monster_skill'", "owner_ordinal": "1", "target": "'all'"}),
    ("skill_effect", "x % 3 = 2", {"description": "'bites'", "ordinal": "1", "owner_kind": "'monster_skill'", "owner_ordinal": "2", "target": "NULL"}),
    ("passive_skill", "x % 6 = 2", {"name": "'aura'"}),
    ("skill_effect", "x % 6 = 2", {"description": "'shines ' || x", "ordinal": "1", "owner_kind": "'passive_skill'", "owner_ordinal": "1", "target": "NULL"}),
    ("potential_level", "x % 3 = 2", {"description": "'grows'", "level": "x % 30", "target": "'self'"}),
    ("potential_level", "x % 3 = 2", {"description": "'ends'", "level": "99", "target": "NULL"}),
    ("evolution", "x % 5 = 1", {"before_name": "'item ' || (x - 1)", "before_uid": "x - 1", "kind": "'reforge'"}),
    ("evolution_material", "x % 5 = 1", {"kind": "'reforge'", "material_kind": "'gear'", "ordinal": "1", "quantity": "x % 4 + 1", "ref_name": "'gear ' || x % 100", "ref_uid": "x % 100"}),
    ("evolution", "x % 7 = 2", {"before_name": "'item ' || (x + 1)", "before_uid": "x + 1", "kind": "'awakening'"}),
    ("evolution_material", "x % 7 = 2", {"kind": "'awakening'", "material_kind": "'item'", "ordinal": "1", "quantity": "x % 6 + 1", "ref_name": "'part ' || x % 9", "ref_uid": "'i' || x % 9"}),
    ("evolution", "x % 11 = 4 AND x % 3 = 2", {"before_name": "'a friend'", "before_uid": "NULL", "kind": "'enlightening'"}),
]
TAGGED_SQL = " UNION ALL ".join(
    f"SELECT x AS page_id, '{name}' AS name, " + " || ';' || ".join(f"'{k}=' || coalesce(CAST({v} AS VARCHAR), '-')" for k, v in fields.items()) + f" AS fields FROM {GIVEN_SQL} WHERE error IS NULL AND {condition}"
    for name, condition, fields in RECORDS_SQL
)


def read(spark: SparkSession, d: str) -> Records:
    docs = table(spark, d, "documents").selectExpr("CAST(doc_id AS BIGINT) AS x", "n_chars", "CASE doc_id % 3 WHEN 0 THEN 'sword' WHEN 1 THEN 'shield' ELSE 'beast' END AS gear")
    pages = docs.selectExpr("x", f"concat({HTML}) AS html")
    twice = pages.withColumn("n", F.explode(F.when(F.col("x") % 22 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return Records(twice.select(F.col("x").alias("page_id"), "html"), folder(spark), KINDS, (*ELEMENTS, "none"))


@query("pages_01_records", TAGGED_SQL)
def pages_01(spark: SparkSession, d: str) -> DataFrame:
    """The records of all tables, tagged, with their fields in order."""
    told = F.array_join(F.transform(F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), ";")
    return read(spark, d).tagged().select("page_id", "name", told.alias("fields"))


@query(
    "pages_02_evolutions",
    f"""WITH g AS (SELECT x AS uid, * FROM {GIVEN_SQL} WHERE error IS NULL) SELECT uid, 'reforge' AS kind, CAST(x - 1 AS VARCHAR) AS before_uid, 'item ' || (x - 1) AS before_name, 'gear' AS material_kind, CAST(x % 100 AS VARCHAR) AS ref_uid, x % 4 + 1 AS quantity FROM g WHERE x % 5 = 1
    UNION ALL SELECT uid, 'awakening', CAST(x + 1 AS VARCHAR), 'item ' || (x + 1), 'item', 'i' || x % 9, x % 6 + 1 FROM g WHERE x % 7 = 2 UNION ALL SELECT uid, 'enlightening', NULL, 'a friend', NULL, NULL, NULL FROM g WHERE x % 11 = 4 AND x % 3 = 2""",
)
def pages_02(spark: SparkSession, d: str) -> DataFrame:
    """Reforges and special evolutions with their materials."""
    found = read(spark, d)
    material = found["evolution_material"].select("uid", "kind", "material_kind", "ref_uid", "quantity")
    return found["evolution"].join(material, ["uid", "kind"], "left").select("uid", "kind", "before_uid", "before_name", "material_kind", "ref_uid", "quantity")


@query(
    "pages_03_monsters",
    f"""SELECT x AS uid, 'item ' || x AS name, 'class ' || x % 8 AS restrictions, CASE WHEN x % 6 = 2 THEN 'aura' END AS passive, s.name AS skill, s.ordinal, CASE s.ordinal WHEN 1 THEN 'roars ' || x ELSE 'bites' END AS effect, x % 30 AS least_level
    FROM {GIVEN_SQL}, (VALUES ('roar', CAST(1 AS BIGINT)), ('bite', CAST(2 AS BIGINT))) AS s(name, ordinal) WHERE error IS NULL AND x % 3 = 2""",
)
def pages_03(spark: SparkSession, d: str) -> DataFrame:
    """Monsters with their skills, effects, passive skills and potentials, from seven typed tables."""
    t = read(spark, d)
    effects = t["skill_effect"].where("owner_kind = 'monster_skill'").select("uid", F.col("owner_ordinal").alias("ordinal"), F.col("description").alias("effect"))
    skills = t["monster_skill"].withColumnRenamed("name", "skill").join(effects, ["uid", "ordinal"])
    levels = t["potential_level"].groupBy("uid").agg(F.min("level").alias("least_level"))
    passive = t["passive_skill"].withColumnRenamed("name", "passive")
    return t["equipment"].select("uid", "name").join(t["monster"], "uid").join(passive, "uid", "left").join(skills, "uid").join(levels, "uid").select("uid", "name", "restrictions", "passive", "skill", "ordinal", "effect", "least_level")


@query("pages_04_errors", f"SELECT x AS page_id, error FROM {GIVEN_SQL} WHERE error IS NOT NULL UNION ALL SELECT x, error FROM {GIVEN_SQL} WHERE error = 'a repeated id'")
def pages_04(spark: SparkSession, d: str) -> DataFrame:
    """A row for each page that gives no records, saying why."""
    return read(spark, d).errors()


@query("pages_05_counts", f"SELECT name, count(*) AS n FROM ({TAGGED_SQL}) GROUP BY name UNION ALL SELECT 'element', {len(ELEMENTS) + 1}")
def pages_05(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table, the appended elements among them."""
    t = read(spark, d)
    return reduce(DataFrame.unionByName, [t[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in (*TABLES, "element")]).where("n > 0")

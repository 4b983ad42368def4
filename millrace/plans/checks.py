"""The checks of a build, each on tables with planted faults that grow with the documents, and the SQL that finds them.

The checks read what a build has made; here the build's tables are given, each a formula of a document's number x, so that
every check has rows that break it and the SQL says which from the formulas alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models import checks
from millrace.models.build import Build, Run
from millrace.operators import gate
from millrace.plans.catalog import table
from millrace.plans.registry import query

SHIPPED, LIVE = "x % 13 <> 5", "x % 6 < 3"
#: What a build has made and what it was given, by name: (condition, expressions).
GIVEN = {
    "stg_crawl_run": ("true", "x AS run_id, CASE WHEN x % 2 = 1 THEN 'complete' ELSE 'failed' END AS status"),
    "stg_frontier": ("true", "concat('p', x) AS item_id, x % 3 AS decided_run_id, CASE x % 5 WHEN 0 THEN concat('contract: ', x) WHEN 1 THEN 'http' END AS last_error"),
    "stg_meta": ("x < 2", "CASE x WHEN 0 THEN 'seed.schema_version' ELSE 'scope.fingerprint' END AS key, '1' AS value"),
    "confirmed_aliases": ("x % 4 = 0", "concat('p', x) AS old_uid, concat('p', x + 1) AS new_uid, 'n' AS note"),
    "rejected_aliases": ("x % 12 = 0", "concat('p', x) AS old_uid, concat('p', x + 1) AS new_uid, 'n' AS note"),
    "int_alias_new": ("x % 8 = 0", "concat('p', x) AS old_uid, concat('p', x + 1) AS new_uid"),
    "mart_equipment": (SHIPPED, f"concat('p', x) AS uid, CASE x % 7 WHEN 0 THEN 'R' WHEN 1 THEN 'SR' ELSE 'UR' END AS rarity, CASE WHEN {LIVE} THEN 'live' ELSE 'retired' END AS state, CASE WHEN x % 2 = 0 THEN 'reference' ELSE 'catalog' END AS entry_kind, CASE WHEN x % 10 > 0 THEN concat('s', x) END AS icon_sha, x % 21 AS max_level, concat('g', x % 6) AS gear_type"),
    "mart_evolution_edge": ("x % 12 = 0 OR x % 30 IN (0, 3)", "CASE WHEN x % 12 = 0 THEN 'awakening' ELSE 'reforge' END AS kind, concat('p', x) AS from_uid, concat('p', CASE WHEN x % 12 = 0 THEN x + 6 WHEN x % 30 = 0 THEN x + 3 ELSE x - 3 END) AS to_uid"),
    "mart_evolution_material": ("x % 3 = 0", "'awakening' AS kind, concat('p', x) AS from_uid, concat('p', x + 13) AS to_uid"),
    "int_scope_member": ("true", "concat('p', x) AS uid, CASE WHEN x % 3 = 0 THEN 'evolution' ELSE 'list' END AS source, CASE WHEN x % 2 = 0 THEN 'reference' ELSE 'catalog' END AS entry_kind, CASE WHEN x % 3 = 0 THEN 'evolution:awakening' ELSE 'cost' END AS keep_reason, concat('p', x + 6) AS parent_id"),
    "int_changes": ("true", "'equipment' AS entity_type, concat('p', CASE WHEN x % 10 = 1 THEN x - 1 ELSE x END) AS entity_key, CASE WHEN x % 3 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS operation"),
    "stg_parse_error": ("x % 26 = 5", "concat('p', x) AS source_id, concat('broken ', x) AS error"),
    "mart_uid_retired": ("x % 6 >= 3 AND x % 18 <> 3", "concat('p', x) AS uid, x + CASE WHEN x % 18 = 9 THEN 1 ELSE 0 END AS since_revision"),
    "mart_uid_alias": ("x % 36 = 0 AND x % 72 > 0 OR x % 16 = 0 OR x % 28 = 1", "concat('p', x) AS old_uid, concat('p', CASE WHEN x % 28 = 1 THEN x - 1 WHEN x % 36 = 0 THEN x + 2 ELSE x + 1 END) AS new_uid"),
    "int_aggregate_hash_game": ("x % 8 = 3", "'proc' AS entity_type, concat('p', x) AS entity_key"),
    "int_aggregate_hash_ledger": ("false", "'proc' AS entity_type, concat('p', x) AS entity_key"),
    "int_evolution_material": ("true", "x % 5 > 0 AS attributed, concat('p', x) AS source_uid, 'reforge' AS kind, 1L AS ordinal, 'r' AS ref_uid, 'n' AS ref_name"),
    "int_unresolved_ref": ("x % 17 = 0", "concat('p', x) AS source_uid"),
    "int_item": ("true", "concat('i', x) AS uid, CASE WHEN x % 11 = 0 THEN 2L ELSE 1L END AS name_variants"),
    "int_weapon_ability": ("true", "concat('a', x) AS uid, 'n' AS name, CASE WHEN x % 15 = 0 THEN 3L ELSE 1L END AS name_variants"),
    "stg_listing": ("true", "concat('p', x) AS item_id, CASE WHEN x % 23 = 0 THEN 'weapon' ELSE 'armor' END AS grp, CASE WHEN x % 19 = 0 THEN 'SR' ELSE 'UR' END AS rarity"),
    "stg_equipment": ("true", "concat('p', x) AS source_uid, 'defensive_gear' AS model_class, 'ur' AS rarity"),
    "mart_monster": ("x % 3 = 2", "concat('p', x) AS uid"),
    "mart_monster_skill": ("x % 3 = 2 AND x % 15 <> 2", "concat('p', x) AS uid"),
    "mart_potential_level": ("x % 5 = 0", "concat('p', x) AS uid"),
    "mart_weapon": ("x % 3 = 0", "concat('p', x) AS uid, CASE WHEN x % 33 > 0 THEN x END AS proc_id"),
    "mart_defensive_gear": ("x % 3 = 1", "concat('p', x) AS uid, CASE WHEN x % 12 <> 1 THEN x END AS proc_id"),
    "int_proc": ("true", "concat('p', x) AS source_uid, x AS proc_id, CASE WHEN x % 16 = 0 THEN 'flame xl' ELSE 'flame' END AS raw_name, CAST(NULL AS STRING) AS size, CASE WHEN x % 3 = 0 THEN 'red' END AS name_element, CASE WHEN x % 2 = 1 THEN 'blue' END AS scaling_element, CASE WHEN x % 20 = 7 THEN 2L ELSE x % 2 END AS scaling_elements"),
    "mart_proc_scaling": ("true", "x AS proc_id, concat('s', x % 3) AS scale_kind"),
    "int_population": ("x = 0", "'catalog' AS scope, {n} - 5 AS value"),
    "int_first_seen": ("true", "concat('p', x) AS uid, x % 8 = 1 AS is_new_item"),
    "int_equipment_status": ("true", "concat('p', x) AS uid, x % 25 = 0 AS newly_retired, 'gone' AS retire_reason, x % 9 = 0 AS revived"),
    "stg_unlisted_release": ("x % 27 = 0", "concat('u', x) AS item_id, concat('new ', x) AS name, x % 5 AS runs"),
}
PREVIOUS = {
    "alias_rejected": ("x % 20 = 0", "concat('p', x) AS old_uid, concat('p', x + 1) AS new_uid"),
    "uid_alias": ("x % 36 = 0 OR x % 16 = 0 OR x % 28 = 1", "concat('p', x) AS old_uid, concat('p', CASE WHEN x % 28 = 1 THEN x - 1 WHEN x % 36 = 0 THEN x + 2 ELSE x + 1 END) AS new_uid"),
    "uid_retired": ("x % 6 >= 3", "concat('p', x) AS uid, x AS since_revision"),
    "entity_current": ("true", "CASE WHEN x % 4 = 3 THEN 'proc' ELSE 'equipment' END AS entity_type, concat('p', x) AS entity_key, CASE WHEN x % 9 = 0 THEN 'DELETE' ELSE 'INSERT' END AS last_operation"),
    "equipment_seen": ("x % 52 = 5", "concat('p', x) AS uid"),
    "population": ("x = 0", "'run1' AS run_id, 'catalog' AS scope, {n} AS value"),
}
#: Tables of several rows for a document: its stats, and the two ways that an item may have come about.
STATS = "SELECT concat('p', x) AS uid, 'attack' AS label, tier FROM docs LATERAL VIEW explode(CASE WHEN x % 14 = 0 THEN array('initial') WHEN x % 4 = 0 THEN array('initial', 'max1') ELSE array('initial', 'max') END) AS tier"
EDGES = "SELECT 'awakening' AS kind, concat('p', x) AS to_uid, concat(a, x) AS from_uid FROM docs LATERAL VIEW explode(CASE WHEN x % 18 = 0 THEN array('a', 'b') ELSE array('a') END) AS a"
VOCABULARY = [("gear_type", f"g{i}") for i in range(5)] + [("stat_label", "attack"), ("stat_tier", "initial"), ("stat_tier", "max"), ("scale_kind", "s0"), ("scale_kind", "s1")]


def given(spark: SparkSession, d: str) -> Build:
    table(spark, d, "documents").selectExpr("CAST(doc_id AS BIGINT) AS x").createOrReplaceTempView("docs")
    n = spark.table("docs").count()
    frame = lambda where, columns: spark.sql(f"SELECT {columns.replace('{n}', str(n))} FROM docs WHERE {where}")
    made = {name: frame(*f) for name, f in GIVEN.items()}
    made |= {"mart_stat": spark.sql(STATS), "int_evolution_edge": spark.sql(EDGES), "vocabulary": spark.createDataFrame(VOCABULARY, "domain string, value string")}
    run = Run(3, "run2", "2024-02-01T00:00:00Z", last_complete_run=2, scope_fingerprint="a", catalog_version="b", prev_run_id="run1", prev_parser_version=1)
    return Build(spark, run, {}, {name: frame(*f) for name, f in PREVIOUS.items()}, made=made)


#: What names a broken row of each check.
KEYS = {
    "crawl_complete": "last_complete_run", "frontier_contract_failure": "concat_ws(' ', item_id, last_error)", "meta_keys": "key", "seed_scope_matches": "concat_ws(' ', seed_fingerprint, catalog_version)",
    "alias_confirmed_and_rejected": "concat_ws(' ', old_uid, new_uid)", "alias_csv_disagrees_with_ledger": "concat_ws(' ', old_uid, new_uid, ledger_new_uid)", "alias_cycle": "uid", "alias_old_uid_live": "old_uid",
    "alias_target_missing": "concat_ws(' ', old_uid, new_uid)", "equipment_rarity_closed": "concat_ws(' ', uid, rarity)", "evolution_endpoint_shipped": "concat_ws(' ', table_name, kind, from_uid, to_uid)", "evolution_no_cycle": "concat_ws(' ', kind, uid)",
    "one_operation_per_key": "concat_ws(' ', entity_key, n)", "equipment_never_deleted": "uid", "ledgers_append_only": "concat_ws(' ', ledger, entity_key)",
    "alias_csv_removed": "concat_ws(' ', old_uid, new_uid)", "alias_deferred": "old_uid", "deferred_shared_deletes": "concat_ws(' ', entity_type, entity_key)", "evolution_material_dropped": "source_uid", "evolution_unresolved_ref": "source_uid",
    "item_name_conflict": "concat_ws(' ', uid, name_variants)", "weapon_ability_conflict": "concat_ws(' ', uid, name_variants)", "listing_detail_disagree": "concat_ws(' ', item_id, grp, listing_rarity)", "max_potential_iff_hidden_potential": "concat_ws(' ', uid, split)", "proc_name_element_without_scaling": "proc_id",
}


def broken(spark: SparkSession, d: str, group: str) -> DataFrame:
    b = given(spark, d)
    rows = [function(b).select(F.lit(name).alias("check"), F.expr(KEYS[name]).cast("string").alias("key")) for name, (g, function) in checks.CHECKS.items() if g == group]
    return reduce(DataFrame.unionByName, rows)


DOCS_SQL = f"d AS (SELECT CAST(doc_id AS BIGINT) AS x, 'p' || doc_id AS p FROM documents), shipped AS (SELECT * FROM d WHERE {SHIPPED})"


def sql(**found: str) -> str:
    """The rows of each check: an expression and the rest of a SELECT, on documents d and those that are shipped."""
    return f"WITH {DOCS_SQL} " + " UNION ALL ".join(f"SELECT '{name}' AS \"check\", CAST({rest.partition(' FROM ')[0]} AS VARCHAR) AS key FROM {rest.partition(' FROM ')[2]}" for name, rest in found.items())


@query(
    "checks_01_contract",
    sql(
        crawl_complete="2 FROM (SELECT 1) WHERE NOT EXISTS (SELECT 1 FROM d WHERE x = 2 AND x % 2 = 1)", frontier_contract_failure="p || ' contract: ' || x FROM d WHERE x % 3 = 2 AND x % 5 = 0",
        meta_keys="k FROM (VALUES (0, 'seed.schema_version'), (1, 'scope.fingerprint'), (2, 'crawl.last_complete_run')) AS v(i, k) WHERE i = 2 OR NOT EXISTS (SELECT 1 FROM d WHERE x = i)", seed_scope_matches="'a b' FROM (SELECT 1)",
    ),
)
def checks_01(spark: SparkSession, d: str) -> DataFrame:
    return broken(spark, d, "contract")


@query(
    "checks_02_structural",
    sql(
        alias_confirmed_and_rejected="p || ' p' || (x + 1) FROM d WHERE x % 12 = 0 OR x % 20 = 0", alias_csv_disagrees_with_ledger="p || ' p' || (x + 1) || ' p' || (x + 2) FROM d WHERE x % 36 = 0",
        alias_cycle="'p' || (d.x + i) FROM d, (VALUES (0), (1)) AS v(i) WHERE d.x % 28 = 0 AND EXISTS (SELECT 1 FROM d e WHERE e.x = d.x + 1)", alias_old_uid_live=f"p FROM shipped WHERE x % 4 = 0 AND x % 36 > 0 AND x % 16 > 0 AND {LIVE}",
        alias_target_missing="p || ' p' || (x + 1) FROM d WHERE x % 4 = 0 AND NOT EXISTS (SELECT 1 FROM shipped s WHERE s.x = d.x + 1)",
        equipment_rarity_closed="p || CASE WHEN x % 7 = 0 THEN ' R' ELSE ' SR' END FROM shipped WHERE x % 7 = 0 OR x % 7 = 1 AND NOT (x % 12 = 0 AND EXISTS (SELECT 1 FROM shipped s WHERE s.x = shipped.x + 6 AND s.x % 6 < 3))",
        evolution_endpoint_shipped="concat_ws(' ', n, kind, 'p' || a, 'p' || b) FROM (SELECT 'evolution_edge' AS n, 'awakening' AS kind, x AS a, x + 6 AS b FROM d WHERE x % 12 = 0 UNION ALL SELECT 'evolution_edge', 'reforge', x, CASE WHEN x % 30 = 0 THEN x + 3 ELSE x - 3 END FROM d WHERE x % 30 IN (0, 3) AND x % 12 > 0"
        " UNION ALL SELECT 'evolution_material', 'awakening', x, x + 13 FROM d WHERE x % 3 = 0) WHERE a NOT IN (SELECT x FROM shipped) AND b NOT IN (SELECT x FROM shipped)",
        evolution_no_cycle="'reforge p' || (d.x + i) FROM d, (VALUES (0), (3)) AS v(i) WHERE d.x % 30 = 0 AND d.x % 12 > 0 AND (d.x + 3) % 12 > 0 AND EXISTS (SELECT 1 FROM d e WHERE e.x = d.x + 3)",
        one_operation_per_key="'p' || (x - 1) || ' 2' FROM d WHERE x % 10 = 1 AND EXISTS (SELECT 1 FROM d e WHERE e.x = d.x - 1)", equipment_never_deleted="p FROM d WHERE x % 4 < 3 AND x % 9 > 0 AND x % 13 = 5 AND x % 26 <> 5",
        ledgers_append_only="k FROM (SELECT 'uid_retired ' || p AS k FROM d WHERE x % 18 IN (3, 9) UNION ALL SELECT 'uid_alias ' || p FROM d WHERE x % 72 = 0 AND x % 16 > 0 AND x % 28 <> 1)",
    ),
)
def checks_02(spark: SparkSession, d: str) -> DataFrame:
    return broken(spark, d, "structural")


@query(
    "checks_03_info",
    sql(
        alias_csv_removed="p || ' p' || (x - 1) FROM d WHERE x % 28 = 1", alias_deferred="p FROM d WHERE x % 4 = 0 AND x % 36 > 0 AND x % 8 > 0",
        deferred_shared_deletes="'proc ' || p FROM d WHERE x % 8 = 7 AND x % 9 > 0 AND EXISTS (SELECT 1 FROM d e WHERE e.x % 26 = 5 AND e.x % 4 < 3 AND e.x % 9 > 0)", evolution_material_dropped="p FROM d WHERE x % 5 = 0", evolution_unresolved_ref="p FROM d WHERE x % 17 = 0",
        item_name_conflict="'i' || x || ' 2' FROM d WHERE x % 11 = 0", weapon_ability_conflict="'a' || x || ' 3' FROM d WHERE x % 15 = 0",
        listing_detail_disagree="p || CASE WHEN x % 23 = 0 THEN ' weapon' ELSE ' armor' END || CASE WHEN x % 19 = 0 THEN ' SR' ELSE ' UR' END FROM d WHERE x % 23 = 0 OR x % 19 = 0",
        max_potential_iff_hidden_potential="p || CASE WHEN x % 4 = 0 AND x % 14 > 0 THEN ' true' ELSE ' false' END FROM d WHERE x % 3 = 2 AND (x % 4 = 0 AND x % 14 > 0) <> (x % 5 = 0)", proc_name_element_without_scaling="x FROM d WHERE x % 6 = 0",
    ),
)
def checks_03(spark: SparkSession, d: str) -> DataFrame:
    return broken(spark, d, "info")


GAPS = "array_to_string(list_filter([CASE WHEN x % 12 = 1 THEN 'defensive gear without proc' END, CASE WHEN x % 21 = 0 THEN 'max_level = 0' END, CASE WHEN x % 15 = 2 THEN 'monster without skills' END, CASE WHEN x % 14 = 0 THEN 'stat attack has no max tier' END, CASE WHEN x % 33 = 0 THEN 'weapon without proc' END], lambda g: g IS NOT NULL), '; ')"
ITEM = "'equipment' AS entity_type, p AS entity_key, CASE WHEN x % 2 = 0 THEN 'reference' ELSE 'catalog' END AS entry_kind, x % 8 = 1 AS is_new_item, 1 AS affected, NULL AS runs"
PROC = "'proc' AS entity_type, CAST(x AS VARCHAR) AS entity_key, CASE WHEN x % 2 = 0 THEN 'reference' ELSE 'catalog' END AS entry_kind, false AS is_new_item, 1 AS affected, NULL AS runs"
POLICY_ROWS = [
    ("count_drop", "'equipment' AS entity_type, '*' AS entity_key, 'catalog' AS entry_kind, false AS is_new_item, 5 AS affected, NULL AS runs", "'live catalog ' || n || ' -> ' || (n - 5)", "(SELECT count(*) AS n FROM d) WHERE n > 0"),
    ("icon_missing", ITEM, "NULL", f"shipped WHERE {LIVE} AND x % 10 = 0"),
    ("optional_field_null", ITEM, GAPS, f"shipped WHERE {LIVE} AND {GAPS} <> ''"),
    ("parse_failure", ITEM.replace("x % 8 = 1 AS is_new_item", "x % 52 <> 5 AS is_new_item"), "'broken ' || x", "d WHERE x % 26 = 5"),
    ("retired", ITEM, "'gone'", "shipped WHERE x % 25 = 0"),
    ("unexplained_churn", ITEM, "NULL", "(SELECT s.x, s.p FROM d JOIN shipped s ON s.x = CASE WHEN d.x % 10 = 1 THEN d.x - 1 ELSE d.x END WHERE d.x % 3 = 0 AND s.x % 9 > 0)"),
    ("unknown_vocabulary", ITEM, "'gear_type g5'", "shipped WHERE x % 6 = 5"),
    ("unknown_vocabulary", ITEM, "'tier max1'", "shipped WHERE x % 4 = 0 AND x % 14 > 0"),
    ("unknown_vocabulary", PROC, "'scale_kind s2'", "d WHERE x % 3 = 2"),
    ("unknown_vocabulary", PROC, "'flame xl'", "d WHERE x % 16 = 0"),
    ("unlisted_release", "'unlisted_release' AS entity_type, 'u' || x AS entity_key, 'catalog' AS entry_kind, false AS is_new_item, 1 AS affected, x % 5 AS runs", "'new ' || x", "d WHERE x % 27 = 0"),
    ("wiki_contradiction", ITEM.replace("x % 8 = 1 AS is_new_item", "false AS is_new_item"), "'awakening: a' || x || ', b' || x", "d WHERE x % 18 = 0"),
    ("wiki_contradiction", PROC, "CASE WHEN x % 16 = 0 THEN 'flame xl' ELSE 'flame' END || ': name red, scaling blue'", "d WHERE x % 6 = 3"),
    ("wiki_contradiction", PROC, "CASE WHEN x % 16 = 0 THEN 'flame xl' ELSE 'flame' END", "d WHERE x % 20 = 7"),
]
POLICY_SQL = " UNION ALL ".join(f"SELECT '{name}' AS \"check\", {columns}, {detail} AS detail FROM {rest}" for name, columns, detail, rest in POLICY_ROWS)


@query("checks_04_policy", f"WITH {DOCS_SQL} SELECT \"check\", entity_type, entity_key, entry_kind, is_new_item, CAST(affected AS BIGINT) AS affected, CAST(runs AS BIGINT) AS runs, CAST(detail AS VARCHAR) AS detail FROM ({POLICY_SQL})")
def checks_04(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all ten policy checks, as the gate weighs them."""
    return checks.gate_input(given(spark, d))


RULES = """
[check.count_drop]
scopes = { catalog = "warning" }
escalate = { scope = "catalog", level = "blocker", min_count = 4, min_pct = 0.0001 }
[check.icon_missing]
scopes = { catalog = "info", reference = "info", new_item = "warning" }
escalate = { scope = "catalog", level = "warning", min_count = 2, min_pct = 1.5 }
[check.optional_field_null]
scopes = { catalog = "info", reference = "info" }
escalate = { scope = "reference", level = "blocker", min_count = 2, min_pct = 3.0 }
[check.parse_failure]
scopes = { catalog = "warning", new_item = "info" }
[check.retired]
scopes = { catalog = "info", reference = "warning" }
[check.unexplained_churn]
scopes = { catalog = "info", reference = "info" }
escalate = { scope = "catalog", level = "blocker", min_count = 3, min_pct = 2.0 }
[check.unknown_vocabulary]
scopes = { catalog = "warning", reference = "info" }
[check.unlisted_release]
scopes = { catalog = "info" }
escalate = { scope = "catalog", level = "warning", min_runs = 3 }
[check.wiki_contradiction]
scopes = { catalog = "info", reference = "info" }
escalate = { scope = "catalog", level = "warning", min_count = 5, min_pct = 4.0 }
"""
#: check, scope, base level, raised level, least count, share and runs.
RULES_SQL = """(VALUES ('count_drop', 'catalog', 1, 2, 4, 0.0001, NULL), ('icon_missing', 'catalog', 0, 1, 2, 1.5, NULL), ('icon_missing', 'reference', 0, NULL, 0, 0, NULL), ('icon_missing', 'new_item', 1, NULL, 0, 0, NULL),
 ('optional_field_null', 'catalog', 0, NULL, 0, 0, NULL), ('optional_field_null', 'reference', 0, 2, 2, 3.0, NULL), ('parse_failure', 'catalog', 1, NULL, 0, 0, NULL), ('parse_failure', 'new_item', 0, NULL, 0, 0, NULL), ('retired', 'catalog', 0, NULL, 0, 0, NULL), ('retired', 'reference', 1, NULL, 0, 0, NULL),
 ('unexplained_churn', 'catalog', 0, 2, 3, 2.0, NULL), ('unexplained_churn', 'reference', 0, NULL, 0, 0, NULL), ('unknown_vocabulary', 'catalog', 1, NULL, 0, 0, NULL), ('unknown_vocabulary', 'reference', 0, NULL, 0, 0, NULL), ('unlisted_release', 'catalog', 0, 1, 0, 0, 3),
 ('wiki_contradiction', 'catalog', 0, 1, 5, 4.0, NULL), ('wiki_contradiction', 'reference', 0, NULL, 0, 0, NULL)) AS v("check", scope, base, raised, min_count, min_pct, min_runs)"""


@query(
    "checks_05_gate",
    f"""WITH {DOCS_SQL}, pop AS (SELECT 'catalog' AS scope, count(*) AS population FROM d), rules AS (SELECT * FROM {RULES_SQL}), g AS (SELECT *, CASE WHEN is_new_item AND "check" IN ('icon_missing', 'parse_failure') THEN 'new_item' ELSE entry_kind END AS scope FROM ({POLICY_SQL})),
    k AS (SELECT "check", scope, entity_type, entity_key, max(affected) AS affected, max(runs) AS runs FROM g GROUP BY ALL),
    j AS (SELECT k.*, base, raised, min_count, min_pct, min_runs, coalesce(min_runs IS NOT NULL AND coalesce(runs, 0) >= min_runs, false) AS long FROM k LEFT JOIN rules USING ("check", scope)),
    f AS (SELECT "check", scope, base, raised, min_count, min_pct, min_runs, long, count(*) AS n, sum(affected) AS affected, min(entity_key) AS first_key FROM j GROUP BY ALL),
    s AS (SELECT f.*, CASE WHEN population > 0 THEN 100.0 * affected / population END AS share FROM f LEFT JOIN pop USING (scope))
    SELECT "check", scope, CAST(CASE WHEN raised IS NOT NULL AND (long OR min_runs IS NULL AND affected >= min_count AND coalesce(share >= min_pct, false)) THEN raised ELSE coalesce(base, 0) END AS INTEGER) AS level, n AS "count", CAST(affected AS BIGINT) AS affected, round(share, 6) AS pct, first_key FROM s""",
)
def checks_05(spark: SparkSession, d: str) -> DataFrame:
    """The gate's findings on the rows of all ten checks, with a rule for nearly all of them."""
    b = given(spark, d)
    found = gate.findings(checks.gate_input(b), gate.Policy.parse(RULES).frame(spark), b.prev("population"))
    return found.select("check", "scope", "level", "count", "affected", "pct", "first_key")

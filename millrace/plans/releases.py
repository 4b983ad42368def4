"""Queries on what must hold between manifests, packages and icon packs: a release for each document, some of them broken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import releases
from millrace.plans.catalog import table
from millrace.plans.registry import query

#: A document x is release n; its facts are what both engines make manifests, packages and packs from.
FACTS = """SELECT *, CASE WHEN delta THEN concat('icons/delta-', delta_from, '-', n, '.zip', CASE WHEN x % 39 = 10 THEN 'x' ELSE '' END) END AS delta_path FROM (
 SELECT x, x + 10 AS n, x % 4 = 0 AS alone, x % 4 > 0 AND x % 3 = 1 AS delta, CASE WHEN x % 33 = 7 THEN x + 1 ELSE x + 9 END AS delta_from, CASE WHEN x % 53 = 9 THEN x + 3 ELSE x + 9 END AS pkg_from,
 concat('icons/base-', x + 10, CASE WHEN x % 41 = 3 THEN '.tar' ELSE '.zip' END) AS base_path FROM (SELECT CAST(doc_id AS BIGINT) AS x FROM {documents}))"""
MANIFESTS = """SELECT n AS revision, CASE WHEN x % 24 = 0 THEN n - 1 WHEN alone THEN n ELSE n - 3 END AS minimum_revision, alone AS snapshot_only, concat('snapshots/', n + CASE WHEN x % 31 = 1 THEN 1 ELSE 0 END, '.sqlite.gz') AS snapshot,
 concat('lineage/', n, CASE WHEN x % 37 = 2 THEN '.json' ELSE '.json.gz' END) AS lineage, named_struct('path', base_path, 'icon_count', CAST(CASE WHEN x % 43 = 4 THEN 3 ELSE 2 END AS BIGINT)) AS base,
 transform(CASE WHEN alone AND x % 28 > 0 THEN CAST(array() AS ARRAY<BIGINT>) WHEN alone OR x % 29 = 5 THEN array(n - 1) ELSE sequence(n - 3, n - 1) END, a -> named_struct('from_revision', a, 'path', concat('updates/', a, '-', n + CASE WHEN x % 23 = 6 THEN 1 ELSE 0 END, '.json.gz'))) AS updates,
 CASE WHEN delta THEN array(named_struct('from_revision', delta_from, 'path', delta_path, 'sha256', concat('s', x))) END AS deltas, 5L AS icon_entities, CAST(CASE WHEN x % 47 = 8 THEN 6 ELSE 5 END AS BIGINT) AS icon_count FROM facts"""
OP = "named_struct('op', '{op}', 'entity', '{entity}', 'key', concat('{k}', x), 'rev', {rev}, 'to', {to}, 'uid', {uid}, 'since', {since}, 'ends', {ends})"
NO_ENDS = "CAST(NULL AS ARRAY<STRUCT<from_uid: STRING, to_uid: STRING>>)"


def _op(op: str, entity: str, k: str, rev: str = "n", to: str = "CAST(NULL AS STRING)", uid: str = "CAST(NULL AS STRING)", since: str = "CAST(NULL AS BIGINT)", ends: str = NO_ENDS) -> str:
    return OP.format(op=op, entity=entity, k=k, rev=rev, to=to, uid=uid, since=since, ends=ends)


RETIRE = _op("RETIRE", "equipment", "r")
ALIAS = _op("ALIAS", "equipment", "r", rev="CASE WHEN x % 71 = 13 THEN n - 9 ELSE n END", to="concat(CASE WHEN x % 67 = 12 THEN 'r' ELSE 'e' END, x)")
PACKAGES = f"""SELECT pkg_from AS from_revision, n AS to_revision, CASE WHEN delta THEN array(concat('i1', x), concat('i2', x)) WHEN x % 89 = 17 THEN array('i') END AS added, delta_path AS pack, CASE WHEN delta THEN CASE WHEN x % 97 = 18 THEN 'other' ELSE concat('s', x) END END AS pack_sha256,
 concat(array({_op('UPSERT', 'equipment', 'e', uid="concat(CASE WHEN x % 59 = 10 THEN 'other' ELSE 'e' END, x)", ends="array(named_struct('from_uid', CASE WHEN x % 61 = 11 THEN 'a' ELSE concat('e', x) END, 'to_uid', 'z'))")}),
 CASE WHEN x % 83 = 16 THEN array({RETIRE}, {RETIRE}, {ALIAS}) WHEN x % 73 = 14 THEN array({ALIAS}, {RETIRE}) ELSE array({RETIRE}, {ALIAS}) END,
 array({_op('UPSERT', 'uid_retired', 'r', uid="concat('r', x)", since="CASE WHEN x % 79 = 15 THEN n - 20 ELSE n END")})) AS ops FROM facts WHERE NOT alone"""
ICON = "named_struct('kind', '{kind}', 'sha256', concat('{i}', x), 'path', concat('{kind}/', {shown}, x, '.png'))"
PACKS = f"""SELECT delta_path AS path, CASE WHEN x % 101 = 19 THEN 'wrong' ELSE substring_index(delta_path, '/', -1) END AS name, 'delta' AS pack_type, n + CASE WHEN x % 103 = 20 THEN 1 ELSE 0 END AS to_revision,
 CASE WHEN x % 109 = 22 THEN array({ICON.format(kind='equipment', i='i1', shown="'i1'")}) ELSE array({ICON.format(kind='equipment', i='i1', shown="'i1'")}, {ICON.format(kind='item', i='i2', shown="CASE WHEN x % 107 = 21 THEN 'i3' ELSE 'i2' END")}) END AS icons FROM facts WHERE delta AND x % 113 <> 23
 UNION ALL SELECT base_path, substring_index(base_path, '/', -1), 'base', n, array({ICON.format(kind='equipment', i='b1', shown="'b1'")}, {ICON.format(kind='item', i='b2', shown="'b2'")}) FROM facts"""
PKG = "concat(pkg_from, '-', n)"
#: (rule, breach, condition, subject) of what is broken, on the facts alone; one row for each.
BROKEN = [
    ("INV-4", "path", "x % 31 = 1", "'snapshot'"), ("INV-4", "path", "x % 37 = 2", "'lineage'"), ("INV-4", "path", "x % 41 = 3", "'base'"),
    *[("INV-4", "update path", f"x % 23 = 6 AND ({c})", f"CAST(n - {k} AS VARCHAR)") for k, c in ((1, "NOT alone OR x % 28 = 0"), (2, "NOT alone AND x % 29 <> 5"), (3, "NOT alone AND x % 29 <> 5"))],
    ("INV-4", "minimum of a snapshot-only release", "x % 24 = 0", "'manifest'"), ("INV-4", "packages of a snapshot-only release", "x % 28 = 0", "'manifest'"), ("INV-4", "window", "NOT alone AND x % 29 = 5", "'manifest'"),
    ("INV-9", "icon count", "x % 47 = 8", "'manifest'"), ("INV-5", "delta without update", "delta AND x % 33 = 7", "CAST(delta_from AS VARCHAR)"), ("INV-5", "delta path", "delta AND x % 39 = 10", "CAST(delta_from AS VARCHAR)"),
    ("INV-6", "package outside the window", "NOT alone AND x % 53 = 9", PKG), ("INV-6", "operation twice", "NOT alone AND x % 83 = 16", f"{PKG} || ' RETIRE equipment r' || x"),
    ("INV-6", "operation outside the package", "NOT alone AND x % 71 = 13", f"{PKG} || ' ALIAS equipment r' || x"), ("INV-6", "alias to itself", "NOT alone AND x % 67 = 12", f"{PKG} || ' ALIAS equipment r' || x"),
    ("INV-6", "alias before its retirement", "NOT alone AND x % 73 = 14 AND x % 83 <> 16", f"{PKG} || ' ALIAS equipment r' || x"), ("INV-6", "payload of another key", "NOT alone AND x % 59 = 10", f"{PKG} || ' UPSERT equipment e' || x"),
    ("INV-6", "payload from outside the package", "NOT alone AND x % 79 = 15", f"{PKG} || ' UPSERT uid_retired r' || x"), ("INV-6", "link that misses its key", "NOT alone AND x % 61 = 11", f"{PKG} || ' UPSERT equipment e' || x"),
    ("INV-7", "icons without a pack", "NOT alone AND NOT (delta AND delta_from = pkg_from) AND (delta OR x % 89 = 17)", PKG), ("INV-7", "another pack than the manifest''s", "delta AND delta_from = pkg_from AND x % 97 = 18", PKG),
    ("INV-7", "no index of the pack", "delta AND delta_from = pkg_from AND x % 97 <> 18 AND x % 113 = 23", PKG), ("INV-7", "other icons than the index''s", "delta AND delta_from = pkg_from AND x % 97 <> 18 AND x % 113 <> 23 AND x % 109 = 22", PKG),
    ("INV-8", "name", "delta AND x % 113 <> 23 AND x % 101 = 19", "delta_path"), ("INV-8", "revision", "delta AND x % 113 <> 23 AND x % 103 = 20", "delta_path"),
    ("INV-8", "member path", "delta AND x % 113 <> 23 AND x % 109 <> 22 AND x % 107 = 21", "delta_path || ' i2' || x"), ("INV-8", "icon count", "x % 43 = 4", "base_path"),
]


def frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Manifests, packages and pack indexes."""
    table(spark, d, "documents").createOrReplaceTempView("documents_in")
    facts = FACTS.format(documents="documents_in")
    return tuple(spark.sql(f"WITH facts AS ({facts}) {q}") for q in (MANIFESTS, PACKAGES, PACKS))


@query(
    "cdc_27_breaches",
    f"WITH facts AS ({FACTS.format(documents='documents')}) " + " UNION ALL ".join(f"SELECT n AS revision, '{rule}' AS rule, {subject} AS subject, '{what}' AS breach FROM facts WHERE {condition}" for rule, what, condition, subject in BROKEN),
)
def cdc_27_breaches(spark: SparkSession, d: str) -> DataFrame:
    """Every breach of every release."""
    return releases.breaches(*frames(spark, d))


@query(
    "cdc_27_good_releases",
    f"WITH facts AS ({FACTS.format(documents='documents')}) SELECT n AS revision FROM facts WHERE NOT (" + " OR ".join(f"({condition})" for _, _, condition, _ in BROKEN) + ")",
)
def cdc_27_good(spark: SparkSession, d: str) -> DataFrame:
    """Releases that break no rule."""
    manifests, packages, packs = frames(spark, d)
    return manifests.select("revision").join(releases.breaches(manifests, packages, packs).select("revision"), "revision", "left_anti").select(F.col("revision"))

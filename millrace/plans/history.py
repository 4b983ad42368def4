"""Queries on change: hashes of records, the change log, ledgers, slowly changing history, links and lifecycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import changes, graph, hashes, lifecycle
from millrace.plans.catalog import CURRENT, ITEM, ITEMS_SQL, LINKS_SQL, OLD_COST, PREVIOUS, STATE, STATS_SQL, clean_sql, hash_id_sql, items, links, row_text_sql, select, stats, table
from millrace.plans.registry import query

REVISION = 7
ITEM_STATE = ITEM | {"state": STATE, "retired_revision": "CASE WHEN p_partkey % 17 = 0 THEN 3 END"}
OLD_STATE = ITEM | {"cost": OLD_COST, "state": "CASE WHEN p_partkey % 34 = 0 THEN 'retired' ELSE 'live' END", "retired_revision": "CASE WHEN p_partkey % 34 = 0 THEN 3 END"}

EQUIPMENT = hashes.Aggregate(
    "equipment", "equipment", "uid",
    (hashes.Child("stat", ("uid",)), hashes.Child("link", ("from_uid", "to_uid"))),
    outside_content=("state", "retired_revision"), retirable=True,
)


def equipment(spark: SparkSession, d: str, where: str, state: dict[str, str]) -> DataFrame:
    frames = {"equipment": items(spark, d, where, **state), "stat": stats(spark, d), "link": links(spark, d)}
    return hashes.aggregate_hashes(EQUIPMENT, frames)


def brands(spark: SparkSession, d: str, where: str) -> DataFrame:
    """A second, deletable kind of record: brands, without children."""
    rows = table(spark, d, "part").where(where).groupBy("p_brand").agg(F.min("p_type").alias("least_type"))
    return hashes.aggregate_hashes(hashes.Aggregate("brand", "brand", "p_brand", deletable=True), {"brand": rows})


def child_sql(child: str, columns: list[str], source: str, owners: list[str]) -> str:
    text = f"'{child}' || chr(30) || {row_text_sql([f'm.{c}' for c in columns])}"
    on = " OR ".join(f"m.{o} = r.uid" for o in owners)
    return f"SELECT r.uid AS k, string_agg({text}, chr(28) ORDER BY {text}) AS t FROM r JOIN {source} m ON {on} GROUP BY r.uid"


def equipment_sql(where: str, state: dict[str, str]) -> str:
    cs = list(state)
    content = [c for c in cs if c not in EQUIPMENT.outside_content]
    head = "'equipment' || chr(29) || 'equipment' || chr(30) || "
    tail = " || chr(28) || coalesce(a.t, '') || chr(28) || coalesce(b.t, '')"
    return f"""(WITH r AS (SELECT * FROM {select(state, 'part', where)}),
    a AS ({child_sql('stat', ['uid', 'label', 'tier', 'value', 'ordinal'], STATS_SQL, ['uid'])}),
    b AS ({child_sql('link', ['kind', 'from_uid', 'to_uid'], LINKS_SQL, ['from_uid', 'to_uid'])})
    SELECT 'equipment' AS entity_type, r.uid AS entity_key, sha256({head}{row_text_sql([f'r.{c}' for c in cs])}{tail}) AS row_hash,
    sha256({head}{row_text_sql([f'r.{c}' for c in content])}{tail}) AS content_hash, r.state, CAST(r.retired_revision AS BIGINT) AS retired_revision
    FROM r LEFT JOIN a ON a.k = r.uid LEFT JOIN b ON b.k = r.uid)"""


def brands_sql(where: str) -> str:
    text = "sha256('brand' || chr(29) || 'brand' || chr(30) || 'v' || p_brand || chr(31) || 'v' || min(p_type))"
    return f"(SELECT 'brand' AS entity_type, p_brand AS entity_key, {text} AS row_hash, {text} AS content_hash, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS BIGINT) AS retired_revision FROM part WHERE {where} GROUP BY p_brand)"


NEW_BRANDS, OLD_BRANDS = "p_partkey % 2 = 0 AND p_brand <> 'Brand#3'", "p_partkey % 3 > 0 AND p_brand <> 'Brand#5'"
CURRENT_SQL = f"(SELECT * FROM {equipment_sql(CURRENT, ITEM_STATE)} UNION ALL SELECT * FROM {brands_sql(NEW_BRANDS)})"
PREVIOUS_SQL = f"(SELECT *, CAST(3 AS BIGINT) AS last_revision, CASE WHEN entity_key LIKE '%4' THEN 'DELETE' ELSE 'UPDATE' END AS last_operation FROM {equipment_sql(PREVIOUS, OLD_STATE)} UNION ALL SELECT *, 3, 'INSERT' FROM {brands_sql(OLD_BRANDS)})"
CHANGES_SQL = f"""WITH cur AS {CURRENT_SQL}, prev AS {PREVIOUS_SQL}, known AS (SELECT * FROM prev WHERE last_operation <> 'DELETE'),
ops AS (SELECT c.entity_type, c.entity_key, CASE WHEN p.entity_key IS NULL THEN 'INSERT' WHEN p.row_hash = c.row_hash THEN NULL
 WHEN c.entity_type = 'equipment' AND p.content_hash = c.content_hash AND p.state = 'live' AND c.state = 'retired' THEN 'RETIRE' ELSE 'UPDATE' END AS operation, c.row_hash, c.content_hash, c.state, c.retired_revision
 FROM cur c LEFT JOIN known p ON p.entity_type = c.entity_type AND p.entity_key = c.entity_key
 UNION ALL SELECT p.entity_type, p.entity_key, 'DELETE', NULL, NULL, NULL, NULL FROM known p WHERE p.entity_type = 'brand' AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.entity_type = p.entity_type AND c.entity_key = p.entity_key)
 UNION ALL SELECT c.entity_type, c.entity_key, 'ALIAS', c.row_hash, c.content_hash, c.state, c.retired_revision FROM cur c WHERE c.entity_type = 'equipment' AND c.entity_key LIKE '%77'),
changed AS (SELECT *, CAST({REVISION} AS BIGINT) AS revision FROM ops WHERE operation IS NOT NULL)"""


def current(spark: SparkSession, d: str) -> DataFrame:
    return equipment(spark, d, CURRENT, {k: v for k, v in ITEM_STATE.items() if k not in ITEM}).unionByName(brands(spark, d, NEW_BRANDS))


def previous(spark: SparkSession, d: str) -> DataFrame:
    old = equipment(spark, d, PREVIOUS, {k: v for k, v in OLD_STATE.items() if ITEM.get(k) != v})
    gone = F.when(F.col("entity_key").endswith("4"), "DELETE").otherwise("UPDATE")
    rows = old.withColumn("last_operation", gone).unionByName(brands(spark, d, OLD_BRANDS).withColumn("last_operation", F.lit("INSERT")))
    return rows.withColumn("last_revision", F.lit(3).cast("long"))


def changed(spark: SparkSession, d: str) -> DataFrame:
    now = current(spark, d)
    aliases = now.where("entity_type = 'equipment' AND entity_key LIKE '%77'").select(F.col("entity_key").alias("old_uid"))
    return changes.detect_changes(now, previous(spark, d), ["brand"], revision=F.lit(REVISION).cast("long"), aliases=aliases)


@query("hsh_03_aggregate_hashes", f"SELECT * FROM {equipment_sql(CURRENT, ITEM_STATE)}")
def hsh_03(spark: SparkSession, d: str) -> DataFrame:
    return equipment(spark, d, CURRENT, {k: v for k, v in ITEM_STATE.items() if k not in ITEM})


@query("cdc_01_change_detection", f"{CHANGES_SQL} SELECT * FROM changed")
def cdc_01(spark: SparkSession, d: str) -> DataFrame:
    return changed(spark, d)


@query(
    "cdc_02_deferred_deletes",
    CHANGES_SQL + " SELECT entity_type, operation, count(*) AS n FROM changed WHERE operation <> 'ALIAS' AND (operation <> 'DELETE' OR NOT EXISTS (SELECT 1 FROM known WHERE entity_type = 'equipment' AND entity_key = 'p1')) GROUP BY ALL",
)
def cdc_02(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "part").where("p_partkey = 1").select(F.concat(F.lit("p"), "p_partkey").alias("source_id"))
    found = changes.detect_changes(current(spark, d), previous(spark, d), ["brand"], revision=F.lit(REVISION).cast("long"), deferred=failed)
    return found.groupBy("entity_type", "operation").agg(F.count("*").alias("n"))


@query(
    "cdc_04_state_overlay",
    CHANGES_SQL + """, new AS (SELECT entity_type, entity_key, row_hash, content_hash, state, retired_revision, revision AS last_revision, operation AS last_operation FROM changed WHERE operation <> 'ALIAS')
    SELECT entity_type, entity_key, row_hash, content_hash, state, retired_revision, last_revision, last_operation FROM prev p WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.entity_type = p.entity_type AND n.entity_key = p.entity_key) UNION ALL SELECT * FROM new""",
)
def cdc_04(spark: SparkSession, d: str) -> DataFrame:
    return changes.overlay(previous(spark, d), changed(spark, d))


@query("cdc_05_append", "SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND NOT (CAST(ts AS DATE) < DATE '2024-01-20')")
def cdc_05(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    ledger = events.where("day < DATE '2024-01-20'")
    return changes.append_new(ledger, events.where("day >= DATE '2024-01-10'"), ["event_id"]).select("event_id", "user_id", "event_type")


@query("set_05_ledger_loss", "SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'A'")
def set_05(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    return changes.missing_from(lines.select("l_orderkey", "l_linenumber"), lines.where("l_returnflag <> 'A'").select("l_orderkey", "l_linenumber"))


@query(
    "cdc_07_slowly_changing",
    """WITH h AS (SELECT c_custkey, c_mktsegment, CAST(10 AS BIGINT) AS at FROM customer WHERE c_custkey % 4 < 3), n AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, CAST(10 + CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 0 END AS BIGINT) AS at FROM customer WHERE c_custkey % 5 > 0)
    SELECT h.c_custkey, h.c_mktsegment, h.at, h.at AS valid_from, n.at AS valid_to FROM h LEFT JOIN n ON n.c_custkey = h.c_custkey AND n.at > h.at
    UNION ALL SELECT n.c_custkey, n.c_mktsegment, n.at, n.at, NULL FROM n LEFT JOIN h ON h.c_custkey = n.c_custkey WHERE h.c_custkey IS NULL OR n.at > h.at""",
)
def cdc_07(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    old = c.where("c_custkey % 4 < 3").selectExpr("c_custkey", "c_mktsegment", "10L AS at", "10L AS valid_from", "CAST(NULL AS BIGINT) AS valid_to")
    new = c.where("c_custkey % 5 > 0").selectExpr("c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment", "10L + CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 0 END AS at")
    return changes.slowly_changing(old, new, "c_custkey", "at")


LOG_SQL = "(SELECT CASE WHEN event_id % 9 = 0 THEN 'uid_alias' ELSE 'equipment' END AS entity_type, 'u' || user_id AS entity_key, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN 'RETIRE' WHEN 'click' THEN 'ALIAS' ELSE 'UPDATE' END AS operation, event_id AS revision FROM events)"


#: A log on documents: three changes of each key, whose kinds follow from lengths, and some keys of a ledger.
DOC_LOG_SQL = """(SELECT CASE WHEN CAST(floor(doc_id / 3) AS BIGINT) % 5 = 0 THEN 'uid_alias' ELSE 'equipment' END AS entity_type, concat('d', CAST(floor(doc_id / 3) AS BIGINT)) AS entity_key,
 CASE n_chars % 5 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'RETIRE' WHEN 3 THEN 'ALIAS' ELSE 'DELETE' END AS operation, doc_id AS revision FROM documents)"""


@query(
    "cdc_09_net_operations_documents",
    f"""WITH n AS (SELECT entity_type, entity_key, arg_min(operation, revision) AS f, arg_max(operation, revision) AS l, bool_or(operation IN ('INSERT', 'UPDATE')) AS w, max(revision) AS revision FROM {DOC_LOG_SQL} WHERE operation <> 'ALIAS' GROUP BY ALL)
    SELECT entity_type, entity_key, CASE WHEN entity_type = 'uid_alias' THEN 'UPSERT' WHEN l = 'DELETE' THEN 'DELETE' WHEN w THEN 'UPSERT' ELSE 'RETIRE' END AS operation, revision FROM n WHERE entity_type = 'uid_alias' OR NOT (l = 'DELETE' AND f = 'INSERT')""",
)
def cdc_09_documents(spark: SparkSession, d: str) -> DataFrame:
    """As cdc_09_net_operations_log, over a log that grows with the documents."""
    table(spark, d, "documents").createOrReplaceTempView("documents_in")
    return changes.net_operations(spark.sql(f"SELECT * FROM {DOC_LOG_SQL.replace('FROM documents', 'FROM documents_in')}"), ["uid_alias"])


def change_log(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("events_in")
    return spark.sql(f"SELECT * FROM {LOG_SQL.replace('FROM events', 'FROM events_in')}")


@query(
    "cdc_09_net_operations",
    f"""WITH n AS (SELECT entity_type, entity_key, arg_min(operation, revision) AS f, arg_max(operation, revision) AS l, bool_or(operation IN ('INSERT', 'UPDATE')) AS w, max(revision) AS revision FROM {LOG_SQL} WHERE operation <> 'ALIAS' AND revision < 400 GROUP BY ALL)
    SELECT entity_type, entity_key, CASE WHEN entity_type = 'uid_alias' THEN 'UPSERT' WHEN l = 'DELETE' THEN 'DELETE' WHEN w THEN 'UPSERT' ELSE 'RETIRE' END AS operation, revision FROM n WHERE entity_type = 'uid_alias' OR NOT (l = 'DELETE' AND f = 'INSERT')""",
)
def cdc_09(spark: SparkSession, d: str) -> DataFrame:
    return changes.net_operations(change_log(spark, d).where("revision < 400"), ["uid_alias"])


@query(
    "cdc_09_net_operations_log",
    f"""WITH n AS (SELECT entity_type, entity_key, arg_min(operation, revision) AS f, arg_max(operation, revision) AS l, bool_or(operation IN ('INSERT', 'UPDATE')) AS w, max(revision) AS revision FROM {LOG_SQL} WHERE operation <> 'ALIAS' GROUP BY ALL)
    SELECT entity_type, entity_key, CASE WHEN entity_type = 'uid_alias' THEN 'UPSERT' WHEN l = 'DELETE' THEN 'DELETE' WHEN w THEN 'UPSERT' ELSE 'RETIRE' END AS operation, revision FROM n WHERE entity_type = 'uid_alias' OR NOT (l = 'DELETE' AND f = 'INSERT')""",
)
def cdc_09_log(spark: SparkSession, d: str) -> DataFrame:
    """As cdc_09_net_operations, over the log from its first revision to its last."""
    return changes.net_operations(change_log(spark, d), ["uid_alias"])


@query("cdc_14_replay", "SELECT CAST(NULL AS BIGINT) AS p_partkey, CAST(NULL AS BIGINT) AS cost, CAST(NULL AS VARCHAR) AS side WHERE false")
def cdc_14(spark: SparkSession, d: str) -> DataFrame:
    """The old table with the operations applied differs from the new one in no row."""
    part = table(spark, d, "part")
    old = part.where(PREVIOUS).selectExpr("p_partkey", f"{OLD_COST} AS cost")
    new = part.where(CURRENT).selectExpr("p_partkey", f"{ITEM['cost']} AS cost")
    o = old.select(F.col("p_partkey").alias("k"), F.col("cost").alias("was"))
    both = new.join(o, new["p_partkey"] == o["k"], "full").select(F.coalesce("p_partkey", "k").alias("p_partkey"), F.when(F.col("p_partkey").isNull(), "DELETE").when(~F.col("cost").eqNullSafe(F.col("was")), "UPSERT").alias("operation"))
    return changes.differences(changes.apply_operations(old, both.where("operation is not null"), new, "p_partkey"), new)


@query(
    "cdc_20_upsert",
    """WITH t AS (SELECT o_orderkey, o_orderstatus, 1 AS changed_at FROM orders WHERE o_orderkey % 3 > 0), s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)
    SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey) UNION ALL SELECT s.o_orderkey, s.o_orderstatus, CASE WHEN t.o_orderkey IS NULL OR t.o_orderstatus IS DISTINCT FROM s.o_orderstatus THEN 2 ELSE t.changed_at END FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey""",
)
def cdc_20(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    target = o.where("o_orderkey % 3 > 0").select("o_orderkey", "o_orderstatus", F.lit(1).alias("changed_at"))
    source = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return changes.upsert(target, source, "o_orderkey", "o_orderstatus", F.lit(2))


@query(
    "cdc_21_consecutive",
    "WITH p AS (SELECT DISTINCT user_id, 3 AS first_run, CAST(user_id % 4 AS BIGINT) AS runs FROM events WHERE event_type = 'click'), s AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') SELECT s.user_id, coalesce(p.first_run, 9) AS first_run, 9 AS last_run, coalesce(p.runs, 0) + 1 AS runs FROM s LEFT JOIN p USING (user_id)",
)
def cdc_21(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    known = events.where("event_type = 'click'").select("user_id").distinct().selectExpr("user_id", "3 AS first_run", "CAST(user_id % 4 AS BIGINT) AS runs")
    return changes.consecutive(known, events.where("event_type = 'error'"), "user_id", F.lit(9))


@query(
    "cdc_22_frontier_merge",
    """WITH b AS (SELECT o_custkey AS item_id, o_orderkey % 6 AS depth, o_orderkey AS parent_id, CASE WHEN o_orderstatus = 'F' THEN 'catalog' ELSE 'reference' END AS entry_kind FROM orders)
    SELECT item_id, arg_min(depth, depth * 1000000000 + parent_id) AS depth, arg_min(parent_id, depth * 1000000000 + parent_id) AS parent_id, CASE WHEN bool_or(entry_kind = 'catalog') THEN 'catalog' ELSE 'reference' END AS entry_kind FROM b GROUP BY item_id""",
)
def cdc_22(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").selectExpr("o_custkey AS item_id", "o_orderkey % 6 AS depth", "o_orderkey AS parent_id", "CASE WHEN o_orderstatus = 'F' THEN 'catalog' ELSE 'reference' END AS entry_kind")
    return lifecycle.merge_frontier(rows.where("parent_id % 2 = 0"), rows.where("parent_id % 2 = 1"))


@query("cdc_24_archive", "SELECT count(*) FILTER (WHERE NOT old) AS kept, count(*) FILTER (WHERE old) AS archived, count(*) AS before FROM (SELECT ts < TIMESTAMP '2024-01-15' AS old FROM events)")
def cdc_24(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    kept, archived = changes.archive_split(events, F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return kept.agg(F.count("*").alias("kept")).join(archived.agg(F.count("*").alias("archived"))).join(events.agg(F.count("*").alias("before")))


@query("agg_18_retained", "SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(week(o_orderdate) AS INTEGER) AS iso_week, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2")
def agg_18(spark: SparkSession, d: str) -> DataFrame:
    return changes.retained_per_week(table(spark, d, "orders"), "o_orderkey", "o_orderdate")


@query(
    "graph_01_chains",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT kind, from_uid, to_uid FROM {LINKS_SQL}), n AS (SELECT kind, from_uid AS uid FROM e UNION SELECT kind, to_uid FROM e),
    w(kind, chain_id, uid, position, path) AS (SELECT kind, uid, uid, 0, [uid] FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.kind = n.kind AND e.to_uid = n.uid)
    UNION ALL SELECT w.kind, w.chain_id, e.to_uid, w.position + 1, list_append(w.path, e.to_uid) FROM w JOIN e ON e.kind = w.kind AND e.from_uid = w.uid WHERE NOT list_contains(w.path, e.to_uid))
    SELECT kind, uid, chain_id, CAST(position AS BIGINT) AS position FROM w QUALIFY row_number() OVER (PARTITION BY kind, uid ORDER BY position, chain_id) = 1""",
)
def graph_01(spark: SparkSession, d: str) -> DataFrame:
    return graph.chains(links(spark, d))


RING_SQL = "SELECT 'ring' AS kind, CAST(c_custkey % 40 AS BIGINT) AS from_uid, CAST((c_custkey * 7 + 3) % 60 AS BIGINT) AS to_uid FROM customer"


@query(
    "graph_02_cycles",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({RING_SQL})), r(a, b) AS (SELECT from_uid, to_uid FROM e UNION SELECT r.a, e.to_uid FROM r JOIN e ON e.from_uid = r.b), c AS (SELECT DISTINCT a AS u FROM r WHERE a = b),
    f AS (SELECT u FROM c UNION SELECT r.b FROM r JOIN c ON c.u = r.a), t AS (SELECT u FROM c UNION SELECT r.a FROM r JOIN c ON c.u = r.b) SELECT DISTINCT 'ring' AS kind, f.u AS uid FROM f JOIN t ON t.u = f.u""",
)
def graph_02(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "customer").createOrReplaceTempView("customer_in")
    return graph.in_cycles(spark.sql(RING_SQL.replace("FROM customer", "FROM customer_in")))


RINGS_SQL = "SELECT 'ring' AS kind, CAST(floor(c_custkey / 120) AS BIGINT) * 100 + c_custkey % 40 AS from_uid, CAST(floor(c_custkey / 120) AS BIGINT) * 100 + (c_custkey * 7 + 3) % 60 AS to_uid FROM customer"


@query(
    "graph_02_cycles_in_blocks",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({RINGS_SQL})), r(a, b) AS (SELECT from_uid, to_uid FROM e UNION SELECT r.a, e.to_uid FROM r JOIN e ON e.from_uid = r.b), c AS (SELECT DISTINCT a AS u FROM r WHERE a = b),
    f AS (SELECT u FROM c UNION SELECT r.b FROM r JOIN c ON c.u = r.a), t AS (SELECT u FROM c UNION SELECT r.a FROM r JOIN c ON c.u = r.b) SELECT DISTINCT 'ring' AS kind, f.u AS uid FROM f JOIN t ON t.u = f.u""",
)
def graph_02_blocks(spark: SparkSession, d: str) -> DataFrame:
    """As graph_02_cycles, with links within blocks of 120 customers, so that keys and cycles grow with the table."""
    table(spark, d, "customer").createOrReplaceTempView("customer_in")
    return graph.in_cycles(spark.sql(RINGS_SQL.replace("FROM customer", "FROM customer_in")))


DOC_RINGS_SQL = "SELECT 'ring' AS kind, CAST(floor(doc_id / 60) AS BIGINT) * 100 + doc_id % 20 AS from_uid, CAST(floor(doc_id / 60) AS BIGINT) * 100 + (doc_id * 7 + 3) % 30 AS to_uid FROM documents"


@query(
    "graph_02_cycles_documents",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({DOC_RINGS_SQL})), r(a, b) AS (SELECT from_uid, to_uid FROM e UNION SELECT r.a, e.to_uid FROM r JOIN e ON e.from_uid = r.b), c AS (SELECT DISTINCT a AS u FROM r WHERE a = b),
    f AS (SELECT u FROM c UNION SELECT r.b FROM r JOIN c ON c.u = r.a), t AS (SELECT u FROM c UNION SELECT r.a FROM r JOIN c ON c.u = r.b) SELECT DISTINCT 'ring' AS kind, f.u AS uid FROM f JOIN t ON t.u = f.u""",
)
def graph_02_documents(spark: SparkSession, d: str) -> DataFrame:
    """As graph_02_cycles_in_blocks, with links between documents in blocks of 60."""
    table(spark, d, "documents").createOrReplaceTempView("documents_in")
    return graph.in_cycles(spark.sql(DOC_RINGS_SQL.replace("FROM documents", "FROM documents_in")))


@query(
    "graph_03_alias_ends",
    "WITH RECURSIVE a AS (SELECT p_partkey AS o, CAST(floor(p_partkey / 2) AS BIGINT) AS n FROM part WHERE p_partkey % 4 > 0), w AS (SELECT o, n FROM a UNION ALL SELECT w.o, a.n FROM w JOIN a ON a.o = w.n) SELECT o AS old_uid, n AS end_uid FROM w WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o = w.n)",
)
def graph_03(spark: SparkSession, d: str) -> DataFrame:
    return graph.alias_ends(table(spark, d, "part").where("p_partkey % 4 > 0").selectExpr("p_partkey AS old_uid", "CAST(floor(p_partkey / 2) AS BIGINT) AS new_uid"))


@query(
    "graph_04_expand",
    """WITH l AS (SELECT CAST(floor(p_partkey / 3) AS BIGINT) AS s, CASE WHEN p_partkey % 2 = 0 THEN 'evolution' ELSE 'enlightening' END AS kind, p_partkey AS t FROM part WHERE p_partkey > 0),
    d0 AS (SELECT p_partkey AS i FROM part WHERE p_partkey < 4), d1 AS (SELECT DISTINCT t AS i FROM l JOIN d0 ON s = i WHERE t NOT IN (SELECT i FROM d0)),
    d2 AS (SELECT DISTINCT t AS i FROM l JOIN d1 ON s = i WHERE kind = 'enlightening' AND t NOT IN (SELECT i FROM d0 UNION SELECT i FROM d1)) SELECT i AS item_id, 0 AS depth FROM d0 UNION ALL SELECT i, 1 FROM d1 UNION ALL SELECT i, 2 FROM d2""",
)
def graph_04(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    linked = part.where("p_partkey > 0").selectExpr("CAST(floor(p_partkey / 3) AS BIGINT) AS source_id", "CASE WHEN p_partkey % 2 = 0 THEN 'evolution' ELSE 'enlightening' END AS kind", "p_partkey AS target_id")
    return graph.expand(part.where("p_partkey < 4").select(F.col("p_partkey").alias("item_id")), linked, {"evolution": 1, "enlightening": 2})


@query(
    "graph_04_expand_many",
    """WITH RECURSIVE l AS (SELECT CAST(floor(p_partkey / 3) AS BIGINT) AS s, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 6 END AS most, p_partkey AS t FROM part WHERE p_partkey > 0),
    w(i, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_partkey % 5 = 1 UNION SELECT l.t, w.depth + 1 FROM w JOIN l ON l.s = w.i WHERE w.depth < l.most) SELECT i AS item_id, min(depth) AS depth FROM w GROUP BY i""",
)
def graph_04_many(spark: SparkSession, d: str) -> DataFrame:
    """As graph_04_expand, from a fifth of all parts and down to depth six."""
    part = table(spark, d, "part")
    linked = part.where("p_partkey > 0").selectExpr("CAST(floor(p_partkey / 3) AS BIGINT) AS source_id", "CASE WHEN p_partkey % 2 = 0 THEN 'evolution' ELSE 'enlightening' END AS kind", "p_partkey AS target_id")
    return graph.expand(part.where("p_partkey % 5 = 1").select(F.col("p_partkey").alias("item_id")), linked, {"evolution": 2, "enlightening": 6})


@query(
    "graph_04_expand_documents",
    """WITH RECURSIVE l AS (SELECT CAST(floor(doc_id / 3) AS BIGINT) AS s, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 6 END AS most, doc_id AS t FROM documents WHERE doc_id > 0),
    w(i, depth) AS (SELECT doc_id, 0 FROM documents WHERE doc_id % 5 = 1 UNION SELECT l.t, w.depth + 1 FROM w JOIN l ON l.s = w.i WHERE w.depth < l.most) SELECT i AS item_id, min(depth) AS depth FROM w GROUP BY i""",
)
def graph_04_documents(spark: SparkSession, d: str) -> DataFrame:
    """As graph_04_expand_many, over links between documents."""
    docs = table(spark, d, "documents")
    linked = docs.where("doc_id > 0").selectExpr("CAST(floor(doc_id / 3) AS BIGINT) AS source_id", "CASE WHEN doc_id % 2 = 0 THEN 'evolution' ELSE 'enlightening' END AS kind", "doc_id AS target_id")
    return graph.expand(docs.where("doc_id % 5 = 1").select(F.col("doc_id").alias("item_id")), linked, {"evolution": 2, "enlightening": 6})


@query(
    "scope_01_decisions",
    f"""SELECT reason, reason IN ('name_token', 'cost_band') AS keep, count(*) AS n FROM (SELECT CASE WHEN lower(name) LIKE '%rod%' THEN 'excluded_name' WHEN cost = 89 THEN 'cosmetic' WHEN lower(name) LIKE '%hot%' THEN 'name_token'
    WHEN rarity NOT IN ('UR') THEN 'rarity' WHEN cost BETWEEN 42 AND 80 THEN 'cost_band' ELSE 'cost' END AS reason FROM {ITEMS_SQL}) GROUP BY ALL""",
)
def scope_01(spark: SparkSession, d: str) -> DataFrame:
    scope = lifecycle.Scope(42, 80, 89, ("UR",), bypass=("HOT",), excluded=("Rod",))
    return lifecycle.decide_scope(items(spark, d), scope).groupBy("reason", "keep").agg(F.count("*").alias("n"))


@query(
    "life_01_status",
    """WITH i AS (SELECT p_partkey AS uid FROM part), f AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 0 THEN 'gone' ELSE 'done' END AS s, CASE WHEN p_partkey % 6 > 0 THEN p_partkey % 8 END AS r FROM part WHERE p_partkey % 9 > 0),
    p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN 'retired' ELSE 'live' END AS state, CASE WHEN p_partkey % 8 = 0 THEN 2 END AS rr FROM part WHERE p_partkey % 5 > 0),
    j AS (SELECT uid, CASE WHEN s = 'gone' THEN 'gone' WHEN f.k IS NULL OR r IS NULL OR r < 3 THEN 'out_of_scope' END AS reason, p.k, p.state AS ps, p.rr FROM i LEFT JOIN f ON f.k = uid LEFT JOIN p ON p.k = uid)
    SELECT uid, CASE WHEN reason IS NULL THEN 'live' ELSE 'retired' END AS state, reason AS retire_reason, CAST(CASE WHEN reason IS NULL THEN NULL WHEN ps = 'retired' THEN coalesce(rr, 7) ELSE 7 END AS BIGINT) AS retired_revision,
    reason IS NOT NULL AND (k IS NULL OR ps = 'live') AS newly_retired, reason IS NULL AND coalesce(ps = 'retired', false) AS revived FROM j""",
)
def life_01(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    frontier = part.where("p_partkey % 9 > 0").selectExpr("p_partkey AS item_id", "CASE WHEN p_partkey % 10 = 0 THEN 'gone' ELSE 'done' END AS frontier_state", "CASE WHEN p_partkey % 6 > 0 THEN p_partkey % 8 END AS decided_run_id")
    old = part.where("p_partkey % 5 > 0").selectExpr("p_partkey AS uid", "CASE WHEN p_partkey % 4 = 0 THEN 'retired' ELSE 'live' END AS state", "CASE WHEN p_partkey % 8 = 0 THEN 2 END AS retired_revision")
    return lifecycle.equipment_status(part.select(F.col("p_partkey").alias("uid")), frontier, old, last_complete_run=F.lit(3), revision=F.lit(REVISION))


@query("life_02_new_items", "SELECT user_id, min(ts) AS first_seen, min(ts) >= (SELECT max(ts) FROM events) - INTERVAL 29 DAY AS is_new_item FROM events GROUP BY user_id")
def life_02(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    seen = events.groupBy("user_id").agg(F.min("ts").alias("first_seen")).join(F.broadcast(events.agg(F.max("ts").alias("now"))))
    return lifecycle.new_items(seen, "first_seen", F.col("now"), 29).drop("now")


@query(
    "life_03_replacements",
    f"""WITH i AS (SELECT * FROM {ITEMS_SQL}), s AS (SELECT DISTINCT uid, label, tier, value % 3 AS value FROM {STATS_SQL}),
    p AS (SELECT o.uid AS old_uid, n.uid AS new_uid, n.name, n.gear_type, n.rarity FROM i o JOIN i n ON o.name = n.name AND o.gear_type = n.gear_type AND o.rarity = n.rarity AND o.uid <> n.uid WHERE o.uid LIKE '%1' AND n.uid NOT LIKE '%1'),
    c AS (SELECT old_uid, new_uid, label, tier, value, 'o' AS side FROM p JOIN s ON s.uid = old_uid UNION ALL SELECT old_uid, new_uid, label, tier, value, 'n' FROM p JOIN s ON s.uid = new_uid),
    k AS (SELECT old_uid, new_uid, label, tier, value, count(DISTINCT side) AS sides FROM c GROUP BY ALL),
    z AS (SELECT p.*, CAST(coalesce(sum(CASE WHEN sides = 2 THEN 1 ELSE 0 END), 0) AS BIGINT) AS e, count(k.label) AS t FROM p LEFT JOIN k ON k.old_uid = p.old_uid AND k.new_uid = p.new_uid GROUP BY ALL)
    SELECT old_uid, new_uid, CASE WHEN t = 0 THEN 1.0 ELSE e / t END AS score, CAST(json_object('name', name, 'gear_type', gear_type, 'rarity', rarity, 'stats_equal', e, 'stats_total', t) AS VARCHAR) AS evidence FROM z WHERE CASE WHEN t = 0 THEN 1.0 ELSE e / t END >= 0.5""",
)
def life_03(spark: SparkSession, d: str) -> DataFrame:
    i = items(spark, d)
    s = stats(spark, d).select("uid", "label", "tier", (F.col("value") % 3).alias("value")).distinct()
    return lifecycle.replacements(i.where("uid LIKE '%1'"), i.where("uid NOT LIKE '%1'"), s, ["name", "gear_type", "rarity"], 0.5)


@query(
    "effect_links",
    f"""SELECT doc_id, CAST(ordinal AS BIGINT) AS ordinal, {hash_id_sql('line')} AS effect_id, line FROM (SELECT doc_id, i AS ordinal, {clean_sql('l', False)} AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)) WHERE line <> ''""",
)
def effect_links(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "l"))
    cleaned = lines.select("doc_id", (F.col("at") + 1).cast("long").alias("ordinal"), tx.clean_text("l", empty_as_null=False).alias("line"))
    return cleaned.where("line <> ''").withColumn("effect_id", tx.hash_id("line"))

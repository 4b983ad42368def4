"""Queries on update packages: payloads, order, replay over whole aggregates, windows, decisions, and what is carried on.

Two revisions of orders with their lines: some orders are new, some gone, some written anew, and some retired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import packages
from millrace.operators.changes import differences
from millrace.operators.packages import Part, Reference, Whole
from millrace.plans.catalog import table
from millrace.plans.registry import query

REVISION = 9
ORDER = Whole("order", "orders", "o_orderkey", (Part("lines", ("l_orderkey",), ("l_linenumber", "l_partkey", "qty")), Part("first_line", ("f_orderkey",), ("f_suppkey",), single=True)))
OLD, NEW, CHANGED, RETIRED = "o_orderkey % 7 <> 3", "o_orderkey % 11 <> 4", "o_orderkey % 5 = 0", "o_orderkey % 13 = 0"
OLD_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "'live' AS state", "CAST(NULL AS BIGINT) AS retired_revision"]
NEW_ORDER = [
    "o_orderkey", "o_custkey", f"CASE WHEN {CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus",
    f"CASE WHEN {RETIRED} THEN 'retired' ELSE 'live' END AS state", f"CAST(CASE WHEN {RETIRED} THEN {REVISION} END AS BIGINT) AS retired_revision",
]
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "CAST(l_quantity AS BIGINT) AS qty"]
NEW_LINE = [*LINE[:3], "CAST(l_quantity + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS qty"]
FIRST = ["l_orderkey AS f_orderkey", "l_linenumber AS f_linenumber", "l_suppkey AS f_suppkey"]
OPERATION = f"CASE WHEN {OLD} AND NOT ({NEW}) THEN 'DELETE' WHEN {NEW} AND (NOT ({OLD}) OR {CHANGED}) THEN 'UPSERT' WHEN {NEW} AND {RETIRED} THEN 'RETIRE' END"
OPERATIONS_SQL = f"(SELECT o_orderkey AS key, {OPERATION} AS operation, CAST({REVISION} AS BIGINT) AS rev FROM orders)"


def state(spark: SparkSession, d: str, where: str, order: list[str], line: list[str]) -> dict[str, DataFrame]:
    orders = table(spark, d, "orders").where(where)
    lines = table(spark, d, "lineitem").where(where.replace("o_orderkey", "l_orderkey"))
    return {"orders": orders.selectExpr(*order), "lines": lines.selectExpr(*line), "first_line": lines.where("l_linenumber = 1").selectExpr(*FIRST)}


def old(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return state(spark, d, OLD, OLD_ORDER, LINE)


def new(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return state(spark, d, NEW, NEW_ORDER, NEW_LINE)


def operations(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.expr(OPERATION).alias("operation"))
    return found.where("operation IS NOT NULL").select(F.lit("order").alias("entity"), "key", "operation", F.lit(REVISION).cast("long").alias("rev"))


def sql_of(columns: list[str], source: str, where: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source} WHERE {where}"


LINES = "lineitem"
NEW_LINES_WHERE, OLD_LINES_WHERE = NEW.replace("o_orderkey", "l_orderkey"), OLD.replace("o_orderkey", "l_orderkey")


@query(
    "cdc_10_payloads",
    f"""WITH k AS (SELECT key FROM {OPERATIONS_SQL} WHERE operation = 'UPSERT'), o AS ({sql_of(NEW_ORDER, 'orders', NEW)}), l AS ({sql_of(NEW_LINE, LINES, NEW_LINES_WHERE)}), f AS (SELECT l_orderkey AS f_orderkey, min(l_suppkey) AS f_suppkey FROM lineitem WHERE l_linenumber = 1 GROUP BY 1),
    a AS (SELECT l_orderkey AS key, list(struct_pack(l_orderkey, l_linenumber, l_partkey, qty) ORDER BY l_linenumber, l_partkey, qty) AS listed FROM l JOIN k ON k.key = l_orderkey GROUP BY l_orderkey)
    SELECT k.key, o.o_orderstatus, o.state, CAST(coalesce(len(listed), 0) AS INTEGER) AS n_lines, CAST(coalesce(list_sum(list_transform(listed, lambda x: x.qty)), 0) AS BIGINT) AS qty, listed[1].l_partkey AS first_part, f.f_suppkey
    FROM k JOIN o ON o.o_orderkey = k.key LEFT JOIN a ON a.key = k.key LEFT JOIN f ON f.f_orderkey = k.key""",
)
def cdc_10(spark: SparkSession, d: str) -> DataFrame:
    """What an update carries of each order that is written anew, with some of each payload's fields."""
    keys = operations(spark, d).where("operation = 'UPSERT'").select("key")
    made = packages.payloads(ORDER, new(spark, d), keys)
    total = F.aggregate("data.lines", F.lit(0).cast("long"), lambda a, x: a + x["qty"])
    return made.select("key", "data.orders.o_orderstatus", "data.orders.state", F.size("data.lines").alias("n_lines"), total.alias("qty"), F.get("data.lines", F.lit(0))["l_partkey"].alias("first_part"), F.col("data.first_line.f_suppkey").alias("f_suppkey"))


ENTITIES = ("customer", "order")
MIXED_SQL = f"""(SELECT 'order' AS entity, key, operation FROM {OPERATIONS_SQL} WHERE operation IS NOT NULL UNION ALL SELECT 'customer', c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'UPSERT' WHEN 1 THEN 'ALIAS' WHEN 2 THEN 'DELETE' ELSE 'RETIRE' END FROM customer)"""


@query(
    "cdc_11_operation_order",
    f"""SELECT entity, key, operation, row_number() OVER (ORDER BY CASE operation WHEN 'UPSERT' THEN 1 WHEN 'RETIRE' THEN 2 WHEN 'ALIAS' THEN 3 ELSE 4 END,
    CASE WHEN operation = 'UPSERT' THEN CASE entity WHEN 'customer' THEN 1 ELSE 2 END WHEN operation = 'DELETE' THEN CASE entity WHEN 'customer' THEN -1 ELSE -2 END ELSE 0 END, key, entity) - 1 AS position FROM {MIXED_SQL}""",
)
def cdc_11(spark: SparkSession, d: str) -> DataFrame:
    kinds = "CASE c_custkey % 4 WHEN 0 THEN 'UPSERT' WHEN 1 THEN 'ALIAS' WHEN 2 THEN 'DELETE' ELSE 'RETIRE' END AS operation"
    customers = table(spark, d, "customer").selectExpr("'customer' AS entity", "c_custkey AS key", kinds)
    return packages.ordered_operations(operations(spark, d).select("entity", "key", "operation").union(customers), ENTITIES)


def applied(spark: SparkSession, d: str, keep: str = "true") -> dict[str, DataFrame]:
    return packages.apply_package([ORDER], old(spark, d), operations(spark, d).where(keep), new(spark, d))


@query("cdc_13_apply_roots", sql_of(NEW_ORDER, "orders", NEW))
def cdc_13_roots(spark: SparkSession, d: str) -> DataFrame:
    return applied(spark, d)["orders"]


@query("cdc_13_apply_children", sql_of(NEW_LINE, LINES, NEW_LINES_WHERE))
def cdc_13_children(spark: SparkSession, d: str) -> DataFrame:
    return applied(spark, d)["lines"]


@query("cdc_14_replay_proof", "SELECT t AS \"table\", true AS same FROM (VALUES ('orders'), ('lines'), ('first_line')) v(t) WHERE (SELECT count(*) FROM orders) > 0")
def cdc_14_proof(spark: SparkSession, d: str) -> DataFrame:
    """The old revision with the package applied has the new one's digests, table by table."""
    return packages.prove(new(spark, d), applied(spark, d))


@query(
    "cdc_14_broken_replay",
    f"""SELECT o_orderkey, o_orderstatus, state, 'left' AS side FROM ({sql_of(OLD_ORDER, 'orders', f'{OLD} AND NOT ({NEW})')}) UNION ALL
    SELECT o_orderkey, o_orderstatus, state, 'left' FROM ({sql_of(OLD_ORDER, 'orders', f"{OPERATION} = 'RETIRE'")}) UNION ALL SELECT o_orderkey, o_orderstatus, state, 'right' FROM ({sql_of(NEW_ORDER, 'orders', f"{OPERATION} = 'RETIRE'")})""",
)
def cdc_14_broken(spark: SparkSession, d: str) -> DataFrame:
    """What a package without its deletions and retirements leaves wrong."""
    columns = ["o_orderkey", "o_orderstatus", "state"]
    return differences(applied(spark, d, "operation = 'UPSERT'")["orders"].select(*columns), new(spark, d)["orders"].select(*columns))


@query(
    "cdc_15_supported_revisions",
    """WITH r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS revision, event_type, value FROM events), n AS (SELECT user_id, max(revision) AS newest FROM r GROUP BY 1),
    w AS (SELECT r.user_id, revision, newest - revision AS back, event_type <> 'error' AND value <= 90 * 0.5 AS qualifies FROM r JOIN n USING (user_id) WHERE revision % 9 <> 0 AND newest - revision BETWEEN 1 AND 30),
    f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY back) AS nth FROM w WHERE qualifies) SELECT user_id, revision FROM f WHERE nth = back""",
)
def cdc_15(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events are revisions, every ninth is missing, errors don't qualify, and a package costs the event's value."""
    numbered = table(spark, d, "events").select("user_id", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long").alias("revision"), "event_type", "value")
    newest = numbered.groupBy("user_id").agg(F.max("revision").alias("newest"))
    qualifies = (F.col("event_type") != "error") & packages.small_enough(F.col("value"), F.lit(90), 0.5)
    rows = numbered.where("revision % 9 <> 0").join(newest, "user_id").withColumn("qualifies", qualifies)
    return packages.supported_revisions(rows, ["user_id"], F.col("newest"), 30)


@query(
    "cdc_16_snapshot_only",
    """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice > 200000 THEN 'package_size' END, CASE WHEN o_orderkey % 5 = 0 THEN 'dataset_schema_version' END, CASE WHEN o_orderstatus = 'P' THEN 'forced' END, CASE WHEN o_orderkey < 10 THEN 'first_release' END], lambda x: x IS NOT NULL), ',') AS reasons FROM orders""",
)
def cdc_16(spark: SparkSession, d: str) -> DataFrame:
    flags = {"forced": F.col("o_orderstatus") == "P", "package_size": F.col("o_totalprice") > 200000, "first_release": F.col("o_orderkey") < 10, "dataset_schema_version": F.col("o_orderkey") % 5 == 0}
    return table(spark, d, "orders").select("o_orderkey", F.array_join(packages.snapshot_only_reasons(flags), ",").alias("reasons"))


DEEP = (Whole("part", "parts", "p_partkey", (Part("stock", ("s_partkey",)),)), Whole("supplier", "suppliers", "s_suppkey"), Whole("nation", "nations", "n_nationkey"))
REFERS = [Reference("lines", "l_partkey", "parts", "p_partkey", "l_linenumber <> 2"), Reference("stock", "s_suppkey", "suppliers", "s_suppkey"), Reference("suppliers", "s_nationkey", "nations", "n_nationkey")]
STOCK_SQL = "(SELECT DISTINCT l_partkey AS s_partkey, l_suppkey AS s_suppkey FROM lineitem WHERE l_quantity > 45)"


@query(
    "cdc_17_carry_forward",
    f"""WITH k AS (SELECT o_orderkey AS key FROM orders WHERE o_orderkey % 17 = 0 AND {OLD} AND NOT ({NEW})), l AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN k ON key = l_orderkey),
    p AS (SELECT DISTINCT p_partkey FROM part JOIN l ON l_partkey = p_partkey WHERE l_linenumber <> 2 AND p_partkey % 3 = 0), st AS (SELECT s.* FROM {STOCK_SQL} s JOIN p ON s.s_partkey = p.p_partkey),
    su AS (SELECT DISTINCT supplier.s_suppkey, s_nationkey FROM supplier JOIN st ON st.s_suppkey = supplier.s_suppkey WHERE supplier.s_suppkey % 2 = 0), n AS (SELECT DISTINCT n_nationkey FROM nation JOIN su ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 1)
    SELECT 'orders' AS "table", CAST(key AS VARCHAR) AS id FROM k UNION ALL SELECT 'lines', l_orderkey || '-' || l_linenumber FROM l UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR) FROM p UNION ALL SELECT 'stock', s_partkey || '-' || s_suppkey FROM st
    UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR) FROM su UNION ALL SELECT 'nations', CAST(n_nationkey AS VARCHAR) FROM n""",
)
def cdc_17(spark: SparkSession, d: str) -> DataFrame:
    """Orders that could not be read, their lines, and the parts, stock, suppliers and nations that these need."""
    part, supplier, nation = (table(spark, d, n) for n in ("part", "supplier", "nation"))
    stock = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("s_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    whole = Whole("order", "orders", "o_orderkey", (Part("lines", ("l_orderkey",)),))
    was = {k: v for k, v in old(spark, d).items() if k != "first_line"} | {"parts": part.select("p_partkey"), "stock": stock, "suppliers": supplier.select("s_suppkey", "s_nationkey"), "nations": nation.select("n_nationkey")}
    now = {"orders": new(spark, d)["orders"], "parts": part.where("p_partkey % 3 <> 0").select("p_partkey"), "suppliers": supplier.where("s_suppkey % 2 <> 0").select("s_suppkey"), "nations": nation.where("n_nationkey % 2 <> 1").select("n_nationkey")}
    failed = table(spark, d, "orders").where("o_orderkey % 17 = 0").select(F.col("o_orderkey").alias("key"))
    carried = packages.carry_forward(whole, now, was, failed, list(DEEP), REFERS)
    ids = {"orders": ["o_orderkey"], "lines": ["l_orderkey", "l_linenumber"], "parts": ["p_partkey"], "stock": ["s_partkey", "s_suppkey"], "suppliers": ["s_suppkey"], "nations": ["n_nationkey"]}
    rows = [df.select(F.lit(n).alias("table"), F.concat_ws("-", *ids[n]).alias("id")) for n, df in carried.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@query(
    "cdc_25_retention",
    """WITH o AS (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'snapshots/' WHEN 1 THEN 'manifests/' WHEN 2 THEN 'updates/' || (o_orderkey - 1) || '-' WHEN 3 THEN 'backups/' WHEN 4 THEN 'notes/' ELSE 'snapshots/x' END || o_orderkey AS path, o_orderdate AS stored, o_orderkey AS r, o_orderkey % 6 AS m FROM orders),
    lim AS (SELECT floor(max(o_orderkey) * 0.75) AS least, max(CAST(o_orderdate AS DATE)) AS now FROM orders), wk AS (SELECT max(r) AS kept FROM o, lim WHERE m = 0 AND floor(date_diff('day', CAST(stored AS DATE), now) / 7) <= 20 GROUP BY date_trunc('week', stored)),
    c AS (SELECT path, CASE m WHEN 0 THEN 'snapshot' WHEN 1 THEN 'manifest' WHEN 2 THEN 'update' WHEN 3 THEN 'backup' ELSE 'unknown' END AS kind, r, r IN (SELECT kept FROM wk) AS weekly, date_diff('day', CAST(stored AS DATE), now) AS age, least FROM o, lim)
    SELECT path, kind, CASE WHEN kind = 'unknown' THEN 'unknown' WHEN (kind IN ('snapshot', 'manifest') AND (r >= CAST(least AS BIGINT) OR weekly)) OR (kind = 'update' AND r >= CAST(least AS BIGINT)) OR (kind = 'backup' AND age <= 90) THEN 'keep' ELSE 'delete' END AS verdict FROM c""",
)
def cdc_25(spark: SparkSession, d: str) -> DataFrame:
    path = "concat(CASE o_orderkey % 6 WHEN 0 THEN 'snapshots/' WHEN 1 THEN 'manifests/' WHEN 2 THEN concat('updates/', o_orderkey - 1, '-') WHEN 3 THEN 'backups/' WHEN 4 THEN 'notes/' ELSE 'snapshots/x' END, o_orderkey) AS path"
    orders = table(spark, d, "orders")
    last = orders.agg(F.max("o_orderkey").alias("k"), F.max("o_orderdate").cast("date").alias("at")).first()
    return packages.retained(orders.selectExpr(path, "o_orderdate AS stored_at"), int((last["k"] or 0) * 0.75), F.lit(last["at"]), 20, 90)


@query(
    "cdc_26_update_decision",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 50 >= 40 THEN 'none' WHEN o_orderkey % 50 < 12 THEN 'snapshot' ELSE (o_orderkey % 50) || '-40' END AS decision FROM orders",
)
def cdc_26(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", packages.update_decision(F.col("o_orderkey") % 50, F.lit(40), F.lit(12)).alias("decision"))


#: Readers of a catalogue for each language, and its revisions: some don't qualify.
READERS_SQL = "SELECT doc_id, lang, CAST(doc_id % 14 AS BIGINT) AS have FROM documents"
REVISIONS_SQL = "SELECT DISTINCT lang, CAST(doc_id % 14 AS BIGINT) AS revision, NOT (lang = 'fr' AND doc_id % 14 = 5 OR lang = 'de' AND doc_id % 14 = 11) AS qualifies FROM documents WHERE lang <> 'es' AND doc_id % 14 < CASE lang WHEN 'en' THEN 12 ELSE 13 END"


@query(
    "cdc_26_update_decisions",
    f"""WITH c AS ({READERS_SQL}), r AS ({REVISIONS_SQL}), p AS (SELECT lang, max(revision) AS newest FROM r GROUP BY lang),
    w AS (SELECT r.lang, r.revision FROM r JOIN p USING (lang) WHERE r.revision >= 1 AND newest - r.revision BETWEEN 1 AND 8 AND NOT EXISTS (SELECT 1 FROM generate_series(r.revision, newest - 1) AS g(k) WHERE NOT EXISTS (SELECT 1 FROM r q WHERE q.lang = r.lang AND q.revision = k AND q.qualifies)))
    SELECT c.*, CASE WHEN newest IS NULL THEN 'unknown' WHEN have >= newest THEN 'none' WHEN w.revision IS NOT NULL THEN have || '-' || newest ELSE 'snapshot-' || newest END AS decision FROM c LEFT JOIN p USING (lang) LEFT JOIN w ON w.lang = c.lang AND w.revision = c.have""",
)
def cdc_26_decisions(spark: SparkSession, d: str) -> DataFrame:
    """What each reader is offered, from the catalogues' pointers and windows."""
    table(spark, d, "documents").createOrReplaceTempView("documents_in")
    readers, revisions = (spark.sql(q.replace("FROM documents", "FROM documents_in")) for q in (READERS_SQL, REVISIONS_SQL))
    pointers = revisions.groupBy("lang").agg(F.max("revision").alias("newest"))
    windows = packages.supported_revisions(revisions.join(pointers, "lang"), ["lang"], F.col("newest"), 8)
    return packages.update_decisions(readers, pointers, windows, ["lang"])


#: A log with all that is forbidden: repeated operations, revisions outside, aliases to themselves and before retirements.
FAULTY_SQL = "(SELECT CASE WHEN event_id % 2 = 0 THEN 'order' ELSE 'customer' END AS entity, user_id AS key, CASE event_type WHEN 'click' THEN 'ALIAS' WHEN 'purchase' THEN 'RETIRE' WHEN 'error' THEN 'DROP' ELSE 'UPSERT' END AS operation, event_id % 100 AS rev, CASE WHEN event_id % 3 = 0 THEN user_id ELSE user_id + 1 END AS target, event_id AS position FROM events)"


@query(
    "cdc_27_invariants",
    f"""WITH o AS (SELECT * FROM {FAULTY_SQL}), b AS (SELECT 'duplicate' AS invariant, entity, key FROM o GROUP BY operation, entity, key HAVING count(*) > 1 UNION ALL SELECT 'revision', entity, key FROM o WHERE NOT (rev > 3 AND rev <= 97) UNION ALL SELECT 'self_alias', entity, key FROM o WHERE operation = 'ALIAS' AND target = key
    UNION ALL SELECT 'alias_before_retire', entity, key FROM o GROUP BY entity, key HAVING max(CASE WHEN operation = 'RETIRE' THEN position END) > min(CASE WHEN operation = 'ALIAS' THEN position END) UNION ALL SELECT 'operation', entity, key FROM o WHERE operation = 'DROP')
    SELECT invariant, entity, key, count(*) AS n FROM b GROUP BY ALL""",
)
def cdc_27(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("events_in")
    log = spark.sql(f"SELECT * FROM {FAULTY_SQL.replace('FROM events', 'FROM events_in')}")
    return packages.broken_invariants(log, F.lit(3), F.lit(97)).groupBy("invariant", "entity", "key").agg(F.count("*").alias("n"))

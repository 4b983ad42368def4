"""Queries on quality: expectations, metrics, the gate's findings and decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import gate, quality
from millrace.plans.catalog import ITEMS_SQL, items, table
from millrace.plans.registry import query
from millrace.plans.sourcing import folder


@query("dq_01_unique", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def dq_01(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique(table(spark, d, "part"), "p_name")


@query("dq_02_accepted_values", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def dq_02(spark: SparkSession, d: str) -> DataFrame:
    return quality.accepted_values(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("dq_03_relationships", "SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')")
def dq_03(spark: SparkSession, d: str) -> DataFrame:
    return quality.relationships(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders").where("o_orderstatus <> 'P'"), "o_orderkey").select("l_orderkey", "l_linenumber")


@query("dq_04_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_04(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique_combination(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_05_polymorphic", "SELECT event_id FROM events WHERE event_type = 'purchase' AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def dq_05(spark: SparkSession, d: str) -> DataFrame:
    owners = table(spark, d, "customer").where("c_custkey % 2 = 0")
    return quality.polymorphic_relationship(table(spark, d, "events"), "event_type", "purchase", "user_id", owners, "c_custkey").select("event_id")


@query("dq_06_vocabulary", "SELECT p_type, count(*) AS n FROM part WHERE p_type NOT IN (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) FROM part) GROUP BY p_type")
def dq_06(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "part").select(F.lit("gear_type").alias("domain"), F.upper(F.split("p_name", " ")[0]).alias("value")).distinct()
    return quality.in_vocabulary(table(spark, d, "part"), "p_type", words, "gear_type")


@query(
    "dq_07_expectation_run",
    """SELECT 'orders_customer' AS name, 'structural' AS grp, count(*) AS failures FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'price_null', 'info', count(*) FROM orders WHERE o_totalprice IS NULL UNION ALL SELECT 'lang_known', 'policy', count(*) FROM (SELECT lang FROM documents WHERE lang NOT IN ('en', 'de') GROUP BY lang)""",
)
def dq_07(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return quality.run_expectations(
        [
            quality.Expectation("orders_customer", quality.relationships(orders, "o_custkey", table(spark, d, "customer"), "c_custkey")),
            quality.Expectation("price_null", quality.not_null(orders, "o_totalprice"), "info"),
            quality.Expectation("lang_known", quality.accepted_values(table(spark, d, "documents"), "lang", ["en", "de"]), "policy"),
        ]
    )


RATES = {"orders": ["o_orderstatus", "o_orderdate"], "documents": ["text", "lang", "source"], "events": ["props", "value"]}
RATES_SQL = " UNION ALL ".join(f"SELECT 'null_rate.{t}.{c}' AS metric, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS value FROM {t}" for t, cs in RATES.items() for c in cs)


@query("agg_06_null_rates", RATES_SQL)
def agg_06(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality.null_rates(table(spark, d, t), cs, t) for t, cs in RATES.items()])


@query(
    "obs_metrics_with_previous",
    """WITH m AS (SELECT 'orders.' || o_orderstatus AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1), p AS (SELECT 'orders.' || o_orderstatus AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders WHERE o_orderkey % 3 > 0 AND o_orderstatus <> 'P' GROUP BY 1)
    SELECT m.metric, m.value, p.value AS prev_value, round(CASE WHEN p.value IS NULL OR p.value = 0 THEN NULL ELSE 100.0 * (m.value - p.value) / p.value END, 9) AS delta_pct FROM m LEFT JOIN p USING (metric)""",
)
def obs_metrics(spark: SparkSession, d: str) -> DataFrame:
    counts = lambda o: o.groupBy(F.concat(F.lit("orders."), "o_orderstatus").alias("metric")).agg(F.count("*").cast("double").alias("value"))
    orders = table(spark, d, "orders")
    return quality.with_previous(counts(orders), counts(orders.where("o_orderkey % 3 > 0 AND o_orderstatus <> 'P'")))


@query("rpt_population", f"SELECT scope, count(*) AS value FROM (SELECT unnest(CASE WHEN cost > 85 THEN ['catalog', 'new_item'] WHEN rarity = 'UR' THEN ['catalog'] ELSE ['reference'] END) AS scope FROM {ITEMS_SQL}) GROUP BY scope")
def rpt_population(spark: SparkSession, d: str) -> DataFrame:
    scopes = F.when(F.col("cost") > 85, F.array(F.lit("catalog"), F.lit("new_item"))).when(F.col("rarity") == "UR", F.array(F.lit("catalog"))).otherwise(F.array(F.lit("reference")))
    return items(spark, d).select(F.explode(scopes).alias("scope")).groupBy("scope").agg(F.count("*").alias("value"))


POLICY = """
[check.icon_missing]
scopes = { reference = "info", new_item = "warning", catalog = "warning" }
escalate = { scope = "catalog", level = "blocker", min_count = 5, min_pct = 4.0 }

[check.unlisted]
scopes = { reference = "info", catalog = "info" }
escalate = { scope = "catalog", level = "warning", min_runs = 3 }
"""
ROWS_SQL = """(SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'icon_missing' ELSE 'unlisted' END AS check_name, concat('p', l_partkey) AS entity_key, CASE WHEN l_suppkey % 3 = 0 THEN 'reference' ELSE 'catalog' END AS entry_kind,
l_partkey % 10 = 0 AS is_new_item, CAST(1 AS BIGINT) AS affected, CAST(l_linenumber AS BIGINT) AS runs FROM lineitem WHERE l_returnflag = 'R' AND l_quantity < 10)"""


def gate_input(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "lineitem").createOrReplaceTempView("lineitem_in")
    rows = spark.sql(f"SELECT * FROM {ROWS_SQL.replace('FROM lineitem', 'FROM lineitem_in')}")
    return quality.gate_rows(rows, entity_type=F.lit("equipment"), entity_key=F.col("entity_key"), entry_kind=F.col("entry_kind"), is_new_item=F.col("is_new_item"), affected=F.col("affected"), runs=F.col("runs"), detail=F.col("check_name")).withColumnRenamed("detail", "check")


FINDINGS_SQL = f"""WITH pop AS (SELECT CASE WHEN p_size % 3 = 0 THEN 'reference' ELSE 'catalog' END AS scope, count(*) AS value FROM part GROUP BY 1),
pol(check_name, scope, base, raised, min_count, min_pct, min_runs) AS (VALUES ('icon_missing', 'catalog', 1, 2, 5, 4.0, NULL), ('icon_missing', 'reference', 0, NULL, 0, 0.0, NULL), ('icon_missing', 'new_item', 1, NULL, 0, 0.0, NULL), ('unlisted', 'catalog', 0, 1, 0, 0.0, 3), ('unlisted', 'reference', 0, NULL, 0, 0.0, NULL)),
s AS (SELECT *, CASE WHEN is_new_item AND check_name = 'icon_missing' THEN 'new_item' ELSE entry_kind END AS scope FROM {ROWS_SQL}),
o AS (SELECT check_name, scope, entity_key, max(affected) AS affected, max(runs) AS runs FROM s GROUP BY ALL),
j AS (SELECT o.*, base, raised, min_count, min_pct, min_runs, min_runs IS NOT NULL AND coalesce(runs, 0) >= min_runs AS long FROM o JOIN pol USING (check_name, scope)),
g AS (SELECT check_name, scope, base, raised, min_count, min_pct, min_runs, long, count(*) AS count, CAST(sum(affected) AS BIGINT) AS affected, min(entity_key) AS first_key FROM j GROUP BY ALL),
z AS (SELECT g.*, round(100.0 * affected / value, 6) AS pct FROM g LEFT JOIN pop USING (scope)),
f AS (SELECT check_name AS "check", scope, count, affected, pct, first_key, base, raised, raised IS NOT NULL AND (long OR (min_runs IS NULL AND affected >= min_count AND coalesce(pct >= min_pct, false))) AS escalated FROM z),
r AS (SELECT "check", scope, CASE WHEN escalated THEN raised ELSE base END AS level, count, affected, pct, escalated, first_key FROM f)"""


def found(spark: SparkSession, d: str) -> DataFrame:
    population = table(spark, d, "part").groupBy(F.when(F.col("p_size") % 3 == 0, "reference").otherwise("catalog").alias("scope")).agg(F.count("*").alias("value"))
    return gate.findings(gate_input(spark, d), gate.Policy.parse(POLICY).frame(spark), population)


@query("gate_01_findings", FINDINGS_SQL + " SELECT * FROM r")
def gate_01(spark: SparkSession, d: str) -> DataFrame:
    return found(spark, d).select("check", "scope", "level", "count", "affected", "pct", "escalated", "first_key")


@query("gate_02_decision", FINDINGS_SQL + " SELECT CASE coalesce(max(level), 0) WHEN 2 THEN 'blocker' WHEN 1 THEN 'warning' ELSE 'pass' END AS decision, coalesce(max(level), 0) < 2 AS publishable, count(*) AS findings FROM r")
def gate_02(spark: SparkSession, d: str) -> DataFrame:
    return gate.decide(found(spark, d))


@query("gate_03_samples", f"SELECT check_name AS \"check\", array_to_string(list(entity_key ORDER BY entity_key), ',') AS keys FROM (SELECT DISTINCT check_name, entity_key FROM {ROWS_SQL} QUALIFY dense_rank() OVER (PARTITION BY check_name ORDER BY entity_key) <= 20) GROUP BY check_name")
def gate_03(spark: SparkSession, d: str) -> DataFrame:
    return gate.samples(gate_input(spark, d)).select("check", F.array_join("keys", ",").alias("keys"))


STRICT = """
[check.late]
scopes = { reference = "info", catalog = "warning", new_item = "info" }
escalate = { scope = "catalog", level = "blocker", min_count = 3, min_pct = 1.0 }
[check.returned]
scopes = { catalog = "warning" }
escalate = { scope = "catalog", level = "blocker", min_runs = 6 }
[check.canary]
scopes = { catalog = "blocker" }
"""
#: Rows of checks with and without a rule, scopes without one, and counts below nothing; and a population of which the
#: late rows of the catalog are a little less than the share at which they would escalate.
ODD_ROWS_SQL = """(SELECT CASE WHEN l_linenumber = 1 THEN 'late' WHEN l_linenumber = 2 THEN 'returned' WHEN l_linenumber = 3 THEN 'misread' ELSE NULL END AS check_name, concat('o', l_orderkey) AS entity_key,
CASE WHEN l_suppkey % 4 = 0 THEN 'reference' WHEN l_suppkey % 4 = 1 THEN NULL ELSE 'catalog' END AS entry_kind, l_partkey % 10 = 0 AS is_new_item, CAST(l_partkey % 5 - 1 AS BIGINT) AS affected, CAST(l_orderkey % 8 AS BIGINT) AS runs FROM lineitem WHERE l_linenumber < 4)"""
ALL_FINDINGS_SQL = f"""WITH pol(check_name, scope, base, raised, min_count, min_pct, min_runs) AS (VALUES ('late', 'catalog', 1, 2, 3, 1.0, NULL), ('late', 'reference', 0, NULL, 0, 0.0, NULL), ('late', 'new_item', 0, NULL, 0, 0.0, NULL), ('returned', 'catalog', 1, 2, 0, 0.0, 6), ('canary', 'catalog', 2, NULL, 0, 0.0, NULL)),
s AS (SELECT * EXCLUDE entry_kind, CASE WHEN is_new_item AND check_name = 'late' THEN 'new_item' ELSE coalesce(entry_kind, 'catalog') END AS scope FROM {ODD_ROWS_SQL} WHERE check_name IS NOT NULL),
o AS (SELECT check_name, scope, entity_key, arg_max(greatest(affected, 0), greatest(affected, 0) * 100 + runs) AS affected, arg_max(runs, greatest(affected, 0) * 100 + runs) AS runs FROM s GROUP BY ALL),
pop AS (SELECT 'catalog' AS scope, 100 * sum(affected) + 1 AS value FROM o WHERE check_name = 'late' AND scope = 'catalog'),
j AS (SELECT o.*, base, raised, min_count, min_pct, min_runs, coalesce(runs >= min_runs, false) AS long FROM o LEFT JOIN pol USING (check_name, scope)),
g AS (SELECT check_name, scope, base, raised, min_count, min_pct, min_runs, long, count(*) AS count, CAST(sum(affected) AS BIGINT) AS affected, max(runs) AS runs FROM j GROUP BY ALL),
f AS (SELECT g.*, value, raised IS NOT NULL AND (long OR (min_runs IS NULL AND affected >= min_count AND coalesce(100.0 * affected / value >= min_pct, false))) AS escalated FROM g LEFT JOIN pop USING (scope) WHERE base IS NULL OR min_runs IS NOT NULL OR affected > 0),
r AS (SELECT check_name AS "check", scope, CAST(CASE WHEN escalated THEN raised ELSE coalesce(base, 0) END AS INTEGER) AS level, count, affected, round(100.0 * affected / value, 6) AS pct, escalated,
 CASE WHEN check_name NOT IN (SELECT check_name FROM pol) THEN 'no rule for the check ' || check_name WHEN base IS NULL THEN check_name || ': scope ' || scope || ' not in policy' WHEN min_runs IS NOT NULL THEN check_name || ': ' || affected || ' in ' || scope || CASE WHEN runs > 0 THEN ', up to ' || runs || ' runs' ELSE '' END ELSE check_name || ': ' || affected || ' in ' || scope || CASE WHEN value IS NOT NULL THEN ' of ' || value ELSE '' END END AS message FROM f)"""


def all_found(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "lineitem").createOrReplaceTempView("lineitem_in")
    rows = spark.sql(f"SELECT * FROM {ODD_ROWS_SQL.replace('FROM lineitem', 'FROM lineitem_in')}").where("check_name IS NOT NULL")
    gated = quality.gate_rows(rows, entity_type=F.lit("order"), entity_key=F.col("entity_key"), entry_kind=F.col("entry_kind"), is_new_item=F.col("is_new_item"), affected=F.col("affected"), runs=F.col("runs"), detail=F.col("check_name")).withColumnRenamed("detail", "check")
    late = gated.where("check = 'late' AND coalesce(entry_kind, 'catalog') = 'catalog' AND NOT is_new_item").groupBy("entity_key").agg(F.max(F.greatest("affected", F.lit(0))).alias("n"))
    population = late.agg((100 * F.sum("n") + 1).alias("value")).select(F.lit("catalog").alias("scope"), "value")
    return gate.findings(gated, gate.Policy.parse(STRICT).frame(spark), population)


@query("gate_04_findings_without_rules", ALL_FINDINGS_SQL + " SELECT * FROM r")
def gate_04(spark: SparkSession, d: str) -> DataFrame:
    return all_found(spark, d).select("check", "scope", "level", "count", "affected", "pct", "escalated", "message")


@query(
    "gate_05_consecutive_runs",
    """WITH past AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS run_id, event_type AS "check", 'u' || CAST(user_id % 40 AS VARCHAR) AS scope, CASE WHEN value > 20 THEN 1 ELSE 0 END AS level FROM events),
    last AS (SELECT max(run_id) AS m FROM past), runs AS (SELECT run_id, row_number() OVER (ORDER BY run_id DESC) AS back FROM (SELECT DISTINCT run_id FROM past, last WHERE run_id < m)),
    hits AS (SELECT DISTINCT p."check", p.scope, back FROM past p JOIN runs USING (run_id) WHERE level >= 1), k AS (SELECT *, row_number() OVER (PARTITION BY "check", scope ORDER BY back) AS nth FROM hits),
    s AS (SELECT "check", scope, count(*) AS n FROM k WHERE nth = back GROUP BY ALL), f AS (SELECT "check", scope, max(level) AS level FROM past, last WHERE run_id = m GROUP BY ALL)
    SELECT f."check", f.scope, f.level, 1 + coalesce(n, 0) AS consecutive_runs FROM f LEFT JOIN s ON s."check" = f."check" AND s.scope = f.scope""",
)
def gate_05(spark: SparkSession, d: str) -> DataFrame:
    """Each day of the events is a run; the findings of the last day with how many runs in a row they have lasted."""
    day = F.date_format("ts", "yyyy-MM-dd")
    past = table(spark, d, "events").select(day.alias("run_id"), day.alias("started_at"), F.col("event_type").alias("check"), F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string")).alias("scope"), F.when(F.col("value") > 20, 1).otherwise(0).alias("level")).distinct()
    last = past.agg(F.max("run_id").alias("m")).first()["m"] or ""
    now = past.where(F.col("run_id") == last).groupBy("check", "scope").agg(F.max("level").alias("level"))
    return gate.with_streaks(now, past, last, last)


@query(
    "gate_06_run_findings",
    """WITH r AS (SELECT 'check' || (o_custkey % 50) AS name, CASE o_custkey % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'policy' ELSE 'structural' END AS grp, CASE WHEN min(o_orderstatus) = 'F' AND o_custkey % 7 = 0 THEN 'fail' WHEN o_custkey % 11 = 0 THEN 'skipped' WHEN o_custkey % 2 = 0 THEN 'warn' ELSE 'pass' END AS status, count(*) AS failures, CASE WHEN o_custkey % 5 = 0 THEN 'seen' END AS message FROM orders GROUP BY o_custkey),
    t AS (SELECT *, status IN ('fail', 'skipped') AS broken FROM r WHERE status IN ('fail', 'skipped') OR (status = 'warn' AND grp <> 'policy'))
    SELECT CASE WHEN broken THEN 'run' ELSE name END AS "check", CAST(CASE WHEN broken THEN 3 ELSE 0 END AS INTEGER) AS level, failures AS affected, name AS sources, CASE WHEN broken THEN concat_ws(' ', name, status, message) WHEN grp = 'info' THEN coalesce(message, name || ': ' || failures || ' rows') ELSE 'unclassified warning ' || name END AS message FROM t""",
)
def gate_06(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderstatus").alias("least"), F.count("*").alias("failures")).selectExpr(
        "concat('check', o_custkey % 50) AS name", "CASE o_custkey % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'policy' ELSE 'structural' END AS grp",
        "CASE WHEN least = 'F' AND o_custkey % 7 = 0 THEN 'fail' WHEN o_custkey % 11 = 0 THEN 'skipped' WHEN o_custkey % 2 = 0 THEN 'warn' ELSE 'pass' END AS status",
        "failures", "CASE WHEN o_custkey % 5 = 0 THEN 'seen' END AS message",
    )
    return gate.run_findings(results).select("check", "level", "affected", "sources", "message")


@query("gate_07_recorded", ALL_FINDINGS_SQL + """, c AS (SELECT "check", scope, level, affected, escalated FROM r UNION ALL SELECT 'canary', 'catalog', 2, 1, false) SELECT "check", scope, max(level) AS level, CAST(sum(affected) AS BIGINT) AS affected, bool_or(escalated) AS escalated FROM c GROUP BY ALL""")
def gate_07(spark: SparkSession, d: str) -> DataFrame:
    """Findings with a failed canary, recorded and read again: one row for each check and scope."""
    at, policy = folder(spark), gate.Policy.parse(STRICT).frame(spark)
    every = all_found(spark, d).unionByName(gate.canary_finding(policy, failed=True)).withColumn("consecutive_runs", F.lit(1))
    gate.record(every, at, "run1")
    return gate.recorded(spark, at).select("check", "scope", "level", "affected", "escalated")


SHIPPED = {"document": ["doc_id", "lang"], "page": ["page_id", "url"], "vector": ["vec_id"]}


@query(
    "dq_s12_shipped",
    """SELECT 'document' AS table_name, 'unexpected column n_chars' AS fault, count(*) AS n FROM documents UNION ALL SELECT 'page', 'missing column url', count(*) FROM pages UNION ALL SELECT 'label', 'unexpected', count(*) FROM labels UNION ALL SELECT 'vector', 'missing', NULL""",
)
def dq_s12(spark: SparkSession, d: str) -> DataFrame:
    """What a published database has beyond or short of the shipped tables, with the rows of what is there."""
    at = folder(spark)
    name = at.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{at}'")
    for t, source, columns in (("document", "documents", ["doc_id", "lang", "n_chars"]), ("page", "pages", ["page_id"]), ("label", "labels", ["doc_id"])):
        table(spark, d, source).select(*columns).write.saveAsTable(f"{name}.{t}")
    found = quality.catalog_of(spark, name)
    faults = spark.createDataFrame(quality.shipped_faults(found, SHIPPED), "table_name string, fault string")
    counts = reduce(DataFrame.unionByName, [spark.table(f"{name}.{t}").agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in found])
    return faults.join(counts, "table_name", "left")

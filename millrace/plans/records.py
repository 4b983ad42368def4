"""Queries on records of equipment pages, effects, the frontier, strict JSON and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import effects as fx
from millrace.functions import text as tx
from millrace.functions.pages import cell, page_tables, rows_of, spread
from millrace.operators import lifecycle
from millrace.operators.hashes import named_digest
from millrace.operators.quality import contract_violations
from millrace.plans.catalog import table
from millrace.plans.registry import query
from millrace.plans.sourcing import DIGEST_SQL, folder
from millrace.sources import files

TARGET_SQL = "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END"
FIRST_SQL = "lower(p_type) || ' up by ' || p_size || '%'"
SECOND_SQL = "'second effect of ' || p_partkey"
AMPLIFIER_SQL = "'ability power boosted by 5 for each increase in skill level.'"
SCALES_SQL = "'max power scales with level ' || p_partkey % 7"
RATE_SQL = "p_size || '% per turn'"
CONDITION_SQL = "'hp below ' || p_size || '%'"
#: The cell of a skill, as a page has it: derived from the parts.
CELL_SQL = (
    f"concat('-', coalesce('target: ' || {TARGET_SQL} || ' . ', ''), {FIRST_SQL}, ' -', {SECOND_SQL}, ' ', {AMPLIFIER_SQL}, "
    f"chr(10), '[activation]', chr(10), {CONDITION_SQL}, chr(10), '[activation rate]', chr(10), {RATE_SQL}, chr(10), {SCALES_SQL})"
)
EFFECTS_SQL = " UNION ALL ".join(
    f"SELECT p_partkey, CAST({i} AS BIGINT) AS ordinal, {t} AS target, {e} AS description FROM part" for i, (t, e) in enumerate([(TARGET_SQL, FIRST_SQL), ("NULL", SECOND_SQL), ("NULL", AMPLIFIER_SQL)], 1)
)
BROKEN = "p_partkey % 10 = 0"


def skill_cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("p_partkey", f"{CELL_SQL} AS cell")


def equipment_pages(spark: SparkSession, d: str) -> DataFrame:
    """page_id and html of a page for each part, with the sums of its order lines as stats; some have no title."""
    row = F.concat(F.lit("<tr><th>"), F.lower("l_returnflag"), F.lit("</th><td>+"), F.lower("l_linestatus"), F.lit("</td><td>"), F.format_number("value", 0), F.lit("</td></tr>"))
    sums = table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("value"))
    stats = sums.groupBy("l_partkey").agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("stats"))
    parts = table(spark, d, "part").join(stats, F.col("p_partkey") == F.col("l_partkey"), "left")
    html = f"""concat(CASE WHEN {BROKEN} THEN '' ELSE '<title>' || p_name || '</title>' END, '<h2>basic data</h2><table><tr><th>gear type</th><td>', p_type, '</td></tr><tr><th>gear cost</th><td>1,', lpad(p_size, 3, '0'), '</td></tr></table>',
    '<h2>stats</h2><table>', coalesce(stats, ''), '</table><h2>skill</h2><table><tr><th>', p_brand, '</th><td>', replace({CELL_SQL}, chr(10), '<br>'), '</td></tr></table>',
    '<h2>hidden potential</h2><table><tr><th>lv ', p_size, '</th><td>second</td></tr><tr><th>lv 0</th><td>first</td></tr><tr><th>restrictions</th><td>', p_brand, '</td></tr></table>') AS html"""
    return parts.selectExpr("p_partkey AS page_id", html)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    # a page for each part
    return page_tables(spread(equipment_pages(spark, d), table(spark, d, "part").count()))


@query("udf_03_effects", EFFECTS_SQL)
def udf_03_effects(spark: SparkSession, d: str) -> DataFrame:
    lines = fx.section(fx.sections("cell"), fx.EFFECTS)
    rows = skill_cells(spark, d).select("p_partkey", F.posexplode(fx.effect_structs(lines)).alias("ordinal", "e"))
    return rows.select("p_partkey", (F.col("ordinal") + 1).cast("long").alias("ordinal"), "e.target", "e.description")


@query(
    "udf_03_sections",
    "SELECT p_partkey, 'effects' AS section, ordinal, coalesce('target: ' || target || ' . ', '') || description AS line FROM (" + EFFECTS_SQL + ")"
    + "".join(f" UNION ALL SELECT p_partkey, '{s}', CAST({i} AS BIGINT), {e} FROM part" for s, i, e in [("activation", 1, CONDITION_SQL), ("activation rate", 1, RATE_SQL), ("activation rate", 2, SCALES_SQL)]),
)
def udf_03_sections(spark: SparkSession, d: str) -> DataFrame:
    parts = skill_cells(spark, d).select("p_partkey", F.explode(fx.sections("cell")).alias("s"))
    return parts.select("p_partkey", F.col("s.name").alias("section"), F.posexplode("s.lines").alias("at", "line")).select("p_partkey", "section", (F.col("at") + 1).cast("long").alias("ordinal"), "line")


@query(
    "udf_01_equipment_pages",
    f"""SELECT CAST(p_partkey AS BIGINT) AS page_id, p_name AS name, p_type AS gear_type, CAST(1000 + p_size AS BIGINT) AS cost, NULL AS error FROM part WHERE NOT ({BROKEN})
    UNION ALL SELECT p_partkey, NULL, NULL, 0, 'ValueError: no title' FROM part WHERE {BROKEN}""",
)
def udf_01_equipment_pages(spark: SparkSession, d: str) -> DataFrame:
    return parsed(spark, d).select("page_id", F.col("title").alias("name"), cell(F.col("rows"), "gear type").alias("gear_type"), fx.whole_number(cell(F.col("rows"), "gear cost")).alias("cost"), "error")


@query(
    "udf_04_stats",
    f"SELECT CAST(p_partkey AS BIGINT) AS page_id, lower(l_returnflag) AS label, lower(l_linestatus) AS tier, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value FROM part JOIN lineitem ON l_partkey = p_partkey WHERE NOT ({BROKEN}) GROUP BY 1, 2, 3",
)
def udf_04_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = parsed(spark, d).select("page_id", F.explode(rows_of(F.col("rows"), "stats")).alias("r"))
    return rows.select("page_id", "r.label", fx.stat_tier(F.get("r.cells", F.lit(0))).alias("tier"), fx.whole_number(F.get("r.cells", F.lit(1))).alias("value"))


@query(
    "udf_04_procs",
    f"SELECT CAST(p_partkey AS BIGINT) AS page_id, p_brand AS name, target, description, {CONDITION_SQL} AS condition, {RATE_SQL} AS rate, {SCALES_SQL} AS scaling FROM part JOIN ({EFFECTS_SQL}) e USING (p_partkey) WHERE NOT ({BROKEN})",
)
def udf_04_procs(spark: SparkSession, d: str) -> DataFrame:
    rows = parsed(spark, d).select("page_id", F.explode(rows_of(F.col("rows"), "skill")).alias("r"))
    procs = rows.select("page_id", F.col("r.label").alias("name"), fx.proc(F.get("r.cells", F.lit(0))).alias("p"))
    listed = procs.select("page_id", "name", F.explode("p.effects").alias("e"), F.array_join("p.condition", "\n").alias("condition"), "p.rate", F.array_join("p.scaling", "\n").alias("scaling"))
    return listed.select("page_id", "name", "e.target", "e.description", "condition", "rate", "scaling")


@query(
    "udf_04_potentials",
    f"SELECT CAST(p_partkey AS BIGINT) AS page_id, level, description, p_brand AS restrictions FROM part, (SELECT 0 AS k, 'first' AS description UNION ALL SELECT 1, 'second') p, LATERAL (SELECT CAST(p_size * k AS INTEGER) AS level) WHERE NOT ({BROKEN})",
)
def udf_04_potentials(spark: SparkSession, d: str) -> DataFrame:
    pages = parsed(spark, d).select("page_id", rows_of(F.col("rows"), "hidden potential").alias("rows"))
    rows = pages.select("page_id", cell(F.col("rows"), "restrictions").alias("restrictions"), F.explode("rows").alias("r"))
    return rows.select("page_id", fx.potential_level("r.label").alias("level"), F.get("r.cells", F.lit(0)).alias("description"), "restrictions").where("level IS NOT NULL")


@query("str_11_casefold", "SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS folded FROM documents")
def str_11(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(tx.casefold("text"), 256).alias("folded"))


@query("dt_06_staleness", "SELECT user_id, max(ts) + INTERVAL 14 DAY AS expires_at, (SELECT max(ts) FROM events) > max(ts) + INTERVAL 14 DAY AS stale FROM events GROUP BY user_id")
def dt_06(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    last = events.groupBy("user_id").agg((F.max("ts") + F.expr("INTERVAL 14 DAY")).alias("expires_at"))
    return last.join(F.broadcast(events.agg(F.max("ts").alias("now")))).select("user_id", "expires_at", (F.col("now") > F.col("expires_at")).alias("stale"))


WANTED = ["c_custkey", "c_custkey % 100 AS cost_min", "c_custkey % 100 + 30 AS cost_max", "CASE c_custkey % 3 WHEN 0 THEN array('SSR') WHEN 1 THEN array('R', 'SR') ELSE array('N') END AS rarities"]


@query(
    "scope_02_clamp",
    """WITH w AS (SELECT c_custkey, c_custkey % 100 AS a, c_custkey % 100 + 30 AS b, c_custkey % 3 AS r FROM customer)
    SELECT c_custkey, CAST(least(greatest(a, 40), 90) AS BIGINT) AS cost_min, CAST(least(greatest(b, 40), 90) AS BIGINT) AS cost_max, CASE r WHEN 0 THEN 'SSR' WHEN 1 THEN 'SR' ELSE 'SSR,SR,UR' END AS rarities,
    concat_ws(',', CASE WHEN a NOT BETWEEN 40 AND 90 THEN 'cost_min' END, CASE WHEN b NOT BETWEEN 40 AND 90 THEN 'cost_max' END, CASE WHEN r > 0 THEN 'rarities' END) AS widened FROM w""",
)
def scope_02(spark: SparkSession, d: str) -> DataFrame:
    scope = lifecycle.Scope(40, 90, 1, ("SSR", "SR", "UR"))
    narrowed = lifecycle.clamp_settings(table(spark, d, "customer").selectExpr(*WANTED), scope)
    return narrowed.select("c_custkey", F.col("cost_min").cast("long"), F.col("cost_max").cast("long"), F.array_join("rarities", ",").alias("rarities"), F.array_join("widened", ",").alias("widened"))


ID_SQL = "CASE o_orderkey % 4 WHEN 0 THEN '0' || o_orderkey WHEN 1 THEN '+' || o_orderkey WHEN 2 THEN '9999999999999' || (o_orderkey + 1000000) ELSE CAST(o_orderkey AS VARCHAR(20)) END"


@query("id_01_text_ids", f"SELECT o_orderkey, {ID_SQL} AS id, o_orderkey % 4 = 3 OR o_orderkey = 0 AND false AS good FROM orders")
def id_01(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").selectExpr("o_orderkey", f"{ID_SQL} AS id")
    return ids.select("o_orderkey", "id", tx.is_id("id").alias("good"))


@query("hsh_04_effect_hash", "SELECT p_partkey, sha256('e' || chr(31) || p_name || chr(31) || p_type || chr(30) || 'r' || chr(31) || p_size) AS hash FROM part")
def hsh_04(spark: SparkSession, d: str) -> DataFrame:
    line = lambda tag, *fields: F.struct(F.lit(tag).alias("tag"), F.array(*[F.col(f).cast("string") for f in fields]).alias("fields"))
    return table(spark, d, "part").select("p_partkey", tx.effect_hash(F.array(line("e", "p_name", "p_type"), line("r", "p_size"))).alias("hash"))


@query(
    "hsh_05_named_digest",
    f"""SELECT count(*) AS rows, sha256('lineitem' || chr(31) || 'l_linenumber' || chr(31) || 'l_orderkey' || chr(31) || 'l_returnflag' || chr(31) || CAST(CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS UBIGINT) AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS VARCHAR) || '-' || CAST(CAST(sum(CAST(CAST('0x' || substr(h, 17, 15) AS UBIGINT) AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS VARCHAR)) AS digest
    FROM (SELECT sha256({DIGEST_SQL}) AS h FROM lineitem)""",
)
def hsh_05_named(spark: SparkSession, d: str) -> DataFrame:
    return named_digest(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "lineitem")


@query(
    "jsn_03_strict",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'duplicate key k' WHEN 1 THEN 'non-finite number NaN' WHEN 2 THEN 'not an object' WHEN 3 THEN 'invalid' END AS fault FROM events",
)
def jsn_03(spark: SparkSession, d: str) -> DataFrame:
    raw = """CASE event_id % 5 WHEN 0 THEN concat('{"a":', props, ',"b":{"k":1,"k":2}}') WHEN 1 THEN concat('{"a":', props, ',"b":NaN}') WHEN 2 THEN concat('[', props, ']') WHEN 3 THEN concat(props, '}') ELSE props END AS raw"""
    return table(spark, d, "events").selectExpr("event_id", raw).select("event_id", tx.json_fault("raw").alias("fault"))


@query(
    "jsn_04_contract",
    """SELECT 'o_orderkey' AS name, 'required' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS rows FROM orders UNION ALL SELECT 'o_orderstatus', 'enum', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'o_totalprice', 'minimum', count(*) FILTER (WHERE o_totalprice < 100000) FROM orders UNION ALL SELECT 'o_totalprice', 'maximum', count(*) FILTER (WHERE o_totalprice > 300000) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'pattern', count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-')) FROM orders UNION ALL SELECT 'o_comment_text', 'required', count(*) FROM orders UNION ALL SELECT 'o_custkey', 'unknown', count(*) FROM orders""",
)
def jsn_04(spark: SparkSession, d: str) -> DataFrame:
    contract = {
        "o_orderkey": {"required": True}, "o_orderstatus": {"enum": ["F", "O"]}, "o_totalprice": {"minimum": 100000, "maximum": 300000},
        "o_orderpriority": {"pattern": "^[1-3]-"}, "o_comment_text": {"required": True},
    }
    return contract_violations(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), contract)


STATE_SQL = "CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'in_flight' ELSE 'failed' END"
FRONTIER = ["o_orderkey AS item_id", "o_orderkey % 6 AS depth", f"{STATE_SQL} AS state", "CAST(o_orderkey % 4 AS INT) AS attempts", "CAST(NULL AS STRING) AS last_error"]
SETTLED_SQL = "CASE WHEN o_orderstatus <> 'F' THEN {state} WHEN o_custkey % 5 = 0 THEN 'done' WHEN o_custkey % 5 = 1 THEN 'gone' WHEN o_custkey % 5 = 2 OR o_orderkey % 4 >= 3 THEN 'failed' ELSE 'pending' END"


@query(
    "cdc_22_claim",
    f"""SELECT o_orderkey AS item_id, CASE WHEN c THEN 'in_flight' ELSE s END AS state, CAST(a + CAST(c AS INTEGER) AS INTEGER) AS attempts FROM
    (SELECT o_orderkey, s, a, s = 'pending' AND row_number() OVER (PARTITION BY s ORDER BY o_orderkey % 6, o_orderkey) <= 500 AS c FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'pending' END AS s, CASE WHEN o_orderstatus = 'F' THEN greatest(o_orderkey % 4 - 1, 0) ELSE o_orderkey % 4 END AS a FROM orders))""",
)
def cdc_22_claim(spark: SparkSession, d: str) -> DataFrame:
    """After an interrupted run: what was in flight is pending again, then the next 500 items are claimed."""
    frontier = lifecycle.reset_in_flight(table(spark, d, "orders").selectExpr(*FRONTIER))
    return lifecycle.claim(frontier, 500).select("item_id", "state", "attempts")


@query(
    "cdc_22_settle",
    f"""SELECT o_orderkey AS item_id, CASE s WHEN 'failed' THEN 'pending' ELSE s END AS state, CAST(CASE s WHEN 'failed' THEN 0 ELSE o_orderkey % 4 END AS INTEGER) AS attempts, CASE WHEN o_orderstatus = 'F' AND o_custkey % 5 > 0 THEN 'http' END AS last_error
    FROM (SELECT *, {SETTLED_SQL.format(state=STATE_SQL)} AS s FROM orders)""",
)
def cdc_22_settle(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of all items in flight, at most three attempts; then failed ones are tried anew."""
    orders = table(spark, d, "orders")
    outcomes = orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey AS item_id", "CASE o_custkey % 5 WHEN 0 THEN 'done' WHEN 1 THEN 'gone' WHEN 2 THEN 'blocked' ELSE 'failed' END AS outcome", "CASE WHEN o_custkey % 5 > 0 THEN 'http' END AS error"
    )
    return lifecycle.retry_failed(lifecycle.settle(orders.selectExpr(*FRONTIER), outcomes, 3)).select("item_id", "state", "attempts", "last_error")


@query("srt_05_ordered_export", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def srt_05(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    files.ordered_export(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_orderkey", "l_linenumber"], at)
    lines = table(spark, d, "lineitem").schema
    return files.read_ndjson(spark, at, ", ".join(f"{c} {lines[c].dataType.simpleString()}" for c in ("l_orderkey", "l_linenumber", "l_returnflag")))


@query("src_08_csv_as_text", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def src_08_text(spark: SparkSession, d: str) -> DataFrame:
    """Every column is read as text, whatever it looks like."""
    at = folder(spark)
    table(spark, d, "part").select("p_partkey", "p_name", "p_size").write.option("header", True).csv(at)
    return files.read_csv(spark, at, "p_partkey string, p_name string, p_size string")


@query("snk_04_canonical_json_orders", "SELECT CAST(json_object('a_status', o_orderstatus, 'b_customer', o_custkey, 'c_none', CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END) AS VARCHAR) AS json FROM orders")
def snk_04_orders(spark: SparkSession, d: str) -> DataFrame:
    return files.canonical_json(table(spark, d, "orders").selectExpr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS c_none", "o_orderstatus AS a_status", "o_custkey AS b_customer"))


@query("jsn_01_evidence_orders", "SELECT o_orderkey, CAST(json_object('status', o_orderstatus, 'customer', o_custkey, 'even', CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END) AS VARCHAR) AS evidence FROM orders")
def jsn_01_orders(spark: SparkSession, d: str) -> DataFrame:
    fields = {"status": F.col("o_orderstatus"), "customer": F.col("o_custkey"), "even": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))}
    return table(spark, d, "orders").select("o_orderkey", tx.json_text(**fields).alias("evidence"))


@query("agg_09_ordered_listagg_lines", "SELECT l_orderkey, string_agg(l_returnflag || l_linenumber, ', ' ORDER BY l_linenumber, l_returnflag) AS lines FROM lineitem GROUP BY l_orderkey")
def agg_09_lines(spark: SparkSession, d: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag", F.concat("l_returnflag", "l_linenumber").alias("line"))))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), ", ").alias("lines"))


@query("join_19_self_lines", "SELECT a.l_orderkey, a.l_linenumber, b.l_linenumber AS later FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_returnflag = b.l_returnflag")
def join_19_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order with the same flag; an order has a few lines."""
    a = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber")
    b = a.withColumnRenamed("l_linenumber", "later")
    return a.join(b, ["l_orderkey", "l_returnflag"]).where("l_linenumber < later").select("l_orderkey", "l_linenumber", "later")


@query(
    "src_11_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, count({c}) AS present, count(*) AS rows FROM {t}"
        for t, cs in {"customer": ["c_custkey", "c_name", "c_mktsegment"], "supplier": ["s_suppkey", "s_name"], "labels": ["doc_id", "quality", "toxic"]}.items()
        for i, c in enumerate(cs, 1)
    ),
)
def src_11(spark: SparkSession, d: str) -> DataFrame:
    """Tables and columns as the session's catalogue lists them, with how many values each column has."""
    wanted = {"customer": ["c_custkey", "c_name", "c_mktsegment"], "supplier": ["s_suppkey", "s_name"], "labels": ["doc_id", "quality", "toxic"]}
    out = []
    for t, cs in wanted.items():
        table(spark, d, t).select(*cs).createOrReplaceTempView(f"shipped_{t}")
        listed = [c.name for c in spark.catalog.listColumns(f"shipped_{t}")]
        counts = spark.table(f"shipped_{t}").agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in listed])
        rows = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(i).alias("ordinal"), F.col(c).alias("present"), F.col("_rows").alias("rows")) for i, c in enumerate(listed, 1)])
        out.append(counts.select(F.inline(rows)))
    return out[0].union(out[1]).union(out[2])

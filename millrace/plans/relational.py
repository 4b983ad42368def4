"""Relational queries: projections, joins, aggregates, windows, sets and functions over the shared tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import naming, selection
from millrace.plans.catalog import ELEMENTS, ITEMS_SQL, clean_sql, hash_id_sql, items, table
from millrace.plans.registry import query


@query("agg_01_count_grouped", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty FROM lineitem GROUP BY ALL")
def agg_01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"))


@query("agg_02_count_non_null", "SELECT count(*) AS n, count(nullif(o_orderstatus, 'P')) AS decided, count(CASE WHEN o_totalprice > 1e12 THEN 1 END) AS none FROM orders")
def agg_02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").agg(F.count("*").alias("n"), F.count(F.nullif("o_orderstatus", F.lit("P"))).alias("decided"), F.count(F.when(F.col("o_totalprice") > 1e12, 1)).alias("none"))


@query("agg_03_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey")
def agg_03(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


@query("agg_04_min_text_and_number", "SELECT p_brand, min(p_name) AS first_name, min(p_size) AS least FROM part GROUP BY p_brand")
def agg_04(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.min("p_name").alias("first_name"), F.min("p_size").alias("least"))


@query(
    "agg_05_conditional_counts",
    "SELECT c.c_nationkey, CAST(coalesce(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END), 0) AS BIGINT) AS finished, count(o.o_orderkey) AS orders "
    "FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey",
)
def agg_05(spark: SparkSession, d: str) -> DataFrame:
    per_customer = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count("*").alias("n"))
    return (
        table(spark, d, "customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey")
        .agg(F.coalesce(F.sum("f"), F.lit(0)).alias("finished"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))
    )


@query(
    "agg_07_arg_min",
    "SELECT p_brand, arg_min(p_partkey, p_size * 1000000 + p_partkey) AS smallest, arg_max(p_partkey, p_size * 1000000 + p_partkey) AS largest FROM part GROUP BY p_brand",
)
def agg_07(spark: SparkSession, d: str) -> DataFrame:
    order = F.struct("p_size", "p_partkey")
    return table(spark, d, "part").groupBy("p_brand").agg(F.min_by("p_partkey", order).alias("smallest"), F.max_by("p_partkey", order).alias("largest"))


@query("agg_08_bool_or_having", "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY l_orderkey HAVING NOT bool_or(l_tax > 0.07)")
def agg_08(spark: SparkSession, d: str) -> DataFrame:
    grouped = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_tax") > 0.07).alias("taxed"))
    return grouped.where("not taxed").drop("taxed")


@query("agg_09_ordered_listagg", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
def agg_09(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "nation").createOrReplaceTempView("nation_in")
    return spark.sql("SELECT n_regionkey, listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name) AS names FROM nation_in GROUP BY n_regionkey")


@query("agg_10_distinct_listagg", "SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def agg_10(spark: SparkSession, d: str) -> DataFrame:
    # the distinct pairs first: partial aggregates drop repeats before anything is gathered
    return table(spark, d, "part").select("p_brand", "p_type").distinct().groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list("p_type")), ", ").alias("types"))


@query("agg_12_distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def agg_12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "agg_13_scalar_counts",
    "SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_orders, (SELECT count(DISTINCT o_custkey) FROM orders) AS buyers",
)
def agg_13(spark: SparkSession, d: str) -> DataFrame:
    for t in ("customer", "orders"):
        table(spark, d, t).createOrReplaceTempView(f"{t}_in")
    return spark.sql("SELECT (SELECT count(*) FROM customer_in) AS customers, (SELECT count(*) FROM orders_in WHERE o_orderstatus = 'O') AS open_orders, (SELECT count(DISTINCT o_custkey) FROM orders_in) AS buyers")


@query(
    "agg_19_order_set_status",
    "SELECT o.o_orderkey, count(l.l_orderkey) AS pieces, CAST(coalesce(sum(CAST(p.p_size AS BIGINT)), 0) AS BIGINT) AS cost, "
    "count(CASE WHEN l.l_returnflag = 'R' THEN 1 END) AS returned, coalesce(sum(CAST(p.p_size AS BIGINT)), 0) > 100 AS over_cap "
    "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY o.o_orderkey",
)
def agg_19(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    # lines are summed up by order before they meet the orders
    sums = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("p_size").cast("long")).alias("c"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return table(spark, d, "orders").join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", zero("n").alias("pieces"), zero("c").alias("cost"), zero("r").alias("returned"), (zero("c") > 100).alias("over_cap")
    )


@query("census", "SELECT n_regionkey, c_mktsegment, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL ORDER BY ALL")
def census(spark: SparkSession, d: str) -> DataFrame:
    # counted by nation first, so that the join meets a few rows
    counts = table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    joined = counts.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_regionkey", "c_mktsegment").agg(F.sum("n").alias("n")).orderBy(F.asc_nulls_last("n_regionkey"), F.asc_nulls_last("c_mktsegment"), "n")


@query("join_01_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey")
def join_01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query(
    "join_02_many_keys",
    "SELECT a.p_partkey AS old_key, b.p_partkey AS new_key FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey",
)
def join_02(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "part").alias("a"), table(spark, d, "part").alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("p_name", "p_brand", "p_type", "p_size")]
    return a.join(b, [*same, F.col("a.p_partkey") != F.col("b.p_partkey")]).select(F.col("a.p_partkey").alias("old_key"), F.col("b.p_partkey").alias("new_key"))


@query("join_04_left_filtered", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 400000")
def join_04(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "orders").where("o_orderstatus = 'P' AND o_totalprice > 400000")
    return table(spark, d, "customer").join(some, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query(
    "join_05_composite_left",
    "SELECT l.l_orderkey, l.l_linenumber, m.l_quantity AS other_quantity FROM lineitem l LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') m ON m.l_orderkey = l.l_orderkey AND m.l_linenumber = l.l_linenumber + 1",
)
def join_05(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") - 1).alias("before"), F.col("l_quantity").alias("other_quantity"))
    lines = table(spark, d, "lineitem")
    return lines.join(m, (lines["l_orderkey"] == m["k"]) & (lines["l_linenumber"] == m["before"]), "left").select("l_orderkey", "l_linenumber", "other_quantity")


@query(
    "join_06_scope_drift",
    "SELECT coalesce(a.k, b.k, c.k) AS key, a.k IS NOT NULL AS customer, b.k IS NOT NULL AS buyer, c.k IS NOT NULL AS supplier "
    "FROM (SELECT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') b ON a.k = b.k "
    "FULL JOIN (SELECT s_suppkey * 3 AS k FROM supplier) c ON coalesce(a.k, b.k) = c.k",
)
def join_06(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("a"))
    b = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("b")).distinct()
    c = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("c"))
    both = a.join(b, F.col("a") == F.col("b"), "full").withColumn("ab", F.coalesce("a", "b"))
    return both.join(c, F.col("ab") == F.col("c"), "full").select(
        F.coalesce("ab", "c").alias("key"), *[F.col(x).isNotNull().alias(n) for x, n in (("a", "customer"), ("b", "buyer"), ("c", "supplier"))]
    )


@query(
    "join_07_set_comparison",
    "SELECT coalesce(e.k, a.k) AS key, CASE WHEN a.k IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM (SELECT DISTINCT p_partkey AS k FROM part) e "
    "FULL JOIN (SELECT DISTINCT l_partkey + 5 AS k FROM lineitem WHERE l_returnflag = 'A') a ON e.k = a.k WHERE e.k IS NULL OR a.k IS NULL",
)
def join_07(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "part").select(F.col("p_partkey").alias("key"))
    actual = table(spark, d, "lineitem").where("l_returnflag = 'A'").select((F.col("l_partkey") + 5).alias("key"))
    return selection.full_difference(expected, actual, "key")


RUN_SQL = "(SELECT max(event_id) AS revision, max(ts) AS started_at, count(*) > 10 AS bootstrap FROM events)"


@query(
    "join_08_run_constants",
    f"SELECT u.event_type, u.n, r.revision, r.bootstrap, p.hit FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) u CROSS JOIN {RUN_SQL} r LEFT JOIN (SELECT count(*) AS hit FROM events WHERE value > 1e9 HAVING count(*) > 0) p ON true",
)
def join_08(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    run = events.agg(F.max("event_id").alias("revision"), (F.count("*") > 10).alias("bootstrap"))
    hit = events.where("value > 1e9").agg(F.count("*").alias("hit")).where("hit > 0")
    # both are one row at most
    return events.groupBy("event_type").agg(F.count("*").alias("n")).join(F.broadcast(run)).join(F.broadcast(hit), F.lit(True), "left").select("event_type", "n", "revision", "bootstrap", "hit")


@query(
    "join_10_containment",
    "SELECT p_partkey, w.word, CAST(strpos(' ' || p_name || ' ', ' ' || w.word || ' ') AS INTEGER) AS place FROM part JOIN (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part) w ON strpos(' ' || p_name || ' ', ' ' || w.word || ' ') > 0",
)
def join_10(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    words = part.select(F.split("p_name", " ")[0].alias("word")).distinct()
    return selection.containment_join(part, "p_name", words, "word").select("p_partkey", "word", "place")


@query(
    "join_11_either_key",
    "SELECT c.c_custkey, m.o_orderkey FROM customer c JOIN (SELECT o_orderkey, o_custkey AS a, o_orderkey % 97 AS b FROM orders) m ON m.a = c.c_custkey OR m.b = c.c_custkey",
)
def join_11(spark: SparkSession, d: str) -> DataFrame:
    moves = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 97).alias("b"))
    return selection.either_key_join(table(spark, d, "customer"), "c_custkey", moves, ("a", "b")).select("c_custkey", "o_orderkey")


@query("join_13_semi", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') OR EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.c_custkey)")
def join_13(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).union(table(spark, d, "supplier").select("s_suppkey"))
    return table(spark, d, "customer").join(keys, F.col("c_custkey") == F.col("k"), "left_semi").select("c_custkey")


@query("join_15_anti", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
def join_15(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("join_16_null_aware_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_custkey >= 0 THEN o_custkey END FROM orders)")
def join_16(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").select(F.when(F.col("o_custkey") >= 0, F.col("o_custkey")).alias("k"))
    return selection.null_aware_anti(table(spark, d, "customer"), "c_custkey", keys, "k").select("c_custkey")


@query("join_16_null_aware_anti_with_nulls", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_custkey % 7 > 0 THEN o_custkey END FROM orders)")
def join_16_nulls(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").select(F.when(F.col("o_custkey") % 7 > 0, F.col("o_custkey")).alias("k"))
    return selection.null_aware_anti(table(spark, d, "customer"), "c_custkey", keys, "k").select("c_custkey")


@query("join_15_anti_some", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
def join_15_some(spark: SparkSession, d: str) -> DataFrame:
    pending = table(spark, d, "orders").where("o_orderstatus = 'P'")
    return table(spark, d, "customer").join(pending, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("join_16_null_aware_anti_some", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 7 > 0 AND o_custkey IS NOT NULL)")
def join_16_some(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").where("o_custkey % 7 > 0").select(F.col("o_custkey").alias("k"))
    return selection.null_aware_anti(table(spark, d, "customer"), "c_custkey", keys, "k").select("c_custkey")


@query(
    "join_16_null_aware_anti_by_segment",
    """WITH k AS (SELECT c_mktsegment AS s, count(o_orderkey) AS n, count(*) FILTER (o_totalprice > 300000) AS nulls FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
    SELECT c_custkey FROM customer JOIN k ON s = c_mktsegment WHERE nulls = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL) UNION ALL SELECT c_custkey FROM customer JOIN k ON s = c_mktsegment WHERE nulls > 0 AND c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IS NOT NULL)""",
)
def join_16_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """A null-aware anti join for each of two groups of segments: those with an expensive order and those without."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    dear = orders.where("o_totalprice > 300000").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment").distinct()
    marked = selection.mark(customer, ["c_mktsegment"], dear, "dear")
    keys = lambda status: orders.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"))
    cheap = selection.null_aware_anti(marked.where("NOT dear"), "c_custkey", keys("F"), "k")
    rest = selection.null_aware_anti(marked.where("dear AND c_custkey % 2 = 0"), "c_custkey", keys("O"), "k")
    return cheap.select("c_custkey").union(rest.select("c_custkey"))


@query("set_04_difference_some", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_04_some(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("join_10_containment_by_token", "SELECT a.p_partkey AS p_partkey, w.word AS word, CAST(instr(' ' || a.p_name || ' ', ' ' || w.word || ' ') AS INTEGER) AS place FROM part a JOIN (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_partkey % 3 = 0) w ON instr(' ' || a.p_name || ' ', ' ' || w.word || ' ') > 0")
def join_10_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Names that hold other names or first words between blanks, by an equality of tokens."""
    part = table(spark, d, "part")
    words = part.select(F.split("p_name", " ")[0].alias("word")).union(part.where("p_partkey % 3 = 0").select("p_name")).distinct()
    return selection.containment_by_token(part.select("p_partkey", "p_name"), "p_name", words, "word").select("p_partkey", "word", "place")


@query("join_17_mark", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') AS returned FROM orders o")
def join_17(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return selection.mark(table(spark, d, "orders"), ["o_orderkey"], lines, "returned").select("o_orderkey", "returned")


@query("join_19_self", "SELECT a.n_name, b.n_name AS neighbour FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_19(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "nation").alias("a"), table(spark, d, "nation").alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_name"), F.col("b.n_name").alias("neighbour"))


@query(
    "win_01_latest",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1",
)
def win_01(spark: SparkSession, d: str) -> DataFrame:
    return selection.latest_by(table(spark, d, "orders"), ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("win_05_distinct_over", "SELECT p_partkey, p_brand, count(DISTINCT p_name) OVER (PARTITION BY p_brand) AS names FROM part")
def win_05(spark: SparkSession, d: str) -> DataFrame:
    return selection.with_distinct_count(table(spark, d, "part"), ["p_brand"], "p_name", "names").select("p_partkey", "p_brand", "names")


@query(
    "win_06_streak",
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), back AS (SELECT day, row_number() OVER (ORDER BY day DESC) AS b FROM days),
    hits AS (SELECT DISTINCT user_id, b FROM events JOIN back ON day = CAST(ts AS DATE) WHERE event_type = 'error' OR user_id % 3 = 0),
    grid AS (SELECT u.user_id, back.b, h.b IS NOT NULL AS hit FROM (SELECT DISTINCT user_id FROM hits) u CROSS JOIN back LEFT JOIN hits h ON h.user_id = u.user_id AND h.b = back.b)
    SELECT user_id, coalesce(min(b) FILTER (WHERE NOT hit) - 1, count(*)) AS runs FROM grid GROUP BY user_id HAVING coalesce(min(b) FILTER (WHERE NOT hit) - 1, count(*)) > 0""",
)
def win_06(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return selection.streaks(events, events.where("event_type = 'error' OR user_id % 3 = 0"), "user_id", "day")


@query("win_07_ordinals", "SELECT p_partkey, CAST(i AS BIGINT) AS ordinal, split_part(p_name, ' ', i) AS word FROM part, unnest([1, 2]) AS u(i) WHERE split_part(p_name, ' ', i) <> ''")
def win_07(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word")).select("p_partkey", (F.col("at") + 1).cast("long").alias("ordinal"), "word").where("ordinal <= 2")


@query("sort_04_top", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_04(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "sort_06_sorted_children",
    "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS lines FROM lineitem GROUP BY l_orderkey",
)
def sort_06(spark: SparkSession, d: str) -> DataFrame:
    lines = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag")))
    shown = F.transform(lines, lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit(":"), x["l_returnflag"]))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(shown, ",").alias("lines"))


@query("set_01_union_all", "SELECT 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_nationkey FROM supplier")
def set_01(spark: SparkSession, d: str) -> DataFrame:
    part = lambda t, c: table(spark, d, t).select(F.lit(t).alias("kind"), F.col(c).alias("nation"))
    return part("customer", "c_nationkey").unionByName(part("supplier", "s_nationkey"))


@query("set_03_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set_03(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("set_04_difference", "SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def set_04(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    part = lambda f: lines.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k")).distinct()
    return part("A").join(part("R"), "k", "left_anti")


@query("set_05_multiset_difference", "SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' EXCEPT ALL SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def set_05(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    part = lambda f: lines.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k"))
    return part("A").exceptAll(part("R"))


@query("flt_03_null_safe", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM CASE WHEN o_orderkey % 3 = 0 THEN 'F' END")
def flt_03(spark: SparkSession, d: str) -> DataFrame:
    expected = F.when(F.col("o_orderkey") % 3 == 0, "F")
    return table(spark, d, "orders").where(~F.nullif("o_orderstatus", F.lit("P")).eqNullSafe(expected)).select("o_orderkey")


@query("flt_04_in_as_value", "SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size > 49) THEN p_brand END AS large_brand FROM part")
def flt_04(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    large = part.where("p_size > 49").select("p_brand")
    return selection.mark(part, ["p_brand"], large, "large").select("p_partkey", F.when(F.col("large"), F.col("p_brand")).alias("large_brand"))


@query("flt_07_coalesced_flag", "SELECT c_custkey, coalesce(o.n > 10, false) AS frequent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON o.o_custkey = c_custkey")
def flt_07(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce(F.col("n") > 10, F.lit(False)).alias("frequent"))


@query("prj_07_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS state, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 100000 THEN 'middle' END AS size FROM orders")
def prj_07(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "open").otherwise("other").alias("state"),
        F.when(price > 400000, "large").when(price > 100000, "middle").alias("size"),
    )


@query("prj_02_contract", "SELECT CAST(c_custkey AS BIGINT) AS uid, CAST(c_name AS VARCHAR) AS name, CAST(c_nationkey AS BIGINT) AS nation, CAST(c_acctbal AS DOUBLE) AS balance FROM customer")
def prj_02(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    return tx.conform(src, {"uid": "long", "name": "string", "nation": "long", "balance": "double"}, required=["uid", "name"])


@query("str_09_clean_text", f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents")
def str_09(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.clean_text("text").alias("cleaned"))


@query(
    "str_01_text_functions",
    "SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS up, replace(p_name, ' ', '  ') AS wide, CAST(strpos(p_name, 'i') AS INTEGER) AS at, "
    "starts_with(p_name, 'red') AS red, ends_with(p_name, 'ring') AS ring, substr(p_name, 1, 3) AS head, p_name || chr(31) || p_brand AS joined, nullif(p_type, 'PROMO') AS kind FROM part",
)
def str_01(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.upper(n).alias("up"), F.replace(n, F.lit(" "), F.lit("  ")).alias("wide"), F.instr(n, "i").alias("at"),
        n.startswith("red").alias("red"), n.endswith("ring").alias("ring"), n.substr(1, 3).alias("head"), F.concat(n, F.lit(chr(31)), "p_brand").alias("joined"), F.nullif("p_type", F.lit("PROMO")).alias("kind"),
    )


@query("rgx_06_slug", "SELECT c_custkey, nullif(trim(regexp_replace(lower(c_mktsegment || ' - ' || c_name), '[^a-z0-9]+', '_', 'g'), '_'), '') AS slug FROM customer")
def rgx_06(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", tx.slug(F.concat("c_mktsegment", F.lit(" - "), "c_name")).alias("slug"))


@query("hsh_01_hash_id", f"SELECT doc_id, {hash_id_sql('text', 'source')} AS id FROM documents")
def hsh_01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.hash_id("text", "source").alias("id"))


@query("mth_04_shard", "SELECT doc_id, CAST(CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT) % 28 AS BIGINT) AS shard FROM documents")
def mth_04(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.shard("doc_id", 28).alias("shard"))


@query(
    "mth_03_percent_change",
    """WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS v FROM orders GROUP BY 1)
    SELECT m.month, m.v, p.v AS prev, round(CASE WHEN p.v IS NULL OR p.v = 0 THEN NULL ELSE 100.0 * (m.v - p.v) / p.v END, 6) AS pct FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 1 MONTH""",
)
def mth_03(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "orders").groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.sum(F.round("o_totalprice").cast("long")).alias("v"))
    p = m.select((F.col("month") + F.expr("interval 1 month")).alias("following"), F.col("v").alias("prev"))
    return m.join(p, F.col("month") == F.col("following"), "left").select("month", "v", "prev", F.round(tx.percent_change("v", "prev"), 6).alias("pct"))


@query(
    "dt_01_iso_round_trip",
    "SELECT event_id, try_strptime(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END, '%Y-%m-%dT%H:%M:%SZ') AS parsed, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS shown FROM events",
)
def dt_01(spark: SparkSession, d: str) -> DataFrame:
    shown = tx.iso_text("ts")
    return table(spark, d, "events").select("event_id", tx.iso_ts(F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(shown)).alias("parsed"), shown.alias("shown"))


@query(
    "dt_02_durations",
    "SELECT o_orderkey, CAST(date_diff('day', o_orderdate, l.first_ship) AS BIGINT) AS days, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey",
)
def dt_02(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    o = table(spark, d, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("o_orderkey", F.datediff("first_ship", "o_orderdate").cast("long").alias("days"), F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate")).alias("quarter"))


@query("jsn_01_evidence", "SELECT n_nationkey, CAST(json_object('name', n_name, 'region', n_regionkey, 'even', CASE WHEN n_nationkey % 2 = 0 THEN n_name END) AS VARCHAR) AS evidence FROM nation")
def jsn_01(spark: SparkSession, d: str) -> DataFrame:
    fields = {"name": F.col("n_name"), "region": F.col("n_regionkey"), "even": F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))}
    return table(spark, d, "nation").select("n_nationkey", tx.json_text(**fields).alias("evidence"))


@query("jsn_02_properties", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsn_02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("cst_01_try_cast", "SELECT p_partkey, try_cast(nullif(regexp_extract(p_brand, '#(\\d+)', 1), '') AS BIGINT) AS brand, try_cast(p_type AS BIGINT) AS none FROM part")
def cst_01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.nullif(F.regexp_extract("p_brand", r"#(\d+)", 1), F.lit("")).try_cast("long").alias("brand"), F.col("p_type").try_cast("long").alias("none"))


@query(
    "arr_01_lists",
    "SELECT o_custkey, len(list(DISTINCT o_orderstatus)) AS states, list_contains(list(o_orderstatus), 'P') AS pending FROM orders GROUP BY o_custkey",
)
def arr_01(spark: SparkSession, d: str) -> DataFrame:
    states = F.collect_set("o_orderstatus")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.size(states).cast("long").alias("states"), F.array_contains(states, "P").alias("pending"))


NAME_SQL = "p_name || CASE p_partkey % 5 WHEN 0 THEN ' XL+' WHEN 1 THEN ' 2s' WHEN 2 THEN ' blue' ELSE '' END"
#: What NAME_SQL and LINE_SQL put together, from the words and keys that they were made of.
WORDS_SQL = f"(SELECT *, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS noun, list_contains({ELEMENTS!r}, split_part(p_name, ' ', 1)) AS coloured FROM part)"


@query(
    "proc_names",
    f"""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'xl+' WHEN 1 THEN '2s' END AS size, CASE WHEN p_partkey % 5 = 2 THEN p_name || ' blue' ELSE p_name END AS base_name,
    CASE WHEN coloured THEN first WHEN p_partkey % 5 = 2 THEN 'blue' END AS name_element, CASE WHEN coloured THEN 'prefix' WHEN p_partkey % 5 = 2 THEN 'suffix' END AS element_position,
    CASE WHEN coloured THEN noun ELSE p_name END AS family_name, {hash_id_sql('CASE WHEN coloured THEN noun ELSE p_name END')} AS family_id FROM {WORDS_SQL}""",
)
def proc_names(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "part").selectExpr("p_partkey", f"{NAME_SQL} AS name")
    return naming.decompose(named, "name", ELEMENTS).select("p_partkey", "size", "base_name", "name_element", "element_position", "family_name", "family_id")


LINE_SQL = "lower(p_type) || ' power scales with the number of ' || split_part(p_name, ' ', 1) || ' elemental ' || CASE WHEN p_size > 25 THEN 'weapons' ELSE 'gear' END || ' equipped up to a max of ' || p_size || 'xl+ (gear pieces needed for maximum effect: ' || p_partkey % 9 || ').'"


@query(
    "proc_scaling",
    f"""SELECT p_partkey, lower(p_type) || '_power' AS scale_kind, CASE WHEN coloured THEN first END AS element_id, CASE WHEN p_size > 25 THEN 'weapons' ELSE 'gear' END AS gear_kind,
    p_size || 'xl+' AS cap, CAST(p_partkey % 9 AS BIGINT) AS pieces_needed FROM {WORDS_SQL}""",
)
def proc_scaling(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "part").selectExpr("p_partkey", f"{LINE_SQL} AS line")
    return naming.scaling(lines, "line", ELEMENTS).select("p_partkey", "scale_kind", "element_id", "gear_kind", "cap", "pieces_needed")


@query("rpt_element_scaling", f"SELECT element_id, rarity, count(*) AS n, count(DISTINCT gear_type) AS types FROM {ITEMS_SQL} GROUP BY ALL ORDER BY ALL")
def rpt_element_scaling(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).groupBy("element_id", "rarity").agg(F.count("*").alias("n"), F.countDistinct("gear_type").alias("types")).orderBy(F.asc_nulls_last("element_id"), F.asc_nulls_last("rarity"))


@query(
    "set_02_metric_table",
    " UNION ALL ".join(f"SELECT 'rows.{t}' AS metric, CAST(count(*) AS DOUBLE) AS value FROM {t}" for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")),
)
def set_02(spark: SparkSession, d: str) -> DataFrame:
    from millrace.operators.quality import row_counts

    return row_counts({t: table(spark, d, t) for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")})



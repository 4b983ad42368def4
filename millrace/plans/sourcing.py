"""Queries on sources, sinks, page records and streams, over files that Spark derives from the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.pages import lineage_links, page_records
from millrace.operators.hashes import table_digest
from millrace.plans.catalog import table
from millrace.plans.registry import query
from millrace.sources import archives, files, sqlite
from millrace.streaming import changes as streams


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{files.shared_folder(spark)}/millrace-{uuid.uuid4().hex}"


@query("src_01_sqlite_round_trip", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_01(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    sqlite.write(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), at, "supplier")
    return sqlite.read(spark, at, "supplier", {"s_suppkey": "long", "s_name": "string", "s_acctbal": "double"})


@query("src_02_stored_pages", "SELECT page_id, sha256(html) AS sha, CAST(length(html) AS BIGINT) AS chars FROM pages WHERE html IS NOT NULL")
def src_02(spark: SparkSession, d: str) -> DataFrame:
    stored = files.store_pages(table(spark, d, "pages"), "page_id", "html")
    return files.read_pages(stored, "page_id").select("page_id", "sha", F.length("html").cast("long").alias("chars"))


@query("src_05_ndjson", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def src_05(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.json(at)
    return files.read_ndjson(spark, at, "o_orderkey long, o_orderstatus string, o_totalprice double")


@query("src_08_csv", "SELECT n_nationkey, n_name FROM nation")
def src_08(spark: SparkSession, d: str) -> DataFrame:
    at = folder(spark)
    table(spark, d, "nation").select("n_nationkey", "n_name").write.option("header", True).csv(at)
    return files.read_csv(spark, at, "n_nationkey int, n_name string")


@query("snk_01_published_revision", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def snk_01(spark: SparkSession, d: str) -> DataFrame:
    at, c = folder(spark), table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    files.publish(c, at, 1)
    files.publish(c.where("c_custkey % 2 = 0"), at, 2)
    return files.read_current(spark, at)


@query("snk_04_canonical_json", "SELECT CAST(json_object('a_name', n_name, 'b_region', n_regionkey, 'c_none', CASE WHEN n_nationkey < 3 THEN n_name END) AS VARCHAR) AS json FROM nation")
def snk_04(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return files.canonical_json(n.select(F.when(F.col("n_nationkey") < 3, F.col("n_name")).alias("c_none"), F.col("n_name").alias("a_name"), F.col("n_regionkey").alias("b_region")))


DIGEST_SQL = " || chr(31) || ".join(f"coalesce('v' || CAST({c} AS VARCHAR), 'n')" for c in ("l_linenumber", "l_orderkey", "l_returnflag"))


@query(
    "hsh_05_table_digest",
    f"""SELECT count(*) AS rows, CAST(CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS UBIGINT) AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS VARCHAR) || '-' || CAST(CAST(sum(CAST(CAST('0x' || substr(h, 17, 15) AS UBIGINT) AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS VARCHAR) AS digest
    FROM (SELECT sha256({DIGEST_SQL}) AS h FROM lineitem)""",
)
def hsh_05(spark: SparkSession, d: str) -> DataFrame:
    return table_digest(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "udf_01_page_records",
    """SELECT page_id, 'title' AS record, CAST(1 AS BIGINT) AS n FROM pages UNION ALL SELECT page_id, 'link', len(regexp_extract_all(html, '<a href=')) FROM pages
    UNION ALL SELECT page_id, 'paragraph', len(regexp_extract_all(html, '<p>')) FROM pages UNION ALL SELECT page_id, 'heading', len(regexp_extract_all(html, '<h[123]>')) FROM pages""",
)
def udf_01(spark: SparkSession, d: str) -> DataFrame:
    return page_records(table(spark, d, "pages")).groupBy("page_id", "record").agg(F.count("*").alias("n"))


@query("udf_08_lineage_links", "SELECT page_id, CAST(i AS BIGINT) AS ordinal, target FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"/([^\"]*)\"', 1)) AS target, unnest(range(1, len(regexp_extract_all(html, '<a href=\"/')) + 1)) AS i FROM pages)")
def udf_08(spark: SparkSession, d: str) -> DataFrame:
    return lineage_links(page_records(table(spark, d, "pages")))


@query(
    "rpt_parse_coverage",
    "SELECT count(*) AS pages, count(*) FILTER (WHERE html LIKE '%<title>%') AS parsed, CAST(sum(len(regexp_extract_all(html, '<a href='))) AS BIGINT) AS links FROM pages",
)
def rpt_parse_coverage(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    r = page_records(pages).agg(F.count_if(F.col("record") == "title").alias("parsed"), F.count_if(F.col("record") == "link").alias("links"))
    return pages.agg(F.count("*").alias("pages")).join(F.broadcast(r))


@query(
    "stream_01_window_counts",
    """SELECT start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type FROM events) WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY start, event_type""",
)
def stream_01(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    source = spark.readStream.schema(events.schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = streams.window_counts(source, "ts", "event_type", "6 hours", "1 day")
    return streams.run_once(counts, folder(spark)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "stream_02_state_from_log",
    """SELECT 'user' AS entity_type, CAST(user_id AS VARCHAR) AS entity_key, arg_max(event_type, event_id) AS last_operation, max(event_id) AS last_revision FROM events WHERE event_type <> 'click' GROUP BY user_id""",
)
def stream_02(spark: SparkSession, d: str) -> DataFrame:
    events, at = table(spark, d, "events"), folder(spark)
    source = spark.readStream.schema(events.schema).parquet(f"{d}/events.parque[t]")
    log = source.selectExpr(
        "'user' AS entity_type", "CAST(user_id AS STRING) AS entity_key", "CASE WHEN event_type = 'click' THEN 'ALIAS' ELSE event_type END AS operation", "sha2(props, 256) AS row_hash",
        "sha2(props, 256) AS content_hash", "'live' AS state", "CAST(NULL AS BIGINT) AS retired_revision", "event_id AS revision",
    )
    run = streams.maintain_state(log, at, f"{at}/checkpoint")
    run.awaitTermination()
    newest = max(b["batchId"] for b in run.recentProgress)
    return spark.read.parquet(f"{at}/batch={newest}").select("entity_type", "entity_key", "last_operation", "last_revision")


EXPORT_ROWS = 500
EXPORT_SQL = """SELECT member, CAST(count(*) AS BIGINT) AS "rows", sha256(string_agg(line || chr(10), '' ORDER BY doc_id, line)) AS sha256 FROM (SELECT *, (row_number() OVER (ORDER BY doc_id, line) - 1) // 500 AS member FROM (
 SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"n_chars":' || coalesce(CAST(n_chars AS VARCHAR), 'null') || '}' AS line FROM documents)) GROUP BY member"""


@query("snk_04_compressed_export", EXPORT_SQL)
def snk_04_compressed(spark: SparkSession, d: str) -> DataFrame:
    """Members of a compressed export, told from the file as it was written: each begins where the export says."""
    at = f"{folder(spark)}/documents.json.gz"
    told = archives.export(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), ["doc_id"], at, rows=EXPORT_ROWS)
    # Hadoop's codec reads the members as one file
    lines = spark.read.text(at).withColumn("n", F.monotonically_increasing_id())
    held = lines.groupBy(F.floor(F.col("n") / EXPORT_ROWS).alias("member")).agg(F.sha2(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]), "\n"), F.lit("\n")), 256).alias("sha256"))
    return told.join(held, ["member", "sha256"]).select("member", "rows", "sha256")

"""Queries on loads: documents and pages as text, some of it bad, into typed tables with a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import loading
from millrace.operators.loading import Field, Refused, Specification
from millrace.plans.catalog import table
from millrace.plans.registry import query
from millrace.plans.sourcing import folder
from millrace.sources.versions import Store

SPECS = {
    "document": Specification({"uid": Field("string", required=True, pattern="^d[0-9]+$"), "n": Field("long", minimum=0, maximum=2000), "lang": Field("string", enum=("en", "de", "fr", "es")), "at": Field("timestamp_ntz")}, least_rows=1, most_bad=0.9),
    "page": Specification({"uid": Field("long", required=True), "url": Field("string", required=True)}, most_bad=0.5),
}
#: The texts of a document x, with faults by its number.
DOCUMENT = "concat(CASE WHEN x % 11 = 0 THEN 'e' ELSE 'd' END, x) AS uid, CASE WHEN x % 13 = 0 THEN 'many' ELSE CAST(n_chars AS STRING) END AS n, lang, CASE WHEN x % 17 = 0 THEN 'soon' ELSE concat('2024-01-', lpad(CAST(1 + x % 28 AS STRING), 2, '0'), 'T10:00:00Z') END AS at"
PAGE = "CASE WHEN page_id % 7 = 3 THEN NULL ELSE CAST(page_id AS STRING) END AS uid, url, 1 AS extra"
GOOD_SQL = "x % 11 > 0 AND x % 13 > 0 AND x % 17 > 0 AND coalesce(n_chars BETWEEN 0 AND 2000, true) AND coalesce(lang IN ('en', 'de', 'fr', 'es'), true)"


def load(spark: SparkSession, d: str, store: Store, specs: dict[str, Specification] = SPECS):
    docs = table(spark, d, "documents").selectExpr("*", "CAST(doc_id AS BIGINT) AS x")
    tables = {"document": docs.selectExpr(*_parts(DOCUMENT)), "page": table(spark, d, "pages").selectExpr(*_parts(PAGE))}
    return loading.load(store, tables, specs, {"documents": lambda: not docs.isEmpty()})


def _parts(expressions: str) -> list[str]:
    from millrace.plans.warehouse import split

    return split(expressions)


@query("load_01_documents", f"SELECT 'd' || x AS uid, n_chars AS n, lang, CAST(1 + x % 28 AS INTEGER) AS day FROM (SELECT *, CAST(doc_id AS BIGINT) AS x FROM documents) WHERE {GOOD_SQL}")
def load_01(spark: SparkSession, d: str) -> DataFrame:
    """The good rows, typed."""
    return load(spark, d, Store(spark, folder(spark)))["document"].select("uid", "n", "lang", F.dayofmonth("at").alias("day"))


@query(
    "load_02_report",
    f"""WITH x AS (SELECT *, CAST(doc_id AS BIGINT) AS x FROM documents), c(table_name, column_name, rule, rows) AS (
    SELECT 'document', '*', 'rows', count(*) FROM x UNION ALL SELECT 'document', '*', 'good', count(*) FROM x WHERE {GOOD_SQL} UNION ALL SELECT 'document', 'uid', 'pattern', count(*) FROM x WHERE x % 11 = 0 UNION ALL SELECT 'document', 'n', 'type', count(*) FROM x WHERE x % 13 = 0
    UNION ALL SELECT 'document', 'n', 'maximum', count(*) FROM x WHERE x % 13 > 0 AND n_chars > 2000 UNION ALL SELECT 'document', 'lang', 'enum', count(*) FROM x WHERE lang NOT IN ('en', 'de', 'fr', 'es') UNION ALL SELECT 'document', 'at', 'type', count(*) FROM x WHERE x % 17 = 0
    UNION ALL SELECT 'page', '*', 'rows', count(*) FROM pages UNION ALL SELECT 'page', '*', 'good', count(*) FROM pages WHERE page_id % 7 <> 3 AND url <> '' UNION ALL SELECT 'page', 'uid', 'required', count(*) FROM pages WHERE page_id % 7 = 3
    UNION ALL SELECT 'page', 'url', 'required', count(*) FROM pages WHERE coalesce(url, '') = '' UNION ALL SELECT 'page', 'extra', 'unknown', count(*) FROM pages) SELECT * FROM c WHERE rows > 0""",
)
def load_02(spark: SparkSession, d: str) -> DataFrame:
    """How many rows broke each rule, from the pass that wrote them."""
    return load(spark, d, Store(spark, folder(spark)))[loading.REPORTS].where("rows > 0")


@query("load_03_refused", "SELECT count(*) AS documents, CAST(1 AS BIGINT) AS revision, 'page: ' || (SELECT count(*) FROM pages WHERE page_id % 7 = 3 OR coalesce(url, '') = '') || ' of ' || (SELECT count(*) FROM pages) || ' rows are bad' AS reason FROM (SELECT *, CAST(doc_id AS BIGINT) AS x FROM documents) WHERE " + GOOD_SQL)
def load_03(spark: SparkSession, d: str) -> DataFrame:
    """A second load that bears no bad page is refused; the first one's revision stays."""
    store, reason = Store(spark, folder(spark)), None
    load(spark, d, store)
    try:
        load(spark, d, store, SPECS | {"page": Specification(SPECS["page"].fields)})
    except Refused as e:
        reason = str(e)
    now = store.snapshot()
    return now["document"].agg(F.count("*").alias("documents")).select("documents", F.lit(now.revision).cast("long").alias("revision"), F.lit(reason).alias("reason"))

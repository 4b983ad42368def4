"""Queries on lineage: a page with slots for each document, some with broken markup, some contradicting others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.pages import spread
from millrace.functions.slots import page_slots
from millrace.operators import lineage
from millrace.plans.catalog import table
from millrace.plans.registry import query


def _slot(label: str, link: str | None, name: str = "'item'") -> str:
    return f"'<dt>{label}</dt><dd>" + (f"<a href=\"' || {link} || '\"><b>' || {name} || '</b></a>" if link else "none") + "</dd>'"


#: What came before x by reforge is x - 2 if x is even; the page of x - 2 says so as well, unless x % 6 = 0; and it claims another item if x % 10 = 0.
HTML = ", ".join(
    [
        "'<h1>' || x || '</h1><dl>'", f"CASE WHEN x % 2 = 0 THEN {_slot('Before Reforge', chr(39) + '/item/' + chr(39) + ' || (x - 2)')} ELSE {_slot('before reforge', None)} END",
        f"CASE WHEN x % 2 = 0 AND (x + 2) % 6 > 0 THEN {_slot('after reforge', chr(39) + '/item/' + chr(39) + ' || (x + 2)')} ELSE '' END",
        f"CASE WHEN x % 5 = 3 THEN {_slot('after  awakening', chr(39) + '/item/' + chr(39) + ' || (x - x % 20)')} ELSE '' END",
        f"CASE WHEN x % 29 = 4 THEN {_slot('before fusion', None)} WHEN x % 31 = 5 THEN '<dt>after reforge</dt>' WHEN x % 37 = 6 THEN {_slot('before awakening', chr(39) + '/gear/' + chr(39) + ' || x')} WHEN x % 41 = 7 THEN {_slot('before enlightening', chr(39) + '/item/' + chr(39) + ' || x')}"
        f" WHEN x % 43 = 8 THEN {_slot('before reforge', chr(39) + '/item/9' + chr(39))} ELSE '' END",
        "'</dl>'",
    ]
)
ERROR_SQL = """CASE WHEN x % 29 = 4 THEN 'unknown label ''before fusion''' WHEN x % 31 = 5 THEN '''after reforge'' has no slot' WHEN x % 37 = 6 THEN '''before awakening'' links to /gear/' || x WHEN x % 41 = 7 THEN '''before enlightening'' links to itself'
 WHEN x % 43 = 8 AND x % 2 = 0 THEN 'two slots ''before reforge''' WHEN x % 5 = 3 AND x < 20 AND x - x % 20 = x THEN '''after awakening'' links to itself' END"""
PAGES_SQL = f"p AS (SELECT *, {ERROR_SQL} AS error FROM (SELECT CAST(doc_id AS BIGINT) AS x FROM documents)), good AS (SELECT * FROM p WHERE error IS NULL)"
CLAIMS_SQL = f"""{PAGES_SQL}, each AS (SELECT 'reforge' AS kind, x - 2 AS a, x AS b, true AS own FROM good WHERE x % 2 = 0 AND x >= 2 UNION ALL SELECT 'reforge', x, x + 2, false FROM good WHERE x % 2 = 0 AND (x + 2) % 6 > 0
 UNION ALL SELECT 'awakening', x, x - x % 20, false FROM good WHERE x % 5 = 3 UNION ALL SELECT 'reforge', 9, x, true FROM good WHERE x % 43 = 8 AND x % 2 = 1),
 c AS (SELECT kind, CAST(a AS VARCHAR) AS from_uid, CAST(b AS VARCHAR) AS to_uid, bool_or(own) AS of_to, bool_or(NOT own) AS of_from FROM each GROUP BY ALL)"""


def slots(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").selectExpr("CAST(doc_id AS BIGINT) AS x").where("x <> 0").selectExpr("x AS page_id", f"concat({HTML}) AS html")
    return page_slots(spread(pages))


@query("udf_08_markup_errors", f"WITH {PAGES_SQL} SELECT CAST(x AS VARCHAR) AS page_id, error FROM p WHERE error IS NOT NULL AND x <> 0")
def udf_08_errors(spark: SparkSession, d: str) -> DataFrame:
    """The first breach of each page's markup."""
    return lineage.errors(slots(spark, d))


@query(
    "udf_08_settled_claims",
    f"""WITH {CLAIMS_SQL.replace('FROM documents', 'FROM documents WHERE doc_id <> 0')} SELECT kind, from_uid, to_uid, of_to, of_from, count(*) OVER w - 1 AS rivals, row_number() OVER (w ORDER BY of_to AND of_from DESC, of_to DESC, from_uid) = 1 AS stands FROM c WINDOW w AS (PARTITION BY kind, to_uid)""",
)
def udf_08_claims(spark: SparkSession, d: str) -> DataFrame:
    """All claims on links, with those that stand."""
    return lineage.settled(lineage.claims(slots(spark, d)))


@query("udf_08_links", f"WITH {CLAIMS_SQL.replace('FROM documents', 'FROM documents WHERE doc_id <> 0')}, r AS (SELECT *, row_number() OVER (PARTITION BY kind, to_uid ORDER BY of_to AND of_from DESC, of_to DESC, from_uid) AS k FROM c) SELECT kind, count(*) AS links, count(*) FILTER (WHERE of_to AND of_from) AS confirmed FROM r WHERE k = 1 GROUP BY kind")
def udf_08_links(spark: SparkSession, d: str) -> DataFrame:
    """How many links stand, and how many both pages claim."""
    stands = lineage.settled(lineage.claims(slots(spark, d))).where("stands")
    return stands.groupBy("kind").agg(F.count("*").alias("links"), F.count_if(F.col("of_to") & F.col("of_from")).alias("confirmed"))

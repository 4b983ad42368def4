"""Queries on digest trees: rows in which two versions of a table differ, found without reading what is equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import digests
from millrace.plans.catalog import table
from millrace.plans.registry import query

LINES = digests.Shape(width=64)
#: Order lines, and a later version: some orders have other quantities, others are gone.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "CAST(l_quantity AS BIGINT) AS qty"]
LATER = [*LINE[:3], "CAST(l_quantity + CASE WHEN l_orderkey % 997 = 5 THEN 1 ELSE 0 END AS BIGINT) AS qty"]
LATER_WHERE = "l_orderkey NOT BETWEEN 300 AND 340"
LINES_SQL = f"(SELECT {', '.join(LINE)} FROM lineitem)"
LATER_SQL = f"(SELECT {', '.join(LATER)} FROM lineitem WHERE {LATER_WHERE})"


def differences_sql(a: str, b: str) -> str:
    return f"SELECT *, 'left' AS side FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b}) UNION ALL SELECT *, 'right' FROM (SELECT * FROM {b} EXCEPT ALL SELECT * FROM {a})"


def versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "lineitem")
    return lines.selectExpr(*LINE), lines.where(LATER_WHERE).selectExpr(*LATER)


@query("hsh_05_changed_lines", differences_sql(LINES_SQL, LATER_SQL))
def hsh_05_changed_lines(spark: SparkSession, d: str) -> DataFrame:
    old, new = versions(spark, d)
    found = digests.differing(digests.tree(old, "l_orderkey", LINES), digests.tree(new, "l_orderkey", LINES), LINES)
    return digests.changed_rows(old, new, "l_orderkey", found, LINES)


@query(
    "hsh_05_tree",
    # a level is there if the one below it has more than 16 nodes; 16 levels hold all keys of 64 bits
    """WITH l0 AS (SELECT l_orderkey // 64 AS leaf, count(*) AS n FROM lineitem GROUP BY ALL),
    every AS (SELECT CAST(l AS INTEGER) AS level, leaf // (CAST(1 AS BIGINT) << CAST(4 * l AS BIGINT)) AS node, sum(n) AS n FROM l0, range(16) r(l) GROUP BY ALL), sizes AS (SELECT level, count(*) AS nodes FROM every GROUP BY level)
    SELECT level, node, CAST(n AS BIGINT) AS "rows" FROM every WHERE level = 0 OR level IN (SELECT level + 1 FROM sizes WHERE nodes > 16)""",
)
def hsh_05_tree(spark: SparkSession, d: str) -> DataFrame:
    """The nodes of a tree and the rows below them."""
    return digests.tree(versions(spark, d)[0], "l_orderkey", LINES).select("level", "node", "rows")


DOCS = digests.Shape(width=16)
DOC = ["doc_id", "lang", "n_chars", "text"]
LATER_DOC = ["doc_id", "CASE WHEN doc_id % 499 = 7 THEN 'xx' ELSE lang END AS lang", "n_chars", "CASE WHEN doc_id % 613 = 3 THEN upper(text) ELSE text END AS text"]
LATER_DOC_WHERE = "doc_id % 811 <> 4"


@query("hsh_05_changed_documents", f"SELECT doc_id, lang, n_chars, side FROM ({differences_sql(f'(SELECT {", ".join(DOC)} FROM documents)', f'(SELECT {", ".join(LATER_DOC)} FROM documents WHERE {LATER_DOC_WHERE})')})")
def hsh_05_changed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Changed, new and missing documents, whole texts compared by digests first."""
    docs = table(spark, d, "documents")
    old, new = docs.selectExpr(*DOC), docs.where(LATER_DOC_WHERE).selectExpr(*LATER_DOC)
    found = digests.differing(digests.tree(old, "doc_id", DOCS), digests.tree(new, "doc_id", DOCS), DOCS)
    return digests.changed_rows(old, new, "doc_id", found, DOCS).select("doc_id", "lang", "n_chars", "side")

"""Queries on versioned histories of many tables, and on archives of what they close; on documents, pages and vectors."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import archive
from millrace.plans.catalog import table
from millrace.plans.registry import query
from millrace.plans.sourcing import folder
from millrace.sources.versions import Snapshot, Store

#: The documents of revision {r}: a fifth is missing, and a third has another length.
STATE = "SELECT doc_id, lang, n_chars + CASE WHEN doc_id % 3 = {r} THEN {r} ELSE 0 END AS n_chars FROM {documents} WHERE doc_id % 5 <> {r}"
#: What the second revision changes, after the first; and the third after the second.
CHANGES_SQL = """(SELECT 1 AS revision, doc_id, 'INSERT' AS operation FROM documents WHERE doc_id % 5 <> 1
 UNION ALL SELECT r, doc_id, CASE WHEN doc_id % 5 = r - 1 THEN 'INSERT' WHEN doc_id % 5 = r THEN 'DELETE' ELSE 'UPDATE' END FROM documents, (VALUES (2), (3)) AS v(r)
 WHERE doc_id % 5 IN (r - 1, r) OR (CASE WHEN doc_id % 3 = r THEN r ELSE 0 END) <> (CASE WHEN doc_id % 3 = r - 1 THEN r - 1 ELSE 0 END))"""


def state(spark: SparkSession, d: str, r: int) -> DataFrame:
    table(spark, d, "documents").createOrReplaceTempView("documents_in")
    return spark.sql(STATE.format(r=r, documents="documents_in"))


def changed(before: DataFrame, now: DataFrame, revision: int) -> DataFrame:
    """The log's rows of a revision: what it adds, changes and no longer has."""
    old, new = before.select("doc_id", F.struct(*before.columns).alias("_old")), now.select("doc_id", F.struct(*now.columns).alias("_new"))
    operation = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").when(F.col("_old") != F.col("_new"), "UPDATE")
    return old.join(new, "doc_id", "full").select(F.lit(revision).alias("revision"), "doc_id", operation.alias("operation")).where("operation IS NOT NULL")


def advance(store: Store, spark: SparkSession, d: str, r: int):
    """The transaction of revision r, not committed: the state replaced, its changes appended, pages written once."""
    change, now = store.begin(), state(spark, d, r)
    before = change.base["document"] if "document" in change.base else now.limit(0)
    change.append("document_log", changed(before, now, r))
    change.replace("document", now)
    if "page" not in change.base:
        change.replace("page", table(spark, d, "pages").select("page_id", "url"))
    return change


def three(spark: SparkSession, d: str) -> tuple[Snapshot, Snapshot]:
    """The second revision, taken before the third is written and read after it, and the third."""
    store = Store(spark, folder(spark))
    advance(store, spark, d, 1).commit()
    advance(store, spark, d, 2).commit()
    pinned, third = store.snapshot(), advance(store, spark, d, 3)
    return pinned, third.commit()


@query("version_01_pinned", STATE.format(r=2, documents="documents"))
def version_01(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the second revision, read when there is a third."""
    return three(spark, d)[0]["document"]


@query("version_02_log", f"SELECT revision, doc_id, operation FROM {CHANGES_SQL}")
def version_02(spark: SparkSession, d: str) -> DataFrame:
    """The log of all three revisions, each compared with the one it follows."""
    return three(spark, d)[1]["document_log"]


@query(
    "version_03_counts",
    f"""SELECT 2 AS revision, 'document' AS name, count(*) AS n FROM documents WHERE doc_id % 5 <> 2 UNION ALL SELECT 3, 'document', count(*) FROM documents WHERE doc_id % 5 <> 3
    UNION ALL SELECT 2, 'document_log', count(*) FROM {CHANGES_SQL} WHERE revision <= 2 UNION ALL SELECT 3, 'document_log', count(*) FROM {CHANGES_SQL} UNION ALL SELECT r, 'page', count(*) FROM pages, (VALUES (2), (3)) AS v(r) GROUP BY r""",
)
def version_03(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table of two revisions; the pages of both are the same files."""
    each = [s[n].agg(F.count("*").alias("n")).select(F.lit(s.revision).alias("revision"), F.lit(n).alias("name"), "n") for s in three(spark, d) for n in sorted(s.tables)]
    return reduce(DataFrame.unionByName, each)


WHEN, DAYS, MINIMUM = datetime(2024, 5, 15, tzinfo=UTC), 90, 4
#: Tables of a history: (source, expressions); rules come from their columns.
HISTORY = {
    "scd_document": ("documents", "doc_id AS id, lang, CAST(CASE WHEN doc_id % 3 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + (doc_id % 90) * INTERVAL '1' DAY END AS TIMESTAMP) AS valid_to"),
    "row_version": ("embeddings", "vec_id AS id, vec_id % 9 AS revision"),
    "obs_page": ("pages", "page_id AS id, concat('2024-0', 1 + page_id % 6, '-01T00:00:00Z') AS observed_at"),
    "ledger": ("labels", "doc_id AS id, doc_id % 9 AS revision"),
}
GONE = {"scd_document": "valid_to < TIMESTAMP '2024-02-15 00:00:00'", "row_version": "revision < 4", "obs_page": "observed_at < '2024-02-15T00:00:00Z'", "ledger": "false"}


def archived(spark: SparkSession, d: str) -> tuple[Snapshot, str | None, list[archive.Count]]:
    """Two checkpoints of one history: the second finds what has been appended since the first."""
    store = Store(spark, folder(spark))
    for part in ("id % 2 = 0", "id % 2 = 1"):
        change = store.begin()
        for name, (source, expressions) in HISTORY.items():
            table(spark, d, source).createOrReplaceTempView("history_in")
            change.append(name, spark.sql(f"SELECT * FROM (SELECT {expressions} FROM history_in) WHERE {part}"))
        found = archive.rules(change.commit(), WHEN - timedelta(days=DAYS), MINIMUM, by_revision=("row_version",))
        last = archive.run(store, WHEN, found)
    return last


@query(
    "archive_01_rows",
    " UNION ALL ".join(
        f"SELECT CASE WHEN {GONE[n]} THEN 'archive/2024-Q2' || CASE WHEN id % 2 = 1 THEN '-2/' ELSE '/' END ELSE '' END || '{n}' AS name, id FROM (SELECT {e} FROM {s})" for n, (s, e) in HISTORY.items()
    ),
)
def archive_01(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a history with the table or archive it is in after two checkpoints."""
    after = archived(spark, d)[0]
    return reduce(DataFrame.unionByName, [after[n].select(F.lit(n).alias("name"), "id") for n in sorted(after.tables)])


@query(
    "archive_02_reconciled",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) FILTER (WHERE id % 2 = 1 OR NOT gone) AS before, count(*) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone AND id % 2 = 1) AS archived FROM (SELECT *, coalesce({GONE[n]}, false) AS gone FROM (SELECT {e} FROM {s}))"
        for n, (s, e) in HISTORY.items() if n != "ledger"
    ),
)
def archive_02(spark: SparkSession, d: str) -> DataFrame:
    """What the second checkpoint counted while it wrote."""
    counts = archived(spark, d)[2]
    return spark.createDataFrame([(c.table, c.before, c.kept, c.archived) for c in counts], "name string, before long, kept long, archived long")

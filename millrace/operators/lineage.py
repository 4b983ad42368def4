"""Links of lineage between items: read from slots, told with the errors of their markup, and claims of two pages settled.

A page says what its item came from (a slot ``before``) and what came from it (``after``). Both are claims on one link:
kind, from and to. A page whose markup breaks a rule makes no claim. Where claims on what an item came from by one kind
contradict each other, the one wins that both items' pages make; else the one on the item's own page; else the one with the
least id. All of it is columns and equality joins, but for the parse before it.

Defined cases: an empty slot claims nothing; pages that repeat an id, equal or not, are judged each by itself, and equal
claims count once; an item that no page tells of may be claimed by others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.slots import ITEM, LABEL


def _side(slot: Column) -> Column:
    return F.regexp_extract(slot["label"], LABEL, 1)


def _kind(slot: Column) -> Column:
    return F.regexp_extract(slot["label"], LABEL, 2)


def _target(slot: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(slot["href"], F.lit("")), ITEM, 1), F.lit(""))


def errors(slots: DataFrame) -> DataFrame:
    """page_id, error: the first breach of a page's markup, in page order; pages without one have no row."""
    page = F.col("page_id")

    def breach(s: Column, i: Column) -> Column:
        label = F.concat(F.lit("'"), s["label"], F.lit("'"))
        before = F.filter("slots", lambda o, k: (k < i) & (o["label"] == s["label"]) & o["href"].isNotNull())
        return (
            F.when(~s["label"].rlike(LABEL), F.concat(F.lit("unknown label "), label))
            .when(~s["filled"], F.concat(label, F.lit(" has no slot")))
            .when(s["href"].isNull(), None)
            .when(_target(s).isNull(), F.concat(label, F.lit(" links to "), s["href"]))
            .when(_target(s) == page, F.concat(label, F.lit(" links to itself")))
            .when((_side(s) == "before") & (F.size(before) > 0), F.concat(F.lit("two slots "), label))
        )

    found = F.get(F.filter(F.transform("slots", breach), lambda e: e.isNotNull()), F.lit(0))
    return slots.select("page_id", found.alias("error")).where("error IS NOT NULL")


def claims(slots: DataFrame) -> DataFrame:
    """kind, from_uid, to_uid, of_to, of_from: each link that a good page claims, and whether the later item's page does and the earlier one's."""
    bad = errors(slots).select("page_id").distinct()
    rows = slots.join(bad, "page_id", "left_anti").select("page_id", F.explode("slots").alias("s")).where("s.href IS NOT NULL")
    s, page = F.col("s"), F.col("page_id")
    before = _side(s) == "before"
    each = rows.select(_kind(s).alias("kind"), F.when(before, _target(s)).otherwise(page).alias("from_uid"), F.when(before, page).otherwise(_target(s)).alias("to_uid"), before.alias("_before"))
    return each.groupBy("kind", "from_uid", "to_uid").agg(F.bool_or("_before").alias("of_to"), F.bool_or(~F.col("_before")).alias("of_from"))


def settled(claimed: DataFrame) -> DataFrame:
    """The claims with ``rivals`` (other claims on what the item came from by that kind) and ``stands``: one of them each."""
    way = Window.partitionBy("kind", "to_uid")
    rank = F.row_number().over(way.orderBy(F.desc(F.col("of_to") & F.col("of_from")), F.desc("of_to"), "from_uid"))
    # an item has few claims on what it came from; they are counted by key and joined, and only rivals meet in a window
    counts = claimed.groupBy("kind", "to_uid").agg((F.count("*") - 1).alias("rivals"))
    joined = claimed.join(counts, ["kind", "to_uid"])
    alone = joined.where("rivals = 0").withColumn("stands", F.lit(True))
    return alone.unionByName(joined.where("rivals > 0").withColumn("stands", rank == 1)).select("kind", "from_uid", "to_uid", "of_to", "of_from", "rivals", "stands")

"""Stable hashes of records that consist of a root row and child rows in other tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import FIELD_SEPARATOR, GROUP_SEPARATOR, RECORD_SEPARATOR, UNIT_SEPARATOR, joined, row_text


@dataclass(frozen=True)
class Child:
    """A table whose rows belong to a root: by one column, by either of two, or through a table of owner and id."""

    table: str
    owners: tuple[str, ...]
    owner_kind: str | None = None
    #: (table, owner column, id columns joined by ':')
    via: tuple[str, str, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Aggregate:
    entity: str
    table: str
    key: str
    children: tuple[Child, ...] = ()
    #: root columns that the content hash leaves out
    outside_content: tuple[str, ...] = ()
    deletable: bool = False
    retirable: bool = False
    columns: tuple[str, ...] = field(default=())


def child_lines(child: Child, frames: dict[str, DataFrame]) -> DataFrame:
    """_k, _t: each child row's text under the key of the root it belongs to."""
    rows = frames[child.table]
    columns = rows.columns
    text = F.concat(F.lit(child.table + RECORD_SEPARATOR), row_text([F.col(f"_r.{c}") for c in columns]))
    if child.owner_kind is not None:
        rows = rows.where(F.col("owner_kind") == child.owner_kind)
    held = rows.select(F.struct(*columns).alias("_r"), *[F.col(o).cast("string").alias(f"_o{i}") for i, o in enumerate(child.owners)])
    if child.via:
        table, owner, ids = child.via
        link = frames[table].select(F.col(owner).cast("string").alias("_k"), joined([F.col(i).cast("string") for i in ids], ":").alias("_id"))
        found = link.join(held, F.col("_id") == F.col("_o0"))
    elif len(child.owners) == 2:
        # a row whose two owners are the same belongs to it once
        found = held.withColumn("_k", F.explode(F.array_distinct(F.array("_o0", "_o1"))))
    else:
        found = held.withColumn("_k", F.col("_o0"))
    return found.select("_k", text.alias("_t")).where("_k IS NOT NULL")


def aggregate_hashes(aggregate: Aggregate, frames: dict[str, DataFrame]) -> DataFrame:
    """entity_type, entity_key, row_hash, content_hash, state and retired_revision of every root.

    Roots and children of all tables are sent out by the key once, and a key's rows meet in one group. Roots with one key
    (the table should have none) each have all children, and these once for each of the roots.
    """
    root = frames[aggregate.table]
    columns = list(aggregate.columns) or root.columns
    head = F.lit(aggregate.entity + GROUP_SEPARATOR + aggregate.table + RECORD_SEPARATOR)
    whole = root.select(
        F.col(aggregate.key).cast("string").alias("entity_key"),
        F.struct(
            F.concat(head, row_text(columns)).alias("row"),
            # without such columns the two are the same text, which is then hashed once
            (F.concat(head, row_text([c for c in columns if c not in aggregate.outside_content])) if aggregate.outside_content else F.lit(None).cast("string")).alias("content"),
            (F.col("state").cast("string") if "state" in columns else F.lit(None).cast("string")).alias("state"),
            (F.col("retired_revision").cast("long") if "retired_revision" in columns else F.lit(None).cast("long")).alias("retired_revision"),
        ).alias("_root"),
    )
    tail = F.lit("")
    if aggregate.children:
        line = "struct<i: int, t: string>"
        rows = whole.withColumn("_line", F.lit(None).cast(line))
        for i, child in enumerate(aggregate.children):
            lines = child_lines(child, frames).select(F.col("_k").alias("entity_key"), F.lit(None).cast(whole.schema["_root"].dataType).alias("_root"), F.struct(F.lit(i).alias("i"), F.col("_t").alias("t")).alias("_line"))
            rows = rows.unionByName(lines)
        # a record's rows lie in one row, as its text does that is hashed
        met = rows.groupBy("entity_key").agg(F.collect_list("_root").alias("_roots"), F.sort_array(F.collect_list("_line")).alias("_lines")).where(F.size("_roots") > 0)
        own = lambda i: F.transform(F.filter("_lines", lambda x: x["i"] == i), lambda x: x["t"])
        again = lambda i: F.flatten(F.transform(own(i), lambda t: F.array_repeat(t, F.size("_roots"))))
        for i in range(len(aggregate.children)):
            tail = F.concat(tail, F.lit(FIELD_SEPARATOR), F.array_join(F.when(F.size("_roots") > 1, again(i)).otherwise(own(i)), FIELD_SEPARATOR))
        whole = met.select("entity_key", tail.alias("_tail"), F.explode("_roots").alias("_root"))
    else:
        whole = whole.withColumn("_tail", tail)
    hashed = whole.select("entity_key", "_root", F.sha2(F.concat("_root.row", "_tail"), 256).alias("row_hash"), *(["_tail"] if aggregate.outside_content else []))
    content = F.sha2(F.concat("_root.content", "_tail"), 256) if aggregate.outside_content else F.col("row_hash")
    return hashed.select(F.lit(aggregate.entity).alias("entity_type"), "entity_key", "row_hash", content.alias("content_hash"), "_root.state", "_root.retired_revision")


def table_digest(df: DataFrame) -> DataFrame:
    """One row (rows, digest) that is the same for the same rows in any order: their number and the sum of their hashes.

    The digest adds two 63-bit halves of each row's SHA-256, so equal rows count as often as they occur and no row has to
    meet another before a partial sum.
    """
    h = F.sha2(row_text(sorted(df.columns)), 256)
    half = lambda at: F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)")
    return df.select(half(1).alias("a"), half(17).alias("b")).agg(
        F.count("*").alias("rows"), F.concat_ws("-", F.coalesce(F.sum("a"), F.lit(0)).cast("string"), F.coalesce(F.sum("b"), F.lit(0)).cast("string")).alias("digest")
    )


def named_digest(df: DataFrame, name: str) -> DataFrame:
    """``table_digest`` bound to the table's and the columns' names, so that renamed columns give another digest."""
    header = UNIT_SEPARATOR.join([name, *sorted(df.columns)])
    return table_digest(df).withColumn("digest", F.sha2(F.concat(F.lit(header + UNIT_SEPARATOR), "digest"), 256))

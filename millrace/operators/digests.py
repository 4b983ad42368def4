"""Digests of a table as a tree over ranges of its key, and the rows in which two tables differ.

A leaf covers ``width`` keys, and holds the number of its rows and two sums of 64-bit hashes of them, so it comes from
partial aggregates in any order. Above it a node digests the nodes of ``fanout`` neighbours in their order, up to a handful
of nodes. Trees are small, are kept beside the table they tell of, and may be compared without it: level by level
downwards, each time only below the nodes that differ. Then only the ranges of leaves that differ are read from the tables;
the bounds are conditions on the key, which a Parquet scan uses to leave out what lies outside.

Defined cases: rows count as often as they occur; nulls in any column differ from all else; rows without a key are a leaf of
their own, below all others; an empty table has an empty tree; column names and types must be equal, their order needn't be;
keys are whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import row_text
from millrace.operators.changes import differences
from millrace.operators.graph import checkpoint

#: The leaf of rows without a key.
NO_KEY = -(1 << 62)
#: Ranges of leaves that become conditions of a scan; more are met by a join instead.
RANGES = 256


@dataclass(frozen=True)
class Shape:
    """How many keys a leaf has, and how many nodes are below one node. Only trees of one shape can be compared."""

    width: int = 1024
    fanout: int = 16

    def leaf(self, key: str) -> Column:
        return F.coalesce(F.expr(f"(`{key}` - pmod(`{key}`, {self.width})) DIV {self.width}"), F.lit(NO_KEY)).cast("long")

    def above(self, node: str) -> Column:
        return F.expr(f"(`{node}` - pmod(`{node}`, {self.fanout})) DIV {self.fanout}")


def leaves(df: DataFrame, key: str, shape: Shape) -> DataFrame:
    """(node, rows, digest) of the lowest level."""
    text = row_text(sorted(df.columns))
    hashed = df.select(shape.leaf(key).alias("node"), F.xxhash64(F.lit(1), text).cast("decimal(38,0)").alias("a"), F.xxhash64(F.lit(2), text).cast("decimal(38,0)").alias("b"))
    sums = hashed.groupBy("node").agg(F.count("*").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select("node", "rows", F.sha2(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("rows", "a", "b")]), 256).alias("digest"))


def tree(df: DataFrame, key: str, shape: Shape = Shape()) -> DataFrame:
    """(level, node, rows, digest): leaves are level 0, and the last level has at most ``fanout`` nodes."""
    now = checkpoint(leaves(df, key, shape))
    every, level = now.select(F.lit(0).alias("level"), "node", "rows", "digest"), 0
    while now.count() > shape.fanout:
        below = F.sort_array(F.collect_list(F.struct("node", "digest")))  # fanout at most
        told = F.sha2(F.array_join(F.transform(below, lambda x: F.concat_ws(" ", x["node"].cast("string"), x["digest"])), "\n"), 256)
        now = checkpoint(now.groupBy(shape.above("node").alias("above")).agg(F.sum("rows").alias("rows"), told.alias("digest")).withColumnRenamed("above", "node"))
        level += 1
        every = every.unionByName(now.select(F.lit(level).alias("level"), "node", "rows", "digest"))
    return every


def differing(a: DataFrame, b: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(node, rows_a, rows_b): the leaves in which two trees differ; below equal nodes nothing is looked at."""
    tops = [t.agg(F.max("level").alias("l")).first()["l"] for t in (a, b)]
    if None in tops:
        top = 0
    else:
        top = min(tops)
    open_ = None
    for level in range(top, -1, -1):
        left, right = (t.where(F.col("level") == level).select("node", F.col("rows").alias(f"rows_{s}"), F.col("digest").alias(f"digest_{s}")) for t, s in ((a, "a"), (b, "b")))
        if open_ is not None:
            left, right = (t.withColumn("_above", shape.above("node")).join(open_.select(F.col("node").alias("_above")), "_above", "left_semi").drop("_above") for t in (left, right))
        both = left.join(right, "node", "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
        open_ = checkpoint(both.select("node", F.coalesce("rows_a", F.lit(0)).alias("rows_a"), F.coalesce("rows_b", F.lit(0)).alias("rows_b")))
    return open_


def merged(nodes: list[int]) -> list[tuple[int, int]]:
    """Runs of neighbours, first and last."""
    out: list[tuple[int, int]] = []
    for n in sorted(nodes):
        if out and out[-1][1] == n - 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def within(df: DataFrame, key: str, found: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """The rows of a table in the given leaves: by bounds on the key if the leaves are few, else by a join."""
    few = [r["node"] for r in found.select("node").limit(RANGES + 1).collect()]
    if len(few) > RANGES:
        return df.withColumn("_leaf", shape.leaf(key)).join(found.select(F.col("node").alias("_leaf")), "_leaf", "left_semi").drop("_leaf")
    wanted = F.lit(False)
    for first, last in merged([n for n in few if n != NO_KEY]):
        wanted = wanted | F.col(key).between(first * shape.width, (last + 1) * shape.width - 1)
    return df.where(wanted | F.col(key).isNull() if NO_KEY in few else wanted)


def changed_rows(a: DataFrame, b: DataFrame, key: str, found: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Rows that only one of the tables has, with ``side``, as often as they occur; only the given leaves are read."""
    return differences(within(a, key, found, shape), within(b, key, found, shape))

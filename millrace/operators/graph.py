"""Directed links between keys: chains from their roots, cycles, ends of aliases, and expansion by depth.

Each step is a join of a frontier with the links; a key that a walk has reached is not walked from again, so the work is
bounded by the links and not by the number of paths. Steps are cut from their lineage in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.files import shared_folder

#: Links of the longest chain that is followed, and frontiers that are written apart.
MAX_DEPTH, COMPACT = 1000, 8
#: How the sides of a step meet: they grow with the links, and one that is broadcast lies whole in the driver.
APART = "merge"


def checkpoint(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def chains(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """kind, uid, chain_id, position: for each key the nearest root (no link leads to it), the least one of several.

    edges: kind, from_uid, to_uid. Keys that no root reaches (cycles) are left out. A step writes its frontier alone; the
    frontiers together are what has been reached, and after every COMPACT of them they are written as one. It takes away
    the links that it walks and those into the keys that it reaches, so that the links left lead to keys not yet reached,
    and later steps read no more than these. ValueError where a chain is longer than ``max_depth``.
    """
    edges = edges.select("kind", "from_uid", "to_uid").distinct()
    targets = edges.select("kind", F.col("to_uid").alias("uid")).distinct()
    nodes = edges.select("kind", F.col("from_uid").alias("uid")).union(targets).distinct()
    frontier = nodes.join(targets.hint(APART), ["kind", "uid"], "left_anti").select("kind", "uid", F.col("uid").alias("chain_id"), F.lit(0).cast("long").alias("position"))
    left = edges.withColumnRenamed("from_uid", "uid")
    frontier = checkpoint(frontier)
    frontiers = [frontier]
    for _ in range(max_depth):
        walked = checkpoint(left.join(frontier.hint(APART), ["kind", "uid"], "left"))
        step = walked.where("chain_id IS NOT NULL").groupBy("kind", F.col("to_uid").alias("uid")).agg(F.min("chain_id").alias("chain_id"), (F.min("position") + 1).alias("position"))
        frontier = checkpoint(step)
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, frontiers)
        left = walked.where("chain_id IS NULL").select("kind", "uid", "to_uid").join(frontier.select("kind", F.col("uid").alias("to_uid")).hint(APART), ["kind", "to_uid"], "left_anti")
        if len(frontiers) >= COMPACT:
            frontiers = [checkpoint(reduce(DataFrame.unionByName, frontiers))]
        frontiers.append(frontier)
    raise ValueError(f"chains of more than {max_depth} links")


def trimmed(edges: DataFrame) -> DataFrame:
    """The links left when keys without a link in or without one out are taken away again and again."""
    edges = checkpoint(edges.select("kind", "from_uid", "to_uid").distinct())
    n = edges.count()
    while n:
        ins = edges.select("kind", F.col("to_uid").alias("from_uid")).distinct()
        outs = edges.select("kind", F.col("from_uid").alias("to_uid")).distinct()
        edges = checkpoint(edges.join(ins.hint(APART), ["kind", "from_uid"], "left_semi").join(outs.hint(APART), ["kind", "to_uid"], "left_semi").select("kind", "from_uid", "to_uid"))
        n, before = edges.count(), n
        if n == before:
            break
    return edges


def in_cycles(edges: DataFrame) -> DataFrame:
    """kind, uid of the keys on a cycle, and not of those on the way from one cycle to another.

    What is left after trimming is coloured: each key takes the greatest key that leads to it. The keys of a colour that
    lead back to the key it is named for form a strongly connected component. These are taken out, and the rest is
    trimmed and coloured again.
    """
    found, left = edges.select("kind", F.col("from_uid").alias("uid")).limit(0), trimmed(edges)
    while not left.isEmpty():
        ends = left.select("kind", F.col("from_uid").alias("uid")).union(left.select("kind", F.col("to_uid").alias("uid"))).distinct()
        colours = checkpoint(ends.withColumn("colour", F.col("uid")))
        while True:
            came = left.join(colours.withColumnRenamed("uid", "from_uid").hint(APART), ["kind", "from_uid"]).groupBy("kind", F.col("to_uid").alias("uid")).agg(F.max("colour").alias("came"))
            moved = checkpoint(colours.join(came.hint(APART), ["kind", "uid"], "left").select("kind", "uid", F.greatest("colour", "came").alias("colour"), (F.col("came") > F.col("colour")).alias("moved")))
            colours = moved.drop("moved")
            if moved.where("moved").isEmpty():
                break
        one = left.join(colours.withColumnRenamed("uid", "from_uid").hint(APART), ["kind", "from_uid"]).join(colours.select("kind", F.col("uid").alias("to_uid"), F.col("colour").alias("_colour")).hint(APART), ["kind", "to_uid"])
        inner = checkpoint(one.where("colour = _colour").select("kind", "from_uid", "to_uid"))
        reached = frontier = checkpoint(colours.where("uid = colour").select("kind", "uid"))
        while True:
            back = frontier.join(inner.withColumnRenamed("to_uid", "uid").hint(APART), ["kind", "uid"]).select("kind", F.col("from_uid").alias("uid")).distinct()
            frontier = checkpoint(back.join(reached.hint(APART), ["kind", "uid"], "left_anti"))
            if frontier.isEmpty():
                break
            reached = checkpoint(reached.union(frontier))
        heads, tails = reached.withColumnRenamed("uid", "from_uid"), reached.withColumnRenamed("uid", "to_uid")
        # a component of one key is a cycle only if the key is linked with itself
        inside = inner.join(heads.hint(APART), ["kind", "from_uid"], "left_semi").join(tails.hint(APART), ["kind", "to_uid"], "left_semi")
        found = found.union(inside.select("kind", "from_uid")).union(inside.select("kind", "to_uid"))
        left = trimmed(left.join(heads.hint(APART), ["kind", "from_uid"], "left_anti").join(tails.hint(APART), ["kind", "to_uid"], "left_anti"))
    return found.distinct()


def alias_ends(aliases: DataFrame, max_depth: int = 64) -> DataFrame:
    """old_uid, end_uid: where each alias leads in the end, in rounds that double the steps; cycles have no end and stop
    the job."""
    now = checkpoint(aliases.select("old_uid", F.col("new_uid").alias("end_uid")))
    for _ in range(max_depth.bit_length()):
        nxt = now.select(F.col("old_uid").alias("_old"), F.col("end_uid").alias("_end"))
        moved = checkpoint(now.join(nxt, now["end_uid"] == nxt["_old"], "left").select("old_uid", F.coalesce("_end", "end_uid").alias("end_uid"), F.col("_end").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now
    raise ValueError("aliases form a cycle or are too deep")


def expand(start: DataFrame, links: DataFrame, depths: dict[str, int]) -> DataFrame:
    """item_id, depth: what links (source_id, kind, target_id) lead to from the start, each kind down to its own depth."""
    limits = F.create_map(*[x for k, d in depths.items() for x in (F.lit(k), F.lit(d))])
    reached = frontier = checkpoint(start.select("item_id").distinct().withColumn("depth", F.lit(0)))
    for depth in range(1, max(depths.values(), default=0) + 1):
        usable = links.where(F.coalesce(limits[F.col("kind")], F.lit(0)) >= depth)
        found = frontier.join(usable, frontier["item_id"] == usable["source_id"]).select(F.col("target_id").alias("item_id")).distinct()
        frontier = checkpoint(found.join(reached, "item_id", "left_anti").withColumn("depth", F.lit(depth)))
        reached = reached.unionByName(frontier)
    return reached

"""A catalogue item's life: scope, state, first sight, and the item that took its place."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import first_token, json_text, row_text
from millrace.operators.selection import SMALL_ROWS
from millrace.sources.files import shared_folder


@dataclass(frozen=True)
class Scope:
    """Which listed items are wanted."""

    min_cost: int
    max_cost: int
    cosmetic_cost: int
    rarities: tuple[str, ...]
    bypass: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()


def decide_scope(listing: DataFrame, scope: Scope) -> DataFrame:
    """Listing rows with keep and reason: the first rule that applies decides."""
    reason = (
        F.when(first_token("name", list(scope.excluded)).isNotNull(), "excluded_name")
        .when(F.col("cost") == scope.cosmetic_cost, "cosmetic")
        .when(first_token("name", list(scope.bypass)).isNotNull(), "name_token")
        .when(~F.col("rarity").isin(*scope.rarities), "rarity")
        .when(F.col("cost").between(scope.min_cost, scope.max_cost), "cost_band")
        .otherwise("cost")
    )
    return listing.withColumn("reason", reason).withColumn("keep", F.col("reason").isin("name_token", "cost_band"))


def clamp(wanted: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(wanted, F.lit(low)), F.lit(high))


def equipment_status(items: DataFrame, frontier: DataFrame, previous: DataFrame, *, last_complete_run: Column, revision: Column) -> DataFrame:
    """uid, state, retire_reason, retired_revision, newly_retired, revived.

    An item is gone if its frontier row says so, out of scope if it has none or none decided since the last complete run,
    else live. A retirement keeps its first revision.
    """
    f = frontier.select(F.col("item_id").alias("_f"), "frontier_state", "decided_run_id")
    p = previous.select(F.col("uid").alias("_p"), F.col("state").alias("_state"), F.col("retired_revision").alias("_retired"))
    reason = F.when(F.col("frontier_state") == "gone", "gone").when(
        F.col("_f").isNull() | F.col("decided_run_id").isNull() | (F.col("decided_run_id") < last_complete_run), "out_of_scope"
    )
    joined = items.select("uid").join(f, F.col("uid") == F.col("_f"), "left").join(p, F.col("uid") == F.col("_p"), "left").withColumn("retire_reason", reason)
    live = F.col("retire_reason").isNull()
    return joined.select(
        "uid", F.when(live, "live").otherwise("retired").alias("state"), "retire_reason",
        F.when(live, None).when(F.col("_state") == "retired", F.coalesce("_retired", revision)).otherwise(revision).cast("long").alias("retired_revision"),
        (~live & (F.col("_p").isNull() | (F.col("_state") == "live"))).alias("newly_retired"),
        (live & F.coalesce(F.col("_state") == "retired", F.lit(False))).alias("revived"),
    )


def new_items(seen: DataFrame, first_seen: str, now: Column, days: int) -> DataFrame:
    """Rows with is_new_item: first seen within so many days before now."""
    return seen.withColumn("is_new_item", F.coalesce(F.col(first_seen) >= now - F.make_dt_interval(F.lit(days)), F.lit(False)))


#: Members of a class that lie in one row at most, on average; rows of each side that meet in one group of the join.
MEMBERS, TILE = 512, 2048


def written(df: DataFrame) -> DataFrame:
    """The frame in the shared folder, read again: as checkpoint, but in columns, which takes a fraction of its disk."""
    at = f"{shared_folder(df.sparkSession)}/millrace-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def facts(df: DataFrame) -> DataFrame:
    """A table of groups, written; broadcast where it has SMALL_ROWS at most, so that what it is joined with stays where it is,
    and larger ones are never the driver's."""
    made = written(df)
    return F.broadcast(made) if made.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else made.hint("merge")


def replacements(retired: DataFrame, live: DataFrame, stats: DataFrame, attributes: list[str], min_score: float) -> DataFrame:
    """old_uid, new_uid, score, evidence: live items that equal a retired one in the attributes and in enough of its stats.

    The score is the share of different (label, tier, value) cells of the two that both have; 1 without any. stats: uid,
    label, tier, value; one without a label doesn't count.

    Items with equal attributes and equal cells are one class, and classes are what is compared: copies of an item cost one
    comparison. A class is a row with its members, or several rows where it has many.

    Two classes reach the score only if they share one of their rarest cells: of n cells all but so many that the score can't
    be made up by the others. Classes with equal attributes meet by these cells, each pair at the first one that they share,
    or all with all where that makes fewer meetings (cells that most of them have tell little). Without cells they meet each
    other; with a score of 0 or less to reach, all classes with equal attributes are pairs, as all are results.

    Pairs are made by the last join and put out by the task that makes them: what is sent and stored grows with the items.
    Groups of more than TILE rows a side meet in parts, so that none is a single task's.
    """
    both = retired.select("uid", *attributes, F.lit(True).alias("old")).unionByName(live.select("uid", *attributes, F.lit(False).alias("old")))
    told = stats.where(F.col("label").isNotNull()).select("uid", row_text(["label", "tier", "value"]).alias("cell"))
    frequency = facts(told.groupBy("cell").agg(F.count("*").alias("held")))
    # the cells of one item lie in one row, as its stats are few; rare ones come first
    held = told.join(frequency, "cell").groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("held", "cell")))["cell"].alias("cells"))
    there = reduce(and_, [F.col(c).isNotNull() for c in ("uid", *attributes)])
    items = both.where(there).join(held.hint("merge"), "uid", "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<string>")))
    kind = [*attributes, "cells", "old"]
    # two classes with one hash are cut in more rows than they need, and stay two
    items = items.withColumn("class", F.xxhash64(*kind))
    many = items.groupBy("class").agg(F.ceil(F.count("*") / MEMBERS).alias("rows")).where("rows > 1")
    part = F.coalesce(F.pmod(F.xxhash64("uid"), "rows"), F.lit(0))
    n, rows = F.size("cells").cast("long"), items.join(many.hint("merge"), "class", "left").groupBy(*kind, part.alias("part"))
    classes = written(rows.agg(F.sort_array(F.collect_set("uid")).alias("uids")).withColumn("n", n).drop("part"))

    sides = [F.count_if(F.col("old")).alias("olds"), F.count_if(~F.col("old")).alias("news")]
    parts = [F.ceil(F.col(c) / TILE).alias(f"{c}_parts") for c in ("olds", "news")]
    groups = classes.groupBy(*attributes).agg(*sides).where("olds > 0 AND news > 0")
    if min_score <= 0:
        met = classes.join(facts(groups.select(*attributes, *parts)), attributes).withColumn("meet", F.lit(""))
    else:
        by_cell = classes.withColumn("meet", F.explode(_rarest("cells", "n", min_score))).groupBy(*attributes, "meet").agg(*sides)
        meetings = F.col("olds").cast("double") * F.col("news")
        sums = by_cell.groupBy(*attributes).agg(F.sum(meetings).alias("_by_cell"))
        # both in one pass over small groups: whether they meet apart, by cells, and in how many parts
        ways = facts(groups.join(sums.hint("merge"), attributes).select(*attributes, (F.col("_by_cell") < meetings).alias("apart"), *parts))
        large = by_cell.where((F.col("olds") > TILE) | (F.col("news") > TILE)).select(*attributes, "meet", *[p.alias(f"_{c}") for p, c in zip(parts, ("olds", "news"), strict=True)])
        meet = F.explode(F.when(F.col("apart"), _rarest("cells", "n", min_score)).otherwise(F.array(F.lit(""))))
        met = classes.join(ways, attributes).withColumn("meet", meet).join(facts(large), [*attributes, "meet"], "left")
        for c in ("olds", "news"):
            met = met.withColumn(f"{c}_parts", F.when(F.col("apart"), F.coalesce(f"_{c}", F.lit(1))).otherwise(F.col(f"{c}_parts")))
    on = [*attributes, "meet", "old_part", "new_part"]
    own = lambda c: F.pmod(F.xxhash64("cells", "uids"), f"{c}_parts")
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{c}_parts") - 1))
    olds = met.where("old").select(*attributes, "meet", own("olds").alias("old_part"), each("news").alias("new_part"), *[F.col(c).alias(f"old_{c}") for c in ("n", "cells", "uids")])
    news = met.where("NOT old").select(*attributes, "meet", own("news").alias("new_part"), each("olds").alias("old_part"), *[F.col(c).alias(f"new_{c}") for c in ("n", "cells", "uids")])
    # merged and not broadcast: a side is small in its files and large in the driver
    pairs = olds.join(news.hint("merge"), on)
    if min_score > 0:
        first = F.get(F.array_intersect(*[_rarest(f"{side}_cells", f"{side}_n", min_score) for side in ("old", "new")]), F.lit(0))
        near = (F.col("new_n") >= F.col("old_n") * min_score - 1e-9) & (F.col("old_n") >= F.col("new_n") * min_score - 1e-9)
        pairs = pairs.where(near & ((F.col("meet") == "") | (first == F.col("meet"))))
    # a row is made for the number that both have, so that it is counted once for the score and what follows from it
    joined = pairs.withColumn("stats_equal", F.explode(F.array(F.size(F.array_intersect("old_cells", "new_cells")).cast("long"))))
    joined = joined.withColumn("stats_total", F.col("old_n") + F.col("new_n") - F.col("stats_equal"))
    score = F.when(F.col("stats_total") == 0, 1.0).otherwise(F.col("stats_equal") / F.col("stats_total"))
    evidence = json_text(**{a: F.col(a) for a in attributes}, stats_equal=F.col("stats_equal"), stats_total=F.col("stats_total"))
    alike = joined.withColumn("score", score).where(F.col("score") >= min_score).select("old_uids", "new_uids", "score", evidence.alias("evidence"))
    members = alike.withColumn("old_uid", F.explode("old_uids")).withColumn("new_uid", F.explode("new_uids"))
    return members.where("old_uid <> new_uid").select("old_uid", "new_uid", "score", "evidence")


def _rarest(cells: str, n: str, min_score: float) -> Column:
    """Of cells with the rarest first those that two items with the score share one of; the empty text stands for none at all."""
    least = F.ceil(F.col(n) * F.lit(min_score) - F.lit(1e-9))
    return F.when(F.col(n) == 0, F.array(F.lit(""))).otherwise(F.slice(cells, F.lit(1), F.greatest(F.col(n) - least + 1, F.lit(0)).cast("int")))


def merge_frontier(known: DataFrame, found: DataFrame) -> DataFrame:
    """item_id, depth, parent_id, entry_kind: the shortest way to each item wins, and catalog beats reference."""
    both = known.select("item_id", "depth", "parent_id", "entry_kind").unionByName(found.select("item_id", "depth", "parent_id", "entry_kind"))
    return both.groupBy("item_id").agg(
        F.min(F.struct("depth", "parent_id")).alias("way"), F.bool_or(F.col("entry_kind") == "catalog").alias("catalog")
    ).select("item_id", "way.depth", "way.parent_id", F.when(F.col("catalog"), "catalog").otherwise("reference").alias("entry_kind"))


def claim(frontier: DataFrame, n: int) -> DataFrame:
    """The frontier with its first n pending items, by depth and id, in flight and with one more attempt."""
    first = frontier.where("state = 'pending'").orderBy("depth", "item_id").limit(n).select("item_id", F.lit(True).alias("_claimed"))
    claimed = F.coalesce("_claimed", F.lit(False))
    joined = frontier.join(first, "item_id", "left")
    return joined.withColumns({"state": F.when(claimed, "in_flight").otherwise(F.col("state")), "attempts": F.col("attempts") + claimed.cast("int")}).select(*frontier.columns)


def settle(frontier: DataFrame, outcomes: DataFrame, max_attempts: int) -> DataFrame:
    """The frontier after outcomes (item_id, outcome, error) of items in flight: done, gone, blocked (failed at once) or
    failed (pending again while attempts remain). An outcome of an item that is not in flight stops the job."""
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    o = outcomes.select("item_id", F.col("outcome").alias("_outcome"), F.col("error").alias("_error"))
    joined = frontier.join(o, "item_id", "full")
    outcome = F.col("_outcome")
    after = (
        F.when(outcome.isNull(), F.col("state"))
        .when(~F.col("state").eqNullSafe("in_flight"), F.raise_error(F.concat(F.col("item_id").cast("string"), F.lit(" is not in flight"))))
        .when(outcome.isin("done", "gone"), outcome)
        .when((outcome == "blocked") | (F.col("attempts") >= max_attempts), "failed")
        .otherwise("pending")
    )
    error = F.when(outcome.isNull(), F.col("last_error")).otherwise(F.col("_error"))
    return joined.withColumns({"state": after, "last_error": error}).select(*frontier.columns)


def reset_in_flight(frontier: DataFrame) -> DataFrame:
    """The frontier of an interrupted run: items in flight are pending again and get their attempt back."""
    flying = F.col("state") == "in_flight"
    attempts = F.when(flying, F.greatest(F.col("attempts") - 1, F.lit(0))).otherwise(F.col("attempts"))
    return frontier.withColumns({"attempts": attempts, "state": F.when(flying, "pending").otherwise(F.col("state"))})


def retry_failed(frontier: DataFrame) -> DataFrame:
    failed = F.col("state") == "failed"
    return frontier.withColumns({"attempts": F.when(failed, 0).otherwise(F.col("attempts")), "state": F.when(failed, "pending").otherwise(F.col("state"))})


def clamp_settings(wanted: DataFrame, scope: Scope) -> DataFrame:
    """Wanted cost_min, cost_max and rarities brought within the scope, and ``widened``: the names of the fields that asked for more."""
    low, high = (clamp(F.col(c), scope.min_cost, scope.max_cost) for c in ("cost_min", "cost_max"))
    offered = F.array(*[F.lit(r) for r in scope.rarities])
    beyond = F.size(F.array_except("rarities", offered)) > 0
    kept = F.array_intersect(offered, F.col("rarities"))
    names = F.array(
        F.when(low != F.col("cost_min"), "cost_min"), F.when(high != F.col("cost_max"), "cost_max"), F.when(beyond, "rarities"),
    )
    narrowed = {"cost_min": low, "cost_max": high, "rarities": F.when(F.size(kept) > 0, kept).otherwise(offered), "widened": F.array_compact(names)}
    return wanted.withColumns(narrowed)

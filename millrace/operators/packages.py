"""Update packages: what a revision changes for those who have an older one, applied and proved over whole aggregates.

An aggregate is a root table and child tables whose rows name their root. A package is a frame of operations (entity, key,
operation, rev) and, for what is written anew, the tables' rows of the new revision.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.graph import checkpoint
from millrace.operators.hashes import table_digest

#: The order in which kinds of operations are applied.
PHASES = ("UPSERT", "RETIRE", "ALIAS", "DELETE")


@dataclass(frozen=True)
class Part:
    """A child table: the columns that name the root (any of them), what its rows are ordered by, and whether there is one
    row at most for a root."""

    table: str
    owners: tuple[str, ...]
    order: tuple[str, ...] = ()
    single: bool = False


@dataclass(frozen=True)
class Whole:
    entity: str
    table: str
    key: str
    parts: tuple[Part, ...] = ()


def _owned(rows: DataFrame, part: Part, keys: DataFrame) -> DataFrame:
    """The child rows that belong to one of the keys (a frame of one column, key), each once for each key."""
    owner = F.explode(F.array_distinct(F.array(*part.owners))) if len(part.owners) > 1 else F.col(part.owners[0])
    return rows.withColumn("_owner", owner).join(keys, F.col("_owner") == F.col("key")).drop("_owner")


def payloads(whole: Whole, frames: dict[str, DataFrame], keys: DataFrame) -> DataFrame:
    """key and data for each of the keys that the root table has: the root row as a struct, a struct for a single child
    (null without one), and an ordered array of structs for the others (empty without any). An aggregate is one row, as a
    package has it: its children must be as few as a record's are."""
    root = frames[whole.table]
    out = root.join(keys, root[whole.key] == keys["key"]).select("key", F.struct(*root.columns).alias(whole.table))
    for part in whole.parts:
        rows = frames[part.table]
        order = [c for c in part.order or rows.columns]
        entry = F.struct(F.struct(*order).alias("_by"), F.struct(*rows.columns).alias("_row"))
        held = _owned(rows, part, keys).groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("_all"))
        listed = held.select(F.col("key").alias("_key"), F.transform("_all", lambda e: e["_row"]).alias("_listed"))
        joined = out.join(listed, F.col("key") == F.col("_key"), "left").drop("_key")
        empty = F.array().cast(listed.schema["_listed"].dataType)
        value = F.get("_listed", F.lit(0)) if part.single else F.coalesce("_listed", empty)
        out = joined.withColumn(part.table, value).drop("_listed")
    return out.select("key", F.struct(*[c for c in out.columns if c != "key"]).alias("data"))


def ordered_operations(operations: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """The operations with ``position``, from 0: what is written in the order of the entities, then retirements, aliases,
    and deletions in the reversed order; within these by key.

    The rows are sorted by ranges; a row's position is its place in its range and the rows of the ranges before, so that
    no task numbers all of them.
    """
    place = F.array_position(F.array(*map(F.lit, entities)), F.col("entity"))
    phase = F.array_position(F.array(*map(F.lit, PHASES)), F.col("operation"))
    rank = F.when(F.col("operation") == "UPSERT", place).when(F.col("operation") == "DELETE", -place).otherwise(F.lit(0))
    by = ["_phase", "_rank", "key", "entity"]
    sorted_ = operations.withColumn("_phase", phase).withColumn("_rank", rank).repartitionByRange(*by).sortWithinPartitions(*by)
    held = checkpoint(sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    # one row for each range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return held.join(F.broadcast(sizes), "_part").withColumn("position", F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_before", "_phase", "_rank")


def apply_package(wholes: list[Whole], frames: dict[str, DataFrame], operations: DataFrame, payload: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables after the package: roots and children of written and deleted keys go, the payload's rows of the written
    ones come, and retired roots get their state and revision. Aliases change no table. Operations are one for each key."""
    out = dict(frames)
    for whole in wholes:
        own = operations.where(F.col("entity") == whole.entity)
        gone = own.where("operation IN ('UPSERT', 'DELETE')").select("key").distinct()
        written = own.where("operation = 'UPSERT'").select("key").distinct()
        root = frames[whole.table]
        kept = root.join(gone, F.col(whole.key) == F.col("key"), "left_anti").select(*root.columns)
        if {"state", "retired_revision"} <= set(root.columns):
            retired = own.where("operation = 'RETIRE'").select("key", F.col("rev").alias("_rev"))
            done = F.col("_rev").isNotNull()
            kept = kept.join(retired, F.col(whole.key) == F.col("key"), "left").select(
                *[F.when(done, F.lit("retired")).otherwise(F.col(c)).alias(c) if c == "state" else F.when(done, F.col("_rev")).otherwise(F.col(c)).cast(root.schema[c].dataType).alias(c) if c == "retired_revision" else c for c in root.columns]
            )
        new = payload[whole.table].join(written, F.col(whole.key) == F.col("key"), "left_semi")
        out[whole.table] = kept.unionByName(new.select(*root.columns))
        for part in whole.parts:
            rows, fresh = out[part.table], payload[part.table]
            columns = rows.columns
            for owner in part.owners:
                rows = rows.join(gone, F.col(owner) == F.col("key"), "left_anti")
            # a row that two written keys own comes once
            mine = reduce(lambda a, b: a | b, [F.col(f"_{o}") for o in part.owners])
            for owner in part.owners:
                there = written.select(F.col("key").alias(f"_k{owner}"), F.lit(True).alias(f"_{owner}"))
                fresh = fresh.join(there, F.col(owner) == F.col(f"_k{owner}"), "left").fillna(False, [f"_{owner}"])
            out[part.table] = rows.select(*columns).unionByName(fresh.where(mine).select(*columns))
    return out


def prove(expected: dict[str, DataFrame], got: dict[str, DataFrame]) -> DataFrame:
    """table, same: whether each table has the same digest in both; a package is right if all have."""
    both = []
    for name, want in expected.items():
        a, b = table_digest(want), table_digest(got[name].select(*want.columns))
        # one row each
        both.append(a.join(b.select(F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))).select(F.lit(name).alias("table"), ((F.col("rows") == F.col("_rows")) & (F.col("digest") == F.col("_digest"))).alias("same")))
    return reduce(DataFrame.unionByName, both)


def supported_revisions(revisions: DataFrame, keys: list[str], newest: Column, window: int) -> DataFrame:
    """keys and revision: from which older revisions of each catalogue an update to its newest one is offered.

    revisions: keys, revision, qualifies. Going back from the newest one, the first revision that is missing or doesn't
    qualify ends the window, which is ``window`` revisions long at most.
    """
    own = revisions.withColumn("_back", newest - F.col("revision")).where((F.col("_back") >= 1) & (F.col("_back") <= window) & (F.col("revision") >= 1))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_back"))
    # of revisions without a gap and without one that fails, the n-th lies n back
    return own.where("qualifies").withColumn("_nth", rank).where("_nth = _back").select(*keys, "revision")


def small_enough(package_bytes: Column, snapshot_bytes: Column, ratio: float) -> Column:
    """Whether a package is worth its while beside the whole snapshot."""
    return package_bytes <= snapshot_bytes * F.lit(ratio)


#: Why a release may offer its snapshot alone, in the order in which reasons are given.
SNAPSHOT_ONLY = ("package_size", "dataset_schema_version", "catalog_version", "forced", "first_release", "no_base")


def snapshot_only_reasons(flags: dict[str, Column]) -> Column:
    """The reasons whose flags are true, as an array in the fixed order."""
    return F.array_compact(F.array(*[F.when(flags[r], F.lit(r)) for r in SNAPSHOT_ONLY if r in flags]))


def update_decision(have: Column, newest: Column, minimum: Column) -> Column:
    """none if one is up to date, snapshot below the oldest supported revision, else the package's name."""
    return F.when(have >= newest, "none").when(have < minimum, "snapshot").otherwise(F.concat(have.cast("string"), F.lit("-"), newest.cast("string")))


def update_decisions(clients: DataFrame, pointers: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """clients (keys, have, ...) with ``decision``: none if they have what the catalogue's pointer names, the update's name
    if the window offers one from what they have, else the snapshot's; ``unknown`` without a pointer.

    pointers: keys, newest (one row for each catalogue). windows: keys, revision, as :func:`supported_revisions` gives them.
    """
    offered = windows.select(*keys, F.col("revision").alias("have"), F.lit(True).alias("_offered"))
    met = clients.join(pointers.select(*keys, F.col("newest").alias("_newest")), keys, "left").join(offered, [*keys, "have"], "left")
    name = F.concat_ws("-", F.col("have").cast("string"), F.col("_newest").cast("string"))
    decision = F.when(F.col("_newest").isNull(), "unknown").when(F.col("have") >= F.col("_newest"), "none").when(F.col("_offered"), name).otherwise(F.concat(F.lit("snapshot-"), F.col("_newest").cast("string")))
    return met.select(*clients.columns, decision.alias("decision"))


def broken_invariants(operations: DataFrame, since: Column, upto: Column) -> DataFrame:
    """invariant, entity, key of operations that no package may hold: twice the same, a revision outside (since, upto], an
    alias to itself, an alias that comes before its retirement (by position), a kind that is none.

    operations: entity, key, operation, rev, target (of an alias), position.
    """
    pick = lambda name, rows: rows.select(F.lit(name).alias("invariant"), "entity", "key")
    twice = operations.groupBy("operation", "entity", "key").agg(F.count("*").alias("n")).where("n > 1")
    order = operations.where("operation IN ('RETIRE', 'ALIAS')").groupBy("entity", "key").agg(
        F.min(F.when(F.col("operation") == "ALIAS", F.col("position"))).alias("alias"), F.max(F.when(F.col("operation") == "RETIRE", F.col("position"))).alias("retire")
    )
    return reduce(DataFrame.unionByName, [
        pick("duplicate", twice), pick("revision", operations.where(~((F.col("rev") > since) & (F.col("rev") <= upto)))),
        pick("self_alias", operations.where("operation = 'ALIAS' AND target = key")), pick("alias_before_retire", order.where("retire > alias")),
        pick("operation", operations.where(~F.col("operation").isin(*PHASES))),
    ])


@dataclass(frozen=True)
class Reference:
    """Rows of a table that name a row of a shared one, if ``where`` holds."""

    table: str
    column: str
    parent: str
    key: str
    where: str = "true"


def carry_forward(whole: Whole, new: dict[str, DataFrame], old: dict[str, DataFrame], failed: DataFrame, shared: list[Whole], references: list[Reference], max_rounds: int = 16) -> dict[str, DataFrame]:
    """Rows of the last release that stay because the records they belong to could not be read this time.

    The aggregates of ``failed`` (a frame of key) that the old tables have and the new ones lack are carried whole; then,
    round by round, what their rows refer to in shared tables and the new tables lack, with its own children, until
    nothing more is missing. Each table's rows come once. ValueError if references go deeper than ``max_rounds``.
    """
    there = new[whole.table].select(F.col(whole.key).alias("key"))
    keys = failed.select("key").distinct().join(old[whole.table].select(F.col(whole.key).alias("key")), "key", "left_semi").join(there, "key", "left_anti")
    carried: dict[str, DataFrame] = {}

    def add(name: str, rows: DataFrame) -> None:
        carried[name] = rows if name not in carried else carried[name].unionByName(rows).distinct()

    fresh = {whole.table: old[whole.table].join(keys, F.col(whole.key) == F.col("key"), "left_semi")}
    fresh |= {p.table: _owned(old[p.table], p, keys).select(*old[p.table].columns).distinct() for p in whole.parts}
    by_table = {w.table: w for w in shared}
    have = {w.table: new[w.table].select(F.col(w.key).alias("key")).distinct() for w in shared}
    for _ in range(max_rounds):
        fresh = {n: checkpoint(df) for n, df in fresh.items()}
        for name, rows in fresh.items():
            add(name, rows)
        wanted: dict[str, DataFrame] = {}
        for r in references:
            if r.table in fresh:
                asked = fresh[r.table].where(r.where).select(F.col(r.column).alias("key")).where("key IS NOT NULL").distinct()
                wanted[r.parent] = asked if r.parent not in wanted else wanted[r.parent].union(asked).distinct()
        fresh = {}
        for parent, asked in wanted.items():
            w = by_table[parent]
            missing = checkpoint(asked.join(have[parent], "key", "left_anti").join(old[parent].select(F.col(w.key).alias("key")), "key", "left_semi"))
            if missing.isEmpty():
                continue
            have[parent] = have[parent].union(missing)
            more = {parent: old[parent].join(missing, F.col(w.key) == F.col("key"), "left_semi")}
            more |= {p.table: _owned(old[p.table], p, missing).select(*old[p.table].columns).distinct() for p in w.parts}
            for name, rows in more.items():
                fresh[name] = rows if name not in fresh else fresh[name].unionByName(rows).distinct()
        if not fresh:
            return carried
    raise ValueError(f"references go deeper than {max_rounds} rounds")


def retained(objects: DataFrame, minimum: int, now: Column, weeks: int, days: int) -> DataFrame:
    """path, kind, verdict (keep, delete, unknown) of stored objects (path, stored_at): manifests, snapshots and updates
    from the oldest supported revision on, the newest snapshot of each of the last weeks with its manifest, and backups of
    the last days."""
    number = lambda pattern: F.regexp_extract("path", pattern, 1)
    made = objects.select(
        "path", "stored_at",
        F.when(F.col("path").rlike(r"^snapshots/[0-9]+$"), "snapshot").when(F.col("path").rlike(r"^manifests/[0-9]+$"), "manifest")
        .when(F.col("path").rlike(r"^updates/[0-9]+-[0-9]+$"), "update").when(F.col("path").rlike(r"^backups/[0-9]+$"), "backup").otherwise("unknown").alias("kind"),
        F.try_to_number(number(r"([0-9]+)$"), F.lit("999999999999999999")).cast("long").alias("revision"),
    )
    age = F.datediff(now, F.col("stored_at"))
    weekly = made.where((F.col("kind") == "snapshot") & (F.floor(age / 7) <= weeks)).groupBy(F.date_trunc("week", "stored_at").alias("_week")).agg(F.max("revision").alias("_kept"))
    kept = weekly.select("_kept").distinct()
    joined = made.join(F.broadcast(kept), F.col("revision") == F.col("_kept"), "left")  # a row for each of the last weeks
    stays = (
        F.when(F.col("kind").isin("snapshot", "manifest"), (F.col("revision") >= minimum) | F.col("_kept").isNotNull())
        .when(F.col("kind") == "update", F.col("revision") >= minimum).when(F.col("kind") == "backup", age <= days)
    )
    return joined.select("path", "kind", F.when(F.col("kind") == "unknown", "unknown").when(stays, "keep").otherwise("delete").alias("verdict"))

"""Changes between two states of a catalogue: detection, ledgers, history, net effect and replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ("entity_type", "entity_key", "row_hash", "content_hash", "state", "retired_revision")
KEY = ["entity_type", "entity_key"]


def detect_changes(current: DataFrame, previous: DataFrame, deletable: list[str], *, revision: Column, deferred: DataFrame | None = None, retirable: str = "equipment", aliases: DataFrame | None = None) -> DataFrame:
    """One row for each key that changed, with the operation: INSERT, UPDATE, RETIRE, DELETE or ALIAS.

    A key deleted before counts as absent. RETIRE is a change of nothing but live to retired. Only deletable types are
    deleted, and none at all while ``deferred`` (a frame of failed keys) meets a known key of the retirable type.
    """
    p = previous.where("last_operation <> 'DELETE'").select(*[F.col(c).alias(f"p_{c}") for c in STATE])
    same_key = [F.col(k) == F.col(f"p_{k}") for k in KEY]
    operation = (
        F.when(F.col("p_entity_key").isNull(), "INSERT")
        .when(F.col("p_row_hash") == F.col("row_hash"), None)
        .when((F.col("entity_type") == retirable) & (F.col("p_content_hash") == F.col("content_hash")) & (F.col("p_state") == "live") & (F.col("state") == "retired"), "RETIRE")
        .otherwise("UPDATE")
    )
    kept = current.join(p, same_key, "left").select(*KEY, operation.alias("operation"), *STATE[2:]).where("operation is not null")
    gone = p.where(F.col("p_entity_type").isin(deletable)).join(current.select(*KEY), same_key, "left_anti")
    if deferred is not None:
        failed = deferred.select(F.col("source_id").alias("_failed")).distinct()
        stop = p.where(F.col("p_entity_type") == retirable).join(failed, F.col("p_entity_key") == F.col("_failed"), "left_semi").agg((F.count("*") > 0).alias("_stop"))
        gone = gone.join(F.broadcast(stop)).where("not _stop")
    deleted = gone.select(
        F.col("p_entity_type").alias("entity_type"), F.col("p_entity_key").alias("entity_key"), F.lit("DELETE").alias("operation"),
        *[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in STATE[2:]],
    )
    parts = [kept, deleted]
    if aliases is not None:
        a = aliases.select(F.col("old_uid").alias("_old"))
        parts.append(current.where(F.col("entity_type") == retirable).join(a, F.col("entity_key") == F.col("_old")).select(*KEY, F.lit("ALIAS").alias("operation"), *STATE[2:]))
    return reduce(DataFrame.unionByName, parts).withColumn("revision", revision)


def overlay(previous: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after the changes: their rows, and the previous ones that they don't touch; aliases change no state."""
    new = changes.where("operation <> 'ALIAS'").select(
        *STATE, F.col("revision").alias("last_revision"), F.col("operation").alias("last_operation")
    )
    kept = previous.join(new.select(*KEY), KEY, "left_anti").select(*STATE, "last_revision", "last_operation")
    return kept.unionByName(new)


def append_new(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the ledger lacks: what an append may add, so that a second run adds nothing."""
    return rows.join(ledger.select(*keys).distinct(), keys, "left_anti")


def missing_from(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows, counted as often as they occur, that an append-only ledger has lost."""
    return old.exceptAll(new.select(*old.columns))


def slowly_changing(history: DataFrame, current: DataFrame, key: str, changed_at: str) -> DataFrame:
    """A history with valid_from and valid_to after a new load: rows with a later time stamp close the open row of their key."""
    open_ = history.where("valid_to is null")
    new = current.select(F.col(key).alias("_k"), F.col(changed_at).alias("_at"))
    closing = open_.join(new, (F.col(key) == F.col("_k")) & (F.col("_at") > F.col(changed_at)), "left")
    closed = closing.withColumn("valid_to", F.col("_at")).select(*history.columns)
    known = open_.select(F.col(key).alias("_k"), F.col(changed_at).alias("_known"))
    opened = (
        current.join(known, F.col(key) == F.col("_k"), "left").where(F.col("_known").isNull() | (F.col(changed_at) > F.col("_known")))
        .withColumn("valid_from", F.col(changed_at)).withColumn("valid_to", F.lit(None).cast(history.schema["valid_to"].dataType))
        .select(*history.columns)
    )
    return history.where("valid_to is not null").unionByName(closed).unionByName(opened)


def net_operations(log: DataFrame, ledgers: list[str]) -> DataFrame:
    """What a window of the change log comes to for each key: UPSERT, RETIRE or DELETE; a key that came and went is left out."""
    plain = log.where("operation <> 'ALIAS'")
    net = plain.groupBy(*KEY).agg(
        F.min_by("operation", "revision").alias("first"), F.max_by("operation", "revision").alias("last"),
        F.bool_or(F.col("operation").isin("INSERT", "UPDATE")).alias("written"), F.max("revision").alias("revision"),
    )
    operation = (
        F.when(F.col("entity_type").isin(ledgers), "UPSERT")
        .when((F.col("last") == "DELETE") & (F.col("first") == "INSERT"), None)
        .when(F.col("last") == "DELETE", "DELETE")
        .when(F.col("written"), "UPSERT")
        .otherwise("RETIRE")
    )
    return net.select(*KEY, operation.alias("operation"), "revision").where("operation is not null")


def apply_operations(rows: DataFrame, operations: DataFrame, payload: DataFrame, key: str) -> DataFrame:
    """A table after operations (key, operation): deleted and rewritten keys go, the payload's rows of upserts come."""
    touched = operations.where("operation in ('UPSERT', 'DELETE')").select(key)
    upserts = operations.where("operation = 'UPSERT'").select(key)
    return rows.join(touched, key, "left_anti").select(*rows.columns).unionByName(payload.join(upserts, key, "left_semi").select(*rows.columns))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, with the side; none if a replay has given the same table."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def consecutive(previous: DataFrame, seen: DataFrame, key: str, run: Column) -> DataFrame:
    """How many runs in a row each key of ``seen`` has been there; a key that is absent loses its count."""
    p = previous.select(F.col(key).alias("_k"), "first_run", F.col("runs").alias("_runs"))
    return seen.select(key).distinct().join(p, F.col(key) == F.col("_k"), "left").select(
        key, F.coalesce("first_run", run).alias("first_run"), run.alias("last_run"), (F.coalesce("_runs", F.lit(0)) + 1).cast("long").alias("runs")
    )


def upsert(target: DataFrame, source: DataFrame, key: str, digest: str, now: Column) -> DataFrame:
    """Target and source merged by key: the source's rows win, ``changed_at`` moves only where the digest differs."""
    t = target.select(F.col(key).alias("_k"), F.col(digest).alias("_digest"), F.col("changed_at").alias("_changed"))
    changed = F.when(F.col("_k").isNull() | ~F.col("_digest").eqNullSafe(F.col(digest)), now).otherwise(F.col("_changed"))
    merged = source.join(t, F.col(key) == F.col("_k"), "left").withColumn("changed_at", changed).select(*target.columns)
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(merged)


def retained_per_week(releases: DataFrame, revision: str, at: str) -> DataFrame:
    """The newest revision of each ISO week."""
    return releases.groupBy(F.year(F.date_trunc("week", F.col(at)) + F.expr("interval 3 days")).alias("iso_year"), F.weekofyear(at).alias("iso_week")).agg(F.max(revision).alias(revision))


def archive_split(df: DataFrame, old: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows to archive; a null condition keeps."""
    move = F.coalesce(old, F.lit(False))
    return df.where(~move), df.where(move)

"""Expectations: each gives the rows that break it, and a run stores them and says how many there were."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that every gate check returns.
GATE_ROW = {"entity_type": "string", "entity_key": "string", "entry_kind": "string", "is_new_item": "boolean", "affected": "long", "runs": "long", "detail": "string"}


def unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; nulls are equal to each other."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with how often they occur; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null column the parent lacks."""
    keys = parent.select(F.col(key).alias("_key")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def polymorphic_relationship(child: DataFrame, kind_column: str, kind: str, column: str, parent: DataFrame | None, key: str | None) -> DataFrame:
    """As relationships, for child rows of one kind; without a parent every such row fails."""
    own = child.where(F.col(kind_column) == kind)
    return own if parent is None else relationships(own, column, parent, key)


def in_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame, domain: str) -> DataFrame:
    words = vocabulary.where(F.col("domain") == domain)
    return relationships(df, column, words, "value").groupBy(column).agg(F.count("*").alias("n"))


def gate_rows(df: DataFrame, **given: Column) -> DataFrame:
    """The seven columns of a gate check; what isn't given has its default."""
    default = {"is_new_item": F.lit(False), "affected": F.lit(1)}
    return df.select(*[given.get(c, default.get(c, F.lit(None))).cast(kind).alias(c) for c, kind in GATE_ROW.items()])


@dataclass(frozen=True)
class Expectation:
    name: str
    failing: DataFrame
    #: contract, structural, policy or info
    group: str = "structural"


def run_expectations(expectations: Iterable[Expectation], folder: str | None = None) -> DataFrame:
    """name, group, failures; with a folder the failing rows are written there, one table for each expectation."""
    counts = []
    for e in expectations:
        failing = e.failing
        if folder:
            failing.write.mode("overwrite").parquet(f"{folder}/{e.name}")
            failing = failing.sparkSession.read.schema(failing.schema).parquet(f"{folder}/{e.name}")
        counts.append(failing.agg(F.count("*").alias("failures")).select(F.lit(e.name).alias("name"), F.lit(e.group).alias("grp"), "failures"))
    return reduce(DataFrame.unionByName, counts)


def null_rates(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """metric, value: the share of nulls of each column, in one pass; rounded to 9 places."""
    once = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return once.unpivot([], columns, "column_name", "value").select(
        F.concat(F.lit(f"null_rate.{name}."), "column_name").alias("metric"), F.round("value", 9).alias("value")
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """metric, value: rows of each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").cast("double").alias("value")).select(F.lit(f"rows.{name}").alias("metric"), "value") for name, df in frames.items()])


def with_previous(metrics: DataFrame, previous: DataFrame) -> DataFrame:
    """Metrics with the last run's value and the change in percent; null where there is nothing to compare."""
    p = previous.select("metric", F.col("value").alias("prev_value"))
    change = F.when(F.col("prev_value").isNull() | (F.col("prev_value") == 0), F.lit(None).cast("double")).otherwise(100.0 * (F.col("value") - F.col("prev_value")) / F.col("prev_value"))
    return metrics.join(p, "metric", "left").select("metric", "value", "prev_value", F.round(change, 9).alias("delta_pct"))


def contract_violations(df: DataFrame, contract: dict[str, dict]) -> DataFrame:
    """name, rule, rows: how many rows break each rule of a contract, in one pass; rules of absent columns are broken by all rows.

    A column's rules are ``required``, ``pattern``, ``minimum``, ``maximum`` and ``enum``; nulls break ``required`` alone.
    Columns that the contract doesn't name are told with the rule ``unknown``.
    """
    broken = {
        "required": lambda c, want: c.isNull() & F.lit(want),
        "pattern": lambda c, want: ~c.cast("string").rlike(want),
        "minimum": lambda c, want: c < want,
        "maximum": lambda c, want: c > want,
        "enum": lambda c, want: ~c.isin(want),
    }
    counts = []
    for name, rules in contract.items():
        for rule, want in rules.items():
            bad = F.count_if(broken[rule](F.col(name), want)) if name in df.columns else F.count("*")
            counts.append((name, rule, bad))
    counts += [(name, "unknown", F.count("*")) for name in df.columns if name not in contract]
    totals = df.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(counts)])
    rows = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("rows")) for i, (name, rule, _) in enumerate(counts)])
    return totals.select(F.inline(rows))


def exactly_shipped(found: list[str], shipped: list[str]) -> list[tuple[str, str]]:
    """Tables that a published folder lacks or has beyond the shipped ones, in order; names alone, so a driver's list."""
    return [(t, "missing") for t in sorted(set(shipped) - set(found))] + [(t, "unexpected") for t in sorted(set(found) - set(shipped))]


def catalog_of(spark: SparkSession, database: str) -> dict[str, list[str]]:
    """The tables of a database with their columns, as the catalogue lists them."""
    return {t.name: [c.name for c in spark.catalog.listColumns(f"{database}.{t.name}")] for t in spark.catalog.listTables(database) if not t.isTemporary}


def shipped_faults(found: dict[str, list[str]], shipped: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(table, fault) of what a catalogue lacks or has beyond the shipped tables and their columns, in order."""
    out = exactly_shipped([*found], [*shipped])
    for name in sorted(set(found) & set(shipped)):
        out += [(name, f"{fault} column {c}") for c, fault in exactly_shipped(found[name], shipped[name])]
    return out

"""Loading tables of text into a versioned store: typed, judged by rules, and reported, in the one pass that writes them.

Each table has a specification: the type of every column and the rules for its values. A row that breaks a rule is left
out; how many rows break each rule is observed while the others are written, so the report needs no scan of its own. If a
table has too few rows or too many bad ones, or a precondition doesn't hold, the load is refused: what has been written is
named by no revision, and readers stay with the one before. Otherwise all tables become visible together, with the
report.

Defined cases: an absent column breaks ``required`` in every row if it is required, and is null otherwise; a null or empty
text is null; text that isn't of the type breaks ``type`` and no other rule; text with a control separator breaks
``control``; columns without a specification are left out and told as ``unknown``; an empty table has a report of zeros,
and is refused if it needs rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import iso_ts
from millrace.sources.versions import Part, Snapshot, Store

#: Control separators, which no field may hold.
CONTROL = r"[\x1C-\x1F]"
REPORT = "table_name string, column_name string, rule string, rows long"
#: Where a store keeps the reports of its loads.
REPORTS = "load_report"


@dataclass(frozen=True)
class Field:
    """The type of a column and the rules for its values."""

    type: str
    required: bool = False
    enum: tuple | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None

    def value(self, text: Column) -> Column:
        """The text as its type; null where it isn't of it. Times are ISO-8601 in UTC."""
        return iso_ts(text) if self.type == "timestamp_ntz" else text.try_cast(self.type)

    def rules(self, text: Column, value: Column) -> dict[str, Column]:
        given = {
            "required": text.isNull() if self.required else None, "type": text.isNotNull() & value.isNull(), "control": text.rlike(CONTROL),
            "enum": ~value.isin(*self.enum) if self.enum else None, "pattern": ~value.cast("string").rlike(self.pattern) if self.pattern else None,
            "minimum": value < self.minimum if self.minimum is not None else None, "maximum": value > self.maximum if self.maximum is not None else None,
        }
        return {rule: F.coalesce(broken, F.lit(False)) for rule, broken in given.items() if broken is not None}


@dataclass(frozen=True)
class Specification:
    fields: dict[str, Field]
    #: Rows that must be there, and the share of bad rows that is borne.
    least_rows: int = 0
    most_bad: float = 0.0

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {f.type}" for n, f in self.fields.items()))


class Refused(ValueError):
    """A load that no reader will see; ``report`` says how many rows broke each rule, as far as tables were read."""

    def __init__(self, reasons: list[str], report: list[tuple[str, str, str, int]]):
        super().__init__("; ".join(reasons))
        self.reasons, self.report = reasons, report


@dataclass
class Judged:
    part: Part
    rows: int
    good: int
    broken: dict[tuple[str, str], int] = field(default_factory=dict)


def write(store: Store, name: str, df: DataFrame, spec: Specification) -> Judged:
    """The good rows of a table in a folder, and what was observed meanwhile."""
    texts = {c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit(None).cast("string") for c in spec.fields}
    read = df.select(*[t.alias(c) for c, t in texts.items()])
    typed = read.select(*[F.struct(F.col(c).alias("text"), f.value(F.col(c)).alias("value")).alias(c) for c, f in spec.fields.items()])
    rules = {(c, rule): broken for c, f in spec.fields.items() for rule, broken in f.rules(F.col(c)["text"], F.col(c)["value"]).items()}
    flags = {key: f"f{i}" for i, key in enumerate(rules)}
    judged = typed.select("*", *[broken.alias(flags[key]) for key, broken in rules.items()])
    bad = F.lit(False)
    for flag in flags.values():
        bad = bad | F.col(flag)
    seen = Observation()
    observed = judged.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(flag)).alias(flag) for flag in flags.values()])
    part = store.write(name, observed.where(~bad).select(*[F.col(c)["value"].alias(c) for c in spec.fields]))
    got = seen.get
    broken = {key: got[flag] for key, flag in flags.items()} | {(c, "unknown"): got["rows"] for c in df.columns if c not in spec.fields}
    return Judged(part, got["rows"], part.rows, broken)


def load(store: Store, tables: dict[str, DataFrame], specs: dict[str, Specification], preconditions: dict[str, Callable[[], bool]] | None = None) -> Snapshot:
    """The next revision of the store, with all tables and the report; Refused if it may not be."""
    missing = [f"no table {n}" for n in specs if n not in tables]
    failed = missing + [f"precondition {n}" for n, holds in (preconditions or {}).items() if not holds()]
    if failed:
        raise Refused(failed, [])
    change, report, reasons = store.begin(), [], []
    for name, spec in specs.items():
        found = write(store, name, tables[name], spec)
        report += [(name, "*", "rows", found.rows), (name, "*", "good", found.good), *[(name, c, rule, n) for (c, rule), n in found.broken.items()]]
        if found.rows < spec.least_rows:
            reasons.append(f"{name}: {found.rows} rows, {spec.least_rows} needed")
        if found.rows - found.good > spec.most_bad * found.rows:
            reasons.append(f"{name}: {found.rows - found.good} of {found.rows} rows are bad")
        change.place(name, spec.schema, found.part)
    if reasons:
        raise Refused(reasons, report)
    change.replace(REPORTS, report_frame(store.spark, report))
    return change.commit(rebase=False)


def report_frame(spark: SparkSession, report: list[tuple[str, str, str, int]]) -> DataFrame:
    """A row for each table, column and rule."""
    return spark.createDataFrame(report, REPORT).coalesce(1)

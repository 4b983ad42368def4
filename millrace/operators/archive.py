"""Moving closed rows of a versioned history into archives of their own.

Each table has at most one rule: rows closed before a time, rows of revisions that no reader needs any more, or rows
observed before a time. One pass over a table writes its kept and its archived rows into two folders and counts both while
it writes. Only if the counts add up to the rows that the table had, for all tables, one new revision takes the kept rows
for the tables and names the archived ones under the archive: history and archives change in the same step.

Defined cases: rows whose time or revision is null are kept; tables without a rule are carried forward unread; a table
none of whose rows go keeps its folders; if no rows of any table go, there is no new revision; an archive of the same
quarter gets the next number; counts that don't add up raise Mismatch, and the store is as it was.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.versions import Part, Snapshot, Store

#: Where archives lie among a store's tables: archive/<quarter>/<table>.
ARCHIVE = "archive/"
SIDE = "millrace_archived"


class Mismatch(ValueError):
    """Rows have been lost or doubled on the way."""


@dataclass(frozen=True)
class Rule:
    """Rows of a table that go where the column is below the bound."""

    table: str
    column: str
    bound: datetime | int

    def condition(self, schema: T.StructType) -> Column:
        kind = schema[self.column].dataType
        if isinstance(self.bound, int):
            value = F.lit(self.bound)
        elif isinstance(kind, T.StringType):  # ISO-8601 with Z, which sorts as time does
            value = F.lit(self.bound.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
        elif isinstance(kind, T.TimestampType):
            value = F.timestamp_seconds(F.lit(int(self.bound.timestamp())))
        else:
            value = F.lit(self.bound.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S")).cast(kind)
        return F.coalesce(F.col(self.column) < value, F.lit(False))


def rules(snapshot: Snapshot, cutoff: datetime, revision: int, *, by_revision: tuple[str, ...] = (), never: tuple[str, ...] = ()) -> list[Rule]:
    """A rule for each table that calls for one by its columns: ``valid_to`` (closed rows), ``revision`` where the table is
    listed, or ``observed_at``."""
    found = []
    for name in sorted(snapshot.tables):
        columns = snapshot[name].columns
        if name in never or name.startswith(ARCHIVE):
            continue
        if "valid_to" in columns:
            found.append(Rule(name, "valid_to", cutoff))
        elif name in by_revision and "revision" in columns:
            found.append(Rule(name, "revision", revision))
        elif "observed_at" in columns:
            found.append(Rule(name, "observed_at", cutoff))
    return found


def quarter(when: datetime, taken: set[str]) -> str:
    """The year and quarter, with a number from 2 on if that is taken."""
    base = f"{when.year}-Q{(when.month + 2) // 3}"
    return next(name for n in range(1, len(taken) + 2) if (name := base if n == 1 else f"{base}-{n}") not in taken)


@dataclass(frozen=True)
class Count:
    table: str
    before: int
    kept: int
    archived: int


def split(store: Store, name: str, df: DataFrame, condition: Column) -> tuple[Part, Part]:
    """Kept and archived rows of a frame, in two folders from one pass."""
    seen, side = Observation(), F.col(SIDE)
    marked = df.withColumn(SIDE, condition)
    marked = marked.observe(seen, F.count(F.when(~side, 1)).alias("kept"), F.count(F.when(side, 1)).alias("archived"))
    folder = store.write_parted(name, marked, SIDE)
    return tuple(Part(f"{folder}/{SIDE}={str(gone).lower()}", seen.get["archived" if gone else "kept"]) for gone in (False, True))


def run(store: Store, when: datetime, found: list[Rule]) -> tuple[Snapshot, str | None, list[Count]]:
    """Apply the rules to the newest revision: the revision after it, the archive's name and the counts of each table.

    Counts come in the order of the rules; without rows to move the revision is the same and the archive None.
    """
    change = store.begin()
    base, counts, moved = change.base, [], {}
    for rule in found:
        df = base[rule.table]
        kept, gone = split(store, rule.table, df, rule.condition(df.schema))
        counts.append(Count(rule.table, base.rows(rule.table), kept.rows, gone.rows))
        if gone.rows:
            change.place(rule.table, df.schema, *([kept] if kept.rows else []))
            moved[rule.table] = (df.schema, gone)
    for c in counts:
        if c.before != c.kept + c.archived:
            raise Mismatch(f"{c.table}: {c.before} rows are not {c.kept} kept and {c.archived} archived")
    if not moved:
        return base, None, counts
    taken = {t.removeprefix(ARCHIVE).split("/")[0] for t in base.tables if t.startswith(ARCHIVE)}
    name = quarter(when.astimezone(UTC), taken)
    for table, (schema, gone) in moved.items():
        change.place(f"{ARCHIVE}{name}/{table}", schema, gone)
    return change.commit(rebase=False), name, counts

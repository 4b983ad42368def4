"""SQLite files as a Spark source and sink.

A table is a folder of SQLite files, one for each partition that was written, or a single file. Each file is read by
ranges of its rowid, and only the asked columns are selected. Files must be where the executors can open them.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Declared SQLite types and what they are read as; other declared types are refused.
KINDS = {"TEXT": T.StringType(), "INTEGER": T.LongType(), "REAL": T.DoubleType(), "BLOB": T.BinaryType()}
DECLARED = {"string": "TEXT", "long": "INTEGER", "bigint": "INTEGER", "integer": "INTEGER", "int": "INTEGER", "double": "REAL", "binary": "BLOB"}
ROWS = 100_000
BATCH = 10_000


def local(path: str) -> str:
    return path.removeprefix("file://")


def files(path: str) -> list[str]:
    p = Path(local(path))
    return sorted(map(str, p.glob("*.sqlite"))) if p.is_dir() else [str(p)]


def connect(path: str) -> sqlite3.Connection:
    """Read only; as unchanging unless the file has a write-ahead log."""
    wal = os.path.exists(f"{path}-wal")
    return sqlite3.connect(f"file:{path}?mode=ro" + ("" if wal else "&immutable=1"), uri=True)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class Range(InputPartition):
    path: str
    since: int
    until: int


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema

    def partitions(self) -> list[Range]:
        out = []
        for path in files(self.path):
            con = connect(path)
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
            con.close()
            if low is not None:
                out += [Range(path, a, min(a + ROWS, high + 1)) for a in range(low, high + 1, ROWS)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        con = connect(partition.path)
        columns = ", ".join(quoted(f.name) for f in self.schema.fields) or "1"
        yield from con.execute(f"SELECT {columns} FROM {quoted(self.table)} WHERE rowid >= ? AND rowid < ?", (partition.since, partition.until))
        con.close()


@dataclass
class Written(WriterCommitMessage):
    draft: str
    rows: int


class SqliteWriter(DataSourceArrowWriter):
    """Each task writes a file of its own under a draft name; the commit gives them their names."""

    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.folder, self.table, self.schema, self.overwrite = local(options["path"]), options["table"], schema, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        draft, rows = f"{self.folder}/{uuid.uuid4().hex}.draft", 0
        con = sqlite3.connect(draft)
        columns = ", ".join(f"{quoted(f.name)} {DECLARED[f.dataType.simpleString()]}" for f in self.schema.fields)
        con.execute(f"CREATE TABLE {quoted(self.table)} ({columns})")
        insert = f"INSERT INTO {quoted(self.table)} VALUES ({', '.join('?' * len(self.schema.fields))})"
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                con.executemany(insert, zip(*(c.to_pylist() for c in part.columns), strict=True))
                rows += part.num_rows
        con.commit()
        con.close()
        return Written(draft, rows)

    def commit(self, messages: list[Written]) -> None:
        if self.overwrite:
            for old in Path(self.folder).glob("*.sqlite"):
                old.unlink()
        for m in messages:
            if m and m.rows:
                os.rename(m.draft, m.draft.removesuffix(".draft") + ".sqlite")
            elif m:
                os.unlink(m.draft)

    def abort(self, messages: list[Written]) -> None:
        for m in messages:
            if m and os.path.exists(m.draft):
                os.unlink(m.draft)


class SqliteSource(DataSource):
    """format("sqlite_seed") with options path and table."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_seed"

    def schema(self) -> T.StructType:
        first = files(self.options["path"])[0]
        con = connect(first)
        info = con.execute(f"SELECT name, type FROM pragma_table_xinfo({quoted(self.options['table'])})").fetchall()
        con.close()
        unknown = [(n, t) for n, t in info if t.upper() not in KINDS]
        if unknown or not info:
            raise ValueError(f"{self.options['table']}: " + (f"types are not known: {unknown}" if unknown else "no such table"))
        return T.StructType([T.StructField(n, KINDS[t.upper()]) for n, t in info])

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)


def read(spark: SparkSession, path: str, table: str, columns: dict[str, str] | None = None):
    """A table; with columns (name to type) only these are read from the file."""
    register(spark)
    reader = spark.read.format("sqlite_seed").option("path", path).option("table", table)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` {t}" for c, t in columns.items()))
    return reader.load()


def write(df, path: str, table: str) -> None:
    register(df.sparkSession)
    df.write.format("sqlite_seed").option("path", path).option("table", table).mode("overwrite").save()

"""Exports whose bytes depend on the rows alone: JSON lines in the order of their keys, compressed in members of fixed size.

Rows are numbered in the order of their keys. A member is so many rows in a row; tasks compress whole members, with
headers that name neither time nor file, so the bytes are the same however the rows were dealt out. Members one after the
other are one valid gzip file; they are joined as bytes, nothing is compressed twice, and no task sees more than a member
at once.

Defined cases: null fields are written as null; ties are in the order of their lines; an empty table is an empty file of
one member; keys are sorted as Spark sorts them, nulls first.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.graph import checkpoint

#: Rows of a member, and zlib's level.
MEMBER_ROWS, LEVEL = 10_000, 9
MEMBERS = "member long, rows long, bytes long, sha256 string, body binary"


def numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """``json`` and ``at``: each row's line, and its place in the order of the keys from 0 on.

    A place is the row's place in its partition and the rows of all partitions before; these sums are a row each.
    """
    lines = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], canonical_json_column(df).alias("json"))
    order = [*(f"_k{i}" for i in range(len(keys))), "json"]
    ranged = checkpoint(lines.repartitionByRange(*order).sortWithinPartitions(*order).select("json", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")))
    held = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    base = held.select("part", "first", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # a row for each partition
    return ranged.join(F.broadcast(base), "part").select("json", (F.col("base") + F.col("id") - F.col("first")).alias("at"))


def canonical_json_column(df: DataFrame):
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def members(df: DataFrame, keys: list[str], *, rows: int = MEMBER_ROWS) -> DataFrame:
    """A row for each member: its number, rows, bytes of text, their SHA-256 and the compressed body."""

    def pack(number: int, lines: list[str]) -> tuple:
        text = "".join(line + "\n" for line in lines).encode()
        return number, len(lines), len(text), hashlib.sha256(text).hexdigest(), gzip.compress(text, LEVEL, mtime=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines = None, []

        def told(row: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["member", "rows", "bytes", "sha256", "body"])

        for batch in batches:
            for number, line in zip(batch.column("member").to_pylist(), batch.column("json").to_pylist(), strict=True):
                if number != now and lines:
                    yield told(pack(now, lines))
                    lines = []
                now = number
                lines.append(line)
        if lines:
            yield told(pack(now, lines))

    placed = numbered(df, keys).withColumn("member", F.floor(F.col("at") / rows))
    return placed.repartition("member").sortWithinPartitions("member", "at").select("member", "json").mapInArrow(run, MEMBERS)


def export(df: DataFrame, keys: list[str], path: str, *, rows: int = MEMBER_ROWS) -> DataFrame:
    """Write the file, and tell its members (member, rows, bytes, sha256, at: where it begins in the file).

    The compressed members are copied one after the other through the driver, a member at a time.
    """
    spark = df.sparkSession
    made = checkpoint(members(df, keys, rows=rows))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    begins, place = [], 0
    try:
        for r in made.select("member", "body").orderBy("member").toLocalIterator():
            begins.append((r["member"], place))
            stream.write(r["body"])
            place += len(r["body"])
        if not begins:
            stream.write(bytearray(gzip.compress(b"", LEVEL, mtime=0)))
    finally:
        stream.close()
    return made.drop("body").join(spark.createDataFrame(begins, "member long, at long"), "member")

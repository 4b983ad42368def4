"""Text files with a fixed schema, stored pages, canonical JSON, and published revisions."""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's checkpoint folder; in local mode a new temporary
    one where none is set."""
    have = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not have:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        have = tempfile.mkdtemp(prefix="millrace-")
    return have.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; a line that doesn't fit stops the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """With a header, types as given."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)


def store_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Pages as a crawl keeps them: id, SHA-256 of the text and the compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if x is None else x.encode() for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([None if x is None else hashlib.sha256(x).hexdigest() for x in raw], pa.string()), pa.array([None if x is None else zlib.compress(x) for x in raw], pa.binary())],
                names=[key, "sha", "body"],
            )

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, sha string, body binary")


def read_pages(stored: DataFrame, key: str) -> DataFrame:
    """id, sha and html of stored pages with a body; a body that isn't what its hash says stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, sha, body in zip(*(batch.column(c).to_pylist() for c in (key, "sha", "body")), strict=True):
                raw = zlib.decompress(body)
                if hashlib.sha256(raw).hexdigest() != sha:
                    raise ValueError(f"page {i} isn't what its hash says")
                out.append(raw.decode())
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("sha"), pa.array(out, pa.string())], names=[key, "sha", "html"])

    return stored.where("body is not null").select(key, "sha", "body").mapInArrow(run, f"{key} {stored.schema[key].dataType.simpleString()}, sha string, html string")


def canonical_json(df: DataFrame) -> DataFrame:
    """A column ``json`` for each row: keys in order, no blanks, nulls kept."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("json"))


def publish(df: DataFrame, folder: str, revision: int) -> None:
    """Write a revision beside the others, then point to it: a reader sees the old or the new one, whole.

    A revision that is there already is never written again.
    """
    df.write.mode("error").parquet(f"{folder}/revision={revision}")
    df.sparkSession.range(1).select(F.lit(revision).alias("revision")).coalesce(1).write.mode("append").json(f"{folder}/current")


def current_revision(spark: SparkSession, folder: str) -> int | None:
    return spark.read.schema("revision long").json(f"{folder}/current").agg(F.max("revision").alias("revision")).first()["revision"]


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/revision={current_revision(spark, folder)}")


def ordered_export(df: DataFrame, keys: list[str], path: str) -> None:
    """Rows as JSON lines in the order of their keys, over files whose names follow the same order."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("ignoreNullFields", False).json(path)

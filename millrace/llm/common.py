"""What the text operators share: table access, folds, checkpoints and batches of text."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy pass takes at once; a longer document is a pass of its own.
PASS_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text, mod n; 0 (held out) where the id is null."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % n, F.lit(0))


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each made longer until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's, or a new one in local mode where it has none."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        have = spark.sparkContext.getCheckpointDir()
        if not have:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            have = tempfile.mkdtemp(prefix="millrace-checkpoint-")
            spark.sparkContext.setCheckpointDir(have)
        return have
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(have)
    return have


#: A key is hot if it has at least so many rows, and at least one in HOT_KEYS of all rows.
HOT_ROWS, HOT_KEYS = 100_000, 512


def join_counted(rows: DataFrame, facts: DataFrame, key: str, count: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of rows with facts, one for each value of the key, where ``count`` says how many of the rows have it.

    Hot keys are HOT_KEYS at most whatever the data; their facts are broadcast, so that no task gets a hot key's rows,
    and only the others' rows are shuffled. Null keys don't join. Both sides may be read twice: give tables whose lineage
    is cut.
    """
    sizes = facts.agg(F.sum(count).alias("total"), F.max(count).alias("most")).first()
    least = max(hot_rows, -(-(sizes["total"] or 0) // HOT_KEYS))
    if (sizes["most"] or 0) < least:
        return rows.join(facts.drop(count), key)
    hot, cold = facts.where(F.col(count) >= least).drop(count), facts.where(F.col(count) < least).drop(count)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(cold, key))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder, so that a lost executor costs no rerun of what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column, one after the other, and the places where each row starts (one more than rows); null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, at - at[0]


def valid(column: pa.Array) -> pa.Array:
    """The column, with U+FFFD for bytes that aren't UTF-8."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        texts = column.cast(pa.large_binary()).to_pylist()
        return pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.large_string())


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a folder that Hadoop names, and the path in it."""
    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme == "dbfs":
        uri = f"file:///dbfs/{rest.lstrip('/')}"
    elif scheme == "file":
        uri = f"file:///{rest.lstrip('/')}"
    return arrow_fs.FileSystem.from_uri(uri)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str, text: str) -> DataFrame:
    """(_text, _label) of about ``rows`` labelled rows at most.

    Ids are chosen by a hash, and their number, which bounds what is broadcast, by ``rows``. Rows that repeat id and text
    are one; where ids repeat with many texts, texts are chosen by a hash of both in turn. An id with several labels has
    their majority, and 1 on a tie; null labels and ids don't count.
    """
    span = 1 << 31

    def share(of: int) -> int:
        return int(min(1.0, rows / max(of, 1)) * span)

    usable = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    chosen = (
        usable.where(F.pmod(F.xxhash64("_key"), F.lit(span)) < F.lit(share(usable.select("_key").distinct().count())))
        .groupBy("_key").agg((F.avg("_label") >= 0.5).cast("double").alias("_label"))
    )
    found = docs.join(F.broadcast(chosen), F.col(key) == F.col("_key")).select(
        "_label", F.coalesce(F.col(text), F.lit("")).alias("_text"), F.xxhash64("_key", F.coalesce(F.col(text), F.lit(""))).alias("_h")
    )
    many = found.agg(F.approx_count_distinct("_h")).first()[0]
    thinned = found.where(F.pmod("_h", F.lit(span)) < F.lit(share(many))) if many > 1.2 * rows else found
    once = thinned.groupBy("_h").agg(F.first("_label").alias("_label"), F.first("_text").alias("_text"))
    # bytes that aren't UTF-8 are replaced here, as a UDF can't read them
    return checkpoint(once.select("_label", F.make_valid_utf8("_text").alias("_text")))


def decoded(column: pa.Array) -> list[str]:
    """Texts of an Arrow string column; null is empty, and bytes that aren't UTF-8 are read as U+FFFD."""
    return [(t or b"").decode("utf-8", "replace") for t in column.cast(pa.large_binary()).to_pylist()]


def passes(at: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) of at most ``most`` bytes together, or a single longer row."""
    a, n = 0, len(at) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


def as_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

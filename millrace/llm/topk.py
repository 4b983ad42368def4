"""Exact top-k search by integer inner product.

A component x becomes floor(256 x). Candidates are ranged by length, longest first, and each task goes through its range
in blocks from the longest on: where a block's longest vector can't reach a query's k-th score (Cauchy-Schwarz), the query
leaves out the block. The rest is compared on the leading axes of a rotation (the singular vectors of a bounded sample); what the remaining
axes can add at most is the product of the residual lengths, and only pairs that can still reach the k-th score get the
next axes and at last their exact integer product. The rotation and the first scores only prune: every candidate is
either compared or ruled out by a bound.

Queries lie in files of bounded blocks in the shared folder, each with what the longest candidates give as its first
scores. One job compares them: a task takes its range of candidates, a bounded part at a time, through the blocks.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows without an id take no part;
shorter vectors are as if filled up with zeros; rows that repeat an id are never each other's candidates, and count for
other queries with the best of their scores; the first row of a repeated query id (in the order of its vectors) asks;
ties go to the smaller id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ensure_checkpoint_dir, file_system

#: Queries of a block on average; sampled vectors for the rotation; longest vectors that give the first scores.
QUERY_BLOCK, SAMPLE_ROWS, SEED_ROWS = 2048, 4096, 2048
#: Components of candidates that a task holds at once.
HELD = 1 << 22
#: Candidates compared at once, and the leading axes compared in turn.
ROWS, AXES = 1024, (8, 24)
#: What rounding may add to a bound, in units of the lengths' product.
SLACK = 1e-6


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (vec_id, v, norm2) that take part."""
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return (
        vectors.where(usable).select(F.col(key).alias("vec_id"), v.alias("v"))
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    if n and (lengths == width).all():
        return flat.reshape(n, width)
    out = np.zeros((n, width), np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)])
    for i in range(n):
        m = min(width, int(lengths[i]))
        out[i, :m] = flat[at[i] : at[i] + m]
    return out


def best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k best rows, in order of query, score falling, id; an id counts once."""
    order = np.lexsort((ident, -score, query))
    q, s, v = query[order], score[order], ident[order]
    fresh = np.ones(len(q), bool)
    pair = np.lexsort((np.arange(len(q)), v, q))
    again = (q[pair[1:]] == q[pair[:-1]]) & (v[pair[1:]] == v[pair[:-1]])
    fresh[pair[1:][again]] = False
    order, q = order[fresh], q[fresh]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


class Candidates:
    """Vectors of about one length, with their lengths, and on the rotated axes with what the axes after AXES leave."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.turned = vectors @ axes
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.rest = [np.sqrt((self.turned[:, a:] ** 2).sum(axis=1)) for a in AXES]


class Search:
    """A block of queries, and the best scores found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray, k: int, least: np.ndarray | None = None):
        self.asked, self.axes, self.k = Candidates(ids, vectors, axes), axes, k
        self.query, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), -np.inf) if least is None else least

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.compare(Candidates(ids, vectors, self.axes))

    def compare(self, some: Candidates) -> None:
        """Compare with candidates; queries that can't gain from the longest of them are left out."""
        asked = self.asked
        open_ = np.flatnonzero(asked.norms * some.norms.max(initial=0.0) * (1 + SLACK) + SLACK >= self.least)
        if not len(open_):
            return
        a, b = AXES
        bound = asked.turned[open_, :a] @ some.turned[:, :a].T + np.outer(asked.rest[0][open_], some.rest[0])
        slack = SLACK * np.outer(asked.norms[open_], some.norms) + SLACK
        i, j = np.nonzero(bound + slack >= self.least[open_][:, None])
        slack, i = slack[i, j], open_[i]
        keep = np.empty(len(i), bool)
        for c in range(0, len(i), 1 << 17):
            s = slice(c, c + (1 << 17))
            keep[s] = np.einsum("ij,ij->i", asked.turned[i[s], :b], some.turned[j[s], :b]) + asked.rest[1][i[s]] * some.rest[1][j[s]] + slack[s] >= self.least[i[s]]
        keep &= asked.ids[i] != some.ids[j]
        i, j = i[keep], j[keep]
        score = np.empty(len(i), np.int64)
        for c in range(0, len(i), 1 << 17):
            s = slice(c, c + (1 << 17))
            score[s] = np.einsum("ij,ij->i", asked.vectors[i[s]], some.vectors[j[s]])
        good = score >= self.least[i]
        self._take(i[good], score[good], some.ids[j[good]])

    def _take(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        query, score, ident = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.found, ident)))
        kept = best(query, score, ident, self.k)
        self.query, self.score, self.found = query[kept], score[kept], ident[kept]
        full = np.flatnonzero(np.bincount(self.query, minlength=len(self.asked.ids)) == self.k)
        last = np.searchsorted(self.query, full, "right") - 1
        self.least[full] = np.maximum(self.least[full], self.score[last])


def parts(batches: Iterator[pa.RecordBatch], axes: np.ndarray) -> Iterator[list[Candidates]]:
    """Batches in lists of at most HELD components together, each in blocks of ROWS."""
    width, held, rows = axes.shape[0], [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            if held and (rows + part.num_rows) * width > HELD:
                yield held
                held, rows = [], 0
            held.append(Candidates(part.column("vec_id").to_numpy(), matrix(part.column("v"), width), axes))
            rows += part.num_rows
    if held:
        yield held


def write_blocks(queries: DataFrame, seeds: tuple[np.ndarray, np.ndarray], axes: np.ndarray, k: int, folder: str) -> list[str]:
    """Files of queries (vec_id, v, least: the k-th score among the seeds); their addresses."""
    sent = queries.sparkSession.sparkContext.broadcast((seeds, axes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, vectors), axes = sent.value
        longest = [Candidates(ids[a : a + ROWS], vectors[a : a + ROWS], axes) for a in range(0, len(ids), ROWS)]
        for batch in batches:
            block = Search(batch.column("vec_id").to_numpy(), matrix(batch.column("v"), axes.shape[0]), axes, k)
            for some in longest:
                block.compare(some)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(block.least)], names=["vec_id", "v", "least"])

    queries.mapInArrow(run, "vec_id long, v array<long>, least double").write.parquet(folder)
    where, path = file_system(folder)
    return sorted(f.path for f in where.get_file_info(arrow_fs.FileSelector(path)) if f.path.endswith(".parquet"))


def scan(candidates: DataFrame, folder: str, blocks: list[str], axes: np.ndarray, k: int) -> DataFrame:
    """For each range of candidates, the best of it for each query that it can give one of its k best."""
    sent = candidates.sparkSession.sparkContext.broadcast((axes, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, blocks = sent.value
        where, _ = file_system(folder)
        for held in parts(batches, axes):
            for path in blocks:
                for block in pq.ParquetFile(path, filesystem=where).iter_batches(QUERY_BLOCK):
                    search = Search(block.column("vec_id").to_numpy(), matrix(block.column("v"), axes.shape[0]), axes, k, block.column("least").to_numpy().copy())
                    for some in held:
                        search.compare(some)
                    if len(search.query):
                        yield pa.RecordBatch.from_arrays([pa.array(search.asked.ids[search.query]), pa.array(search.found), pa.array(search.score)], names=["query_id", "vec_id", "score"])

    return candidates.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score long")


def rows_of(df: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded table, on the driver."""
    got = df.select(F.col("vec_id").cast("long"), "v").toArrow()
    return got.column("vec_id").to_numpy().astype(np.int64), matrix(got.column("v"), width)


def search(vectors: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding", *, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best candidates of each query: query_id, rank, vec_id, score. is_query: an SQL condition on vec_id."""
    spark = vectors.sparkSession
    ready = integers(vectors, key, vector)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/topk-{uuid.uuid4().hex}"
    facts = ready.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count(F.when(F.expr(is_query), 1)).alias("queries")).first()
    n, width = facts["n"], max(facts["width"] or 0, AXES[-1] + 1)
    ranges = max(1, -(-n * width // HELD), min(-(-n // ROWS), spark.sparkContext.defaultParallelism))
    ready.repartitionByRange(ranges, F.desc("norm2"), F.col("vec_id")).sortWithinPartitions(F.desc("norm2"), "vec_id").write.parquet(f"{folder}/candidates")
    ready = spark.read.schema("vec_id long, v array<long>, norm2 double").parquet(f"{folder}/candidates")
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    _, sample = rows_of(ready.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31)) < F.lit(int(share * (1 << 31)))).orderBy("vec_id", "v").limit(2 * SAMPLE_ROWS), width)
    axes = np.linalg.svd((sample.T @ sample).astype(np.float64))[0]
    seeds = rows_of(ready.orderBy(F.desc("norm2"), "vec_id").limit(SEED_ROWS), width)
    asking = ready.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(max(1, -(-facts["queries"] // query_block)), "vec_id")
    blocks = write_blocks(asking, seeds, axes, k, f"{folder}/queries")
    found = scan(ready, folder, blocks, axes, k).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")

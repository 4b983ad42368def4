"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text is lower-cased, and its n-grams of code points are hashed to buckets with a rolling hash in numpy. The labelled
texts give each bucket a log ratio: how much more often texts of label 1 hold it than texts of label 0. The buckets whose
ratio is the most certain are the features; a feature that a text holds has its ratio as value, and a logistic regression
with a ridge penalty learns the weights (values are not standardised, as that would undo the scaling). A score is a sum
over the distinct features of the whole text, so that a few words count in a long text as they do in a short one.

Defined cases: a null text counts as empty, bytes that aren't UTF-8 are read as U+FFFD, and an empty text has the score of a text without features; n-grams don't
run from one text into the next; null labels and ids do not train; a document with several label rows has their majority,
and 1 on a tie; rows that repeat id and text train once; without labelled rows every score is 0.5, and with labels of one
kind it is that kind's share with one added to either side. Ties and repeated rows are scored alike. Other columns pass
through; columns of the input that carry the names of the results, in any case, are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import checkpoint, fresh, labelled_sample, passes, utf8

#: Labelled rows that the model is fitted on, on average at most.
SAMPLE_ROWS = 20_000
#: Lengths of n-grams, buckets (a power of two), and the features that are kept at most.
SIZES, BUCKETS, FEATURES = (3, 4, 5, 6), 1 << 20, 4096
#: Added to every count; texts that must hold a feature at least; the least certainty of its ratio, in standard errors.
SMOOTHING, MIN_TEXTS, CERTAINTY = 1.0, 4, 3.0
#: Strength of the ridge, and the score from which a text is predicted to be of label 1.
RIDGE, THRESHOLD = 0.001, 0.3
#: Bytes of texts, and code points of a long one, that a numpy pass takes at once.
PASS = 1 << 18


def hashed(points: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point."""
    rolled = points[: len(points) - n + 1].copy() if len(points) >= n else np.zeros(0, np.uint32)
    for k in range(1, n):
        rolled *= np.uint32(0x01000193)
        rolled += points[k : len(points) - n + 1 + k]
    rolled += np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(13)
    return rolled & np.uint32(BUCKETS - 1)


def parts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of rows [a, b) with their texts, of at most PASS bytes together, or a single longer text."""
    raw, at = utf8(column)
    for a, b in passes(at, PASS):
        yield a, b, [raw[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace") for i in range(a, b)]


def held(texts: list[str], feature_of: np.ndarray | None = None, size: int = PASS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once and in order, of what the texts hold. feature_of: of a bucket, -1 for none."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    flat, row = np.concatenate(points), np.repeat(np.arange(len(texts)), [len(p) for p in points])
    found = [np.zeros(0, np.int64)]
    for a in range(0, len(flat), size):  # parts overlap by all but one character of an n-gram
        part, of = flat[a : a + size + max(SIZES) - 1], row[a : a + size + max(SIZES) - 1]
        for n in SIZES:
            feature = hashed(part, n).astype(np.int64)
            whole = of[: len(feature)] == of[len(of) - len(feature) :]
            if feature_of is not None:
                feature = feature_of[feature]
                whole &= feature >= 0
            found.append(np.unique(of[: len(feature)][whole] * BUCKETS + feature[whole]))
    return np.divmod(np.unique(np.concatenate(found)), BUCKETS)


@dataclass
class Model:
    intercept: float
    #: of a bucket the feature, or -1; of a feature its value times its weight
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def table(self) -> np.ndarray:
        out = np.full(BUCKETS, -1, np.int64)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def scores(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        if len(self.buckets):
            row, feature = held(texts, table)
            total += np.bincount(row, self.weights[feature], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -700, 700)))


def counted(sample: DataFrame) -> DataFrame:
    """Of each bucket (bucket, ones, zeros): how many texts of either label hold it. A task sums up before it hands on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            label = batch.column("_label").to_numpy()
            for a, b, texts in parts(batch.column("_text")):
                row, bucket = held(texts)
                one = label[a:b][row] > 0
                np.add.at(counts[1], bucket[one], 1)
                np.add.at(counts[0], bucket[~one], 1)
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[1][some]), pa.array(counts[0][some])], names=["bucket", "ones", "zeros"])

    partial = sample.mapInArrow(run, "bucket long, ones long, zeros long")
    return partial.groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def ratios(sample: DataFrame, ones: int, zeros: int) -> tuple[np.ndarray, np.ndarray]:
    """The chosen buckets and their log-count ratios."""
    p, q = F.col("ones") + SMOOTHING, F.col("zeros") + SMOOTHING
    ratio = F.log(p / (ones + 2 * SMOOTHING)) - F.log(q / (zeros + 2 * SMOOTHING))
    certainty = F.abs(F.col("ratio")) / F.sqrt(1 / p + 1 / q)
    best = (
        counted(sample).where(F.col("ones") + F.col("zeros") >= MIN_TEXTS).withColumn("ratio", ratio).withColumn("certainty", certainty)
        .where(F.col("certainty") >= CERTAINTY).orderBy(F.desc("certainty"), "bucket").limit(FEATURES).select("bucket", "ratio").toArrow()
    )
    return best.column("bucket").to_numpy().astype(np.int64), best.column("ratio").to_numpy().astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", key: str = "doc_id", *, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, label, rows, key, text)
    facts = sample.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    n, ones = facts["n"], int(facts["ones"] or 0)
    if not n:
        return Model(0.0)
    buckets, ratio = ratios(sample, ones, n - ones) if 0 < ones < n else (np.zeros(0, np.int64), np.zeros(0))
    if not len(buckets):
        return Model(math.log((ones + 1) / (n - ones + 1)))
    table = Model(0.0, buckets).table()

    value = ratio.tolist()

    def vector(text: str) -> SparseVector:
        at = held([text], table)[1].tolist()
        return Vectors.sparse(len(value), at, [value[i] for i in at])

    ready = checkpoint(sample.select("_label", F.udf(vector, VectorUDT())("_text").alias("_x")))
    fitted = LogisticRegression(labelCol="_label", featuresCol="_x", regParam=RIDGE, elasticNetParam=0.0, standardization=False, maxIter=100, tol=1e-4).fit(ready)
    return Model(float(fitted.intercept), buckets, fitted.coefficients.toArray() * ratio)


def predict(docs: DataFrame, model: Model, text: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with ``score`` and ``predicted``."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    read = docs.select(*kept, F.col(text).alias(fresh(docs, "_text")[0]))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            found = [model.scores(texts, table) for _, _, texts in parts(batch.column(batch.num_columns - 1))]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)

    return read.mapInArrow(run, schema)

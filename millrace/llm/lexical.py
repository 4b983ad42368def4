"""Ranked lexical search with exact results, pruned by hashed max-sketches.

A term has an impact on a document (its frequency, damped by the document's length) and a weight in an item (rarer terms
weigh more); a score is the sum of weight times impact over an item's terms. Each document's impacts are folded into a
sketch: every term is hashed to two cells, and a cell keeps the greatest impact that falls into it. What an item's terms
find in their cells (the lesser of the two) bounds the score from above. Documents are taken from the greatest bound on
and scored exactly, until the bounds fall below the k-th score found.

Items are few against documents: they are broadcast in rounds of bounded size, and each round is one job over the
documents, in which a task keeps the k best of each item. How many documents hold a term is counted for the items' terms
only, which tasks know by a bitmap of fixed size.

Defined cases: a null text has no terms, and a text without terms is no document in the counts and is never found; bytes
that aren't UTF-8 belong to terms as they are; documents that repeat an id or a text, and those without an id, are
documents of their own, and a null id comes last among equal scores; rows that repeat an item's id are one item, with the
least of their texts; an item without terms that occur has no rows; terms of any length and number are whole; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import checkpoint

#: What isn't part of a term becomes a space, A to Z become small, all else stays.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: Cells of a sketch (a power of two), documents whose sketches lie side by side, and the steps that impacts are rounded up to.
CELLS, BLOCK, STEP = 4096, 512, 16
#: Bits of the bitmap of the items' terms, and different terms that a task counts before it hands them on.
MARKS, HELD_TERMS = 1 << 20, 1 << 18
#: Items and items' terms of a round, on average at most, and terms of an item looked up at once.
ROUND_ITEMS, ROUND_TERMS, LOOKUP = 1024, 1 << 18, 2048
#: Parts that the results of an item are first ranked in.
PARTS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term): the different terms of each item."""
    schema = T.StructType([items.schema[item], T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, t) for r, value in enumerate(raw(batch.column(text))) for t in dict.fromkeys(terms_of(value))]
            rows = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(item).take(rows), pa.array([t for _, t in found], pa.binary())], names=schema.names)

    return items.groupBy(item).agg(F.min(text).alias(text)).mapInArrow(run, schema)


def counted(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(term, documents, occurrences) of the terms that the bitmap lets through, and of all terms together under null."""
    marks = np.zeros(MARKS, bool)
    marks[terms.select(F.pmod(F.xxhash64("term"), F.lit(MARKS)).alias("m")).distinct().toArrow().column("m").to_numpy()] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = occurrences = 0
        seen: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            some = [t for t in seen if marks[xxhash.xxh64_intdigest(t, 42) & MARKS - 1]]
            out = pa.RecordBatch.from_arrays(
                [pa.array([*some, None], pa.binary()), pa.array([*map(seen.__getitem__, some), documents], pa.int64()), pa.array([0] * len(some) + [occurrences], pa.int64())],
                names=["term", "documents", "occurrences"],
            )
            seen.clear()
            return out

        for batch in batches:
            for value in raw(batch.column(text)):
                found = terms_of(value)
                documents, occurrences = documents + bool(found), occurrences + len(found)
                seen.update(set(found))
                if len(seen) > HELD_TERMS:
                    yield told()
                    documents = occurrences = 0
        yield told()

    partial = docs.select(text).mapInArrow(run, "term binary, documents long, occurrences long")
    return partial.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences"))


@dataclass
class Corpus:
    """How many documents have terms, and how many terms they have with repeats."""

    documents: int
    occurrences: int

    def damping(self, n: int) -> int:
        return 10 + 90 * n * self.documents // self.occurrences


def impacts(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * damping)


class Sketches:
    """Max-sketches of a block of documents, a cell after the other."""

    def __init__(self, n: int, row: np.ndarray, code: np.ndarray, impact: np.ndarray):
        self.cells = np.zeros((CELLS, n), np.uint16)
        flat, rounded = self.cells.reshape(-1), (-(-impact // STEP)).astype(np.uint16)
        for cell in cells_of(code):
            np.maximum.at(flat, cell * n + row, rounded)

    def bounds(self, cells: tuple[np.ndarray, np.ndarray], weight: np.ndarray) -> np.ndarray:
        """No document of the block can score more with terms in these cells."""
        out = np.zeros(self.cells.shape[1])
        for a in range(0, len(weight), LOOKUP):
            one, other = (c[a : a + LOOKUP] for c in cells)
            out += weight[a : a + LOOKUP] @ np.minimum(self.cells[one], self.cells[other]).astype(np.float64)
        return out * STEP


def cells_of(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two cells for each hash of 32 bits."""
    return code & (CELLS - 1), code >> 20 & (CELLS - 1)


class Items:
    """The items of a round, and the k best documents found for each."""

    def __init__(self, found: list[tuple[list[bytes], list[int]]], k: int):
        self.k = k
        vocabulary: dict[bytes, int] = {}
        self.asked = []
        for terms, weights in found:
            number = [vocabulary.setdefault(t, len(vocabulary)) for t in terms]
            self.asked.append((dict(zip(number, weights, strict=True)), cells_of(np.array([zlib.crc32(t) for t in terms], np.int64)), np.array(weights, np.float64)))
        self.vocabulary = vocabulary
        self.best: list[list[tuple]] = [[] for _ in found]
        self.compared = 0  # pairs of item and document that were scored exactly

    def add(self, ids: list, texts: list[bytes | None], corpus: Corpus) -> None:
        """Take the documents of a block."""
        row, code, tf, damping, known = [], [], [], [], []
        for i, text in enumerate(texts):
            words = terms_of(text)
            counts = Counter(words)
            row.append(len(counts))
            damping.append(corpus.damping(len(words)))
            code += map(zlib.crc32, counts)
            tf += counts.values()
            known.append({self.vocabulary[t]: counts[t] for t in counts.keys() & self.vocabulary.keys()})
        row, code, tf = np.repeat(np.arange(len(texts)), row), np.array(code, np.int64), np.array(tf, np.int64)
        sketches = Sketches(len(texts), row, code, impacts(tf, np.array(damping, np.int64)[row]))
        for (weights, cells, weight), best in zip(self.asked, self.best, strict=True):
            least = -best[-1][0] if len(best) == self.k else 1
            bound = sketches.bounds(cells, weight)
            some = np.flatnonzero(bound >= least)
            for i in some[np.argsort(-bound[some], kind="stable")].tolist():
                if bound[i] < least:
                    break
                self.compared += 1
                has, m = known[i], 8 * damping[i]
                score = sum(weights[t] * (1_000_000_000 * has[t] // (1000 * has[t] + m)) for t in weights.keys() & has.keys())
                if score >= least:
                    insort(best, (-score, ids[i] is None, ids[i] if ids[i] is not None else 0))
                    del best[self.k :]
                    least = -best[-1][0] if len(best) == self.k else 1


def scan(docs: DataFrame, names: pa.Array, items: list[tuple[list[bytes], list[int]]], corpus: Corpus, k: int, key: str, text: str, item: T.StructField) -> DataFrame:
    """The k best documents of each task for each item of a round."""
    schema = T.StructType([item, T.StructField("_id", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast((names, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, found = sent.value
        asked, kind = Items(found, k), None
        for batch in batches:
            kind = batch.column(key).type
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                asked.add(part.column(key).to_pylist(), raw(part.column(text)), corpus)
        rows = [(i, None if null else ident, -score) for i, best in enumerate(asked.best) for score, null, ident in best]
        if rows:
            at, ids, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), pa.array(ids, kind), pa.array(scores, pa.int64())], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item: the item's id, rank (int, from 1), the document's id and its score."""
    spark = docs.sparkSession
    asked = checkpoint(item_terms(items, item, item_text))
    known = checkpoint(counted(docs, asked, text))
    total = known.where("term IS NULL").select("documents", "occurrences").first()
    corpus = Corpus(total["documents"], total["occurrences"]) if total else Corpus(0, 0)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * corpus.documents + 2.0) / (2.0 * F.col("documents") + 1.0)))
    weighed = asked.join(known.where("term IS NOT NULL"), "term").select(F.struct(item).alias("_item"), "term", weight.alias("weight")).where("weight > 0")
    of_item = checkpoint(weighed.groupBy("_item").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")))
    facts = of_item.agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    rounds = max(1, -(-facts["n"] // ROUND_ITEMS), -(-(facts["terms"] or 0) // ROUND_TERMS))
    found = []
    for r in range(rounds if facts["n"] else 0):
        got = of_item.where(F.pmod(F.xxhash64("_item"), F.lit(rounds)) == r).select(f"_item.{item}", "terms").toArrow().combine_chunks()
        asks = [([x["term"] for x in terms], [x["weight"] for x in terms]) for terms in got.column("terms").to_pylist()]
        names = got.column(0).combine_chunks() if got.num_rows else got.column(0)
        if got.num_rows:
            found.append(scan(docs, names, asks, corpus, k, key, text, items.schema[item]))
    if not found:
        return spark.createDataFrame([], T.StructType([items.schema[item], T.StructField("rank", T.IntegerType()), docs.schema[key], T.StructField("score", T.LongType())]))
    order = [F.desc("score"), F.col("_id").asc_nulls_last()]
    ranked = reduce(DataFrame.unionAll, found).withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(PARTS)))
    for by in ([item, "_part"], [item]):  # an item's results are first cut down in parts
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(item, F.col("rank").cast("int"), F.col("_id").alias(key), "score")

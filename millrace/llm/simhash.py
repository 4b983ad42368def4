"""Near-duplicate groups by 64-bit SimHash.

A text's fingerprint is the majority of the bits of its shingles' hashes. Fingerprints that differ in few bits are
linked. To find the links, equal fingerprints are first made one; then each is sent to every bucket that its bytes, but
for as many as the radius, name. Two fingerprints within the radius meet in at least one bucket, and a bucket can't
outgrow what the left-out bytes can count. Inside a bucket the fingerprints lie bit-sliced, a plane of bits for each
place: a query's distances to all lanes grow together in carry-save counters, and blocks of lanes whose distances are all
beyond the radius are abandoned. Buckets give a spanning tree of their links, not every pair; groups are the components.

Defined cases: a null text counts as empty; a text without words has fingerprint 0 and is linked like any other; with
fewer words than a shingle the whole sequence is one shingle; an empty table has no groups. A node is a fingerprint, so
rows that repeat an id with other texts are grouped each by its own text. Documents without an id are linked like others
but give a group no name: a group of such documents alone has a null one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import checkpoint, fresh, join_counted, passes, utf8

SHINGLE_WORDS, HASH_SEED, RADIUS = 3, 42, 2
#: Words of 64 lanes that are abandoned together.
BLOCK_WORDS = 8
#: Buckets of up to this size are compared pair by pair, all buckets at once.
TINY = 4
#: Links that a task holds before it hands on what spans them.
HELD_LINKS = 1 << 20


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> list[int]:
    """XXH64 of each shingle of the lower-cased words."""
    found = text.lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def fingerprint_batch(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of texts."""
    out = np.zeros(len(at) - 1, np.uint64)
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for a, b in passes(at):
        hashes: list[int] = []
        upto = [0]
        for i in range(a, b):
            hashes += shingle_hashes(raw[at[i] : at[i + 1]].tobytes())
            upto.append(len(hashes))
        upto = np.array(upto)
        some = np.flatnonzero(np.diff(upto))
        if not len(some):
            continue
        h = np.array(hashes, np.uint64)
        for k in range(0, 64, 8):  # eight places at a time, to bound memory
            bits = np.unpackbits((h >> np.uint64(k)).astype(np.uint8)[:, None], axis=1, bitorder="little")
            sums = np.add.reduceat(bits, upto[some], axis=0, dtype=np.int64)
            major = 2 * sums > np.diff(upto)[some][:, None]
            out[a + some] |= (major * powers[k : k + 8]).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns to keep, and fingerprints as signed longs."""
    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8(batch.column(text))
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(fingerprint_batch(raw, at).view(np.int64))], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)


def planes(values: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bit planes of the values, as (place, block, word) of 64 lanes, for the places where values differ, and these places."""
    n = len(values)
    lanes = -(-n // (64 * BLOCK_WORDS)) * 64 * BLOCK_WORDS
    differ = int(np.bitwise_or.reduce(values ^ values[0]))
    places = [p for p in range(64) if differ >> p & 1]
    out = np.empty((len(places), lanes // (64 * BLOCK_WORDS), BLOCK_WORDS), np.uint64)
    for k, p in enumerate(places):
        bits = np.zeros(lanes, np.uint8)
        bits[:n] = values >> np.uint64(p) & np.uint64(1)
        out[k] = np.packbits(bits, bitorder="little").view(np.uint64).reshape(out.shape[1:])
    return out, places


def near(sliced: np.ndarray, places: list[int], query: int, radius: int = RADIUS) -> np.ndarray:
    """Words whose bits tell which lanes differ from the query in at most ``radius`` places."""
    blocks = np.arange(sliced.shape[1])
    shape = (sliced.shape[1], sliced.shape[2])
    counters = [np.zeros(shape, np.uint64) for _ in range(radius.bit_length())]
    beyond = np.zeros(shape, np.uint64)
    ones = ~np.uint64(0)

    def exceed() -> np.ndarray:
        more, same = beyond.copy(), np.full(beyond.shape, ones)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                same &= counters[k]
            else:
                more |= same & counters[k]
                same &= ~counters[k]
        return more

    for i, p in enumerate(places):
        carry = sliced[i] if len(blocks) == sliced.shape[1] else sliced[i, blocks]
        carry = ~carry if query >> p & 1 else carry
        for k, c in enumerate(counters):
            counters[k], carry = c ^ carry, c & carry
        beyond |= carry
        if i % 4 == 3:
            alive = (exceed() != ones).any(axis=1)
            if not alive.all():
                blocks, beyond = blocks[alive], beyond[alive]
                counters = [c[alive] for c in counters]
                if not len(blocks):
                    break
    out = np.zeros(shape, np.uint64)
    out[blocks] = ~exceed()
    return out.ravel()


def tree(values: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Links (i, j) that span the components of the values within the radius of one another."""
    n = len(values)
    sliced, places = planes(values)
    fresh = np.zeros(sliced.shape[1] * BLOCK_WORDS * 64, np.uint8)
    fresh[:n] = 1
    fresh = np.packbits(fresh, bitorder="little").view(np.uint64)
    for first in range(n):
        if not int(fresh[first >> 6]) >> (first & 63) & 1:
            continue
        todo = [first]
        fresh[first >> 6] &= ~np.uint64(1 << (first & 63))
        while todo:
            i = todo.pop()
            found = near(sliced, places, int(values[i]), radius) & fresh
            fresh &= ~found
            for w in np.flatnonzero(found).tolist():
                lanes = np.flatnonzero(np.unpackbits(found[w : w + 1].view(np.uint8), bitorder="little")) + 64 * w
                for j in lanes.tolist():
                    yield i, j
                    todo.append(j)


def roots(pairs: np.ndarray) -> np.ndarray:
    """Pairs (node, least node of its component) for the nodes of the pairs that aren't the least themselves."""
    nodes, flat = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in flat.reshape(-1, 2).tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    up = np.array([root(i) for i in range(len(nodes))], np.int64)
    moved = np.flatnonzero(up != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[up[moved]]], axis=1)


def bucket_links(keys: np.ndarray, values: np.ndarray, nodes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links (node, node) inside runs of equal keys. keys: (rows, columns), sorted."""
    n = len(values)
    change = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]])
    edges = np.flatnonzero(change)
    sizes = np.diff(edges)
    out = []
    run = np.repeat(np.arange(len(sizes)), sizes)
    small = (sizes[run] <= TINY) & (sizes[run] > 1)
    for d in range(1, TINY):
        i = np.flatnonzero(small[: n - d] & (run[: n - d] == run[d:])) if n > d else np.zeros(0, np.int64)
        i = i[np.bitwise_count(values[i] ^ values[i + d]) <= radius]
        out.append(np.stack([nodes[i], nodes[i + d]], axis=1))
    for k in np.flatnonzero(sizes > TINY).tolist():
        a, b = edges[k], edges[k + 1]
        found = np.array(list(tree(values[a:b], radius)), np.int64).reshape(-1, 2)
        out.append(nodes[a:b][found])
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v), v the lesser, that join all of the nodes (node, fp: distinct) within the radius."""
    masks = [~sum(0xFF << (8 * i) for i in left_out) & ((1 << 64) - 1) for left_out in combinations(range(8), radius)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*map(F.lit, masks))).alias("t", "mask")).select(
        "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "node"
    )
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def of(rows: np.ndarray) -> np.ndarray:
        return bucket_links(rows[:, :2], rows[:, 2].copy().view(np.uint64), rows[:, 3], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        kept: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            pairs = roots(np.concatenate(kept))
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for batch in batches:
            now = np.stack([c.to_numpy() for c in (batch.column("t").cast(pa.int64()), *map(batch.column, ("key", "fp", "node")))], axis=1)
            held = now if held is None else np.concatenate([held, now])
            last = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:  # the last run may go on in the next batch
                kept.append(of(held[:cut]))
                held = held[cut:]
                if sum(map(len, kept)) > HELD_LINKS:
                    yield told()
        if held is not None and len(held):
            kept.append(of(held))
        if kept:
            yield told()

    return keyed.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """For each node of the edges (u, v) that isn't its component's least: u, and the least as v.

    Stars are grown and merged in turn until nothing changes: the neighbours of a node are hung on their least, first
    those above it, then those below. Each round's edges are no more than the last's, and are cut from their lineage.
    """

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    now = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = mark(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.when(F.col("v") > F.col("u"), 1)).alias("n"))
        least = checkpoint(least.where("n > 0").select("u", F.least("u", "m").alias("m"), "n"))
        large = checkpoint(join_counted(both.where("v > u"), least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = checkpoint(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = join_counted(large, low, "u", "n").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = checkpoint(small.where("u <> v").distinct())
        after = mark(now)
        if after == before:
            break
        before = after
    return now


def grouped(made: DataFrame, radius: int) -> DataFrame:
    """Of each fingerprint of rows that are cut from their lineage: fp, n (its rows) and root, the least of its component."""
    nodes = checkpoint(made.groupBy("fp").agg(F.count("*").alias("n")))
    found = components(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    return nodes.join(found, nodes["fp"] == found["u"], "left").select("fp", "n", F.coalesce("v", "fp").alias("root"))


def least_of_group(made: DataFrame, value: Column, radius: int) -> DataFrame:
    """(fp, n, least): the least value among the rows of each fingerprint's component."""
    own = made.groupBy("fp").agg(F.min(value).alias("own"))
    member = checkpoint(grouped(made, radius).join(own, "fp"))
    of_root = checkpoint(member.groupBy("root").agg(F.min("own").alias("least"), F.count("*").alias("size")))
    return join_counted(member.drop("own"), of_root, "root", "size").select("fp", "n", "least")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", *, radius: int = RADIUS) -> DataFrame:
    """Of each document: id, fingerprint in hexadecimal, and the least id of its component."""
    made = checkpoint(fingerprints(docs, key, text=text))
    names = checkpoint(least_of_group(made, F.col(key), radius).withColumnRenamed("least", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return join_counted(made, names, "fp", "n").select(key, hexed, "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", *, radius: int = RADIUS, keep_unnamed: bool = True) -> DataFrame:
    """The rows of docs, unchanged, of which each group of near-duplicates keeps one.

    It is the row with the least id. Among rows of that id in the group the text with the least MD5 stays, and of rows
    equal in id and text the one whose columns' hash is the least. Rows without an id all stay with ``keep_unnamed``;
    otherwise one stays where its group has no row with an id, and else none.
    """
    mark, nth = fresh(docs, "row_mark", "nth")
    marked = F.concat(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.when(F.col(key).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(key).cast("string"))))
    made = checkpoint(fingerprints(docs.select(key, text, marked.alias(mark)), key, mark, text=text))
    first = F.struct(F.col(key).isNull().alias("without"), F.col(key).alias("id"), F.col(mark).alias("mark"))
    # a mark belongs to one text, and so to one group
    kept = least_of_group(made, first, radius).select(F.col("least.mark").alias(mark)).distinct()
    judged = docs.where(F.col(key).isNotNull()) if keep_unnamed else docs
    chosen = judged.withColumn(mark, marked).join(kept, mark, "left_semi")
    order = F.xxhash64(*[F.col(c).cast("string") for c in docs.columns])
    one = chosen.withColumn(nth, F.row_number().over(Window.partitionBy(mark).orderBy(order))).where(F.col(nth) == 1).select(docs.columns)
    return one.unionByName(docs.where(F.col(key).isNull())) if keep_unnamed else one

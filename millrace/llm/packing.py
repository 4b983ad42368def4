"""Packing of tokenised documents into sequences of fixed size by minimum bin slack.

A document is its token ids and an end id; one longer than a sequence is cut into whole sequences from its end, so that
only its first piece may be shorter. For a bin, a bitset subset-sum over the lengths still there finds the fullest
combination with the longest of them; it is taken as often as the counts allow, and what it used is removed. Plans with
some slack allowed are made as well, the best stays, and its emptiest sequences are packed anew while that saves one.

Only lengths matter to the plan, so it is made from a histogram of at most ``capacity`` counts however many documents
there are. The pieces stay on the executors: each has a rank among the pieces of its length (its place within its
partition plus what earlier partitions hold), and the plan says which sequence and offset that rank gets.

Defined cases: a null text counts as empty and is the end id alone; documents with equal texts or equal ids are packed
as documents of their own; an empty table gives no rows; null ids are kept as they are; other columns are not read; a
text that the library's regular expression gives up on (a million white-space characters in a row) is cut into pieces
by :mod:`millrace.llm.pretokens` and has the same ids.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, pairwise, product

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bpe import pieces_of, read_json
from millrace.llm.common import checkpoint


@lru_cache(maxsize=4)
def tokenizer(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file in JSON, with special tokens inside texts as themselves."""
    ranks, special = read_json(path)
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(tool: tiktoken.Encoding, text: str) -> list[int]:
    try:
        return tool.encode(text, allowed_special="all")
    except ValueError:  # the stack of the library's regular expression is bounded
        raw, special = np.frombuffer(text.encode(), np.uint8), tool.special_tokens_set
        text, starts, _ = pieces_of(raw, np.array([0, len(raw)]), tuple(special))
        out = []
        for a, b in pairwise(starts.tolist()):
            piece = text[a:b]
            out += [tool.encode_single_token(piece)] if piece in special else tool._encode_single_piece(piece)
        return out


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece, with its rank among the pieces of its length in its partition."""
    schema = T.StructType([docs.schema[key], T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "nth")), T.StructField("part", T.IntegerType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = tokenizer(path), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            made = []
            for row, value in enumerate(batch.column(text)):
                data = np.array(encode(tool, value.as_py() or ""), "<u4").tobytes() + end
                n = len(data) // 4
                start, stop, k = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    made.append((row, k, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]), seen[stop - start]))
                    seen[stop - start] += 1
                    start, stop, k = stop, stop + capacity, k + 1
            if made:
                rows, *rest = zip(*made, strict=True)
                columns = [pa.array(c, kind) for c, kind in zip(rest, (pa.int32(), *[pa.int64()] * 4), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows)), *columns, pa.array([part] * len(rows), pa.int32())], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def even(counts: dict[int, int], room: int, slack: int = 0) -> list[int]:
    """Lengths (with repeats, at most their counts) whose sum is within ``slack`` of the greatest up to ``room``; of the
    combinations that the longest lengths suffice for, the fullest one, whose shortest length is as long as can be."""
    usable = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    within, reach, steps = (1 << (room + 1)) - 1, 1, []
    enough = max(0, room - slack)
    for n in usable:
        left, take = min(counts[n], room // n), 1
        while left and not reach >> enough:
            k = min(take, left)
            steps.append((n, k, reach))
            reach |= reach << (n * k) & within
            left, take = left - k, take * 2
        if reach >> enough:
            break
    total, out = reach.bit_length() - 1, []
    for n, k, before in reversed(steps):
        if not before >> total & 1:
            out += [n] * k
            total -= n * k
    return sorted(out, reverse=True)


def steep(counts: dict[int, int], room: int, slack: int = 0) -> list[int]:
    """As :func:`even`, but of all combinations within ``slack`` the one with the most of the longest, then of the next."""
    usable = sorted(n for n, c in counts.items() if c and n <= room)
    within, reach = (1 << (room + 1)) - 1, [1]  # sums of the first lengths, a bit for each
    for n in usable:
        sums, left, take = reach[-1], min(counts[n], room // n), 1
        while left:
            k = min(take, left)
            sums |= sums << (n * k) & within
            left, take = left - k, take * 2
        reach.append(sums)
    most = room
    least = max(0, reach[-1].bit_length() - 1 - slack)
    out: list[int] = []
    for i in range(len(usable) - 1, -1, -1):
        n = usable[i]
        for k in range(min(counts[n], most // n), -1, -1):
            a, b = max(least - k * n, 0), most - k * n
            if reach[i] >> a & ((1 << (b - a + 1)) - 1):
                out += [n] * k
                least, most = a, b
                break
    return out


#: How far a bin may stay below the fullest combination, if that takes longer pieces: each is tried, the best plan stays.
SLACKS = (0, 1, 2, 4, 8, 16, 32, 64, 128, 1 << 20)
Plan = list[tuple[tuple[int, ...], int]]


def sequences(planned: Plan) -> int:
    return sum(times for _, times in planned)


def fill_bins(histogram: dict[int, int], capacity: int, slack: int = 0, choose=even) -> Plan:
    """Combinations of lengths, longest first, and how many sequences get each; together they use up the histogram."""
    counts = {n: c for n, c in histogram.items() if c}
    out = []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        combination = (seed, *choose(counts, capacity - seed, slack))
        counts[seed] += 1
        used = Counter(combination)
        times = min(counts[n] // k for n, k in used.items())
        out.append((combination, times))
        for n, k in used.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return out


def lengths_of(planned: Plan) -> Counter[int]:
    out: Counter[int] = Counter()
    for combination, times in planned:
        for n in combination:
            out[n] += times
    return out


def best_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """The plan of the fewest sequences over all slacks and both ways to choose."""
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best: Plan | None = None
    for slack, choose in product(SLACKS, (even, steep)):
        tried = fill_bins(histogram, capacity, slack, choose)
        if best is None or sequences(tried) < sequences(best):
            best = tried
        if sequences(best) == least:
            break
    return best or []


def worst(planned: Plan, n: int) -> tuple[Plan, Plan]:
    """The n emptiest sequences, and the others."""
    taken, rest = [], []
    for combination, times in sorted(planned, key=lambda x: sum(x[0])):
        k = min(times, n)
        n -= k
        if k:
            taken.append((combination, k))
        if times > k:
            rest.append((combination, times - k))
    return taken, rest


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan, whose emptiest sequences are packed anew, more and more of them, as long as that saves one."""
    best = best_plan(histogram, capacity)
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    n = 8
    while sequences(best) > least and n < 2 * sequences(best):
        taken, rest = worst(best, n)
        again = best_plan(lengths_of(taken), capacity)
        if sequences(again) < sequences(taken):
            best = rest + again
        else:
            n *= 2
    return best


class Places:
    """Sequence and offset of the piece that is the r-th of its length."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]):
        rows = defaultdict(list)
        first = 0
        for combination, times in planned:
            begin = dict(zip(reversed(combination), reversed(list(accumulate(combination, initial=0))[:-1]), strict=True))
            for n, k in Counter(combination).items():
                rows[n].append((k * times, k, first, begin[n]))
            first += times
        self.by_length = {}
        for n, found in rows.items():
            slots, *rest = (np.array(c, np.int64) for c in zip(*found, strict=True))
            self.by_length[n] = (np.cumsum(slots), np.cumsum(slots) - slots, *rest)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for n in np.unique(length).tolist():
            rows = np.flatnonzero(length == n)
            until, since, k, first, begin = self.by_length[n]
            i = np.searchsorted(until, rank[rows], "right")
            turn, within = np.divmod(rank[rows] - since[i], k[i])
            sequence[rows] = first[i] + turn
            offset[rows] = begin[i] + within * n
        return sequence, offset


def pack(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece with the sequence it is in and its place there."""
    made = checkpoint(pieces(docs, path, capacity, end_id, key, text))
    held = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = made.join(base, ["length", "part"]).select(key, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema)

"""An n-gram language model in a compact trie, built and queried on the executors.

A word is a 64-bit hash, and its id is the hash's rank among all. An entry of level n is a context, the id of the n-gram
of level n - 1 before it, and a word; its own id is its rank in the level. A level is a number of files of bounded size.
In a file contexts are an Elias-Fano sequence of ids, pointers to their successors one of places, and the successors one
of (place of the context, word), so that a search looks only between two pointers; each entry has its discounted
probability, and each context its weight for the shorter context, in 16 bits. The files are memory-mapped in the shared
folder (or read whole from a store that can't be mapped), and a batch of texts asks each file for its distinct
entries at once.

P(w | h) = max(c(h w) - d, 0) / c(h) + d T(h) / c(h) * P(w | shorter h), T(h) the number of different successors, with
additive smoothing for words alone. A context that occurs more often than a file should hold is spread over files by its
words; their T are summed up by Spark, and one row for each (at most the tokens over ``spread_from``) goes to the driver.

Defined cases: a null or empty text is its end token alone; repeated texts count as often as they occur; texts without an
id are scored but not learned; without training texts every word has the same probability 0.1 / (0.1 * 1).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import checkpoint, ensure_checkpoint_dir, file_system, passes, utf8
from millrace.llm.elias_fano import EliasFano, from_bytes, from_file, pack, to_bytes, unpack
from millrace.llm.repetition import mix

#: Length of the longest n-gram, and what is taken off each count.
ORDER, DISCOUNT = 3, 0.75
#: Additive smoothing of words alone.
ADDED = 0.1
#: Tokens of training text for each file of a level, and from which count on a context is spread over files.
FILE_TOKENS, SPREAD = 2_000_000, 200_000
#: Bytes of text in a pass, and entries that a task counts before it hands them on.
PASS, HELD = 4 << 20, 2_000_000
#: Steps of a quantised log10 probability; 16 bits of them reach down to 10^-16.
STEPS = 4000
#: Files that a worker keeps mapped: each pass goes through them in order, and mapping anew is cheap.
OPEN_FILES = 4
#: Bytes of a word above which it is hashed by itself.
LONG_WORD = 256

EMPTY = np.zeros(0, np.int64)

#: Stand-ins of a text's end among the hashes, and the hashes' seed.
END_HASH, SEED = 0x9B1D_5A3C_77E4_0F21, 1


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEPS), 0, 65535).astype(np.uint16)


#: Probability of each quantised value.
LEVELS = 10.0 ** (-np.arange(65536) / STEPS)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays, byte planes apart and compressed."""
    out = [np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes(), "".join(f"{a.dtype.str:>4}" for a in arrays).encode()]
    out += [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join(out), 1)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", n, 8)
    at = 8 * (n + 1)
    kinds = [np.dtype(raw[at + 4 * i : at + 4 * i + 4].decode().strip()) for i in range(n)]
    at, out = at + 4 * n, []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        plane = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += size * kind.itemsize
    return out


def short(numbers: np.ndarray) -> np.ndarray:
    """The numbers in 32 bits if they fit."""
    return numbers.astype(np.uint32) if int(numbers.max(initial=0)) < 1 << 32 else numbers


def steps_of(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=np.zeros(1, sorted_values.dtype))


def word_hashes(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the bytes, eight bytes of all words at a time; long words one by one."""
    words = np.ndarray((len(low) + 1,), "<u8", np.concatenate([low, np.zeros(8, np.uint8)]), 0, (1,))
    out = mix(sizes + SEED)
    left = np.flatnonzero(sizes <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        if not len(left):
            break
        rest = sizes[left] - k
        part = words[starts[left] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - rest, 0)).astype(np.uint64))
        out[left] = mix(out[left] ^ part)
        left = left[rest > 8]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(low[starts[i] : starts[i] + sizes[i]].tobytes(), SEED)
    return out


class Tokens:
    """A pass of texts: their distinct words' hashes, and the tokens with each text's end as indices of these."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        low = np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint8(0x20), raw)
        within = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
        begins = within.copy()
        begins[1:] &= ~within[:-1]
        heads = at[:-1][at[:-1] < at[1:]]
        begins[heads] = within[heads]
        stops = within.copy()
        stops[:-1] &= ~within[1:]
        stops[heads[1:] - 1] = within[heads[1:] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        codes, distinct = pd.factorize(word_hashes(low, starts, ends - starts))
        upto = np.searchsorted(starts, at)
        self.hashes = np.concatenate([np.array([END_HASH], np.uint64), distinct.astype(np.uint64)])
        self.index = np.zeros(len(starts) + n, np.int64)
        self.index[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(upto))] = codes + 1
        self.ends = upto[1:] + np.arange(1, n + 1)
        self.begins = np.concatenate([[0], self.ends[:-1]]) if n else self.ends


def write_file(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write under another name first, so that a task that is run again or dies half-way leaves no broken file."""
    where, path = file_system(uri)
    draft = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(draft) as f:
        for part in to_bytes(arrays):
            f.write(part)
    where.move(draft, path)


@lru_cache(maxsize=OPEN_FILES)
def read_file(uri: str) -> dict[str, np.ndarray]:
    where, path = file_system(uri)
    if isinstance(where, arrow_fs.LocalFileSystem):
        return from_file(path)
    with where.open_input_file(path) as f:
        return from_bytes(f.read())


@dataclass
class Step:
    """A level's distinct entries for a pass: which tokens ask, for which of the entries; the entries' context, word and
    the context's count; and what the level knows of them."""

    asked: np.ndarray | None = None
    inverse: np.ndarray | None = None
    context: np.ndarray | None = None
    word: np.ndarray | None = None
    seen: np.ndarray | None = None
    id: np.ndarray | None = None
    count: np.ndarray | None = None
    p: np.ndarray | None = None
    rest: np.ndarray | None = None


@dataclass
class Model:
    """Where the levels are, and what is common to their files."""

    folder: str
    files: int
    spread_from: int = SPREAD
    tokens: int = 0
    texts: int = 0
    #: for each level, the first id of each file (and the end)
    base: list[np.ndarray] = field(default_factory=list)
    #: for each level from the second, contexts that are spread over files, sorted, with their weights for the shorter context
    spread: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @property
    def words(self) -> int:
        return int(self.base[0][-1]) if self.base else 0

    def uri(self, level: int, file: int) -> str:
        return f"{self.folder}/level{level}-{file}.ef"

    def word_file(self, hashes: np.ndarray) -> np.ndarray:
        return (mix(hashes) % np.uint64(self.files)).astype(np.int64)

    def entry_file(self, context: np.ndarray, word: np.ndarray, often: np.ndarray) -> np.ndarray:
        """File of (context, word); often: the context's count."""
        return (mix(context + np.where(often > self.spread_from, mix(word) % np.uint64(self.files), 0).astype(np.uint64)) % np.uint64(self.files)).astype(np.int64)

    def find_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for file, rows in by_file(self.word_file(hashes)):
            if self.base[0][file] == self.base[0][file + 1]:
                continue
            arrays = read_file(self.uri(1, file))
            rank = EliasFano(arrays, "hash").find(hashes[rows])
            hit = rank >= 0
            ids[rows[hit]] = self.base[0][file] + rank[hit]
            counts[rows[hit]] = unpack(arrays["count"], int(arrays["width"][0]), rank[hit])
        return ids, counts

    def find_entries(self, level: int, context: np.ndarray, word: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of entries of a level, sorted by context: id (-1: unknown), count (0 in the last level), discounted probability, and the weight of
        the shorter context (1 where the context is unknown)."""
        n = len(context)
        ids, counts, p, rest = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n), np.ones(n)
        base = self.base[level - 1]
        for file, rows in by_file(self.entry_file(context, word, often)):
            if base[file] == base[file + 1]:
                continue
            arrays = read_file(self.uri(level, file))
            asked = context[rows]
            fresh = np.diff(asked, prepend=-1) > 0
            place = EliasFano(arrays, "context").find(asked[fresh])[np.cumsum(fresh) - 1]
            rows, place = rows[place >= 0], place[place >= 0]
            rest[rows] = LEVELS[arrays["rest"][place]]
            since, until = EliasFano(arrays, "pointer").pair(place)
            asked = place * int(arrays["universe"][0]) + word[rows]
            rank = EliasFano(arrays, "successor").find(asked, since.astype(np.int64), until.astype(np.int64))
            hit = rank >= 0
            rows, rank = rows[hit], rank[hit]
            ids[rows] = base[file] + rank
            p[rows] = LEVELS[arrays["p"][rank]]
            if "count" in arrays:
                counts[rows] = unpack(arrays["count"], int(arrays["width"][0]), rank)
        contexts, weights = self.spread[level - 2]
        if len(contexts):
            i = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            hot = contexts[i] == context
            rest[hot] = weights[i[hot]]
        return ids, counts, p, rest

    @property
    def universe(self) -> int:
        """Ids that stand at a word's place: the words', a text's beginning, and one for unknown words."""
        return self.words + 2

    def walk(self, t: Tokens, upto: int) -> Iterator[Step]:
        """Level by level, what each token is asked for and what is known of it; a level not yet built knows nothing."""
        ids, counts = self.find_words(t.hashes)
        now, often = ids[t.index], counts[t.index]
        word = np.where(now < 0, self.words + 1, now)
        yield Step(count=often)
        first = np.zeros(len(word), bool)
        first[t.begins] = True
        for level in range(2, upto + 1):
            context, seen = np.full(len(word), -1, np.int64), np.zeros(len(word), np.int64)
            context[1:], seen[1:] = now[:-1], often[:-1]
            # before a text's first token stands its beginning, and nothing before that
            context[first], seen[first] = (self.words, self.texts) if level == 2 else (-1, 0)
            asked = np.flatnonzero(context >= 0)
            place = context[asked]
            if int(place.max(initial=0)) + 1 > (1 << 62) // self.universe:
                _, place = np.unique(place, return_inverse=True)
            distinct, inverse = np.unique(place * self.universe + word[asked], return_inverse=True)
            at = np.empty(len(distinct), np.int64)
            at[inverse] = asked  # any of the tokens that ask for the entry
            step = Step(asked, inverse, context[at], word[at], seen[at])
            now, often = np.full(len(word), -1, np.int64), np.zeros(len(word), np.int64)
            if level <= len(self.base):
                step.id, step.count, step.p, step.rest = self.find_entries(level, step.context, step.word, step.seen)
                now[asked], often[asked] = step.id[inverse], step.count[inverse]
            yield step

    def score(self, t: Tokens) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, log10 probability by words alone and by the whole model."""
        levels = self.walk(t, len(self.base))
        count = next(levels).count
        p = (count + ADDED) / (self.tokens + ADDED * (self.words + 1))
        base = np.log10(p)
        for step in levels:
            p[step.asked] = step.p[step.inverse] + step.rest[step.inverse] * p[step.asked]
        total = lambda x: np.add.reduceat(x, t.begins) if len(t.ends) else x[:0]
        return t.ends - t.begins, total((count > 0).astype(np.int64)), total(base), total(np.log10(p))


def by_file(files: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each file with its rows."""
    order = np.argsort(files.astype(np.uint16) if files.max(initial=0) < 1 << 16 else files, kind="stable")  # short numbers are sorted by radix
    edges = np.flatnonzero(np.diff(files[order], prepend=-1, append=-1) if len(order) else np.zeros(0))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(files[order[a]]), order[a:b]


def summed(keys: tuple[np.ndarray, ...], counts: np.ndarray, universe: int = 0) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct keys (columns, the first leading) in order, and the sums of their counts.

    With a universe the keys are context, word below the universe, and what follows from the context; then one number
    stands for the key if it fits. What comes in ordered runs is only merged.
    """
    if not len(counts):
        return keys, counts
    if universe and int(keys[0].max()) < (1 << 62) // universe:
        lead = (keys[0] * universe + keys[1].astype(np.int64),)
    else:
        lead = keys
    order = np.lexsort(lead[::-1]) if len(lead) > 1 else np.argsort(lead[0], kind="stable")
    lead = tuple(k[order] for k in lead)
    at = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in lead], axis=0)]))
    return tuple(k[order[at]] for k in keys), np.add.reduceat(counts[order].astype(np.int64), at)


def gather(texts: DataFrame, text: str, count, tell, universe: int = 0) -> DataFrame:
    """Rows (file, data): what ``count`` finds in passes of texts, summed up in each task and told file by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                keys = tuple(map(np.concatenate, zip(*(k for k, _ in held), strict=True)))
                told = list(tell(*summed(keys, np.concatenate([c for _, c in held]), universe)))
                held.clear()
                for a in range(0, len(told), 64):
                    files, data = zip(*told[a : a + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(data, pa.binary())], names=["file", "data"])

        for batch in batches:
            raw, at = utf8(batch.column(text))
            for a, b in passes(at, PASS):
                if sum(len(c) for _, c in held) > HELD:
                    yield from flush()
                held.append(count(Tokens(raw[at[a] : at[b]], at[a : b + 1] - at[a])))
        yield from flush()

    return texts.select(text).mapInArrow(run, "file long, data binary")


def build(rows: DataFrame, files: int, make) -> DataFrame:
    """One file of the level for each ``file``, in as many tasks. What ``make`` tells of them: a row (file, n, tokens) for each, and rows
    (context, kinds, seen) of contexts that are spread over files."""

    def run(table: pa.Table) -> pa.Table:
        return make(table.column("file")[0].as_py(), [unsqueeze(d.as_py()) for d in table.column("data")])

    return checkpoint(rows.repartition(files, "file").groupBy("file").applyInArrow(run, "file long, n long, tokens long, context long, kinds long, seen long"))


def told(file: int, n: int, tokens: int, context: np.ndarray = EMPTY, kinds: np.ndarray = EMPTY, seen: np.ndarray = EMPTY) -> pa.Table:
    one, rest = [None] * len(context), [None]
    columns = {"file": [file, *one], "n": [n, *one], "tokens": [tokens, *one], "context": rest + context.tolist(), "kinds": rest + kinds.tolist(), "seen": rest + seen.tolist()}
    return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def build_words(model: Model, texts: DataFrame, text: str) -> None:
    def count(t: Tokens):
        return (t.hashes,), short(np.bincount(t.index, minlength=len(t.hashes)))

    def tell(keys, counts):
        for file, rows in by_file(model.word_file(keys[0])):
            yield file, squeeze(steps_of(keys[0][rows]), counts[rows])

    def make(file: int, parts: list) -> pa.Table:
        (hashes,), counts = summed((np.concatenate([np.cumsum(h, dtype=np.uint64) for h, _ in parts]),), np.concatenate([c for _, c in parts]).astype(np.int64))
        hashes, counts = hashes[counts > 0], counts[counts > 0]
        width = int(counts.max(initial=0)).bit_length()
        write_file(model.uri(1, file), EliasFano.build(hashes, "hash") | {"count": pack(counts, width), "width": np.array([width])})
        return told(file, len(hashes), int(counts.sum()))

    found = build(gather(texts, text, count, tell), model.files, make)
    model.tokens = found.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    model.base.append(bases(found, model.files))


def bases(found: DataFrame, files: int) -> np.ndarray:
    sizes = np.zeros(files, np.int64)
    for r in found.where(F.col("file").isNotNull()).select("file", "n").collect():
        sizes[r["file"]] = r["n"]
    return np.concatenate([[0], np.cumsum(sizes)])


def build_level(model: Model, level: int, texts: DataFrame, text: str, keep_counts: bool) -> None:
    def count(t: Tokens):
        *_, step = model.walk(t, level)
        return (step.context, short(step.word), short(step.seen)), short(np.bincount(step.inverse, minlength=len(step.context)))

    def tell(keys, counts):
        context, word, seen = keys
        for file, rows in by_file(model.entry_file(context, word, seen)):
            c = context[rows]
            starts = np.flatnonzero(np.diff(c, prepend=-1))
            yield file, squeeze(steps_of(c[starts]), np.diff(np.append(starts, len(c))).astype(np.uint32), seen[rows[starts]], word[rows], counts[rows])

    def make(file: int, parts: list) -> pa.Table:
        columns = []
        for c, runs, seen, word, counts in parts:
            columns.append((np.repeat(np.cumsum(c), runs), word, np.repeat(seen, runs), counts.astype(np.int64)))
        *keys, counts = map(np.concatenate, zip(*columns, strict=True))
        (context, word, seen), counts = summed(tuple(keys), counts, model.universe)
        starts = np.flatnonzero(np.diff(context, prepend=-1))
        runs = np.diff(np.append(starts, len(context)))
        often, word = seen[starts].astype(np.int64), word.astype(np.int64)
        arrays = EliasFano.build(context[starts], "context") | EliasFano.build(np.append(starts, len(context)), "pointer")
        arrays |= EliasFano.build(np.repeat(np.arange(len(starts)), runs) * model.universe + word, "successor")
        arrays |= {"p": quantise((counts - DISCOUNT) / seen), "rest": quantise(DISCOUNT * runs / often), "universe": np.array([model.universe])}
        if keep_counts:
            width = int(counts.max(initial=0)).bit_length()
            arrays |= {"count": pack(counts, width), "width": np.array([width])}
        write_file(model.uri(level, file), arrays)
        hot = often > model.spread_from
        return told(file, len(context), 0, context[starts][hot], runs[hot], often[hot])

    found = build(gather(texts, text, count, tell, model.universe), model.files, make)
    spread = found.where(F.col("context").isNotNull()).groupBy("context").agg(F.sum("kinds").alias("kinds"), F.max("seen").alias("seen")).orderBy("context").collect()
    contexts, kinds, seen = (np.array([r[k] for r in spread], np.int64) for k in ("context", "kinds", "seen"))
    model.spread.append((contexts, DISCOUNT * kinds / seen))
    model.base.append(bases(found, model.files))


def fit(texts: DataFrame, text: str = "text", *, order: int = ORDER, file_tokens: int = FILE_TOKENS, spread_from: int = SPREAD) -> Model:
    """Learn from all rows of texts; the levels are files in the shared folder."""
    folder = f"{ensure_checkpoint_dir(texts.sparkSession).rstrip('/')}/ngram-{uuid.uuid4().hex}"
    where, path = file_system(folder)
    where.create_dir(path)
    facts = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    model = Model(folder, files=max(1, -(-((facts["bytes"] or 0) // 6 + facts["n"]) // file_tokens)), spread_from=spread_from, texts=facts["n"])
    build_words(model, texts, text)
    for level in range(2, order + 1):
        build_level(model, level, texts, text, keep_counts=level < order)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Of each text: n_tokens, n_known, base_score and score."""
    names = ("n_tokens", "n_known", "base_score", "score")
    schema = T.StructType([*(docs.schema[k] for k in keep), *(T.StructField(n, T.LongType() if n.startswith("n_") else T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8(batch.column(text))
            for a, b in passes(at, PASS):
                got = model.score(Tokens(raw[at[a] : at[b]], at[a : b + 1] - at[a]))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in keep), *map(pa.array, got)], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)

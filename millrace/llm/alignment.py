"""Alignment of two tokenizers over a corpus.

A text is encoded by a byte-level BPE (A) and by a piece model (B). Where tokens of both end at the same byte, the text is
cut into groups, and all tokens of A and B in a group are linked. Linked pairs of ids are kept as an inverted index: a
task numbers its documents in blocks, and for each pair and block writes a compressed bitmap of the documents that hold
the pair, and of the number of its links less one a bitmap for each binary digit (multiplicity planes). Bitmaps of a pair
are disjoint parts of one by their blocks, and parts of one block are OR-merged; the sum of their populations is the
pair's number of documents, and links are the populations weighed by the planes' powers of two. The index then returns
to its blocks with the scores of its pairs, and every posting adds its pair's score to the documents it names.

A pair's bitmaps never meet in one place: only their populations are summed, by partial sums, and the scores of pairs
with very many postings are broadcast (join_counted).

Defined cases: texts that are null or empty, or whose tokens' bytes joined differ from a space and the text, have no
tokens and zeros; bytes that aren't UTF-8 are read as U+FFFD; special tokens inside a text are plain text; equal texts,
and rows that repeat an id, are documents of their own, and null ids are kept; a group of any size is linked whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bpe import pieces_of, read_json
from millrace.llm.common import PASS_BYTES, checkpoint, decoded, ensure_checkpoint_dir, join_counted

#: Documents of a block, and pairs of (pair, document) that a task gathers before it ends a block.
BLOCK_DOCS, HELD = 1 << 16, 1 << 21
#: A bitmap of up to so many documents is a list of 16-bit numbers; a longer one is a bit for each document of a block.
LISTED, BITS = 4095, BLOCK_DOCS // 8
#: Pairs made at once from the groups of a pass.
PAIRS = 1 << 22
#: Rows handed on at once.
ROWS = 1 << 15
#: The plane that stands for the documents themselves.
DOCUMENTS = -1


class Vocabulary:
    """Both tokenizers, the bytes of their tokens, and their ids as text with what may follow them."""

    def __init__(self, path_a: str, path_b: str):
        ranks, special = read_json(path_a)
        self.a = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_a, self.n_b = max([*ranks.values(), *special.values()]) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.n_b)]
        self.length_a, self.length_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))
        #: a token and what follows it: of A `,` or `|`, of B `,` or `;`
        self.told = [b"%d%s" % (i, end) for n, ends in ((self.n_a, (b",", b"|")), (self.n_b, (b",", b";"))) for end in ends for i in range(n)]

    def encode_a(self, text: str) -> list[int]:
        try:
            return self.a.encode_ordinary(text)
        except ValueError:  # the stack of the library's regular expression is bounded
            raw = np.frombuffer(text.encode(), np.uint8)
            text, starts, _ = pieces_of(raw, np.array([0, len(raw)]))
            out = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                out += self.a._encode_single_piece(text[a:b])
            return out

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both, or none."""
        if not text:
            return [], []
        whole = " " + text
        want = whole.encode()
        b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return [], []
        a = self.encode_a(whole)
        return (a, b) if b"".join(map(self.bytes_a.__getitem__, a)) == want else ([], [])


@lru_cache(maxsize=2)
def vocabulary(path_a: str, path_b: str) -> Vocabulary:
    return Vocabulary(path_a, path_b)


class Groups:
    """Groups of the tokens of several texts, one text after the other."""

    def __init__(self, tools: Vocabulary, found: list[tuple[list[int], list[int]]]):
        self.tools = tools
        self.n_a, self.n_b = (np.array([len(f[k]) for f in found], np.int64) for k in (0, 1))
        self.a, self.b = (np.fromiter((i for f in found for i in f[k]), np.int64, int(n.sum())) for k, n in ((0, self.n_a), (1, self.n_b)))
        ends_a, ends_b = np.cumsum(tools.length_a[self.a]), np.cumsum(tools.length_b[self.b])
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.int8)
        mark[ends_a] = 1
        mark[ends_b] += 1
        self.last_a, self.last_b = mark[ends_a] == 2, mark[ends_b] == 2
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        groups = int(self.last_a.sum())
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.doc_of = np.repeat(np.arange(len(found)), self.n_a)[self.last_a]
        self.n_groups = np.bincount(self.doc_of, minlength=len(found))
        self.n_links = np.zeros(len(found), np.int64)
        np.add.at(self.n_links, self.doc_of, self.in_a * self.in_b)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, `a1,a2|b1;a3|b2,b3`; nothing for a text without tokens."""
        n_a, n_b = self.tools.n_a, self.tools.n_b
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + (np.cumsum(self.in_b) - self.in_b)[self.group_a]] = self.a + n_a * self.last_a
        code[np.arange(len(self.b)) + np.cumsum(self.in_a)[self.group_b]] = 2 * n_a + self.b + n_b * self.last_b
        at, told, out = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist(), self.tools.told.__getitem__, []
        for a, b in zip(at[:-1], at[1:], strict=True):
            out.append(hashlib.sha256(b"".join(map(told, code[a:b].tolist()))[:-1]).hexdigest() if b > a else "")
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pair, text, links) for the linked pairs of ids, the pair as a * n_b + b; a text's pair may come several times."""

        def once(group: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key, times = np.unique(group * n + ids, return_counts=True)
            return key // n, key % n, times

        group_a, a, times_a = once(self.group_a, self.a, self.tools.n_a)
        group_b, b, times_b = once(self.group_b, self.b, self.tools.n_b)
        many = np.bincount(group_b, minlength=len(self.in_b))
        first = np.cumsum(many) - many
        made = np.cumsum(many[group_a]) if len(group_a) else np.zeros(0, np.int64)
        begin = 0
        while begin < len(a):
            end = max(begin + 1, int(np.searchsorted(made, (made[begin - 1] if begin else 0) + PAIRS, "right")))
            group = group_a[begin:end]
            of = np.repeat(np.arange(begin, end), many[group])
            within = np.arange(len(of)) - np.repeat(np.cumsum(many[group]) - many[group], many[group])
            other = first[group_a[of]] + within
            yield a[of] * self.tools.n_b + b[other], self.doc_of[group_a[of]], times_a[of] * times_b[other]
            begin = end


def bitmaps(start: np.ndarray, members: np.ndarray) -> pa.Array:
    """Compressed bitmaps of runs of sorted 16-bit numbers; start: where runs begin, and the end."""
    sizes = np.diff(start)
    if (sizes <= LISTED).all():
        data = np.ascontiguousarray(members, "<u2")
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((2 * start).astype(np.int32)), pa.py_buffer(data)])
    out = []
    for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
        if b - a <= LISTED:
            out.append(members[a:b].astype("<u2").tobytes())
        else:
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[members[a:b]] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
    return pa.array(out, pa.binary())


def members_of(bitmap: bytes) -> np.ndarray:
    if len(bitmap) == BITS:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
    return np.frombuffer(bitmap, "<u2").astype(np.int64)


class Block:
    """The inverted index of a block's documents, as it grows."""

    def __init__(self, number: int):
        self.number, self.docs, self.parts, self.held = number, 0, [], 0

    def add(self, pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> None:
        """doc: numbers of documents within the block."""
        self.parts.append(merged(pair * BLOCK_DOCS + doc, links))
        self.held += len(self.parts[-1][0])

    def postings(self) -> Iterator[pa.RecordBatch]:
        """(pair, block, plane, bitmap, n): parts are merged, so that a pair's bitmap is the union of theirs."""
        if not self.parts:
            return
        key, links = merged(*map(np.concatenate, zip(*self.parts, strict=True)))
        yield from self._rows(DOCUMENTS, key)
        plane, more = 0, links - 1
        while more.any():
            yield from self._rows(plane, key[more & 1 == 1])
            key, more, plane = key[more > 1], more[more > 1] >> 1, plane + 1

    def _rows(self, plane: int, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        pair, member = np.divmod(key, BLOCK_DOCS)
        start = np.append(np.flatnonzero(np.diff(pair, prepend=-1)), len(pair))
        for a in range(0, len(start) - 1, ROWS):
            some = start[a : a + ROWS + 1]
            n = len(some) - 1
            columns = [pa.array(pair[some[:-1]]), pa.array(np.full(n, self.number)), pa.array(np.full(n, plane, np.int32)), bitmaps(some - some[0], member[some[0] : some[-1]]), pa.array(np.diff(some))]
            yield pa.RecordBatch.from_arrays(columns, names=["pair", "block", "plane", "bitmap", "n"])


def merged(key: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its links."""
    order = np.argsort(key, kind="stable")
    key, links = key[order], links[order]
    first = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(links, first) if len(first) else links[:0]


POSTINGS = "pair long, block long, plane int, bitmap binary, n long"


def index(docs: DataFrame, path_a: str, path_b: str, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The postings, and of each document its block, its number there and what its groups say; both from one pass.

    Blocks are numbered by partition, so they are written once in the shared folder and only read from then on.
    """
    facts = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("doc", docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")), T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([*T.StructType.fromDDL(POSTINGS).fields, *facts.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = vocabulary(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        block, kinds = Block(number), None

        def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
            have = dict(zip(batch.schema.names, batch.columns, strict=True))
            return pa.RecordBatch.from_arrays([have[n] if n in have else pa.nulls(batch.num_rows, kinds[n]) for n in schema.names], names=schema.names)

        for batch in batches:
            kinds = kinds or dict(zip(schema.names, [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), batch.column(key).type, *[pa.int64()] * 3, pa.string()], strict=True))
            texts = decoded(batch.column(text))
            for a, b in runs(texts):
                if block.docs + b - a > BLOCK_DOCS or block.held > HELD:
                    yield from map(filled, block.postings())
                    block = Block(block.number + 1)
                groups = Groups(tools, [*map(tools.encode, texts[a:b])])
                for pair, doc, links in groups.pairs():
                    block.add(pair, doc + block.docs, links)
                told = [np.full(b - a, block.number), np.arange(block.docs, block.docs + b - a, dtype=np.int32), groups.n_a, groups.n_b, groups.n_groups]
                yield filled(pa.RecordBatch.from_arrays([*map(pa.array, told), batch.column(key).slice(a, b - a), pa.array(groups.digests(), pa.string())], names=["block", "number", "n_a", "n_b", "n_groups", "doc", "groups_sha256"]))
                block.docs += b - a
        if kinds:
            yield from map(filled, block.postings())

    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    docs.select(key, text).mapInArrow(run, schema).write.parquet(folder)
    written = docs.sparkSession.read.schema(schema).parquet(folder)
    postings = written.where("pair IS NOT NULL").select("pair", "block", "plane", "bitmap", "n")
    return postings, written.where("number IS NOT NULL").select("block", *facts.names)


def runs(texts: list[str], size: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts [a, b) of at most ``size`` characters together and no more than a block's, or a single longer text."""
    a = many = 0
    for b, text in enumerate(texts):
        if b > a and (many + len(text) > size or b - a == BLOCK_DOCS):
            yield a, b
            a, many = b, 0
        many += len(text)
    if a < len(texts):
        yield a, len(texts)


def pair_counts(postings: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, b, documents, links, postings) of each pair of ids, from the populations of its bitmaps."""
    documents = F.when(F.col("plane") == DOCUMENTS, F.col("n"))
    links = F.when(F.col("plane") == DOCUMENTS, F.col("n")).otherwise(F.col("n") * F.expr("shiftleft(1L, plane)"))
    summed = postings.groupBy("pair").agg(F.sum(documents).alias("documents"), F.sum(links).alias("links"), F.count("*").alias("postings"))
    return summed.select("pair", F.expr(f"pair DIV {n_b}").cast("int").alias("a"), (F.col("pair") % n_b).cast("int").alias("b"), "documents", "links", "postings")


def scored(counts: DataFrame) -> DataFrame:
    """(pair, score, best, postings): a pair's documents, and whether no pair of its A id has more.

    The highest counts are broadcast: there is one for each token of A at most.
    """
    highest = counts.groupBy("a").agg(F.max("documents").alias("most"))
    best = (F.col("documents") == F.col("most")).cast("long")
    return counts.join(F.broadcast(highest), "a").select("pair", F.col("documents").alias("score"), best.alias("best"), "postings")


def returned(postings: DataFrame, facts: DataFrame, key: T.StructField) -> DataFrame:
    """Postings with scores back in their blocks: a row for each document with the sums over its links."""
    order = [F.lit(0).alias("kind"), "block", "plane", "bitmap", "score", "best"]
    names = [f for f in facts.schema.fields if f.name != "block"]
    lines = postings.select(*order, *[F.lit(None).cast(f.dataType).alias(f.name) for f in names])
    docs = facts.select(F.lit(1).alias("kind"), "block", *[F.lit(None).cast(t).alias(n) for n, t in (("plane", "int"), ("bitmap", "binary"), ("score", "long"), ("best", "long"))], *[f.name for f in names])
    made = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([key, *(T.StructField(n, T.LongType()) for n in made), T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, links, best, score = None, *np.zeros((3, 0), np.int64)
        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(block, prepend=block[0] - 1)), len(block)) if len(block) else np.zeros(0, np.int64)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if block[a] != now:
                    now, (links, best, score) = block[a], np.zeros((3, BLOCK_DOCS), np.int64)
                part = batch.slice(a, b - a)
                n = int((part.column("kind").to_numpy() == 0).sum())
                if n:
                    found = [members_of(x) for x in part.column("bitmap").slice(0, n).to_pylist()]
                    member, size = np.concatenate(found), [*map(len, found)]
                    times = np.int64(1) << np.maximum(part.column("plane").slice(0, n).to_numpy(), 0).astype(np.int64)
                    for total, worth in ((links, times), (best, times * part.column("best").slice(0, n).to_numpy()), (score, times * part.column("score").slice(0, n).to_numpy())):
                        np.add.at(total, member, np.repeat(worth, size))
                if n < b - a:
                    told = part.slice(n)
                    at = told.column("number").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [told.column("doc"), *map(told.column, made[:3]), pa.array(links[at]), pa.array(best[at]), pa.array(score[at]), told.column("groups_sha256")], names=schema.names
                    )

    return lines.unionByName(docs).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each document its tokens, groups and links, how many links are the best of their A id, and their counts' sum."""
    postings, facts = index(docs, path_a, path_b, key, text)
    scores = checkpoint(scored(pair_counts(postings, pieces(path_b))))
    return returned(join_counted(postings, scores, "pair", "postings"), facts, T.StructField(key, docs.schema[key].dataType))


def pairs(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, documents, links): how many documents of the corpus hold a pair of ids linked, and its links."""
    postings, _ = index(docs, path_a, path_b, key, text)
    return pair_counts(postings, pieces(path_b)).select("a", "b", "documents", "links")


def pieces(path_b: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()

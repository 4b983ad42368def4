"""Byte-level BPE: encoding and decoding with a public vocabulary of ranks.

Texts are cut into pieces by :mod:`millrace.llm.pretokens`; each piece is merged pair by pair, once for all its
occurrences (a bounded cache), and the places where pieces begin are kept, so that a token can be traced to its text.

Defined cases: a null text counts as empty and has no tokens; a piece of any length is merged in n log n steps;
repeated texts are encoded alike; an id that the vocabulary lacks raises KeyError when decoded; bytes that aren't
UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm import pretokens
from millrace.llm.common import passes, utf8, valid

#: Pieces whose result a worker keeps, and their characters at most; the cache is emptied when it is full.
CACHE_PIECES, CACHE_CHARS = 200_000, 128
#: Above every rank.
NO_RANK = 1 << 62
#: Longer pieces are merged with a heap.
SHORT_PIECE = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in vocabulary files: printable Latin-1 bytes stand for themselves, the others for
    code points from 256 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes to id, and special tokens to id, from a tokenizer file in JSON."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}, special


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece: the adjacent pair of least rank is joined, the leftmost of equals first, until none is left."""
    if piece in ranks or len(piece) < 2:
        return [piece] if piece else []
    if len(piece) > SHORT_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = NO_RANK
    get = ranks.get
    waits = [get(a + b, none) for a, b in pairwise(parts)]
    while waits:
        least = min(waits)
        if least == none:
            break
        i = waits.index(least)
        joined = parts[i] + parts[i + 1]
        parts[i : i + 2] = [joined]
        del waits[i]
        if i < len(waits):
            waits[i] = get(joined + parts[i + 1], none)
        if i:
            waits[i - 1] = get(parts[i - 1] + joined, none)
    return parts


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """As merge: a heap of pairs over a linked list of (begin, end)."""
    n = len(piece)
    end, left, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop:  # one of the two has been joined since
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            left[stop] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(piece[i : end[i]])
        i = end[i]
    return out


class Cache(dict):
    """Piece to what ``make`` gives for it, of bounded size between batches."""

    def __init__(self, make: Callable[[str], object], most: int = CACHE_PIECES):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece: str):
        found = self.make(piece)
        if len(piece) <= CACHE_CHARS:
            self[piece] = found
        return found

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def pieces_of(raw: np.ndarray, at: np.ndarray, special: tuple[str, ...] = ()) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string; where its pieces begin (and the end); the first piece of each text (and their number).

    A special token inside a text is a piece of its own, and the text before and after it is cut apart from it.
    """
    text = raw.tobytes().decode("utf-8")
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(codes)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[at] if len(codes) != len(raw) else at
    first = np.zeros(n + 1, bool)
    first[heads] = True
    whole: list[tuple[int, int]] = []
    for token in special:
        i = text.find(token)
        while i >= 0:
            j = i + len(token)
            if not first[i + 1 : j].any():  # within one text
                whole.append((i, j))
                i = text.find(token, j)
            else:
                i = text.find(token, i + 1)
    for i, j in whole:
        first[[i, j]] = True
    begin = pretokens.begins(codes, first[:n])
    for i, j in whole:
        begin[i + 1 : j] = False
    starts = np.append(np.flatnonzero(begin), n)
    return text, starts, np.searchsorted(starts, heads)


class Encoder:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int] | None = None):
        self.ranks, self.special = ranks, special or {}
        self.vocabulary = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.cache = Cache(self.encode_piece)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        if piece in self.special:
            return (self.special[piece],)
        return tuple([self.ranks[t] for t in merge(piece.encode(), self.ranks)])

    def encode_batch(self, raw: np.ndarray, at: np.ndarray) -> Iterator[list[int]]:
        """Ids of each text."""
        self.cache.trim()
        text, starts, heads = pieces_of(raw, at, tuple(self.special))
        where = starts.tolist()
        found = list(map(self.cache.__getitem__, [text[a:b] for a, b in pairwise(where)]))
        for a, b in pairwise(heads.tolist()):
            yield list(chain.from_iterable(found[a:b]))

    def encode(self, text: str) -> list[int]:
        raw = np.frombuffer(text.encode(), np.uint8)
        return next(self.encode_batch(raw, np.array([0, len(raw)])))

    def encode_with_offsets(self, text: str) -> list[tuple[int, int, int]]:
        """Ids with the bytes [from, to) of the text that each stands for."""
        out, at = [], 0
        for i in self.encode(text):
            end = at + len(self.vocabulary[i])
            out.append((i, at, end))
            at = end
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """A worker's encoder of a vocabulary file (.tiktoken: no special tokens; .json: with its own)."""
    return Encoder(*read_json(path)) if path.endswith(".json") else Encoder(read_ranks(path))


@cache
def _decimal(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each text: the number of its tokens, and SHA-256 of its ids in decimal and of the bytes they decode to."""
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        number = _decimal(max(tool.vocabulary) + 1)
        for batch in batches:
            raw, at = utf8(valid(batch.column(text)))
            counts, ids_hex, text_hex = [], [], []
            for a, b in passes(at):
                for ids in tool.encode_batch(raw[at[a] : at[b]], at[a : b + 1] - at[a]):
                    counts.append(len(ids))
                    ids_hex.append(hashlib.sha256(" ".join(map(number.__getitem__, ids)).encode()).hexdigest())
                    text_hex.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(run, schema)

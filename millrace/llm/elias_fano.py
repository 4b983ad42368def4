"""Monotone sequences in about two bits and the low bits a number, searched without unpacking; and arrays in one file.

A sequence keeps the low bits of its numbers side by side, and the high bits in unary in a bit vector: a one for each
number, a zero after the numbers of each high part. The numbers with one high part lie between two zeros, which a
directory of the zeros before each word finds, so a search touches a few words of a memory-mapped file.
"""

from __future__ import annotations

import json
import mmap
from collections.abc import Iterable

import numpy as np

ALIGN = 64
#: Place of the r-th one in a byte, for each byte.
SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[r] for r in range(8)] for b in range(256)], np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers in ``width`` bits each, as bytes, with room for reading eight bytes from any of them."""
    out = []
    for a in range(0, len(values), 1 << 16):
        part = np.ascontiguousarray(values[a : a + (1 << 16)], "<u8")
        out.append(np.packbits(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width].ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(16, np.uint8)])


def unpack(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The numbers at the places ``at``; width up to 56."""
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64) * width
    words = np.ndarray((len(packed) - 8,), "<u8", packed, 0, (1,))
    return (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


def select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one of this rank (from 0) in each word: the half that holds it, thrice, then a byte's table."""
    shift = np.zeros(len(words), np.uint64)
    rank = rank.astype(np.uint8)
    for half in (32, 16, 8):
        ones = np.bitwise_count((words >> shift) & np.uint64((1 << half) - 1))
        beyond = rank >= ones
        rank = rank - ones * beyond
        shift += beyond.astype(np.uint64) * np.uint64(half)
    return shift.astype(np.int64) + SELECT[((words >> shift) & np.uint64(255)).astype(np.int64), rank]


def lowest(words: np.ndarray) -> np.ndarray:
    """Place of the lowest one in each word; 64 where there is none."""
    return np.bitwise_count(~words & (words - np.uint64(1))).astype(np.int64)


class EliasFano:
    """A sequence of numbers that don't fall."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.n, self.width, self.highest = (int(x) for x in arrays[f"{name}.shape"])
        self.low, self.high, self.zeros = arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.zeros"]

    @staticmethod
    def build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        highs = (values >> np.uint64(width)).astype(np.int64)
        highest = int(highs[-1]) if n else 0
        bits = np.zeros(-(-(n + highest + 1) // 64) * 64, np.uint8)
        bits[highs + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words))])
        zeros = 64 * np.arange(len(words) + 1) - ones
        return {
            f"{name}.shape": np.array([n, width, highest], np.int64),
            f"{name}.low": pack(values & np.uint64((1 << width) - 1), width) if width else np.zeros(16, np.uint8),
            f"{name}.high": words,
            f"{name}.zeros": zeros.astype(np.uint32 if zeros[-1] < 1 << 32 else np.uint64),
        }

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero (from 0) in the bit vector."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        return 64 * word + select(~self.high[word], k - self.zeros[word].astype(np.int64))

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks [from, to) of the numbers with these high parts (at most the highest)."""
        at = np.zeros(len(high), np.int64)
        some = np.flatnonzero(high > 0)
        at[some] = self._select_zero(high[some] - 1) + 1
        # the numbers are a run of ones that most often ends in the word it begins in
        end = at + lowest(~self.high[at >> 6] >> (at & 63).astype(np.uint64))
        beyond = np.flatnonzero((end ^ at) >> 6)
        end[beyond] = self._select_zero(high[beyond])
        return at - high, end - high

    def _place(self, at: np.ndarray) -> np.ndarray:
        """Places of the ones of the ranks ``at`` in the bit vector."""
        word = np.searchsorted(64 * np.arange(len(self.zeros)) - self.zeros.astype(np.int64), at, "right") - 1
        return 64 * word + select(self.high[word], at - (64 * word - self.zeros[word].astype(np.int64)))

    def _number(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        return ((place - at).astype(np.uint64) << np.uint64(self.width)) | unpack(self.low, self.width, at)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers of the ranks ``at``."""
        return self._number(at, self._place(at))

    def pair(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the ranks ``at`` and of the ranks after these, which must be there."""
        place = self._place(at)
        after = place + 1
        then = after + lowest(self.high[after >> 6] >> (after & 63).astype(np.uint64))
        beyond = np.flatnonzero((then ^ after) >> 6)
        then[beyond] = self._place(at[beyond] + 1)
        return self._number(at, place), self._number(at + 1, then)

    def find(self, values: np.ndarray, since: np.ndarray | None = None, until: np.ndarray | None = None) -> np.ndarray:
        """Rank of each value (the first of equal ones), -1 where it is absent; only ranks [since, until) are searched if given."""
        out = np.full(len(values), -1, np.int64)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        ask = np.flatnonzero((high <= self.highest) & (high >= 0)) if self.n else np.zeros(0, np.int64)
        if not len(ask):
            return out
        begin, end = self._bucket(high[ask])
        if since is not None:
            begin, end = np.maximum(begin, since[ask]), np.minimum(end, until[ask])
        end = np.maximum(begin, end)
        low = values[ask] & np.uint64((1 << self.width) - 1)
        left, right = begin.copy(), end
        open_ = np.flatnonzero(left < right)
        since, until, sought = left[open_], right[open_], low[open_]
        while open_.size:
            middle = (since + until) >> 1
            less = unpack(self.low, self.width, middle) < sought
            since, until = np.where(less, middle + 1, since), np.where(less, until, middle)
            left[open_] = since
            on = np.flatnonzero(since < until)
            open_, since, until, sought = open_[on], since[on], until[on], sought[on]
        inside = np.flatnonzero(left < end)
        inside = inside[unpack(self.low, self.width, left[inside]) == low[inside]]
        out[ask[inside]] = left[inside]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> Iterable[bytes]:
    """A file's bytes: a line of JSON, then the arrays, each at a multiple of ALIGN."""
    about, at = {}, 0
    for name, a in arrays.items():
        about[name] = [a.dtype.str, list(a.shape), at]
        at += -(-a.nbytes // ALIGN) * ALIGN
    head = json.dumps(about).encode() + b"\n"
    yield head + b" " * (-len(head) % ALIGN)
    for a in arrays.values():
        yield np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % ALIGN)


def from_file(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    with open(path, "rb") as f:
        return from_bytes(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def from_bytes(mapped: mmap.mmap | bytes) -> dict[str, np.ndarray]:
    line = mapped.find(b"\n") + 1
    base = -(-line // ALIGN) * ALIGN
    return {name: np.ndarray(shape, dtype, mapped, base + at) for name, (dtype, shape, at) in json.loads(mapped[:line]).items()}

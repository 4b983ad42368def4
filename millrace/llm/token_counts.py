"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

Within a piece of the pre-tokeniser, the last token of every prefix determines its whole encoding: token t can end the
prefix that ends at i if the prefix before it ends in a token p, and p and t stay apart when their bytes are merged
together. So count[i] = count[i - len(t)] + 1 with the one t that fits, and every prefix of the piece is counted at once.
Counts of whole pieces are kept in a bounded cache; a text's count is the sum over its pieces, and the count of a cut
text comes from the piece that holds the cut, without encoding again.

Defined cases: a null text counts as empty, with no tokens; special tokens inside a text count as one token each, as the
library's default has it; pieces of any length are counted whole, a byte of them looking back along a trie of reversed
tokens and no further than the token that fits; bytes that aren't UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.bpe import Cache, merge, pieces_of, read_json
from millrace.llm.common import passes, utf8, valid
from millrace.llm.pretokens import WHITE_SPACE

#: Known verdicts on pairs of tokens that a worker keeps.
PAIRS = 1_000_000

#: White space, as the pre-tokeniser takes it.
BLANKS = "".join(map(chr, WHITE_SPACE))
CONTRACTIONS = ("'re", "'ve", "'ll")


class Counter:
    def __init__(self, ids: dict[bytes, int], special: dict[str, int] | None = None):
        self.special = tuple(special or ())
        # a token must come out as itself when its own bytes are merged
        self.ids = {t: i for t, i in ids.items() if len(t) == 1 or self._made_of(t, ids)}
        #: a trie of the tokens read from their ends: (node, byte) to node, and the token that a node ends
        self.step: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        for t, i in self.ids.items():
            node = 0
            for b in reversed(t):
                node = self.step.setdefault(node << 8 | b, len(self.step) + 1)
            self.ends[node] = i
        self.pair_id: dict[tuple[int, int], int] = {}
        #: of a token, its tokens along the left and the right edge, smallest first
        self.left_edge: dict[int, list[int]] = {}
        self.right_edge: dict[int, list[int]] = {}
        for t, i in sorted(self.ids.items(), key=lambda x: x[1] if len(x[0]) > 1 else -1):
            if len(t) == 1:
                self.left_edge[i] = self.right_edge[i] = [i]
                continue
            a, b = self._made_of(t, ids)
            a, b = ids[a], ids[b]
            self.pair_id[a, b] = i
            self.left_edge[i] = [*self.left_edge[a], i]
            self.right_edge[i] = [*self.right_edge[b], i]
        self.fits: dict[tuple[int, int], bool] = {}
        self.cache = Cache(self._count)

    @staticmethod
    def _made_of(token: bytes, ids: dict[bytes, int]) -> tuple[bytes, bytes] | None:
        """The two tokens that the token's last merge joins; None if its bytes never come together."""
        own = ids[token]
        below = {t: r for n in range(len(token)) for k in range(n + 2, len(token) + 1) if (r := ids.get(t := token[n:k], own)) < own}
        parts = merge(token, below)
        return tuple(parts) if len(parts) == 2 else None

    def apart(self, p: int, t: int) -> bool:
        """Whether p and t stay two tokens when their bytes are merged together.

        The merges inside p and inside t happen in the order of their ids; between any two of them the tokens that touch
        at the border are known, and p and t are joined across it if that pair has a merge which comes before the next
        inside. Of equal merges the leftmost comes first.
        """
        known = self.fits.get((p, t))
        if known is not None:
            return known
        left, right, i, j = self.right_edge[p], self.left_edge[t], 0, 0
        never = 1 << 62
        while True:
            next_left = left[i + 1] if i + 1 < len(left) else never
            next_right = right[j + 1] if j + 1 < len(right) else never
            across = self.pair_id.get((left[i], right[j]))
            if across is not None and across < next_left and across <= next_right:
                verdict = False
                break
            if next_left == never and next_right == never:
                verdict = True
                break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[p, t] = verdict
        return verdict

    def prefixes(self, piece: bytes) -> list[int]:
        """Tokens of piece[:i] for every i from 0 to its length."""
        n, step, ends, apart = len(piece), self.step.get, self.ends.get, self.apart
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(1, n + 1):
            node = 0
            for a in range(i - 1, -1, -1):
                node = step(node << 8 | piece[a])
                if node is None:
                    raise ValueError("the vocabulary lacks a byte")
                t = ends(node)
                if t is not None and (a == 0 or apart(last[a], t)):
                    count[i], last[i] = count[a] + 1, t
                    break
        return count

    def _count(self, piece: str) -> int:
        return 1 if piece in self.special else self.prefixes(piece.encode())[-1]

    def count_batch(self, raw: np.ndarray, at: np.ndarray) -> Iterator[int]:
        self.cache.trim()
        text, starts, heads = pieces_of(raw, at, self.special)
        counts = list(map(self.cache.__getitem__, [text[a:b] for a, b in pairwise(starts.tolist())]))
        total = [0, *accumulate(counts)]
        for a, b in pairwise(heads.tolist()):
            yield total[b] - total[a]

    def text_prefixes(self, text: str) -> np.ndarray:
        """Tokens of text[:j] for every j from 0 to len(text), each as if the cut text were encoded anew."""
        out = np.zeros(len(text) + 1, np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        joined, starts, _ = pieces_of(raw, np.array([0, len(raw)]), self.special)
        where = starts.tolist()
        base, blank_from, blank_base = 0, -1, 0
        for a, b in pairwise(where):
            piece = joined[a:b]
            if piece in self.special:
                for j in range(a + 1, b):
                    out[j] = self._whole(text[:j])
                out[b] = base + 1
                base, blank_from = base + 1, -1
                continue
            white = len(piece) - len(piece.lstrip(BLANKS))
            if white and blank_from < 0:
                blank_from, blank_base = a, base
            if white:  # cut in white space: the run so far is one piece
                run = self._by_char(joined[blank_from : a + white])
                out[a + 1 : a + white + 1] = blank_base + run[a - blank_from + 1 :]
            counts = self._by_char(piece)
            if white < len(piece):
                out[a + white + 1 : b + 1] = base + counts[white + 1 :]
                if piece in CONTRACTIONS:
                    out[a + 2] = base + 2
                blank_from = -1
            base += int(counts[-1])
        return out

    def _by_char(self, piece: str) -> np.ndarray:
        counts = np.array(self.prefixes(piece.encode()))
        return counts[[0, *accumulate(len(c.encode()) for c in piece)]]

    def _whole(self, text: str) -> int:
        raw = np.frombuffer(text.encode(), np.uint8)
        return next(self.count_batch(raw, np.array([0, len(raw)])))

    def longest_prefix(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of the text with at most ``budget`` tokens."""
        return int(np.flatnonzero(self.text_prefixes(text) <= budget)[-1])


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(*read_json(path))


def counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each text: its bytes, its tokens, and whether these are more than ``limit``."""
    schema = T.StructType([docs.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path)
        for batch in batches:
            raw, at = utf8(valid(batch.column(text)))
            n = np.array([c for a, b in passes(at) for c in tool.count_batch(raw[at[a] : at[b]], at[a : b + 1] - at[a])], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(np.diff(at)), pa.array(n), pa.array(n > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(key, text).mapInArrow(run, schema)

"""Quality rules on repetition: how much of a text lies in n-grams and lines that occur more than once.

Words get exact numbers, windows of n words get rolling hashes of these for several n at once over a batch of texts, and
windows whose hash occurs again in the same text mark their words. A window can only repeat if the shorter ones at its
ends do, so each length looks only at what the last one left. The marked words' characters against all words' give the
coverage that the rules judge.

Defined cases: a null or empty text has no words, all counts are 0, and it fails the base rule; equal lines count from
the second on, and only lines with a word; hashes of 64 bits are salted by the text, so that texts don't mix;
bytes that aren't UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import passes, utf8, valid

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Words of a window, and the share of a text's word characters that may lie in its repeated windows.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Share of the characters of lines that may lie in lines that repeat an earlier one.
LINE_COVERAGE = 0.20
BASE_WINDOW, BASE_WORDS, BASE_SHARE = 3, 50, 50

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def mix(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits (the finaliser of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(values: np.ndarray) -> np.ndarray:
    """True where the value occurs at least twice."""
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """True for the words in windows of n words that begin at ``starts``."""
    change = np.zeros(words + 1, np.int64)
    change[starts] += 1
    change[starts + n] -= 1
    return np.cumsum(change[:-1]) > 0


def windows(numbers: np.ndarray, text: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, from short to long, the words inside windows that repeat in their text."""
    words = len(numbers)
    base, salt = mix(numbers), mix(text + np.uint64(1 << 40))
    rolling, reach = salt.copy(), 0
    left = np.arange(words)
    for n in lengths:
        while reach < n:  # rolling[i] covers the words i .. i + reach - 1
            whole = max(0, words - reach)
            rolling[:whole] = rolling[:whole] * np.uint64(0xD6E8FEB86659FD93) + base[reach:]
            reach += 1
        left = left[left + n <= words]
        left = left[text[left] == text[left + n - 1]]
        left = left[repeated(mix(rolling[left]))]
        yield n, covered(left, n, words)


def measure(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text, and characters in repeated windows and lines."""
    n = len(at) - 1
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True
    word = ~space
    before = np.concatenate([[False], word[:-1]]) & ~cut[:-1]
    after = np.concatenate([word[1:], [False]]) & ~cut[1:]
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    heads = np.searchsorted(starts, at)
    per_text = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[heads])

    known: dict[bytes, int] = {}
    numbers: list[int] = []
    dup_lines, line_chars, dup_line_chars = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        text = raw[at[i] : at[i + 1]].tobytes()
        numbers += [known.setdefault(w, len(known)) for w in text.split()]
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line and not line.isspace():
                size = len(line.decode("utf-8"))
                line_chars[i] += size
                if line in seen:
                    dup_lines[i] += 1
                    dup_line_chars[i] += size
                seen.add(line)
    table = np.concatenate([[0], np.cumsum(np.isin(np.arange(256), list(map(ord, SYMBOLS))).take(raw))])
    out = {
        "n_words": np.diff(heads),
        "word_chars": per_text(chars),
        "n_symbols": np.diff(table[at]),
        "n_dup_lines": dup_lines,
        "line_chars": line_chars,
        "dup_line_chars": dup_line_chars,
    }
    text_of = np.repeat(np.arange(n, dtype=np.uint64), np.diff(heads))
    for k, inside in windows(np.array(numbers, np.uint64), text_of, (BASE_WINDOW, *COVERAGE)):
        out["n_repeat_words" if k == BASE_WINDOW else f"dup_{k}"] = per_text(inside if k == BASE_WINDOW else inside * chars)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Base failure, and whether the text is kept."""
    base_failed = (m["n_words"] < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_SHARE * m["n_words"])
    kept = ~base_failed & (m["dup_line_chars"] <= LINE_COVERAGE * m["line_chars"])
    for n, most in COVERAGE.items():
        kept &= m[f"dup_{n}"] <= most * m["word_chars"]
    return base_failed, kept


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each text: its counts, its characters in repeated n-grams and lines, and the verdicts."""
    more = ("dup_line_chars", *(f"dup_{n}" for n in COVERAGE))
    schema = T.StructType([docs.schema[key], *(T.StructField(f, T.LongType()) for f in FIELDS), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), *(T.StructField(f, T.LongType()) for f in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8(valid(batch.column(text)))
            for a, b in passes(at):
                m = measure(raw[at[a] : at[b]], at[a : b + 1] - at[a])
                base_failed, kept = verdict(m)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a), *(pa.array(m[f].astype(np.int64)) for f in FIELDS), pa.array(base_failed), pa.array(kept), *(pa.array(m[f].astype(np.int64)) for f in more)], names=schema.names
                )

    return docs.select(key, text).mapInArrow(run, schema)

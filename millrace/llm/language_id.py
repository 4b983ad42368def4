"""Language identification by compression.

A language is a raw-content zstandard dictionary: a bounded sample of windows of its training texts. A text is cut into
blocks, each block is compressed with every language's dictionary, and the language whose blocks come out smallest over
the whole text is chosen. A text whose two best languages are closer than ``min_margin`` is rejected.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and is rejected; an equal size goes to the
language whose name sorts first; with one learned language every text with a letter is of that language; with none all
are ``und``. Bytes that aren't UTF-8 are read as U+FFFD. Null ids never train. Rows with the same text train once. Other columns pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import decoded

#: Training windows that a language has on average at most, their characters, and all languages' windows together: the
#: bound of the fitted sample. With very many languages each has fewer windows, and none is left out.
WINDOWS, WINDOW_CHARS, ALL_WINDOWS = 210, 300, 1 << 16
#: Bytes of a language's dictionary, of a block, and zstandard's level.
DICT_BYTES, BLOCK_BYTES, LEVEL = 64 << 10, 2 << 10, 5
#: A text is rejected if the second best size is less than this share above the best.
MIN_MARGIN = 0.004

LETTER = r"\p{L}"


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", *, windows: int = WINDOWS, window_chars: int = WINDOW_CHARS, dict_bytes: int = DICT_BYTES, all_windows: int = ALL_WINDOWS) -> dict[str, bytes]:
    """A dictionary's content for each language, from one window of each of about ``windows`` of its texts.

    The driver holds the windows, ``all_windows`` x window_chars characters on average at most, and a count for each
    language; more languages than windows raise ValueError. Texts are chosen by a hash of id and text, and count once however
    often they repeat. A dictionary that comes out longer than ``dict_bytes`` (longer characters, or more windows than the
    average) keeps its end.
    """
    usable = train.where(F.col(lang).isNotNull() & F.col(text).rlike(LETTER)).select(
        F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.xxhash64(F.col(key), F.col(text)).alias("_h")
    )
    counts = {r["_lang"]: r["n"] for r in usable.groupBy("_lang").agg(F.count("*").alias("n")).limit(all_windows + 1).collect()}
    if len(counts) > all_windows:
        raise ValueError(f"more than {all_windows} languages")
    if not counts:
        return {}
    each = min(windows, max(1, all_windows // len(counts)))
    shares = train.sparkSession.createDataFrame([(name, int(min(1.0, each / n) * (1 << 31))) for name, n in counts.items()], "_lang string, _share long")
    start = (F.lit(1) + F.pmod(F.xxhash64("_h", F.lit("start")), F.greatest(F.length("_text") - window_chars, F.lit(1)))).cast("int")
    # the text whose hash is the least comes in any case, so that each language has one
    least = usable.groupBy("_lang").agg(F.min(F.struct("_h", F.col("_text").substr(start, F.lit(window_chars)).alias("w"))).alias("x")).select("_lang", "x.*")
    drawn = usable.join(F.broadcast(shares), "_lang").where(F.pmod("_h", F.lit(1 << 31)) < F.col("_share")).select("_lang", "_h", F.col("_text").substr(start, F.lit(window_chars)).alias("w"))
    rows = drawn.unionByName(least).distinct().collect()
    found: dict[str, dict[str, None]] = {name: {} for name in sorted(counts)}
    for r in sorted(rows, key=lambda r: (r["_lang"], r["_h"], r["w"])):
        found[r["_lang"]][r["w"].lower()] = None
    return {name: "\n".join(ws).encode()[-dict_bytes:] for name, ws in found.items() if ws}


class Sizer:
    """Compressed sizes of a text under each language."""

    def __init__(self, learned: dict[str, bytes], block: int = BLOCK_BYTES, level: int = LEVEL):
        self.names = sorted(learned)
        self.block = block
        self.tools = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(learned[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.tools.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        raw, n = text.lower().encode("utf-8", "replace"), self.block
        blocks = [raw[i : i + n] for i in range(0, len(raw), n)]
        return [sum([len(compress(b)) for b in blocks]) for compress in self.tools]

    def predict(self, text: str | None, min_margin: float) -> tuple[str, float, bool]:
        """Language, score, and whether the text is accepted."""
        if not self.names or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, False
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        if len(order) == 1:
            return self.names[order[0]], 1.0, True
        # the share of the best language if each byte more halves a language's odds, in units of a hundredth of the size
        unit = max(best / 100, 1.0)
        score = 1.0 / sum(math.pow(2.0, -(s - best) / unit) for s in sizes)
        return self.names[order[0]], score, (sizes[order[1]] - best) >= min_margin * best


def predict(docs: DataFrame, learned: dict[str, bytes], text: str = "text", *, min_margin: float = MIN_MARGIN, names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """The rows of ``docs`` with three columns more: language, score and whether it is accepted.

    Columns of ``docs`` that have one of these names are replaced.
    """
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(learned)
        for batch in batches:
            got = [sizer.predict(t, min_margin) for t in decoded(batch.column(text))]
            cols = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    return kept.mapInArrow(run, schema)


def training(docs: DataFrame, held_out: Column) -> DataFrame:
    return docs.where(~held_out & F.col("doc_id").isNotNull())

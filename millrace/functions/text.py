"""Text, id and time functions as Spark columns."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Separators of hashed text, from outer to inner.
FIELD_SEPARATOR, GROUP_SEPARATOR, RECORD_SEPARATOR, UNIT_SEPARATOR = map(chr, (28, 29, 30, 31))
#: Fixed value: ISO-8601 in whole seconds, UTC.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

#: Fixed value: text that cleaning leaves as it is, visible ASCII with single blanks between.
PLAIN = r"^[!-~]++(?: [!-~]++)*+\z"
ID_SHAPE = r"^(0|[1-9][0-9]*)\z"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column, empty_as_null: bool = True) -> Column:
    """Runs of white space to one blank, control and format characters gone, trimmed; nothing left is null or ''."""
    text = column(c).cast("string")
    blanks = F.regexp_replace(text, r"[\t\n\f\r \p{Z}]+", " ")
    out = F.trim(F.regexp_replace(blanks, r"[\p{Cc}\p{Cf}]", ""))
    # most text is plain already, which one look tells
    return F.when(text.rlike(PLAIN), text).otherwise(F.nullif(out, F.lit("")) if empty_as_null else out)


def casefold(c: str | Column) -> Column:
    """Text for comparing without letter case: full upper case and back, so that sharp s is ss, and one form of sigma.

    The sigma is lowered first: in between, it also keeps the optimizer from taking lower(upper(x)) for lower(x).
    """
    return F.lower(F.translate(F.upper(column(c)), "Σ", "σ"))


def slug(c: str | Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 one underscore, none at the ends; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(column(c)), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


def joined(parts: Iterable[Column], separator: str) -> Column:
    parts = list(parts)
    out = parts[0] if parts else F.lit("")
    for p in parts[1:]:
        out = F.concat(out, F.lit(separator), p)
    return out


def hash_id(*fields: str | Column) -> Column:
    """A 63-bit id of the fields' text; a null field counts as ''."""
    text = joined([F.coalesce(column(f).cast("string"), F.lit("")) for f in fields], UNIT_SEPARATOR)
    high = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(high, F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")


def row_text(columns: Iterable[str | Column]) -> Column:
    """The row's fields, each 'v' and its text or 'n' for null."""
    return joined([F.coalesce(F.concat(F.lit("v"), column(c).cast("string")), F.lit("n")) for c in columns], UNIT_SEPARATOR)


def effect_hash(lines: str | Column) -> Column:
    """SHA-256 of an array of (tag, fields) structs: tag and fields by unit, lines by record separator."""
    return F.sha2(F.array_join(F.transform(column(lines), lambda x: F.concat(x["tag"], F.lit(UNIT_SEPARATOR), F.array_join(x["fields"], UNIT_SEPARATOR, ""))), RECORD_SEPARATOR), 256)


def iso_ts(c: str | Column) -> Column:
    """Timestamp without zone of ISO text; null if it isn't exactly that."""
    c = column(c)
    return F.when(c.rlike(ISO_SHAPE), F.try_to_timestamp(c, F.lit(ISO_PATTERN)).cast("timestamp_ntz"))


def iso_text(c: str | Column) -> Column:
    return F.date_format(column(c), ISO_PATTERN)


def shard(c: str | Column, n: int) -> Column:
    """A stable number below n for a key, from its SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(column(c).cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(n))


def is_id(c: str | Column) -> Column:
    """Whether text is the decimal form of an id: no sign, no leading zero, below 2^63."""
    c = column(c)
    return c.rlike(ID_SHAPE) & F.coalesce(F.try_to_number(c, F.lit("9" * 38)) < F.lit(str(1 << 63)).cast("decimal(38,0)"), F.lit(False))


def first_token(text: str | Column, tokens: list[str]) -> Column:
    """The first of the tokens, in their order, that the text contains in any letter case; null if none."""
    low = F.lower(column(text))
    return F.coalesce(*[F.when(low.contains(t.lower()), F.lit(t)) for t in tokens], F.lit(None).cast("string"))


def percent_change(new: str | Column, old: str | Column) -> Column:
    new, old = column(new), column(old)
    return F.when(old.isNull() | (old == 0), F.lit(None).cast("double")).otherwise(100.0 * (new - old) / old)


def conform(df: DataFrame, contract: dict[str, str], required: Iterable[str] = ()) -> DataFrame:
    """Exactly the contract's columns in its order and types; a null in a required column stops the job."""
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    must = set(required)
    return df.select(
        *[
            (F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null"))).otherwise(F.col(c)) if c in must else F.col(c)).cast(kind).alias(c)
            for c, kind in contract.items()
        ]
    )


def json_text(**fields: Column) -> Column:
    """A JSON object with the fields in their order, nulls kept."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


@F.pandas_udf(StringType())
def json_fault(text: pd.Series) -> pd.Series:
    """Why text is no strict JSON object (repeated keys at any depth, numbers that aren't finite, another top level); null if it is one."""

    def once(pairs):
        seen = {}
        for k, v in pairs:
            if k in seen:
                raise ValueError(f"duplicate key {k}")
            seen[k] = v
        return seen

    def constant(name):
        raise ValueError(f"non-finite number {name}")

    def fault(raw):
        try:
            top = json.loads(raw, object_pairs_hook=once, parse_constant=constant)
        except json.JSONDecodeError:
            return "invalid"
        except (TypeError, ValueError, RecursionError) as e:
            return str(e) if raw is not None else "invalid"
        return None if isinstance(top, dict) else "not an object"

    return text.map(fault)

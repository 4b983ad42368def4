"""Joins and windows that Spark SQL has no single word for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows up to which a table may be broadcast for a join without an equality; larger ones are refused.
SMALL_ROWS = 10_000


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should be total within a key."""
    nth = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1").drop("_nth")


def with_distinct_count(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Each row with the number of its key's different values (nulls not counted): an aggregate joined back, so that no
    key's values are gathered in one row."""
    counts = df.groupBy(*keys).agg(F.countDistinct(value).alias(name))
    on = [df[k].eqNullSafe(counts[k]) for k in keys]
    return df.join(counts, on).select(df["*"], counts[name])


def either_key_join(left: DataFrame, key: str, right: DataFrame, owners: tuple[str, str]) -> DataFrame:
    """Join on left.key = one or the other of two columns; a row whose two owners are the same joins once.

    The rows are sent out under each different owner, which makes it an equality join.
    """
    owned = right.withColumn("_owner", F.explode(F.array_distinct(F.array(*owners))))
    return left.join(owned, left[key] == owned["_owner"]).drop("_owner")


def _place(text: str, word: str) -> Column:
    return F.expr(f"instr(concat(' ', `{text}`, ' '), concat(' ', `{word}`, ' '))")


def containment_join(df: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """Rows of df with each word that stands in the text between blanks, and its place; ``words`` must be small."""
    n = words.limit(SMALL_ROWS + 1).count()
    if n > SMALL_ROWS:
        raise ValueError(f"more than {SMALL_ROWS} words: use containment_by_token")
    return df.join(F.broadcast(words), _place(text, word) > 0).withColumn("place", _place(text, word))


#: Parts that the texts of a token are split into, so that a token which all texts hold is no single task's.
SALTS = 8


def containment_by_token(df: DataFrame, text: str, words: DataFrame, word: str, *, salts: int = SALTS) -> DataFrame:
    """As containment_join for any number of words (of one or more tokens): a text goes out under each of its different
    tokens, a word under its first one, and what meets is compared. Each text of a token goes to one of ``salts`` parts, by
    a hash of the text, and each word to all of them."""
    sent = df.withColumn("_token", F.explode(F.array_distinct(F.split(text, " ")))).withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]), F.lit(salts)))
    keyed = words.withColumn("_first", F.split_part(word, F.lit(" "), F.lit(1))).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = sent.join(keyed, (F.col("_token") == F.col("_first")) & (F.col("_salt") == F.col("_part")))
    return met.drop("_token", "_first", "_salt", "_part").withColumn("place", _place(text, word)).where("place > 0")


def null_aware_anti(left: DataFrame, key: str, right: DataFrame, other: str) -> DataFrame:
    """left.key NOT IN (right.other): nothing if right holds a null; rows with a null key only if right is empty."""
    facts = right.agg(F.count("*").alias("n"), F.count(F.when(F.col(other).isNull(), 1)).alias("nulls"))
    keys = right.select(F.col(other).alias("_other")).where(F.col("_other").isNotNull()).distinct()
    kept = left.join(keys, left[key] == keys["_other"], "left_anti").join(F.broadcast(facts))
    return kept.where((F.col("n") == 0) | ((F.col("nulls") == 0) & F.col(key).isNotNull())).drop("n", "nulls")


def mark(left: DataFrame, keys: list[str], right: DataFrame, name: str) -> DataFrame:
    """Every row of left and whether right has its keys."""
    there = right.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_there", F.lit(True))
    on = [left[k] == there[f"_{k}"] for k in keys]
    return left.join(there, on, "left").select(left["*"], F.coalesce("_there", F.lit(False)).alias(name))


def full_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: key, side."""
    e, a = expected.select(F.col(key).alias("e")).distinct(), actual.select(F.col(key).alias("a")).distinct()
    return (
        e.join(a, F.col("e") == F.col("a"), "full").where("e is null or a is null")
        .select(F.coalesce("e", "a").alias(key), F.when(F.col("a").isNull(), "missing").otherwise("unexpected").alias("side"))
    )


def streaks(runs: DataFrame, hits: DataFrame, key: str, run: str) -> DataFrame:
    """For each key that hits in the newest run, in how many runs without a gap, counted back from it.

    The newest missed run of a key decides; it is found with aggregates and equality joins only. Runs are numbered in one
    window and, up to SMALL_ROWS of them, broadcast: a history has a row for each run, not for each record.
    """
    numbered = runs.select(run).distinct().withColumn("back", F.row_number().over(Window.orderBy(F.desc(run))))
    small = runs.select(run).distinct().limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    seen = hits.select(key, run).distinct().join(F.broadcast(numbered) if small else numbered, run)
    # a key's hits numbered by rank: a gap shows where rank and number part
    ranked = seen.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("back")))
    return ranked.where("rank = back").groupBy(key).agg(F.max("rank").cast("long").alias("runs"))

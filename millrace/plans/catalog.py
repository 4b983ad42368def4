"""A catalogue that Spark derives from the shared tables: items from parts, stats from order lines, links between parts.

The expressions are SQL that both engines read alike, so that a check can derive the same catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ELEMENTS = ["red", "blue", "green", "hot", "cold"]

ITEM = {
    "uid": "concat('p', p_partkey)",
    "name": "p_name",
    "model_class": "CASE p_partkey % 3 WHEN 0 THEN 'weapon' WHEN 1 THEN 'armour' ELSE 'monster' END",
    "rarity": "CASE WHEN p_size % 5 = 0 THEN 'SSR' WHEN p_size % 5 = 1 THEN 'SR' ELSE 'UR' END",
    "gear_type": "p_type",
    "element_id": "CASE WHEN p_partkey % 4 = 0 THEN 'red' WHEN p_partkey % 4 = 1 THEN 'blue' ELSE 'none' END",
    "cost": "CAST(p_size + 40 AS BIGINT)",
}
STAT = {
    "uid": "concat('p', l_partkey)", "label": "l_returnflag", "tier": "l_linestatus",
    "value": "CAST(l_quantity AS BIGINT)", "ordinal": "CAST(l_linenumber AS BIGINT)",
}
LINK = {
    "kind": "CASE WHEN p_partkey % 4 = 0 THEN 'awakening' ELSE 'reforge' END",
    "from_uid": "concat('p', CAST(floor(p_partkey / 3) AS BIGINT))",
    "to_uid": "concat('p', p_partkey)",
}
#: What the last revision had: parts that are not new, some at another cost, and none of the parts gone before.
CURRENT = "p_partkey % 13 <> 0"
PREVIOUS = "p_partkey % 11 <> 0"
OLD_COST = "CAST(p_size + 40 + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT)"
STATE = "CASE WHEN p_partkey % 17 = 0 THEN 'retired' ELSE 'live' END"


def columns(expressions: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in expressions.items()]


def select(expressions: dict[str, str], source: str, where: str = "true") -> str:
    return f"(SELECT {', '.join(columns(expressions))} FROM {source} WHERE {where})"


def items(spark: SparkSession, sf_dir: str, where: str = "true", **other: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(where).selectExpr(*columns(ITEM | other))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*columns(STAT))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey % 2 = 0 AND p_partkey > 0").selectExpr(*columns(LINK))


ITEMS_SQL = select(ITEM, "part")
STATS_SQL = select(STAT, "lineitem")
LINKS_SQL = select(LINK, "part", "p_partkey % 2 = 0 AND p_partkey > 0")


def row_text_sql(cs: list[str]) -> str:
    return " || chr(31) || ".join(f"coalesce('v' || CAST({c} AS VARCHAR), 'n')" for c in cs)


def hash_id_sql(*cs: str) -> str:
    text = " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cs)
    return f"CAST(CAST('0x' || substr(sha256({text}), 1, 16) AS UBIGINT) & CAST(9223372036854775807 AS UBIGINT) AS BIGINT)"


def clean_sql(c: str, empty_as_null: bool = True) -> str:
    out = f"trim(regexp_replace(regexp_replace(CAST({c} AS VARCHAR), '[\\t\\n\\f\\r \\p{{Z}}]+', ' ', 'g'), '[\\p{{Cc}}\\p{{Cf}}]', '', 'g'))"
    return f"nullif({out}, '')" if empty_as_null else out

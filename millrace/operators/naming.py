"""Names of effects taken apart: size, element, family; and lines that say what an effect scales with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, hash_id, slug

#: Fixed value: a size at the end of a name.
SIZE = r"[0-9]?(?:x+)?(?:s|m|l)\+?"


def size_of(name: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(name, rf"(?iu)^.*\s({SIZE})\z", 1)), F.lit(""))


def without_size(name: Column) -> Column:
    return F.when(size_of(name).isNull(), name).otherwise(F.trim(F.regexp_extract(name, rf"(?iu)^(.*)\s({SIZE})\z", 1)))


def decompose(df: DataFrame, name: str, elements: list[str]) -> DataFrame:
    """Rows with size, base_name, name_element, element_position, family_name and family_id."""
    raw = clean_text(name, empty_as_null=False)
    df = df.withColumn("size", size_of(raw)).withColumn("base_name", without_size(raw))
    words = F.split("base_name", " ")
    place = F.array(*[F.struct(F.array_position(words, e).alias("at"), F.lit(e).alias("e")) for e in sorted(elements)])
    first = F.array_min(F.filter(place, lambda x: x["at"] > 0))
    element = first["e"]
    position = (
        F.when(F.col("name_element").isNull(), None)
        .when((F.col("base_name") == F.col("name_element")) | F.startswith("base_name", F.concat("name_element", F.lit(" "))), "prefix")
        .when(F.endswith("base_name", F.concat(F.lit(" "), "name_element")), "suffix")
        .otherwise("infix")
    )
    rest = F.array_join(F.filter(words, lambda w: ~w.isin(elements) & (w != "")), " ")
    df = df.withColumn("name_element", element).withColumn("element_position", position)
    df = df.withColumn("family_name", F.coalesce(F.nullif(rest, F.lit("")), F.col("base_name")))
    return df.withColumn("family_id", hash_id("family_name"))


#: What a line says before, between and after its parts.
KIND, TOKEN, WEAPONS = r"^(.*?)\s+scales with", r"number of (\S+) elemental", "%elemental weapons%"
CAP, PIECES = r"up to a max of (\S+)", r"needed for maximum effect: (\d+)"


def scaling(df: DataFrame, line: str, elements: list[str]) -> DataFrame:
    """Rows with scale_kind, element_id, gear_kind, cap and pieces_needed of a scaling line."""
    d = clean_text(line, empty_as_null=False)
    part = lambda pattern: F.nullif(F.regexp_extract(d, pattern, 1), F.lit(""))
    token = part(TOKEN)
    return df.withColumns(
        {
            "scale_kind": F.coalesce(slug(F.regexp_extract(d, KIND, 1)), F.lit("unknown")),
            "element_id": F.when(token.isin(elements), token),
            "gear_kind": F.when(d.like(WEAPONS), "weapons").otherwise("gear"),
            "cap": part(CAP),
            "pieces_needed": part(PIECES).try_cast("long"),
        }
    )

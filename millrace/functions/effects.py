"""Effect cells of catalogue pages as columns: lines, targets, marked sections, procs and potentials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import column

# How effects are written on a page.
LINE_BREAK = r"(?dmU)(?:^|\s)-(?=\S)|\n"
TARGET = r"^target:\s*([^.]+?)\s*\.\s*(.+)$"
MARKER = r"(?d)^\[([^\]\n]+)\](?:\n|\z)"
BEFORE_MARKER = r"(?dm)(?=^\[[^\]\n]+\]$)"
AMPLIFIER = r"(?U)\s*(ability power boosted by \d+ for each increase in skill level\.)\s*$"
POTENTIAL = r"^lv\s*(\d+)"
EFFECTS, ACTIVATION, RATE, SCALES = "effects", "activation", "activation rate", "scales"


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def effect_lines(text: str | Column) -> Column:
    """The lines of a cell, one effect each and none empty; an amplifier at a line's end is a line of its own. Null text: null."""

    def parted(line: Column) -> Column:
        amplifier = F.regexp_extract(line, AMPLIFIER, 1)
        alone = (amplifier == "") | (amplifier == line)
        return F.when(alone, F.array(line)).otherwise(F.array(_stripped(F.regexp_replace(line, AMPLIFIER, "")), amplifier))

    lines = F.filter(F.transform(F.split(column(text), LINE_BREAK), _stripped), lambda x: x != "")
    return F.flatten(F.transform(lines, parted))


def effect_structs(lines: Column) -> Column:
    """(target, description) of each line; a line without a target is all description."""
    return F.transform(
        lines,
        lambda x: F.struct(
            F.nullif(F.regexp_extract(x, TARGET, 1), F.lit("")).alias("target"),
            F.when(x.rlike(TARGET), F.regexp_extract(x, TARGET, 2)).otherwise(x).alias("description"),
        ),
    )


def sections(text: str | Column) -> Column:
    """(name, lines) of each run of lines under a ``[marker]``, in page order; lines before the first marker are ``effects``."""
    blocks = F.filter(F.split(F.array_join(effect_lines(text), "\n"), BEFORE_MARKER), lambda b: b != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            F.when(b.rlike(MARKER), F.regexp_extract(b, MARKER, 1)).otherwise(EFFECTS).alias("name"),
            F.filter(F.split(F.regexp_replace(b, MARKER, ""), "\n"), lambda x: x != "").alias("lines"),
        ),
    )


def section(parts: Column, name: str) -> Column:
    """The lines of all sections of a name; an empty array if there is none."""
    return F.flatten(F.transform(F.filter(parts, lambda s: s["name"] == name), lambda s: s["lines"]))


def proc(text: str | Column) -> Column:
    """effects, condition, rate and scaling of a skill cell: lines that say what a proc scales with are kept apart."""
    # the sections are worked out once, not for each field
    return F.get(F.transform(F.array(sections(text)), _proc_of), F.lit(0))


def _proc_of(parts: Column) -> Column:
    scales = lambda x: x.contains(SCALES)
    effects, rates = section(parts, EFFECTS), section(parts, RATE)
    return F.struct(
        effect_structs(F.filter(effects, lambda x: ~scales(x))).alias("effects"),
        section(parts, ACTIVATION).alias("condition"),
        F.get(F.filter(rates, lambda x: ~scales(x)), F.lit(0)).alias("rate"),
        F.filter(F.concat(effects, rates), scales).alias("scaling"),
    )


def potential_level(label: str | Column) -> Column:
    """The level in a label like ``lv 20``; null if it is none."""
    return F.nullif(F.regexp_extract(column(label), POTENTIAL, 1), F.lit("")).try_cast("int")


def stat_tier(label: str | Column) -> Column:
    return F.regexp_replace(column(label), "[^a-z0-9]", "")


def whole_number(text: str | Column, default: int = 0) -> Column:
    """A number with or without thousands' commas; the default if it is none."""
    return F.coalesce(F.replace(_stripped(column(text)), F.lit(","), F.lit("")).try_cast("long"), F.lit(default))

"""Nested contracts: a JSON schema becomes one column expression that names the first fault of a document, or is null.

Understood are ``type`` (one or several), ``const``, ``enum``, ``pattern``, ``minLength``, ``maxLength``, ``minimum``,
``maximum``, ``required``, ``properties``, ``additionalProperties: false``, ``items``, ``minItems``, ``maxItems``,
``uniqueItems``, ``oneOf`` and ``$ref`` to a place in the same schema; a schema with other rules is refused, as is one
that refers to itself. The document is a variant; every value is reached by its path from the document or from an item of
a list, so the expression grows with the schema and not with its depth.

Faults are looked for in the order of a document read from the outside in: a value's own rules, then the keys that it
lacks, in the contract's order, then keys that it may not have, in theirs, then its parts in the contract's order, the
items of a list one after the other.

Defined cases: text that isn't JSON is the fault ``$: json``; a null text is as well; a value that JSON says is null is of
type null and is there; a whole number is also a number, and 1.0 is an integer; a pattern needs to be found anywhere, as
Java reads it; the length of a text is in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of each type of JSON, what the type of a variant's value looks like.
KINDS = {
    "object": r"^OBJECT<", "array": r"^ARRAY<", "string": r"^STRING$", "boolean": r"^BOOLEAN$", "null": r"^VOID$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)",
}
RULES = {
    "type", "const", "enum", "pattern", "minLength", "maxLength", "minimum", "maximum", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems", "oneOf", "$ref",
}
TOLD = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples"}


def _resolved(schema: dict, whole: dict, seen: tuple[str, ...]) -> tuple[dict, tuple[str, ...]]:
    while "$ref" in schema:
        ref = schema["$ref"]
        if not ref.startswith("#/"):
            raise ValueError(f"not a place in the schema: {ref}")
        if ref in seen:
            raise ValueError(f"{ref} refers to itself")
        found = whole
        for step in ref[2:].split("/"):
            found = found[step.replace("~1", "/").replace("~0", "~")]
        rest = {k: v for k, v in schema.items() if k != "$ref"}
        schema, seen = {**found, **rest}, (*seen, ref)
    if unknown := set(schema) - RULES - TOLD:
        raise ValueError(f"rules that aren't understood: {sorted(unknown)}")
    return schema, seen


class _Value:
    """A value of the document: where it is from a root (a variant column), and how its place is told."""

    def __init__(self, root: Column, path: str = "$", told: Column | None = None):
        self.root, self.path, self.told = root, path, F.lit("$") if told is None else told
        self.value = root if path == "$" else F.try_variant_get(root, path, "variant")

    def key(self, name: str) -> _Value:
        if "'" in name:
            raise ValueError(f"a key with a quotation mark: {name}")
        return _Value(self.root, f"{self.path}['{name}']", F.concat(self.told, F.lit(f".{name}")))

    def as_(self, kind: str) -> Column:
        return F.try_variant_get(self.root, self.path, kind)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first(faults: list[Column]) -> Column:
    return F.coalesce(*faults, F.lit(None).cast("string"))


def _fault(schema: dict, v: _Value, whole: dict, seen: tuple[str, ...]) -> Column:
    schema, seen = _resolved(schema, whole, seen)
    return _once(F.schema_of_variant(v.value), lambda kind: _broken(schema, v, kind, whole, seen))


def _broken(schema: dict, v: _Value, kind: Column, whole: dict, seen: tuple[str, ...]) -> Column:
    is_ = lambda name: kind.rlike(KINDS[name])
    whole_number = is_("integer") | (is_("number") & F.coalesce(v.as_("double") == F.floor(v.as_("double")), F.lit(False)))
    of = lambda name: whole_number if name == "integer" else is_(name)

    def fault(broken: Column, what: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.concat(v.told, F.lit(f": {what}")))

    def equals(want) -> Column:
        if want is None:
            return is_("null")
        if isinstance(want, bool):
            return is_("boolean") & (v.as_("boolean") == want)
        return is_("string") & (v.as_("string") == want) if isinstance(want, str) else is_("number") & (v.as_("double") == float(want))

    found: list[Column] = []
    if "type" in schema:
        types = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        found.append(fault(~reduce(Column.__or__, map(of, types)), "type"))
    for rule, wants in (("const", [schema["const"]] if "const" in schema else None), ("enum", schema.get("enum"))):
        if wants is not None:
            found.append(fault(~reduce(Column.__or__, [F.coalesce(equals(w), F.lit(False)) for w in wants]), rule))
    text, number = v.as_("string"), v.as_("double")
    for rule, applies, broken in (
        ("pattern", "string", lambda w: ~text.rlike(w)), ("minLength", "string", lambda w: F.char_length(text) < w), ("maxLength", "string", lambda w: F.char_length(text) > w),
        ("minimum", "number", lambda w: number < w), ("maximum", "number", lambda w: number > w),
    ):
        if rule in schema:
            found.append(fault(is_(applies) & broken(schema[rule]), rule))
    parts = schema.get("properties", {})
    if parts or "required" in schema or schema.get("additionalProperties") is False:
        keys = F.map_keys(v.as_("map<string, variant>"))
        found += [fault(is_("object") & ~F.array_contains(keys, name), f"lacks {name}") for name in schema.get("required", [])]
        if schema.get("additionalProperties") is False:
            extra = F.array_min(F.array_except(keys, F.array(*map(F.lit, parts)) if parts else F.array().cast("array<string>")))
            found.append(F.when(is_("object") & extra.isNotNull(), F.concat(v.told, F.lit(": may not have "), extra)))
        for name, part in parts.items():
            at = v.key(name)
            found.append(F.when(is_("object") & F.array_contains(keys, name), _fault(part, at, whole, seen)))
    if {"items", "minItems", "maxItems", "uniqueItems"} & set(schema):
        items = v.as_("array<variant>")
        for rule, broken in (("minItems", lambda w: F.size(items) < w), ("maxItems", lambda w: F.size(items) > w)):
            if rule in schema:
                found.append(fault(is_("array") & broken(schema[rule]), rule))
        if schema.get("uniqueItems"):
            told = F.transform(items, lambda x: F.to_json(x))
            found.append(fault(is_("array") & (F.size(F.array_distinct(told)) < F.size(items)), "uniqueItems"))
        if "items" in schema:
            place = lambda i: F.concat(v.told, F.lit("["), i.cast("string"), F.lit("]"))
            each = F.filter(F.transform(items, lambda x, i: _fault(schema["items"], _Value(x, told=place(i)), whole, seen)), lambda f: f.isNotNull())
            found.append(F.when(is_("array"), F.get(each, F.lit(0))))
    if "oneOf" in schema:
        fits = [F.when(_fault(s, v, whole, seen).isNull(), 1).otherwise(0) for s in schema["oneOf"]]
        found.append(fault(reduce(Column.__add__, fits) != 1, "oneOf"))
    return _first(found)


def first_fault(text: str | Column, schema: dict) -> Column:
    """The path of the first fault of JSON text and the rule it breaks (``$.a.b[2]: pattern``); null for a good document."""
    document = F.try_parse_json(F.col(text) if isinstance(text, str) else text)
    return _once(document, lambda d: F.when(d.isNull(), "$: json").otherwise(_fault(schema, _Value(d), schema, ())))


def violations(df: DataFrame, text: str, schema: dict) -> DataFrame:
    """fault, rows: how many documents have each fault; places in lists are told as ``[*]``."""
    fault = F.regexp_replace(first_fault(text, schema), r"\[\d+\]", "[*]")
    return df.select(fault.alias("fault")).where("fault IS NOT NULL").groupBy("fault").agg(F.count("*").alias("rows"))

import json

import pytest

from millrace.operators import contracts

SCHEMA = {
    "$defs": {
        "id": {"type": "string", "pattern": "^[a-z][0-9]+$"},
        "part": {"type": "object", "required": ["kind"], "properties": {"kind": {"enum": ["text", "image", 7, None, True]}, "size": {"type": "integer", "minimum": 0, "maximum": 9}}, "additionalProperties": False},
    },
    "type": "object", "required": ["id", "parts"], "additionalProperties": False,
    "properties": {
        "id": {"$ref": "#/$defs/id"}, "note": {"type": ["string", "null"], "maxLength": 3}, "version": {"const": 2},
        "parts": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"$ref": "#/$defs/part"}},
        "deep": {"type": "object", "properties": {"er": {"type": "object", "properties": {"most": {"type": "array", "items": {"type": "array", "items": {"$ref": "#/$defs/id"}}}}}}},
        "either": {"oneOf": [{"type": "string"}, {"type": "object", "required": ["a"]}, {"type": "object", "required": ["b"]}]},
    },
}
GOOD = {"id": "a1", "parts": [{"kind": "text", "size": 3}]}


@pytest.mark.parametrize(
    ("document", "fault"),
    [
        (GOOD, None), ({**GOOD, "note": None, "version": 2.0, "either": "x"}, None), ({**GOOD, "either": {"a": 1}}, None),
        ({**GOOD, "parts": [{"kind": 7}, {"kind": None}, {"kind": True, "size": 2.0}]}, None),
        ([], "$: type"), ({"parts": []}, "$: lacks id"), ({"id": "a1"}, "$: lacks parts"), ({**GOOD, "zz": 1, "yy": 1}, "$: may not have yy"),
        ({**GOOD, "id": 5}, "$.id: type"), ({**GOOD, "id": "A1"}, "$.id: pattern"), ({**GOOD, "note": "long"}, "$.note: maxLength"), ({**GOOD, "note": "äöü"}, None), ({**GOOD, "version": "2"}, "$.version: const"),
        ({**GOOD, "parts": []}, "$.parts: minItems"), ({**GOOD, "parts": [{"kind": "text"}] * 2}, "$.parts: uniqueItems"), ({**GOOD, "parts": [{"kind": "text", "size": i} for i in range(4)]}, "$.parts: maxItems"),
        ({**GOOD, "parts": [{"kind": "text"}, {"size": 1}]}, "$.parts[1]: lacks kind"), ({**GOOD, "parts": [{"kind": "text", "size": 10}]}, "$.parts[0].size: maximum"), ({**GOOD, "parts": [{"kind": "text", "size": -1}]}, "$.parts[0].size: minimum"),
        ({**GOOD, "parts": [{"kind": "text", "size": 1.5}]}, "$.parts[0].size: type"), ({**GOOD, "parts": [{"kind": "text", "size": "1"}]}, "$.parts[0].size: type"), ({**GOOD, "parts": [{"kind": "video"}]}, "$.parts[0].kind: enum"),
        ({**GOOD, "parts": [{"kind": "text", "x": 1}]}, "$.parts[0]: may not have x"), ({**GOOD, "deep": {"er": {"most": [["a1"], ["b2", "c"]]}}}, "$.deep.er.most[1][1]: pattern"), ({**GOOD, "deep": {"er": []}}, "$.deep.er: type"),
        ({**GOOD, "either": 3}, "$.either: oneOf"), ({**GOOD, "either": {"a": 1, "b": 2}}, "$.either: oneOf"), ({**GOOD, "id": "A", "note": 5}, "$.id: pattern"), (None, "$: type"), ({**GOOD, "parts": {"kind": "text"}}, "$.parts: type"),
    ],
)
def test_first_fault(spark, document, fault):
    frame = spark.createDataFrame([(json.dumps(document),)], "text string")
    assert frame.select(contracts.first_fault("text", SCHEMA)).first()[0] == fault


def test_what_is_not_json(spark):
    frame = spark.createDataFrame([("{",), (None,), ("",), ('{"id": "a1", "parts": [{"kind": "text"}]}',)], "text string")
    assert [r[0] for r in frame.select(contracts.first_fault("text", SCHEMA)).collect()] == ["$: json"] * 3 + [None]
    assert [tuple(r) for r in contracts.violations(frame, "text", SCHEMA).collect()] == [("$: json", 3)]
    assert contracts.violations(frame.limit(0), "text", SCHEMA).count() == 0


@pytest.mark.parametrize("schema", [{"if": {}}, {"properties": {"a": {"format": "date"}}}, {"$ref": "http://x"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}])
def test_schemas_that_are_refused(spark, schema):
    with pytest.raises(ValueError):
        contracts.first_fault("text", schema)

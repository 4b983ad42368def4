"""Queries on nested contracts: documents of JSON made from conversations and events, some with faults at every depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import contracts
from millrace.plans.catalog import table
from millrace.plans.registry import query

TURN = {
    "$defs": {"part": {"oneOf": [
        {"type": "object", "required": ["kind", "size"], "properties": {"kind": {"const": "text"}, "size": {"type": "integer", "minimum": 0}}, "additionalProperties": False},
        {"type": "object", "required": ["kind", "tags"], "properties": {"kind": {"const": "meta"}, "tags": {"type": "array", "items": {"type": "string"}, "maxItems": 2}}, "additionalProperties": False},
    ]}, "name": {"type": "string", "pattern": "^c[0-9]+$"}},
    "type": "object", "required": ["id", "turn"], "additionalProperties": False,
    "properties": {"id": {"$ref": "#/$defs/name"}, "turn": {
        "type": "object", "required": ["index", "role"], "additionalProperties": False,
        "properties": {"index": {"type": "integer"}, "role": {"enum": ["user", "assistant", "system"]}, "labels": {"type": "array", "items": {"type": "array", "items": {"type": "string", "pattern": "^t"}}}, "parts": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/part"}}},
    }},
}
#: A row's JSON; h picks what is wrong with it.
TURN_JSON = """concat('{"id":"', CASE WHEN h % 31 = 6 THEN 'x' ELSE 'c' END, conv_id, '","turn":{', CASE WHEN h % 23 = 4 THEN '' ELSE concat('"index":', turn, ',') END, '"role":"', CASE WHEN h % 11 = 0 THEN 'robot' ELSE 'user' END, '"', CASE WHEN h % 19 = 3 THEN ',"zz":1' ELSE '' END,
 ',"labels":[["t1"],["t2","', CASE WHEN h % 17 = 2 THEN 'x' ELSE 't3' END, '"]],"parts":[{"kind":"text","size":', CASE WHEN h % 13 = 1 THEN '"1"' ELSE CAST(coalesce(length(text), 0) AS STRING) END, '},{"kind":"meta","tags":["a"', CASE WHEN h % 37 = 7 THEN ',1' ELSE '' END, ']}]', CASE WHEN h % 29 = 5 THEN '' ELSE '}}' END)"""
TURN_FAULT = """CASE WHEN h % 29 = 5 THEN '$: json' WHEN h % 31 = 6 THEN '$.id: pattern' WHEN h % 23 = 4 THEN '$.turn: lacks index' WHEN h % 19 = 3 THEN '$.turn: may not have zz' WHEN h % 11 = 0 THEN '$.turn.role: enum'
 WHEN h % 17 = 2 THEN '$.turn.labels[1][1]: pattern' WHEN h % 13 = 1 THEN '$.turn.parts[0]: oneOf' WHEN h % 37 = 7 THEN '$.turn.parts[1]: oneOf' END"""


@query("jsn_04_nested_conversations", f"SELECT conv_id, turn, fault FROM (SELECT conv_id, turn, {TURN_FAULT} AS fault FROM (SELECT *, conv_id * 31 + turn AS h FROM conversations)) WHERE fault IS NOT NULL")
def jsn_04_conversations(spark: SparkSession, d: str) -> DataFrame:
    """The first fault of each turn that has one."""
    turns = table(spark, d, "conversations").selectExpr("*", "conv_id * 31 + turn AS h").selectExpr("conv_id", "turn", f"{TURN_JSON} AS doc")
    return turns.select("conv_id", "turn", contracts.first_fault("doc", TURN).alias("fault")).where("fault IS NOT NULL")


EVENT = {
    "type": "object", "required": ["event"],
    "properties": {"event": {"type": "object", "required": ["id", "user"], "properties": {
        "id": {"type": "integer"}, "user": {"type": "object", "properties": {"key": {"type": "string", "pattern": "^u"}, "values": {"type": "array", "uniqueItems": True, "items": {"type": ["number", "null"], "maximum": 60}}}, "additionalProperties": False},
    }}},
}
EVENT_JSON = """concat('{"event":{"id":', event_id, CASE WHEN event_id % 41 = 1 THEN '.5' ELSE '' END, ',"user":{"key":"u', user_id, '","values":[', coalesce(CAST(value AS STRING), 'null'), ',-1', CASE WHEN event_id % 43 = 2 THEN ',-1' ELSE '' END, ']', CASE WHEN event_id % 47 = 3 THEN ',"b":0,"a":0' ELSE '' END, '}}}')"""
EVENT_FAULT = """CASE WHEN event_id % 41 = 1 THEN '$.event.id: type' WHEN event_id % 47 = 3 THEN '$.event.user: may not have a' WHEN event_id % 43 = 2 THEN '$.event.user.values: uniqueItems' WHEN value > 60 THEN '$.event.user.values[*]: maximum' END"""


@query("jsn_04_nested_events", f'SELECT fault, count(*) AS "rows" FROM (SELECT {EVENT_FAULT} AS fault FROM events) WHERE fault IS NOT NULL GROUP BY fault')
def jsn_04_events(spark: SparkSession, d: str) -> DataFrame:
    """How many events have each fault."""
    return contracts.violations(table(spark, d, "events").selectExpr(f"{EVENT_JSON} AS doc"), "doc", EVENT)

"""Compiled schemas on documents of every fault."""

import json

import pytest

from quillmark.operators import json_schema as J

SCHEMA = {
    "title": "run", "type": "object", "additionalProperties": False, "required": ["runId", "status", "searches"],
    "properties": {
        "runId": {"type": "string", "pattern": "^run-[0-9a-f]{4}$"}, "status": {"enum": ["running", "done"]}, "cursor": {"type": ["string", "integer", "null"]}, "n": {"type": "integer", "minimum": 0, "maximum": 9}, "note": {"type": "string", "minLength": 2},
        "searches": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["id"], "properties": {"id": {"type": "string"}, "hits": {"type": "integer"}, "tags": {"type": "array", "items": {"type": "string"}}}}},
    },
}
GOOD = {"runId": "run-00af", "status": "done", "cursor": None, "n": 3, "searches": [{"id": "a", "hits": 2, "tags": ["x"], "more": 1}]}
CASES = [
    (GOOD, []), ({**GOOD, "cursor": 5, "n": 2.0}, []), ({**GOOD, "cursor": 1.5}, ["cursor: is not string or integer or null"]), ({**GOOD, "runId": "RUN"}, ["runId: does not match"]), ({**GOOD, "status": "x"}, ["status: is none of the values"]),
    ({**GOOD, "n": 10}, ["n: is beyond its maximum"]), ({**GOOD, "n": -1, "note": "x"}, ["n: is beyond its minimum", "note: is too short"]), ({**GOOD, "zz": 1, "y y": 2}, ["<root>: has also y y", "<root>: has also zz"]), ({}, ["<root>: lacks runId", "<root>: lacks searches", "<root>: lacks status"]),
    ({**GOOD, "searches": []}, ["searches: has too few items"]), ({**GOOD, "searches": [{"id": 1}, 7, {"id": "b", "tags": ["x", 2]}, {}]}, ["searches/0/id: is not string", "searches/1: is not object", "searches/2/tags/1: is not string", "searches/3: lacks id"]),
    ([], ["<root>: is not object"]), ("x", ["<root>: is not object"]), (None, ["<root>: is not object"]), ({**GOOD, "status": None}, ["status: is none of the values"]),
]


def test_every_fault_is_named_at_its_place(spark):
    rows = [(i, json.dumps(doc)) for i, (doc, _) in enumerate(CASES)] + [(98, "{bad"), (99, None)]
    frame = spark.createDataFrame(rows, "i int, t string")
    got = {r["i"]: r["e"] for r in frame.select("i", J.validate(frame["t"], SCHEMA).alias("e")).collect()}
    assert got == {i: e for i, (_, e) in enumerate(CASES)} | {98: ["<root>: is no JSON"], 99: ["<root>: is no JSON"]}


def test_what_is_not_checked_is_refused():
    for schema in ({"oneOf": []}, {"properties": {"a": {"not": {}}}}, {"enum": [1]}, {"additionalProperties": {"type": "string"}}):
        with pytest.raises(ValueError):
            J.validate(__import__("pyspark.sql.functions", fromlist=["lit"]).lit("{}"), schema)

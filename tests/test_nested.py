from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from loomline.operators.nested import BRACKETS, _is_deep, argument_table, call_table, leaf_paths, parameter_table

SCHEMA = (
    "sample_id bigint, tool_calls array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>, tools array<string>, ingested_at timestamp,"
    " id string, seen int, path string, rows string"
)


def frame(spark, *rows):
    return spark.createDataFrame([(i, c, t, None, "x", 1, "y", "z") for i, c, t in rows], SCHEMA)


def call(arguments, name="f"):
    return ("c", "function", (name, arguments))


def leaves(df):
    return {tuple(r) for r in leaf_paths(df).collect()}


def test_scalars_arrays_and_nulls(spark):
    args = json.dumps({"a": 1, "b": {"c": [True, None, {"d": "x"}]}, "e": {}, "f": []})
    df = frame(spark, (1, [None, call(args), call(None), ("c", None, None)], None))
    assert leaves(df) == {(1, "tool_calls", 1, p) for p in ("a", "b.c.0", "b.c.1", "b.c.2.d")}


def test_json_in_a_string_counts_once(spark):
    inner = json.dumps({"a": '{"not": "read"}'})
    df = frame(spark, (1, [call(json.dumps(inner))], None), (2, [call('{"broken": ')], None), (3, [call("7"), call('"word"')], None))
    assert leaves(df) == {(1, "tool_calls", 0, "a"), (3, "tool_calls", 0, ""), (3, "tool_calls", 1, "")}


def test_parameters_at_any_depth_and_wrapping(spark):
    inner = {"type": "object", "properties": {"q": {"type": "string"}, "f": {"type": "array", "items": {"type": "object", "properties": {"op": {"type": "string"}, "deep": {"properties": {"z": {}}}}}}}}
    tools = [json.dumps({"type": "function", "function": {"name": "n", "parameters": inner}}), json.dumps({"name": "n", "input_schema": inner}), json.dumps({"name": "n", "parameters": inner}), None, "{", json.dumps({"name": "bare"})]
    want = {"q", "f", "f.op", "f.deep", "f.deep.z"}
    got = leaves(frame(spark, (1, None, tools)))
    assert got == {(1, "tools", k, p) for k in (0, 1, 2) for p in want}


def test_deep_nesting_is_followed_to_its_end(spark):
    v = 1
    for k in range(14):
        v = {f"k{k}": v} if k % 2 else [v]
    got = leaves(frame(spark, (1, [call(json.dumps(v))], None)))
    assert len(got) == 1 and len(next(iter(got))[3].split(".")) == 14


def test_repeated_keys_count_once(spark):
    assert leaves(frame(spark, (1, [call('{"a": 1, "a": {"b": 2}}')], None))) == {(1, "tool_calls", 0, "a.b")}


def test_depth_is_told_by_the_text(spark):
    at, over = "[" * BRACKETS + "]" * BRACKETS, "[" * (BRACKETS + 1) + "]" * (BRACKETS + 1)
    many = "[" + ", ".join(['{"a": "}}{{[\\\\\\"["}'] * 40) + "]"
    df = spark.createDataFrame([("1",), (many,), (at,), (over,), ('{"a": [' + at + ", 1]}",), ("[][[]]{}" * 10,), (f'"{over}"' + "[]" * 20,)], "j string")
    assert [r[0] for r in df.select(_is_deep(F.col("j"))).collect()] == [False, False, False, True, True, False, False]


def test_redelivered_samples_count_once_and_null_keys_are_left_out(spark):
    row = (1, [call('{"a": 1}')], None)
    df = frame(spark, row, row, (None, [call('{"a": 1}')], None))
    assert [tuple(r) for r in leaf_paths(df).collect()] == [(1, "tool_calls", 0, "a")]


@pytest.mark.parametrize("table", [leaf_paths, call_table, argument_table, parameter_table])
def test_empty_table(spark, table):
    assert table(frame(spark).limit(0)).count() == 0
    assert table(frame(spark, (1, None, None), (2, [], []))).count() == 0


def test_every_node_has_its_parent(spark):
    df = frame(spark, (1, [call('{"a": [{"b": 1}, 2]}')], None))
    rows = argument_table(df).collect()
    paths = {(r["pos"], r["path"]) for r in rows}
    assert all(r["parent_path"] is None or (r["pos"], r["parent_path"]) in paths for r in rows)
    assert {(r["path"], r["kind"], r["value"]) for r in rows} == {("", "object", None), ("a", "array", None), ("a.0", "object", None), ("a.0.b", "scalar", "1"), ("a.1", "scalar", "2")}


def test_very_long_arguments(spark):
    big = json.dumps({"a": ["x" * 1000] * 2000})
    assert leaf_paths(frame(spark, (1, [call(big)], None))).count() == 2000


def test_arrays_of_arrays_and_combined_schemas(spark):
    z = {"type": "object", "properties": {"z": {"type": "string"}}}
    deep = {"properties": {"a3": {"type": "array", "items": {"type": "array", "items": {"type": "array", "items": z}}}, "a5": {"items": {"items": {"items": {"items": {"items": z}}}}}}}
    some = {"properties": {"any": {"anyOf": [{"type": "string"}, z, {"type": "array", "items": z}]}, "all": {"allOf": [{"oneOf": [z]}]}, "map": {"additionalProperties": z}, "ref": {"$ref": "#/$defs/z"}, "loop": {"$ref": "#/$defs/loop"}}, "$defs": {"z": z, "loop": {"properties": {"next": {"$ref": "#/$defs/loop"}}}}}
    tools = [json.dumps({"parameters": deep}), json.dumps({"parameters": some}), json.dumps({"name": "n", "schema": z}), json.dumps({"toolSpec": {"inputSchema": {"json": z}}})]
    got = leaves(frame(spark, (1, None, tools), (2, None, [json.dumps({"parameters": z})])))
    want = {(0, "a3"), (0, "a3.z"), (0, "a5"), (0, "a5.z"), (2, "z"), (3, "z"), *((1, p) for p in ("any", "any.z", "all", "all.z", "map", "map.z", "ref", "ref.z", "loop", "loop.next"))}
    assert got == {(1, "tools", *w) for w in want} | {(2, "tools", 0, "z")}
    assert {(r["pos"], r["path"]) for r in parameter_table(frame(spark, (1, None, tools))).collect()} == want


def test_walked_and_projected_rows_are_the_same(spark):
    given = {"a": [1, 2.5, {"b": None, "c": "x", "d": [True, []]}], "e": {"f": {}, "g": "1"}, "n": -3, "": {"k": 0}}
    rows = [(1, [call(json.dumps(given)), None, call(json.dumps(json.dumps(given))), call("[["), call(None), call('"w"')], None)]
    got = sorted((r["pos"], r["path"], r["kind"], r["value"]) for r in argument_table(frame(spark, *rows)).collect())
    deep = 1
    for _ in range(20):
        deep = [deep]
    both = argument_table(frame(spark, (1, [*rows[0][1], call(json.dumps(deep))], None))).where("pos < 6").collect()
    assert got == sorted((r["pos"], r["path"], r["kind"], r["value"]) for r in both) and len(got) > 20


def test_one_very_deep_record_among_others(spark):
    deep = 1
    for _ in range(500):
        deep = {"k": deep}
    got = leaves(frame(spark, (1, [call(json.dumps(deep))], None), (2, [call('{"a": 1}')], None), (3, [call(json.dumps(json.dumps(deep)))], None)))
    path = ".".join(["k"] * 500)
    assert got == {(1, "tool_calls", 0, path), (2, "tool_calls", 0, "a"), (3, "tool_calls", 0, path)}


def test_the_latest_delivery_counts(spark):
    from datetime import datetime

    rows = [(1, [call('{"old": 1}')], None, datetime(2025, 1, 1)), (1, [call('{"new": 1}')], None, datetime(2025, 1, 2)), (2, [call('{"b": 1}')], None, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)
    assert leaves(df) == {(1, "tool_calls", 0, "new"), (2, "tool_calls", 0, "b")}

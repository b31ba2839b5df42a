"""Deeply nested JSON columns as related flat tables.

Each JSON text is read once into a variant. A table is made by one projection of higher-order
functions: at every level a ``transform`` turns the open nodes into their children, attaching the
record's array position, the path, the parent and the place in the parent; ``flatten`` joins the children
into the next level; and one ``inline`` for each target table emits the rows. Higher-order functions
don't recurse, so the projection is unrolled to ``BRACKETS`` levels of brackets. Records with deeper texts, or with
schemas that refer, choose or combine (``$ref``, ``anyOf`` and the like) or are wrapped in an unknown way, are told by their
text and walked in Arrow batches; so no level is cut off, and one deep record doesn't lengthen the plan for all.

Only records that were delivered more than once, or are walked, are joined and reduced; all others go from the scan to
their rows without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.deliveries import latest
from loomline.plans.scratch import materialize

# What a tool may be wrapped in, and by which names it keeps its parameter schema.
TOOL_WRAPS = ("function", "tool", "toolSpec")
SCHEMA_KEYS = ("parameters", "input_schema", "inputSchema", "args_schema")
SCHEMA_WRAP = "json"
# What a schema may hold beside ``properties`` and ``items`` that holds schemas in turn.
LISTS, SINGLES = ("anyOf", "oneOf", "allOf", "prefixItems"), ("additionalProperties", "if", "then", "else", "not", "contains")

#: Levels of brackets the projection is unrolled to.
BRACKETS = 12
_WALKED = r'"(?:anyOf|oneOf|allOf|prefixItems|if|then|else|not|contains|\$ref)"\s*:\s*[\[{"]|"(?:additionalProperties)"\s*:\s*\{|"items"\s*:\s*\['
_KNOWN = r'"(?:parameters|input_schema|inputSchema|args_schema)"\s*:'

_KEYED = "map<string,variant>"
_LISTED = "array<variant>"
NODES = "array<struct<pos:int,path:string,parent:string,key:string,index:int,value:variant>>"


def _get(v: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(v, path, kind)


def parsed(text: Column) -> Column:
    """The JSON in ``text`` as a variant; a JSON string that holds JSON is that JSON; null where unreadable."""
    outer = F.try_parse_json(text)
    # A number has a string form too; only a text in quotes is read again.
    return F.when(F.ltrim(text).startswith('"'), F.coalesce(F.try_parse_json(_get(outer, "string")), outer)).otherwise(outer)


def _node(pos: Column, path: Column, parent: Column | None, key: Column | None, index: Column | None, value: Column) -> Column:
    none = F.lit(None)
    return F.struct(
        pos.alias("pos"), path.alias("path"), (none.cast("string") if parent is None else parent).alias("parent"), (none.cast("string") if key is None else key).alias("key"),
        (none.cast("int") if index is None else index).alias("index"), value.alias("value"),
    )


def _join(path: Column, step: Column) -> Column:
    return F.when(path == "", step).otherwise(F.concat(path, F.lit("."), step))


def _members(n: Column) -> Column:
    return F.transform(F.map_entries(_get(n["value"], _KEYED)), lambda e: _node(n["pos"], _join(n["path"], e["key"]), n["path"], e["key"], None, e["value"]))


def _elements(n: Column) -> Column:
    return F.transform(_get(n["value"], _LISTED), lambda e, i: _node(n["pos"], _join(n["path"], i.cast("string")), n["path"], None, i, e))


def _none() -> Column:
    return F.array().cast(NODES)


def _children(nodes: Column) -> Column:
    """The next level: the members of objects and the elements of arrays."""
    return F.flatten(F.transform(nodes, lambda n: F.coalesce(_members(n), _elements(n), _none())))


def _declared(nodes: Column) -> Column:
    """The parameters the schemas of ``nodes`` declare, and, under their parent's path, the items of arrays of arrays."""
    properties = lambda v: F.coalesce(_get(v, _KEYED, "$.properties"), _get(v, _KEYED, "$.items.properties"))
    named = lambda n: F.transform(F.map_entries(properties(n["value"])), lambda e: _node(n["pos"], _join(n["path"], e["key"]), n["path"], e["key"], None, e["value"]))
    inner = lambda n: _get(n["value"], "variant", "$.items.items")
    through = lambda n: F.when(inner(n).isNotNull(), F.array(_node(n["pos"], n["path"], None, None, None, inner(n))))
    return F.flatten(F.transform(nodes, lambda n: F.concat(F.coalesce(named(n), _none()), F.coalesce(through(n), _none()))))


def _levels(df: DataFrame, top: Column, step: Callable[[Column], Column], depth: int, name: str) -> tuple[DataFrame, list[str]]:
    """``df`` with a column of nodes for each level from the roots down."""
    out, names = df.withColumn(f"{name}0", F.coalesce(top, _none())), [f"{name}0"]
    for k in range(1, depth + 1):
        out = out.withColumn(f"{name}{k}", step(F.col(names[-1])))
        names.append(f"{name}{k}")
    return out, names


#: Where a tool keeps its parameter schema, the first place that there is.
PLACES = [".".join([*w, k, *x]) for x in ([SCHEMA_WRAP], []) for w in ([], *([w] for w in TOOL_WRAPS)) for k in SCHEMA_KEYS]


def call_roots(calls: Column) -> Column:
    """One root for each call whose arguments can be read; ``pos`` is the call's place, null elements keep theirs."""
    roots = F.transform(calls, lambda c, i: _node(i, F.lit(""), None, None, None, parsed(c["function"]["arguments"])))
    return F.filter(roots, lambda n: n["value"].isNotNull())


def tool_roots(tools: Column) -> Column:
    """One root, its parameter schema, for each tool whose JSON can be read and which declares one."""
    places = ["$." + p for p in PLACES]
    schema = lambda v: F.coalesce(*[_get(v, "variant", p) for p in places])
    read = F.transform(tools, lambda t, i: _node(i, F.lit(""), None, None, None, parsed(t)))
    return F.filter(F.transform(read, lambda n: _node(n["pos"], n["path"], None, None, None, schema(n["value"]))), lambda n: n["value"].isNotNull())


def _is_open(v: Column) -> Column:
    return _get(v, _KEYED).isNotNull() | _get(v, _LISTED).isNotNull()


def _raw(text: Column) -> Column:
    """The JSON in ``text`` as text, that in a JSON string without its quotes."""
    return F.when(F.ltrim(text).startswith('"'), F.coalesce(_get(F.try_parse_json(text), "string"), text)).otherwise(text)


def _is_deep(text: Column) -> Column:
    """Whether the text may have more levels than the projection; one with few brackets is told without looking at their order.

    Strings and all but the brackets are taken away, then innermost pairs, a level at a time; what is left is deeper, or no JSON.
    """
    opened = F.length(text) - F.length(F.translate(text, "{[", ""))
    left = F.translate(F.regexp_replace(F.regexp_replace(text, r"\\.", ""), r'"[^"]*+"|[^{}\[\]"]++', ""), "[]", "{}")
    for _ in range(BRACKETS):
        left = F.replace(left, F.lit("{}"), F.lit(""))
    return F.when(opened <= BRACKETS, F.lit(False)).otherwise(left.contains("{"))


def _walked(calls: Column, tools: Column) -> Column:
    """Whether a record is walked: its texts are too deep, or its schemas are of a kind the projection doesn't follow."""
    odd = lambda t: t.rlike(_WALKED) | (t.contains('"properties"') & ~t.rlike(_KNOWN))
    return F.coalesce(F.exists(calls, lambda c: F.coalesce(_is_deep(_raw(c["function"]["arguments"])), F.lit(False))), F.lit(False)) | F.coalesce(
        F.exists(tools, lambda t: F.coalesce(_is_deep(_raw(t)) | odd(_raw(t)), F.lit(False))), F.lit(False)
    )


def _rows(df: DataFrame, key: str, calls: str | None, tools: str | None, order: str, project: Callable[[DataFrame], DataFrame], walk: Callable[[list, list], list[dict]], kind: str) -> DataFrame:
    """``key`` and the flat rows of each record's latest delivery.

    ``project`` gives ``id, seen, rows``, the rows as an array, ``walk`` the same in Python for the records that need it. Which
    records these are, and which were delivered more than once, is written first: the planner knows their number.
    """
    no_calls, no_tools = "array<struct<function:struct<arguments:string>>>", "array<string>"
    base = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.col(order).alias("seen"), F.col(calls).alias("calls") if calls else F.lit(None).cast(no_calls).alias("calls"), F.col(tools).alias("tools") if tools else F.lit(None).cast(no_tools).alias("tools"),
    )
    marks = base.select("id", _walked(F.col("calls"), F.col("tools")).alias("walked")).groupBy("id").agg(F.count("*").alias("n"), F.max("walked").alias("walked"))
    marks = materialize(marks.where("n > 1 or walked"), "nested-marks")
    kinds = dict(base.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [walk([] if a is None else list(a), [] if t is None else list(t)) for a, t in zip(pdf["arguments"], pdf["tools"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"], "seen": pdf["seen"], "rows": pd.Series(made, dtype="object")})

    once = base.join(marks, "id", "left_anti")
    again = latest(base.join(marks.where("not walked"), "id", "left_semi"), "id", "seen")
    odd = base.join(marks.where("walked"), "id", "left_semi").select("id", "seen", F.transform("calls", lambda c: c["function"]["arguments"]).alias("arguments"), "tools")
    odd = latest(odd.mapInPandas(run, f"id {kinds['id']}, seen {kinds['seen']}, rows array<{kind}>"), "id", "seen")
    out = project(once.unionByName(again)).unionByName(odd)
    # For a plain ``inline`` the planner would ask first whether there are rows, by making them once more without sharing anything.
    return out.select(F.col("id").alias(key), F.inline_outer("rows")).where("pos is not null")


def _read(text: str | None) -> tuple[bool, object]:
    """Whether a JSON text can be read, and what it says; numbers stay texts of their own kind."""

    def refuse(x: str) -> None:
        raise ValueError(x)

    try:
        value = json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=refuse) if text is not None else None
        if type(value) is str:
            try:
                value = json.loads(value, parse_float=_Number, parse_int=_Number, parse_constant=refuse)
            except (ValueError, RecursionError):
                pass
        return text is not None, value
    except (ValueError, RecursionError):
        return False, None


class _Number(str):
    """The text of a number."""


def _nodes(arguments: list) -> Iterator[tuple[int, str, str | None, str | None, int | None, object]]:
    """Position, path, parent, key, index and value of every node of all readable arguments."""
    for pos, text in enumerate(arguments):
        known, value = _read(text)
        open_nodes = [("", None, None, None, value)] if known else []
        while open_nodes:
            path, parent, key, index, value = open_nodes.pop()
            yield pos, path, parent, key, index, value
            step = lambda x, path=path: f"{path}.{x}" if path else str(x)
            if isinstance(value, dict):
                open_nodes += [(step(k), path, k, None, v) for k, v in value.items()]
            elif isinstance(value, list):
                open_nodes += [(step(i), path, None, i, v) for i, v in enumerate(value)]


def _at(value: object, path: str) -> object:
    for step in path.split("."):
        value = value.get(step) if isinstance(value, dict) else None
    return value


def _schema(tool: object) -> object:
    """The tool's parameter schema: at a known place, else the first object with properties, level by level."""
    for place in PLACES:
        if (found := _at(tool, place)) is not None:
            return found
    level = [tool]
    while level:
        for x in level:
            if isinstance(x, dict) and isinstance(x.get("properties"), dict):
                return x
        level = [v for x in level for v in (x.values() if isinstance(x, dict) else x if isinstance(x, list) else ())]
    return None


def _parameters(tools: list) -> Iterator[tuple[int, str, str, str, object]]:
    """Position, path, parent path, name and schema of every declared parameter, each path once; a local reference is followed unless it leads to itself."""
    for pos, text in enumerate(tools):
        known, tool = _read(text)
        root = _schema(tool) if known else None
        todo: list[tuple[str, object, tuple[str, ...]]] = [("", root, ())]
        seen: set[str] = set()
        while todo:
            path, v, refs = todo.pop()
            if not isinstance(v, dict):
                continue
            if isinstance(v.get("properties"), dict):
                for name, x in v["properties"].items():
                    own = f"{path}.{name}" if path else name
                    if own not in seen:
                        seen.add(own)
                        yield pos, own, path, name, x
                    todo.append((own, x, refs))
            ref = v.get("$ref")
            if isinstance(ref, str) and ref.startswith("#/") and ref not in refs:
                for start in (root, tool):
                    if (found := _at(start, ref[2:].replace("/", "."))) is not None:
                        todo.append((path, found, (*refs, ref)))
                        break
            items = v.get("items")
            todo += [(path, x, refs) for x in (items if isinstance(items, list) else [items])]
            todo += [(path, x, refs) for k in LISTS for x in (v[k] if isinstance(v.get(k), list) else [])]
            todo += [(path, v.get(k), refs) for k in SINGLES]


def leaf_paths(df: DataFrame, key: str = "sample_id", calls: str = "tool_calls", tools: str = "tools", order: str = "ingested_at") -> DataFrame:
    """``key, holder, pos, leaf_path``: the scalars of all call arguments and the parameters of all tools.

    ``holder`` is ``tool_calls`` or ``tools`` and ``pos`` the place in that array from 0. The path of a scalar joins keys and array
    places, that of a parameter only names; a scalar root has the path ``""``. JSON null is a scalar, empty objects and arrays give
    nothing. Null or unreadable JSON, null elements and null arrays give no rows. Redelivered records count once, by their latest
    delivery. An empty table gives no rows; further columns are ignored.
    """
    leaf = lambda holder: lambda n: F.struct(F.lit(holder).alias("holder"), n["pos"].alias("pos"), n["path"].alias("leaf_path"))

    def project(some: DataFrame) -> DataFrame:
        tree, calls_at = _levels(some, call_roots(F.col("calls")), _children, BRACKETS, "c")
        tree, tools_at = _levels(tree, tool_roots(F.col("tools")), _declared, BRACKETS // 2, "t")
        scalars = [F.transform(F.filter(F.col(c), lambda n: ~_is_open(n["value"])), leaf("tool_calls")) for c in calls_at]
        named = [F.transform(_named(F.col(t)), leaf("tools")) for t in tools_at[1:]]
        return tree.select("id", "seen", F.concat(*scalars, *named).alias("rows"))

    def walk(arguments: list, schemas: list) -> list[dict]:
        leaves = [{"holder": "tool_calls", "pos": p, "leaf_path": path} for p, path, _, _, _, v in _nodes(arguments) if not isinstance(v, (dict, list))]
        return leaves + [{"holder": "tools", "pos": p, "leaf_path": path} for p, path, _, _, _ in _parameters(schemas)]

    return _rows(df, key, calls, tools, order, project, walk, "struct<holder:string,pos:int,leaf_path:string>")


def call_table(df: DataFrame, key: str = "sample_id", calls: str = "tool_calls", order: str = "ingested_at") -> DataFrame:
    """``key, pos, call_id, call_type, name, arguments_readable``: one row a call; null elements keep their place and are rows of nulls."""
    base = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(order).alias("seen"), F.transform(
        F.col(calls), lambda c, i: F.struct(i.alias("pos"), c["id"].alias("call_id"), c["type"].alias("call_type"), c["function"]["name"].alias("name"), parsed(c["function"]["arguments"]).isNotNull().alias("arguments_readable"))
    ).alias("rows"))
    return latest(base, "id", "seen").select(F.col("id").alias(key), F.inline("rows"))


def argument_table(df: DataFrame, key: str = "sample_id", calls: str = "tool_calls", order: str = "ingested_at") -> DataFrame:
    """``key, pos, path, parent_path, key_name, array_index, kind, value``: every node of every call's arguments.

    ``parent_path`` names the row of the parent (``""`` is the root, which has a row too, with a null parent);
    ``kind`` is ``object``, ``array`` or ``scalar``; ``value`` is the text of a scalar, null for JSON null and for inner nodes.
    """

    def row(n: Column) -> Column:
        kind = F.when(_get(n["value"], _KEYED).isNotNull(), "object").when(_get(n["value"], _LISTED).isNotNull(), "array").otherwise("scalar")
        return F.struct(n["pos"].alias("pos"), n["path"].alias("path"), n["parent"].alias("parent_path"), n["key"].alias("key_name"), n["index"].alias("array_index"), kind.alias("kind"), F.when(kind == "scalar", _get(n["value"], "string")).alias("value"))

    def project(some: DataFrame) -> DataFrame:
        tree, at = _levels(some, call_roots(F.col("calls")), _children, BRACKETS, "c")
        return tree.select("id", "seen", F.concat(*[F.transform(F.col(c), row) for c in at]).alias("rows"))

    def walk(arguments: list, _: list) -> list[dict]:
        out = []
        for pos, path, parent, name, index, v in _nodes(arguments):
            kind = "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "scalar"
            value = None if kind != "scalar" or v is None else str(v).lower() if isinstance(v, bool) else str(v)
            out.append({"pos": pos, "path": path, "parent_path": parent, "key_name": name, "array_index": index, "kind": kind, "value": value})
        return out

    return _rows(df, key, calls, None, order, project, walk, "struct<pos:int,path:string,parent_path:string,key_name:string,array_index:int,kind:string,value:string>")


def parameter_table(df: DataFrame, key: str = "sample_id", tools: str = "tools", order: str = "ingested_at") -> DataFrame:
    """``key, pos, path, parent_path, name, type``: every declared parameter; ``parent_path`` is ``""`` for those of the tool itself."""
    row = lambda n: F.struct(n["pos"].alias("pos"), n["path"].alias("path"), n["parent"].alias("parent_path"), n["key"].alias("name"), _get(n["value"], "string", "$.type").alias("type"))

    def project(some: DataFrame) -> DataFrame:
        tree, at = _levels(some, tool_roots(F.col("tools")), _declared, BRACKETS // 2, "t")
        return tree.select("id", "seen", F.concat(*[F.transform(_named(F.col(t)), row) for t in at[1:]]).alias("rows"))

    def walk(_: list, schemas: list) -> list[dict]:
        kind = lambda x: x["type"] if isinstance(x, dict) and isinstance(x.get("type"), str) else None
        return [{"pos": p, "path": path, "parent_path": parent, "name": name, "type": kind(x)} for p, path, parent, name, x in _parameters(schemas)]

    return _rows(df, key, None, tools, order, project, walk, "struct<pos:int,path:string,parent_path:string,name:string,type:string>")


def _named(nodes: Column) -> Column:
    """Without the items of arrays of arrays, which have no name of their own."""
    return F.filter(nodes, lambda n: n["key"].isNotNull())

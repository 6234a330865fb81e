"""Which schemas read what others wrote, and how a value decoded with one becomes a value of another.

Trees are those of ``parse_avro``. Aliases are not followed. A logical type is part of a type, since it decides the column's.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.avro_types import (
    SchemaError,
    _per_distinct_text,
    parse_avro,
    spark_type,
    union_shape,
    value_branches,
)

# The wider types that a reader may have for a writer's.
PROMOTIONS = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
    "string": ("bytes",), "bytes": ("string",),
}


def unreadable(reader: dict, writer: dict, path: str = "") -> list[str]:
    """Why ``reader`` cannot read every value of ``writer``, as codes with paths; empty if it can."""
    if writer["kind"] == "union":
        return [reason for branch in writer["branches"] for reason in unreadable(reader, branch, path)]
    if reader["kind"] == "union":
        return [] if branch_for(reader["branches"], writer) is not None else [f"UNION {path}"]
    kind = reader["kind"]
    logical = [(n.get("logical"), n.get("precision"), n.get("scale")) for n in (reader, writer)]
    if logical[0] != logical[1]:
        return [f"TYPE {path}"]
    if kind != writer["kind"]:
        promoted = kind in PROMOTIONS.get(writer["kind"], ()) and logical[0][0] is None
        return [] if promoted else [f"TYPE {path}"]
    if "name" in reader and reader["name"].rpartition(".")[2] != writer["name"].rpartition(".")[2]:
        return [f"NAME {path}"]
    if kind == "array":
        return unreadable(reader["items"], writer["items"], f"{path}[]")
    if kind == "map":
        return unreadable(reader["values"], writer["values"], f"{path}{{}}")
    if kind == "fixed" and reader["size"] != writer["size"]:
        return [f"SIZE {path}"]
    if kind == "enum" and not set(writer["symbols"]) <= set(reader["symbols"]):
        return [f"SYMBOLS {path}"]
    found = []
    if kind == "record":
        written = dict(writer["fields"])
        for field, node in reader["fields"]:
            below = f"{path}.{field}" if path else field
            if field in written:
                found += unreadable(node, written[field], below)
            elif field not in reader["defaults"]:
                found.append(f"MISSING {below}")
    return found


def branch_for(branches: list[dict], writer: dict) -> int | None:
    """The branch that takes a writer's value: one of its own kind before a wider one."""
    fits = [i for i, branch in enumerate(branches) if not unreadable(branch, writer)]
    return min(fits, key=lambda i: (branches[i]["kind"] != writer["kind"], i), default=None)


def relation(reader: str, writer: str) -> str:
    """FULL, BACKWARD (``reader`` reads what ``writer`` wrote), FORWARD (the other way round) or NONE.

    INVALID if ``reader`` is no usable schema, UNKNOWN if only ``writer`` is none.
    """
    try:
        newer = parse_avro(reader)
    except SchemaError:
        return "INVALID"
    try:
        older = parse_avro(writer)
    except SchemaError:
        return "UNKNOWN"
    backward, forward = not unreadable(newer, older), not unreadable(older, newer)
    return {(True, True): "FULL", (True, False): "BACKWARD", (False, True): "FORWARD"}.get((backward, forward), "NONE")


def schema_relation(reader: Column, writer: Column) -> Column:
    """:func:`relation` of two columns of schema texts; each distinct pair is compared once in a while."""

    def describe(pair: str) -> str:
        texts = json.loads(pair)
        return relation(texts.get("reader"), texts.get("writer"))

    pair = F.to_json(F.struct(reader.alias("reader"), writer.alias("writer")))
    return _per_distinct_text(describe, pa.string(), T.StringType())(pair)


# --- values ----------------------------------------------------------------------


def _single(node: dict) -> dict:
    """What one column of a union's values is: its only branch or the wider of two numbers; else the node itself."""
    if node["kind"] != "union" or not value_branches(node) or union_shape(node) == "members":
        return node
    return max(value_branches(node), key=lambda branch: branch["kind"] in ("long", "double"))


def _null(node: dict) -> Column:
    return F.lit(None).cast(spark_type(node))


def _members(union: dict, values: dict[int, Column]) -> Column:
    branches = value_branches(union)
    return F.struct(*[values.get(i, _null(branch)).alias(f"member{i}") for i, branch in enumerate(branches)])


def as_reader(value: Column, writer: dict, reader: dict) -> Column:
    """``value``, decoded with ``writer``, as ``reader`` has it; for pairs without anything :func:`unreadable`.

    Fields by name, absent ones by their default, wider numbers by a cast, members of unions by their branch.
    """
    if writer == reader:
        return value
    have, want = _single(writer), _single(reader)
    if have["kind"] == "null" or want["kind"] == "null":
        return _null(reader)
    parts = [(value, have)]
    if have["kind"] == "union":
        parts = [(value.getField(f"member{i}"), branch) for i, branch in enumerate(value_branches(have))]
    if want["kind"] == "union":
        branches = value_branches(want)
        taken: dict[int, list[Column]] = {}
        for part, branch in parts:
            i = branch_for(branches, branch)
            taken.setdefault(i, []).append(as_reader(part, branch, branches[i]))
        return F.when(value.isNotNull(), _members(want, {i: F.coalesce(*found) for i, found in taken.items()}))
    if have["kind"] == "union":
        return F.coalesce(*[as_reader(part, branch, want) for part, branch in parts])
    if want["kind"] == "array":
        return F.transform(value, lambda item: as_reader(item, have["items"], want["items"]))
    if want["kind"] == "map":
        return F.transform_values(value, lambda _, item: as_reader(item, have["values"], want["values"]))
    if want["kind"] == "record":
        written = dict(have["fields"])
        fields = [
            (as_reader(value.getField(field), written[field], node) if field in written
             else default_value(want["defaults"][field], node)).alias(field)
            for field, node in want["fields"]
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(spark_type(want))


def default_value(default, node: dict) -> Column:
    """A field's default, in its JSON form, as a value of the field's column; for a union of its first branch."""
    kind, column = node["kind"], spark_type(node)
    if default is None:
        return _null(node)
    if kind == "union":
        first = node["branches"][0]
        inner = default_value(default, first)
        return inner.cast(column) if _single(node)["kind"] != "union" else _members(
            node, {value_branches(node).index(first): inner})
    if kind == "record":
        given = {**node["defaults"], **default}
        return F.struct(*[default_value(given.get(field), inner).alias(field) for field, inner in node["fields"]])
    if kind == "array":
        return F.array(*[default_value(item, node["items"]) for item in default]).cast(column)
    if kind == "map":
        entries = [c for k, item in default.items() for c in (F.lit(k), default_value(item, node["values"]))]
        return F.create_map(*entries).cast(column)
    logical = node.get("logical", "")
    if kind in ("bytes", "fixed"):
        raw = default.encode("latin-1")
        if logical:
            raw = Decimal(int.from_bytes(raw, "big", signed=True)).scaleb(-node["scale"])
        return F.lit(raw).cast(column)
    if logical == "date":
        return F.date_from_unix_date(F.lit(default))
    if logical:
        micros = default * 1000 if logical.endswith("millis") else default
        if logical.startswith("local"):
            return F.lit(str(datetime(1970, 1, 1) + timedelta(microseconds=micros))).cast(column)
        return F.timestamp_micros(F.lit(micros).cast("long"))
    return F.lit(default).cast(column)

"""Tables that lag their events' schemas: columns to add, and changes that a table cannot follow."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.avro_types import DATE_PARTS, SchemaError, _per_distinct_text, record_type, render_type

DRIFT_TYPE = T.StructType([
    T.StructField("added", T.ArrayType(T.StructType([
        T.StructField("path", T.ArrayType(T.StringType())), T.StructField("type", T.StringType())]))),
    T.StructField("refused", T.ArrayType(T.StringType())),
])


def wanted_type(schema: str) -> dict:
    """The type of an event's table, in Spark's JSON form, with the date parts as integers."""
    tree = record_type(schema).jsonValue()
    for field in tree["fields"]:
        if isinstance(field["type"], str) and field["name"] in DATE_PARTS:
            field["type"] = "integer"
    return tree


def difference(have, want, path: tuple[str, ...] = ()) -> tuple[list[tuple[tuple[str, ...], str]], list[str]]:
    """(path, type) of what ``want`` has more than ``have``, and the changes that adding columns cannot make.

    Both are types in Spark's JSON form. Names match without regard to case. What only ``have`` has stays and is null
    in new rows. Any other type is refused, a wider one too: files of both types under one column cannot be read.
    """
    shapes = [kind["type"] if isinstance(kind, dict) else None for kind in (have, want)]
    added, refused = [], []
    if shapes == ["struct", "struct"]:
        known = {field["name"].lower(): field["type"] for field in have["fields"]}
        for field in want["fields"]:
            here, name = (*path, field["name"]), field["name"].lower()
            if name not in known:
                added.append((here, render_type(field["type"], quote=True)))
                continue
            below = difference(known[name], field["type"], here)
            added, refused = added + below[0], refused + below[1]
    elif shapes[0] == shapes[1] and shapes[0] in ("array", "map"):
        for part in ("element",) if shapes[0] == "array" else ("key", "value"):
            below = difference(have[f"{part}Type"], want[f"{part}Type"], (*path, part))
            added, refused = added + below[0], refused + below[1]
    elif have != want:
        refused.append(f"{'.'.join(path)}: {render_type(have)} to {render_type(want)}")
    return added, refused


def column_drift(table_schema: Column, schema: Column) -> Column:
    """:func:`difference` of a table's type (Spark's JSON form) and an event's Avro schema; null if one is unusable."""

    def describe(pair: str) -> dict | None:
        texts = json.loads(pair)
        try:
            added, refused = difference(json.loads(texts["have"]), wanted_type(texts["want"]))
        except (SchemaError, KeyError, TypeError, ValueError):
            return None
        return {"added": [{"path": list(path), "type": kind} for path, kind in added], "refused": refused}

    arrow = pa.struct([
        ("added", pa.list_(pa.struct([("path", pa.list_(pa.string())), ("type", pa.string())]))),
        ("refused", pa.list_(pa.string())),
    ])
    pair = F.to_json(F.struct(table_schema.alias("have"), schema.alias("want")))
    return _per_distinct_text(describe, arrow, DRIFT_TYPE)(pair)


def drifted(definitions: DataFrame, registry: DataFrame, tables: DataFrame) -> DataFrame:
    """event_key, is_transactional, ``added`` and ``refused`` of every table that lags its definition.

    ``tables`` has event_key and table_schema, the type of the table as it is. Definitions without a table, and tables without
    a definition, are left out.
    """
    texts = registry.select("ordinal", "complete_schema")
    rows = definitions.select("ordinal", "event_key", "is_transactional").join(texts, "ordinal").join(tables, "event_key")
    rows = rows.withColumn("drift", column_drift(F.col("table_schema"), F.col("complete_schema")))
    found = rows.select("event_key", "is_transactional", "drift.added", "drift.refused")
    return found.where((F.size("added") > 0) | (F.size("refused") > 0))

from __future__ import annotations

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from sluice.functions.avro_types import parse_avro, spark_type
from sluice.functions.compatibility import as_reader, relation, unreadable
from sluice.operators import reconcile, versions
from sluice.streaming import fanout, ledger
from sluice.streaming.multiplex import start_groups
from tests.test_registry import entry, registry
from workload.inputs import parquet_config


def record(*fields, name="R"):
    return {"type": "record", "name": name, "fields": [dict(f) for f in fields]}


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


def text(*fields, name="R"):
    return json.dumps(record(*fields, name=name))


N = field("n", "long")
V1 = text(N, field("dpYear", "string"))
V2 = text(N, field("dpYear", "string"), field("v", ["double", "null"], default=0.5))
ENUM = {"type": "enum", "name": "E", "symbols": ["A", "B"]}


@pytest.mark.parametrize("reader, writer, expected", [
    ("long", "int", []), ("double", "long", []), ("bytes", "string", []), ("int", "long", ["TYPE n"]), ("string", "long", ["TYPE n"]),
    (["null", "long"], "int", []), ("long", ["null", "long"], ["TYPE n"]), (["null", "string"], "long", ["UNION n"]),
    (["int", "long"], ["long", "int"], []), ("long", {"type": "long", "logicalType": "timestamp-millis"}, ["TYPE n"]),
    ({"type": "array", "items": "long"}, {"type": "array", "items": "string"}, ["TYPE n[]"]),
    ({"type": "map", "values": "long"}, {"type": "map", "values": "string"}, ["TYPE n{}"]),
    (ENUM, {**ENUM, "symbols": ["A", "C"]}, ["SYMBOLS n"]), ({**ENUM, "symbols": ["B", "A", "C"]}, ENUM, []),
    ({"type": "fixed", "name": "F", "size": 2}, {"type": "fixed", "name": "F", "size": 3}, ["SIZE n"]),
    (record(field("a", "int"), name="I"), record(name="I"), ["MISSING n.a"]),
    (record(field("a", "int", default=1), name="I"), record(name="I"), []),
    (record(name="x.I"), record(name="y.I"), []), (record(name="I"), record(name="J"), ["NAME n"]),
])
def test_unreadable(reader, writer, expected):
    found = unreadable(parse_avro(text(field("n", reader))), parse_avro(text(field("n", writer))))
    assert found == expected


def test_relations():
    assert relation(V2, V1) == "FULL" and relation(text(N), V1) == "BACKWARD" and relation(V1, text(N)) == "FORWARD"
    assert relation(text(field("n", "string")), text(N)) == "NONE"
    assert relation("{", V1) == relation(None, None) == "INVALID" and relation(V1, "{") == "UNKNOWN"


@pytest.mark.parametrize("writer, reader, value, expected", [
    ([field("a", "int")], [field("a", "double")], {"a": 3}, {"a": 3.0}),
    ([field("a", "int"), field("b", "int")], [field("b", "int")], {"a": 1, "b": 2}, {"b": 2}),
    ([field("a", {"type": "array", "items": record(field("x", "int"), name="I")})],
     [field("a", {"type": "array", "items": record(field("y", "string", default="d"), field("x", "long"), name="I")})],
     {"a": [{"x": 1}, None]}, {"a": [{"y": "d", "x": 1}, None]}),
    ([field("a", {"type": "map", "values": "int"})], [field("a", {"type": "map", "values": ["null", "long"]})],
     {"a": {"k": 1}}, {"a": {"k": 1}}),
    ([field("a", "long")], [field("a", ["string", "long"])], {"a": 7}, {"a": {"member0": None, "member1": 7}}),
    ([field("a", ["string", "long"])], [field("a", ["null", "long", "string"])],
     {"a": {"member0": "s", "member1": None}}, {"a": {"member0": None, "member1": "s"}}),
    ([field("a", ["int", "long"])], [field("a", "double")], {"a": 4}, {"a": 4.0}),
    ([field("z", "int")], [
        field("s", record(field("p", "int"), field("q", "string", default="w"), name="I"), default={"p": 1}),
        field("l", {"type": "array", "items": "int"}, default=[1, 2]), field("e", {"type": "array", "items": "int"}, default=[]),
        field("m", {"type": "map", "values": "long"}, default={"k": 5}), field("b", "bytes", default="ÿ"),
        field("d", {"type": "int", "logicalType": "date"}, default=1), field("u", ["string", "long"], default="x"),
        field("o", ["null", "string"], default=None)], {"z": 1},
     {"s": {"p": 1, "q": "w"}, "l": [1, 2], "e": [], "m": {"k": 5}, "b": bytearray(b"\xff"), "d": date(1970, 1, 2),
      "u": {"member0": "x", "member1": None}, "o": None}),
])
def test_as_reader(spark, writer, reader, value, expected):
    have, want = parse_avro(text(*writer)), parse_avro(text(*reader))
    assert unreadable(want, have) == []
    given = spark.createDataFrame([(value,), (None,)], f"v {spark_type(have).simpleString()}")
    projected = given.select(as_reader(F.col("v"), have, want).alias("v"))
    assert projected.schema["v"].dataType.simpleString() == spark_type(want).simpleString()
    assert [r.v and r.v.asDict(True) for r in projected.collect()] == [expected, None]


def framed(number, **body):
    return bytearray(b"\x00" + number.to_bytes(4, "big") + json.dumps(body).encode())


RECORDS = [
    framed(1, n=1, dpYear="2024", v=9.0), framed(2, n=2, dpYear="2025", v=9.0), framed(7, n=3, dpYear="2025"),
    framed(3, n=4), None, bytearray(b"\x00\x00"), bytearray(b"\x01" + framed(1, n=5)[1:]), framed(2, n="x"),
]
# 3 has a schema that the newest cannot read, 4 is no schema, 300 an id of two bytes.
WRITERS = {1: V1, 2: V2, 3: text(field("n", "string")), 4: "{", 300: V1}


def test_each_record_by_its_own_schema(spark):
    records = spark.createDataFrame([(r,) for r in [*RECORDS, framed(300, n=6, dpYear="1")]], "value binary")
    rows = versions.to_rows(records, V2, "json", "PERMISSIVE", WRITERS).collect()
    assert list(map(tuple, rows)) == [(1, 2024, 0.5), (2, 2025, 9.0), *[(None,) * 3] * 6, (6, 1, 0.5)]


def test_failfast_names_the_unknown_id(spark):
    records = spark.createDataFrame([(r,) for r in RECORDS], "value binary")
    good = records.where("value IS NULL OR length(value) > 30").limit(2)
    assert versions.to_rows(good, V2, "json", "FAILFAST", WRITERS).count() == 2
    for bad in (RECORDS[2], RECORDS[3], RECORDS[5]):
        with pytest.raises(Exception, match="no usable schema of id"):
            versions.to_rows(spark.createDataFrame([(bad,)], "value binary"), V2, "json", "FAILFAST", WRITERS).collect()
    with pytest.raises(ValueError, match="mode"):
        versions.to_rows(records, V2, "json", "DROP", WRITERS)
    assert versions.to_rows(records.limit(0), V2, "json", "FAILFAST", {}).collect() == []


def schemas(spark, *rows):
    return spark.createDataFrame(rows, "subject string, version int, schema string, schema_id int")


def deliver(spark, root, *rows):
    frame = spark.createDataFrame([(t, r) for t, r in rows], "topic string, value binary")
    frame.write.mode("append").partitionBy("topic").parquet(f"{root}/log")


@pytest.mark.parametrize("grouped", [False, True])
def test_a_stream_decodes_by_id_and_restarts_with_new_ids(spark, root, grouped):
    config = parquet_config(f"{root}/x", source_options={"path": f"{root}/log"})
    start = start_groups if grouped else fanout.start_all
    entries = registry(spark, entry(0, "e", "[a]"))
    deliver(spark, root, ("a", framed(1, n=1, dpYear="2024", v=9.0)))
    fanout.await_all(spark, start(spark, entries, schemas(spark, ("a-value", 1, V1, 1)), config))
    deliver(spark, root, ("a", framed(1, n=2, dpYear="2024", v=9.0)), ("a", framed(2, n=3, dpYear="2024", v=9.0)))
    known = schemas(spark, ("a-value", 1, V1, 1), ("a-value", 2, V2, 2), ("a-value", 2, V2, 2), ("b-value", 1, V1, 8))
    fanout.await_all(spark, start(spark, entries, known, config))
    rows = ledger.read_event(spark, config, "e").select("n", "v").collect()
    assert sorted(map(tuple, rows)) == [(1, None), (2, 0.5), (3, 9.0)]


def test_writers_are_part_of_the_plan_and_its_digest(spark):
    entries = registry(spark, entry(0, "e", "[a, b]"), entry(1, "none", "[c]"))
    known = schemas(spark, ("a-value", 1, V1, 1), ("a-value", 2, V2, 2), ("b-value", 3, V2, 2), ("b-value", 1, None, 4))
    plan = fanout.resolved_stream_plan(entries, known)
    assert {r.event_key: fanout.writers_of(r) for r in plan.collect()} == {"e": {1: V1, 2: V2}, "none": {}}
    more = fanout.resolved_stream_plan(entries, known.union(schemas(spark, ("b-value", 2, V1, 5))))
    todo = reconcile.actions(reconcile.with_digest(plan).select("event_key", "digest"), reconcile.with_digest(more))
    assert [tuple(r) for r in todo.collect()] == [("e", "restart")]


def test_previous_versions_over_blocks(spark):
    draw = random.Random(5)
    rows = [(s, v, f"{s}{v}") for s in "ab" for v in draw.sample(range(60), 25)]
    given = spark.createDataFrame([*rows, *rows[:4], (None, 1, "x"), ("a", None, "x")], "subject string, version int, schema string")
    found = {(r.subject, r.version): (r.previous, r.previous_schema) for r in versions.with_previous(given, block=7).collect()}
    expected = {}
    for s in "ab":
        order = sorted(v for t, v, _ in rows if t == s)
        expected |= {(s, v): (p, None if p is None else f"{s}{p}") for p, v in zip([None, *order], order, strict=False)}
    assert found == expected


def test_compatibility_of_an_empty_history(spark):
    assert versions.compatibility(spark.createDataFrame([], "subject string, version int, schema string")).collect() == []

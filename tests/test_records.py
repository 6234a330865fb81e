from __future__ import annotations

import json
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import records
from sluice.streaming.fanout import start_all
from sluice.streaming.sink import session_conf
from tests.test_registry import registry, subjects
from workload.inputs import parquet_config

SCHEMA = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "n", "type": "long"}, {"name": "dpYear", "type": "string"}]})
HEADER = b"\x00\x00\x00\x00\x01"


def wire(spark, *bodies):
    framed = [(i, None if b is None else bytearray(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(framed, "i int, value binary").select("value")


def body(n, year):
    return json.dumps({"n": n, "dpYear": year}).encode()


def test_strip_header(spark):
    rows = records.strip_header(wire(spark, None, b"", b"abc", b"abcde", HEADER + b"xy")).collect()
    assert [r.body if r.body is None else bytes(r.body) for r in rows] == [None, b"", b"", b"", b"xy"]
    assert records.strip_header(wire(spark, b"")).schema["body"].dataType == T.BinaryType()


def test_permissive_keeps_a_null_row_for_every_bad_body(spark):
    good = HEADER + body(7, "2024")
    given = wire(spark, None, b"abc", HEADER, HEADER + b"\xfe\xff{", good)
    rows = records.to_rows(given, SCHEMA, "json", "PERMISSIVE").collect()
    assert [tuple(r) for r in rows] == [(None, None)] * 4 + [(7, 2024)]


def test_failfast_fails(spark):
    given = wire(spark, HEADER + b"\xfe\xff{")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.to_rows(given, SCHEMA, "json", "FAILFAST").collect()


def test_failfast_keeps_null_values_null(spark):
    rows = records.to_rows(wire(spark, None), SCHEMA, "json", "FAILFAST").collect()
    assert [tuple(r) for r in rows] == [(None, None)]


def test_json_with_one_bad_field_is_bad_as_a_whole(spark):
    given = wire(spark, HEADER + b'{"n": "seven", "dpYear": "2024"}')
    assert tuple(records.to_rows(given, SCHEMA, "json", "PERMISSIVE").first()) == (None, None)


def test_unknown_mode_and_codec(spark):
    with pytest.raises(ValueError, match="DROPMALFORMED"):
        records.to_rows(wire(spark, b""), SCHEMA, "json", "DROPMALFORMED")
    with pytest.raises(ValueError, match="xml"):
        records.to_rows(wire(spark, b""), SCHEMA, "xml")


def test_the_avro_codec_names_the_module_it_needs(spark, root):
    if records.has_native_avro(spark):
        pytest.skip("the module is loaded")
    with pytest.raises(RuntimeError, match="spark-avro"):
        records.to_rows(wire(spark, b""), SCHEMA, "avro")
    with pytest.raises(RuntimeError, match="spark-avro"):
        start_all(spark, registry(spark), subjects(spark), parquet_config(root, codec="avro"))


def test_date_parts_of_other_types_and_cases(spark):
    rows = spark.createDataFrame(
        [(date(2024, 1, 5), "07", datetime(1970, 1, 1, 0, 0, 9), [1], bytearray(b"1"), Decimal("3.9"), True)],
        "dpYear date, dpday string, DPHOUR timestamp, dpMonth array<int>, other binary, DpMinute decimal(3,1), b boolean")
    out = records.cast_date_parts(rows)
    assert out.columns == rows.columns
    assert tuple(out.first())[:4] == (None, 7, 9, [1]) and dict(out.dtypes)["dpMonth"] == "array<int>"
    assert dict(out.dtypes)["dpYear"] == "int" and dict(out.dtypes)["DpMinute"] == "decimal(3,1)"
    assert records.cast_date_parts(rows.select(F.col("other").alias("dpDay"))).first()[0] is None
    assert records.cast_date_parts(rows.select(F.col("b").alias("dpDay"))).first()[0] == 1


def test_date_parts_cast_like_a_lenient_cast(spark):
    """Equal to Spark's cast without ANSI, on the texts a cast can meet."""
    draw = random.Random(7)
    texts = {"07", " 7 ", "x", "", "12.5", ".5", "-.5", "+7.", "1e2", "99999999999", "99999999999.5",
             "\t7\n", "2147483647", "2147483648", "-2147483648.9", "+", "-", "1 2", "12.x", "1.2.3", ".", "\x7f7\x00",
             "7\xa0", "\u0667", "0000000000007"}
    while len(texts) < 3000:
        texts.add("".join(draw.choice("0123456789+-. x\t") for _ in range(draw.randint(1, 6))))
    rows = spark.createDataFrame([(t,) for t in [*sorted(texts), None]], "dpYear string")
    ours = {r.t: r.dpYear for r in records.cast_date_parts(rows.withColumn("t", F.col("dpYear"))).collect()}
    with session_conf(spark, {"spark.sql.ansi.enabled": "false"}):
        cast = rows.select("dpYear", F.col("dpYear").cast("int").alias("v"))
        lenient = {r.dpYear: r.v for r in cast.collect()}
    assert ours == lenient


def test_only_date_parts_that_exist_are_cast(spark):
    rows = spark.createDataFrame([("1", 2, "x")], "dpHour string, dpDay long, other string")
    out = records.cast_date_parts(rows)
    assert out.columns == rows.columns
    assert [f.dataType for f in out.schema] == [T.IntegerType(), T.IntegerType(), T.StringType()]
    assert records.cast_date_parts(rows.select("other")).columns == ["other"]

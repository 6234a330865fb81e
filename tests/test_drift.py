from __future__ import annotations

import json

from pyspark.sql import types as T

from sluice.operators.drift import difference, wanted_type
from sluice.plans.programs import provision_tables
from tests.test_registry import entry, registry
from workload.inputs import parquet_config


def schema(*fields):
    return json.dumps({"type": "record", "name": "R", "fields": [{"name": n, "type": t} for n, t in fields]})


def test_difference_of_nested_types():
    inner = {"type": "record", "name": "I", "fields": [{"name": "x", "type": "int"}, {"name": "y", "type": "string"}]}
    want = wanted_type(schema(
        ("N", "long"), ("s", inner), ("l", {"type": "array", "items": "I"}), ("m", {"type": "map", "values": "I"}),
        ("w", "long"), ("dpYear", "string"), ("new", {"type": "array", "items": "I"})))
    short = T.StructType([T.StructField("x", T.IntegerType())])
    have = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("s", short), T.StructField("l", T.ArrayType(short)),
        T.StructField("m", T.MapType(T.StringType(), short)), T.StructField("w", T.IntegerType()),
        T.StructField("dpyear", T.IntegerType()), T.StructField("old", T.StringType())]).jsonValue()
    added, refused = difference(have, want)
    assert added == [
        (("s", "y"), "string"), (("l", "element", "y"), "string"), (("m", "value", "y"), "string"),
        (("new",), "Array<Struct<`x`: integer, `y`: string>>")]
    assert refused == ["w: integer to long"]
    assert difference(want, want) == ([], [])


def test_a_table_reads_the_widened_data(spark, root, unique):
    names = {True: f"t_{unique}", False: f"n_{unique}"}
    config = parquet_config(root)
    first = schema(("x", "int"), ("dpYear", "string"), ("k", "int"))
    then = schema(("x", "int"), ("y", "string"), ("dpYear", "string"), ("k", "long"))
    for name in names.values():
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{name}'")
    try:
        def provision(text, **more):
            found = provision_tables(
                spark, registry(spark, entry(0, "e", txn=False, schema=text), entry(1, "f", txn=False, schema=first)), config,
                "spark_catalog", sides=tuple(names.values()), namespaces=names, **more)
            return sorted((r.event_key, r.status) for r in found.collect())

        assert provision(first) == [("e", "success"), ("f", "success")]
        assert provision(first, widen=True) == [("e", "success"), ("f", "success")]
        table = f"spark_catalog.{names[False]}.e"
        spark.createDataFrame([(1, "a", 5, 2024)], "x int, y string, k int, dpYear int").write.partitionBy("dpYear").parquet(
            f"{root}/out/e", mode="append")
        spark.sql(f"MSCK REPAIR TABLE {table}")
        assert "y" not in spark.table(table).columns
        # The new column is added, the changed type of k is refused and stays.
        assert provision(then, widen=True) == [("e", "success"), ("e", "success"), ("f", "success")]
        assert [r.asDict() for r in spark.table(table).collect()] == [{"x": 1, "y": "a", "k": 5, "dpYear": 2024}]
    finally:
        for name in names.values():
            spark.sql(f"DROP SCHEMA {name} CASCADE")

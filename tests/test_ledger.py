from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.definitions import table_definitions
from sluice.plans.tables import create_statements
from sluice.streaming import fanout, files, ledger, sink
from tests.test_registry import GOOD, entry, registry
from tests.test_streaming import SCHEMA, log
from workload.inputs import parquet_config


def schema(**types):
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def deliver(spark, root, config, partitions, n, flag=None):
    log(spark, root, ("t", n, "2024"), ("t", n + 1, "2025"))
    rows = fanout.event_rows(spark, config, "t", SCHEMA).withColumn("p", F.lit("x"))
    sink.start_event(rows, "e", partitions, config, flag).awaitTermination()


def numbers(spark, config):
    return sorted(r.n for r in ledger.read_event(spark, config, "e").collect())


def test_a_changed_partition_list_opens_a_generation(spark, root):
    config = parquet_config(root, source_options={"path": f"{root}/log"})
    deliver(spark, root, config, ["p"], 0)
    deliver(spark, root, config, ["p", "dpYear"], 10)
    deliver(spark, root, config, ["p", "dpYear"], 20)
    assert numbers(spark, config) == [0, 1, 10, 11, 20, 21]
    known = ledger.layouts(spark, config, "e")
    assert [(k.generation, k.directory, k.partitions) for k in known] == [
        (0, f"{root}/out/e", ["p"]), (1, f"{root}/out/_g1/e", ["p", "dpYear"])]
    assert sorted(r.n for r in spark.read.parquet(f"{root}/out/e").collect()) == [0, 1]
    deliver(spark, root, config, ["p"], 30)  # back again: the first directory's log has ended, so one more
    assert numbers(spark, config) == [0, 1, 10, 11, 20, 21, 30, 31]
    assert len(ledger.layouts(spark, config, "e")) == 3


def test_a_changed_flag_goes_on_in_the_other_directory(spark, root):
    config = parquet_config(
        root, source_options={"path": f"{root}/log"}, txn_path=f"{root}/txn", non_txn_path=f"{root}/plain")
    deliver(spark, root, config, ["p"], 0, False)
    deliver(spark, root, config, ["p"], 10, True)
    assert numbers(spark, config) == [0, 1, 10, 11]
    newest = ledger.current_layouts(spark, config).collect()
    assert [(r.event_key, r.generation, r.directory) for r in newest] == [("e", 1, f"{root}/txn/e")]
    definitions = table_definitions(registry(spark, entry(1, key="e", txn=False, schema=GOOD)))
    statements = create_statements(definitions, config, layouts=ledger.current_layouts(spark, config))
    assert f"LOCATION '{root}/txn/e'" in statements.first().statement
    assert f"LOCATION '{root}/plain/e'" in create_statements(definitions, config).first().statement


def test_only_changed_layouts_count(spark, root):
    config = parquet_config(root)
    settle = lambda types, parts=("p",): ledger.settle(spark, config, "e", schema(**types), parts).generation
    first = {"a": T.LongType(), "p": T.StringType()}
    assert settle(first) == settle(first) == 0
    assert settle({**first, "b": T.StringType()}) == 0  # merged by the sink
    assert settle({"p": T.StringType()}) == 0
    assert settle({"a": T.StringType(), "p": T.StringType()}) == 1  # no reader takes both types
    assert settle(first) == 2
    assert settle(first, ()) == 3
    record = json.loads(files.read_text(spark, f"{root}/checkpoints/_layouts/e/00000.json"))
    assert record["columns"] == {"a": "bigint", "p": "string"} and len(record["digest"]) == 64


def test_rows_from_before_the_ledger(spark, root):
    config = parquet_config(root)
    spark.createDataFrame([(1, "x", 5)], "a long, p string, q int").write.partitionBy("p", "q").parquet(
        config.event_path("e"))
    assert ledger.directory_partitions(spark, config.event_path("e")) == ["p", "q"]
    assert ledger.directory_partitions(spark, f"{root}/nothing") is None
    found = ledger.settle(spark, config, "e", schema(a=T.LongType(), p=T.StringType()), ["p"])
    assert (found.generation, found.directory) == (1, f"{root}/out/_g1/e")
    assert [k.partitions for k in ledger.layouts(spark, config, "e")] == [["p", "q"], ["p"]]


def test_a_replayed_batch_adds_nothing(spark, root):
    config = parquet_config(root)
    layout = ledger.Layout("e", 1, f"{root}/out/e", f"{root}/out/_g1/e", ["p"])
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "a long, p string")
    for batch in (4, 5, 5):
        ledger.append_batch(rows, batch, layout, "parquet", {})
    assert spark.read.parquet(layout.directory).count() == 4
    with pytest.raises(LookupError):
        ledger.read_event(spark, config, "e")


def test_a_file_is_created_once(spark, root):
    assert files.create_once(spark, f"{root}/d/f.json", "é") and not files.create_once(spark, f"{root}/d/f.json", "2")
    assert files.read_text(spark, f"{root}/d/f.json") == "é"
    assert files.names(spark, f"{root}/d") == [("f.json", False)]
    assert files.names(spark, f"{root}/none") == []


def test_compaction_refuses_a_narrow_schema_and_skips_nothing(spark, root):
    rows = spark.createDataFrame([(1, 2, "x")], "i int, v int, p string")
    rows.write.partitionBy("p").parquet(f"{root}/in")
    with pytest.raises(ValueError, match="columns v"):
        sink.compact(spark, f"{root}/in", f"{root}/a", ["p"], schema="i int, p string")
    sink.compact(spark, f"{root}/in", f"{root}/b", ["p"], where="p = 'none'")
    assert not files.exists(spark, f"{root}/a") and not files.exists(spark, f"{root}/b")
    sink.compact(spark, f"{root}/in", f"{root}/c", ["p"], schema="i int, v int, p string")
    assert spark.read.parquet(f"{root}/c").count() == 1

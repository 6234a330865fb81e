from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sluice.config import IngestConfig
from sluice.operators.definitions import table_definitions
from sluice.plans.tables import create_statements
from sluice.sources.stream import read_records, source_options
from sluice.streaming import fanout, sink
from tests.test_records import HEADER
from tests.test_registry import entry, registry, subjects
from workload.inputs import parquet_config

SCHEMA = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "n", "type": "long"}, {"name": "dpYear", "type": "string"}]})


def log(spark, root, *records):
    rows = [(t, bytearray(HEADER + json.dumps({"n": n, "dpYear": y}).encode())) for t, n, y in records]
    frame = spark.createDataFrame(rows, "topic string, value binary")
    frame.write.mode("append").partitionBy("topic").parquet(f"{root}/log")
    return {"path": f"{root}/log"}


def test_event_options_win(root):
    config = IngestConfig(
        root, root, source_options={"kafka.bootstrap.servers": "b:1", "kafka.group.id": "g",
                                    "startingOffsets": "latest", "subscribe": "x"},
        starting_offsets="earliest", fail_on_data_loss=False)
    assert source_options(config, "a,b") == {
        "kafka.bootstrap.servers": "b:1", "kafka.group.id": "g", "subscribe": "a,b",
        "startingOffsets": "earliest", "failOnDataLoss": "false"}
    assert source_options(IngestConfig(root, root), "a") == {"subscribe": "a"}


def test_kafka_and_delta_are_the_defaults(root):
    config = IngestConfig(root, root)
    assert (config.source_format, config.sink_format) == ("kafka", "delta")
    assert config.processing_time == "2 minutes"


def test_sink_options(root):
    delta = IngestConfig(root, root, compression="zstd", optimize_write=True, auto_compact=True)
    assert sink.sink_options(delta) == {
        "mergeSchema": "true", "compression": "zstd",
        "delta.autoOptimize.optimizeWrite": "true", "delta.autoOptimize.autoCompact": "true"}
    assert sink.sink_options(IngestConfig(root, root, sink_format="parquet", merge_schema=False)) == {
        "mergeSchema": "false"}


def test_topics_select_records(spark, root):
    options = log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"), ("c", 3, "2024"))
    config = parquet_config(f"{root}/x", source_options=options)
    by_directory = parquet_config(f"{root}/y", source_options={
        "path": f"{root}/log/topic={{topics}}", "basePath": f"{root}/log"})
    for settings in (config, by_directory):
        rows = fanout.event_rows(spark, settings, "a, c", SCHEMA)
        sink.start_event(rows, "e", (), settings).awaitTermination()
        found = spark.read.parquet(settings.event_path("e")).collect()
        assert sorted(r.n for r in found) == [1, 3]


def test_query_name_and_compression(spark, root):
    options = log(spark, root, ("a", 1, "2024"))
    config = parquet_config(root, source_options=options, compression="gzip", available_now=False,
                            processing_time="1 second")
    rows = fanout.event_rows(spark, config, "a", SCHEMA)
    query = sink.start_event(rows, "named", ("dpYear",), config)
    try:
        assert query.name == "Stream-named"
        with pytest.raises(Exception, match="(?i)already active|name"):
            sink.start_event(rows, "named", ("dpYear",), config)
        query.processAllAvailable()
        written = spark.read.parquet(config.event_path("named"))
        file = written.select(F.input_file_name().alias("f")).first().f
        assert file.endswith(".gz.parquet") and "/dpYear=2024/" in file
    finally:
        query.stop()


def test_one_event_failing_while_running_does_not_stop_the_rest(spark, root):
    options = log(spark, root, ("good", 1, "2024"), ("bad", 2, "2024"), ("later", 3, "2024"))
    broken = spark.createDataFrame([("bad", bytearray(HEADER + b"{no json"))], "topic string, value binary")
    broken.write.mode("append").partitionBy("topic").parquet(f"{root}/log")
    config = parquet_config(root, source_options=options, mode="FAILFAST")
    events = registry(
        spark,
        entry(0, "later", "[later]", "nonP0Event"), entry(1, "bad", "[bad]"), entry(2, "good", "[good]"),
        entry(3, "unknown", "[unknown]"), entry(4, "parts", "[good]", parts="[absent]"),
    )
    known = subjects(spark, *[(f"{t}-value", 1, SCHEMA) for t in ("good", "bad", "later")])
    started = fanout.start_all(spark, events, known, config)
    fanout.await_all(spark, started)
    assert [s.event_key for s in started] == ["bad", "good", "parts", "unknown", "later"]
    errors = {s.event_key: s.error for s in started}
    assert errors["good"] is None and errors["later"] is None
    assert "StreamingQueryException" in errors["bad"]
    assert "LookupError" in errors["unknown"] and "AnalysisException" in errors["parts"]
    for key, n in (("good", 1), ("later", 3)):
        assert [r.n for r in spark.read.parquet(config.event_path(key)).collect()] == [n]


def test_a_key_registered_twice_streams_its_newest_entry(spark, root):
    config = parquet_config(root, source_options=log(spark, root, ("a", 1, "2024"), ("b", 2, "2024")),
                            txn_path=f"{root}/txn", non_txn_path=f"{root}/non")
    events = registry(
        spark,
        entry(0, "twice", "[a]", "p0Event", txn=True, schema=SCHEMA),
        entry(1, "twice", "[b]", "nonP0Event", parts="[dpYear]", txn=False, schema=SCHEMA),
        entry(2, "once", "[a]", "p0Event", txn=True, schema=SCHEMA),
        entry(3, "once", "[a]", "other", txn=False, schema=SCHEMA))
    started = fanout.start_all(spark, events, subjects(spark, ("a-value", 1, SCHEMA), ("b-value", 1, SCHEMA)), config)
    fanout.await_all(spark, started)
    assert [(s.event_key, s.bucket_id, s.error) for s in started] == [
        ("once", "p0Event", None), ("twice", "nonP0Event", None)]
    located = create_statements(table_definitions(events), config).collect()
    for row, n in zip(sorted(located, key=lambda r: r.event_key), (1, 2)):
        assert f"LOCATION '{root}/non/{row.event_key}'" in row.statement
        assert [r.n for r in spark.read.parquet(f"{root}/non/{row.event_key}").collect()] == [n]


def test_topics_agree_on_a_schema_or_there_is_none(spark):
    other = SCHEMA.replace('"R"', '"S"')
    known = subjects(spark, ("a-value", 1, SCHEMA), ("b-value", 1, SCHEMA), ("c-value", 1, other), ("a-value", 0, other))
    lists = {"[a]": SCHEMA, "[a, b]": SCHEMA, "[a,c]": None, "[c]": other, "[a,absent]": None, "[absent]": None, "[a,a , b]": SCHEMA}
    events = registry(spark, *[entry(i, f"e{i}", topics) for i, topics in enumerate(lists)])
    plan = fanout.stream_plan(events, known).collect()
    assert {f"[{r.topics}]": r.schema for r in plan} == lists


def test_switches_that_would_do_nothing_are_refused(spark, root):
    stream = read_records(spark, parquet_config(root, source_options=log(spark, root, ("a", 1, "2024"))), "a")
    for settings, word in (({"auto_compact": True}, "auto_compact"), ({"target_bytes": 1}, "optimize_write")):
        config = parquet_config(root, **settings)
        with pytest.raises(ValueError, match=word):
            sink.event_writer(stream, "e", (), config)
        with pytest.raises(ValueError, match=word):
            fanout.start_all(spark, registry(spark), subjects(spark), config)
    with sink.session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        with pytest.raises(ValueError, match="adaptive"):
            sink.event_writer(stream, "e", (), parquet_config(root, optimize_write=True))
    with pytest.raises(ValueError, match="Delta"):
        sink.require_switches(spark, IngestConfig(root, root, target_bytes=1, optimize_write=True))
    sink.require_switches(spark, IngestConfig(root, root, auto_compact=True))


def test_optimized_write_survives_a_restart(spark, root):
    config = parquet_config(
        root, source_options={"path": f"{root}/log"}, optimize_write=True)
    for n, year in enumerate(("2023", "2024", "2024")):
        log(spark, root, ("a", n, year))
        for _ in range(2):
            rows = fanout.event_rows(spark, config, "a", SCHEMA)
            sink.start_event(rows, "e", ("dpYear",), config).awaitTermination()
    found = spark.read.parquet(config.event_path("e")).orderBy("n").collect()
    assert [(r.n, r.dpYear) for r in found] == [(0, 2023), (1, 2024), (2, 2024)]


def test_pool_is_restored(spark, root):
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    try:
        assert fanout.start_all(spark, registry(spark), subjects(spark), parquet_config(root)) == []
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "mine"
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def test_optimized_write_splits_a_hot_partition(spark, root):
    """One day with nearly all rows becomes several files, each small day one."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 100 < 97, 1).otherwise((F.col("id") % 100).cast("int")).alias("dpDay"))
    rows.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    config = parquet_config(root, optimize_write=True, target_bytes=4 << 20)
    sink.start_event(stream, "e", ("dpDay",), config).awaitTermination()
    files = spark.read.parquet(config.event_path("e")).groupBy("dpDay").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("rows"))
    found = {r.dpDay: (r.files, r.rows) for r in files.collect()}
    assert found[1][0] > 2 and found[1][1] == 388_000
    assert all(found[day] == (1, 4_000) for day in (97, 98, 99))


def test_compact_keeps_rows_and_refuses_an_existing_target(spark, root):
    rows = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 3).cast("int").alias("day"))
    rows.write.partitionBy("day").parquet(f"{root}/small")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sink.compact(spark, f"{root}/small", f"{root}/large", ["day"])
    large = spark.read.parquet(f"{root}/large")
    assert large.select("id", "day").exceptAll(rows).isEmpty() and large.count() == 1000
    assert large.select("_metadata.file_path").distinct().count() == 3
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    with pytest.raises(Exception, match="(?i)exists"):
        sink.compact(spark, f"{root}/small", f"{root}/large", ["day"])
    sink.compact(spark, f"{root}/small", f"{root}/one", ["day"], where="day = 1")
    assert spark.read.parquet(f"{root}/one").select("day").distinct().collect()[0].day == 1


def test_compact_keeps_late_columns_and_partition_text(spark, root):
    for text, columns in (("007", "id"), ("1e3", "id, id * 2 AS late"), ("08", "id"), (None, "id, id * 2 AS late")):
        rows = spark.range(20).selectExpr(*columns.split(", ")).withColumn("part", F.lit(text).cast("string"))
        rows.write.mode("append").partitionBy("part").parquet(f"{root}/small")
    sink.compact(spark, f"{root}/small", f"{root}/large", ["part"])
    with sink.session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        large = spark.read.parquet(f"{root}/large")
        assert {r.part for r in large.select("part").distinct().collect()} == {"007", "1e3", "08", None}
        assert large.count() == 80 and large.where("late = id * 2").count() == 40
    sink.compact(spark, f"{root}/small", f"{root}/typed", ["part"], schema="id long, late long, part string")
    assert spark.read.schema("id long, late long, part string").parquet(f"{root}/typed").where("late IS NOT NULL").count() == 40


def test_compact_without_partitions(spark, root):
    spark.range(0, 1000, 1, 8).write.parquet(f"{root}/small")
    sink.compact(spark, f"{root}/small", f"{root}/large")
    large = spark.read.parquet(f"{root}/large")
    assert large.count() == 1000 and len(large.inputFiles()) == 1


def test_read_records_keeps_topic_and_value_only(spark, root):
    config = parquet_config(root, source_options=log(spark, root, ("a", 1, "2024")))
    assert read_records(spark, config, "a").columns == ["topic", "value"]

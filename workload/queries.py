"""The registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import IngestConfig
from sluice.functions.avro_types import ddl_type
from sluice.operators import definitions as defs
from sluice.operators import records as rec
from sluice.operators import drift, reconcile, resolution, versions
from sluice.operators import registry as reg
from sluice.operators.latest import last_per_key
from sluice.plans import tables
from sluice.sources.registry import latest_schemas, read_registry, read_schemas
from sluice.sources.stream import RECORD_SCHEMA, read_records
from sluice.streaming import fanout, files, ledger, multiplex, sink
from sluice.streaming.published import publish, read_published
from sluice.streaming.quarantine import quarantined_records, start_separated
from workload import inputs

DAY = ("dpYear", "dpMonth", "dpDay")
TOPICS = "click,error,purchase,signup,view"
ROW_SCHEMA = (
    "event_id long, user_id long, value double, dpYear int, dpMonth int, dpDay int"
)
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rows_at(spark: SparkSession, path: str) -> DataFrame:
    """Read a sink back in a fixed column order: partition columns come last and are inferred."""
    names = [field.split()[0] for field in ROW_SCHEMA.split(", ")]
    return spark.read.schema(ROW_SCHEMA).parquet(path).select(*names)


def _fields(spark, sf_dir):
    return inputs.body_fields(inputs.events(spark, sf_dir))


def _json(spark, sf_dir):
    return inputs.json_records(_fields(spark, sf_dir))


def _bodies(spark, sf_dir):
    return rec.strip_header(_json(spark, sf_dir))


# --- sources ---------------------------------------------------------------------------


def _record_log(spark, fields: DataFrame, label: str) -> str:
    """Write wire records as a log partitioned by topic."""
    path = inputs.scratch(spark, label)
    inputs.json_records(fields).write.partitionBy("topic").parquet(path)
    return path


@query
def src_stream_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _record_log(spark, _fields(spark, sf_dir), "log")
    root = inputs.scratch(spark, "read")
    config = inputs.parquet_config(root, source_options={"path": log})
    stream = read_records(spark, config, TOPICS)
    sink.start_event(stream, "records", (), config).awaitTermination()
    records = spark.read.schema(RECORD_SCHEMA).parquet(config.event_path("records"))
    body = F.substring("value", 6, 2**31 - 1).cast("string")
    return records.select(
        "topic",
        F.hex(F.substring("value", 1, 5)).alias("header"),
        F.get_json_object(body, "$.event_id").cast("long").alias("event_id"),
    )


@query
def reg_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.scratch(spark, "registry")
    inputs.registry(spark, sf_dir).write.parquet(path)
    return read_registry(spark, path)


@query
def reg_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.with_topics(inputs.registry(spark, sf_dir)).select("ordinal", "topics")


@query
def schema_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.scratch(spark, "schemas")
    inputs.schema_versions(spark, sf_dir).write.parquet(path)
    return latest_schemas(read_schemas(spark, path))


# --- records to rows -------------------------------------------------------------------


@query
def proj_strip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("body").cast("string")
    return _bodies(spark, sf_dir).select(
        F.substring(text, 1, 1).alias("first_char"),
        F.get_json_object(text, "$.event_id").cast("long").alias("event_id"),
    )


@query
def proj_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = rec.decode_body(_bodies(spark, sf_dir), inputs.BODY_SCHEMA, "json")
    return decoded.select("output.event_id", "output.user_id", "output.value")


@query
def proj_decode_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.damaged_json_records(_fields(spark, sf_dir))
    decoded = rec.decode_body(rec.strip_header(records), inputs.BODY_SCHEMA, "json", "PERMISSIVE")
    return rec.flatten(decoded)


@query
def proj_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.flatten(rec.decode_body(_bodies(spark, sf_dir), inputs.BODY_SCHEMA, "json"))


@query
def proj_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.col("dpDay"), F.col("event_id") % 5
    fields = _fields(spark, sf_dir).withColumns({
        "dpDay": F.when(kind == 0, F.concat(F.lit(" "), day, F.lit(" ")))
        .when(kind == 1, F.concat(day, F.lit(".75")))
        .when(kind == 2, "x")
        .otherwise(day),
        "dpMonth": F.date_format(F.make_date("dpYear", "dpMonth", day), "yyyy-MM-dd"),
        "dpHour": F.lpad((F.col("event_id") % 24).cast("string"), 2, "0"),
    })
    schema = inputs.BODY_SCHEMA.replace(
        '{"name": "dpDay"', '{"name": "dpHour", "type": "string"}, {"name": "dpDay"'
    ).replace(
        '{"name": "dpMonth", "type": "string"}',
        '{"name": "dpMonth", "type": {"type": "int", "logicalType": "date"}}',
    )
    return rec.to_rows(inputs.json_records(fields), schema, "json")


# --- registry ---------------------------------------------------------------------------


@query
def reg_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.active(inputs.registry(spark, sf_dir)).select("ordinal", "event_key")


@query
def reg_streamable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.streamable(inputs.registry(spark, sf_dir)).select("ordinal", *reg.IDENTITY)


@query
def reg_streamable_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = reg.streamable(inputs.registry(spark, sf_dir), require_partitions=False)
    return entries.select("ordinal", *reg.IDENTITY)


@query
def reg_tableable(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = reg.tableable(inputs.registry(spark, sf_dir))
    return entries.select("ordinal", "event_key", "is_transactional", "partition_columns")


@query
def reg_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = reg.bucketed(reg.streamable(inputs.registry(spark, sf_dir)))
    return entries.select("ordinal", "event_key", "bucket_id")


@query
def reg_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.transactional_keys(inputs.registry(spark, sf_dir))


@query
def reg_nontxn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.non_transactional_keys(inputs.registry(spark, sf_dir))


@query
def reg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.distinct_events(reg.streamable(inputs.registry(spark, sf_dir)))


@query
def reg_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_per_key(inputs.registry(spark, sf_dir))


@query
def reg_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.priority_order(
        reg.distinct_events(reg.bucketed(reg.streamable(inputs.registry(spark, sf_dir))))
    )


@query
def reg_bucket_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.bucket_members(reg.streamable(inputs.registry(spark, sf_dir)))


@query
def reg_partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = reg.with_partitions(inputs.registry(spark, sf_dir))
    return parsed.select(
        "ordinal",
        F.array_join("stream_partitions", "|").alias("stream_partitions"),
        F.array_join("table_partitions", "|").alias("table_partitions"),
    )


@query
def reg_stream_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fanout.stream_plan(
        inputs.registry(spark, sf_dir), inputs.schema_versions(spark, sf_dir)
    )
    return plan.select(
        "event_key", "topics", "bucket_id", "partition_columns", "is_transactional", "priority",
        F.array_join("stream_partitions", "|").alias("stream_partitions"),
        "schema",
    )


@query
def reg_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the stream of an event writes and where its table points, on every event with either."""
    entries, config = inputs.registry(spark, sf_dir), _table_config()

    def side(events: DataFrame, name: str) -> DataFrame:
        path = config.event_path_column(F.col("event_key"), F.col("is_transactional"))
        return events.select(
            "event_key", path.alias(f"{name}_path"), F.array_join(f"{name}_partitions", "|").alias(f"{name}_partitions")
        )

    streams = side(reg.events_to_stream(entries), "stream")
    return streams.join(side(defs.table_definitions(entries), "table"), "event_key", "full")


@query
def reg_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the queries of an older registry to those of a newer one; the schemas stay."""
    entries, schemas = inputs.registry(spark, sf_dir), inputs.schema_versions(spark, sf_dir)
    plans = [reconcile.with_digest(fanout.stream_plan(entries.where(f"ordinal % {n} <> 0"), schemas)) for n in (3, 4)]
    return reconcile.actions(plans[0].select("event_key", "digest"), plans[1])


@query
def reg_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of every event from one entry: directory, flag and partition columns."""
    entries, config = resolution.resolved_entries(inputs.registry(spark, sf_dir)), _table_config()
    path = config.event_path_column(F.col("event_key"), F.col("is_transactional"))
    streams = resolution.stream_side(entries).select(
        "event_key", F.col("ordinal").alias("source"), "topics", "bucket_id", path.alias("stream_path"),
        F.array_join("stream_partitions", "|").alias("stream_partitions"),
    )
    tables_ = resolution.table_side(entries).select(
        "event_key", F.col("ordinal").alias("described_by"), path.alias("table_path"),
        F.array_join("table_partitions", "|").alias("table_partitions"), F.size("columns").cast("long").alias("columns"),
    )
    agreed = (F.col("stream_path") == F.col("table_path")) & (
        F.col("stream_partitions") == F.coalesce("table_partitions", F.lit("")))
    return streams.join(tables_, "event_key", "full").withColumn("agreed", agreed)


# --- schemas and tables -----------------------------------------------------------------


@query
def schema_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every version of every subject and the one before it read each other."""
    return versions.compatibility(inputs.schema_history(spark, sf_dir))


@query
def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defs.column_list(defs.table_definitions(inputs.registry(spark, sf_dir)))


@query
def schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.substring_index("error", ":", 1).alias("code")
    return defs.rejects(inputs.registry(spark, sf_dir)).select("ordinal", "event_key", code)


@query
def schema_type_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = inputs.type_texts(spark, sf_dir).withColumn("d", ddl_type(F.col("type_json")))
    return described.select("event_id", "d.ddl", F.substring_index("d.error", ":", 1).alias("code"))


@query
def tbl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = defs.table_definitions(inputs.registry(spark, sf_dir))
    return definitions.select(
        F.when(F.col("is_transactional"), "Txn").otherwise("NonTxn").alias("side"),
        "event_key", F.array_join("table_partitions", ", ").alias("partitions"), F.size("columns").cast("long").alias("columns"),
    )


@query
def tbl_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = defs.table_definitions(inputs.registry(spark, sf_dir))
    return defs.transactional_side(definitions, False).select(
        "event_key", F.array_join("table_partitions", ", ").alias("partitions")
    )


@query
def tbl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defs.definition_counts(defs.table_definitions(inputs.registry(spark, sf_dir)))


def _table_config(**settings) -> IngestConfig:
    settings = {"txn_path": "/base/Txn/", "non_txn_path": "/base/NonTxn/", **settings}
    return IngestConfig("/base", "/base/checkpoints", **settings)


@query
def tbl_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = defs.table_definitions(inputs.registry(spark, sf_dir))
    statements = tables.create_statements(definitions, _table_config(), catalog="main")
    return statements.select("event_key", "namespace", "statement")


@query
def tbl_ddl_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = defs.table_definitions(inputs.registry(spark, sf_dir))
    statements = tables.create_statements(definitions, _table_config(), quoted=False)
    return statements.select("event_key", "namespace", "statement")


@query
def tbl_alter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to add to tables of older schemas, and what they cannot follow."""
    entries = inputs.registry(spark, sf_dir)
    lagging = drift.drifted(defs.table_definitions(entries), entries, inputs.older_tables(spark, sf_dir))
    statements = tables.alter_statements(lagging, "main")
    return statements.select("event_key", "statement", F.array_join("refused", "; ").alias("refused"))


@query
def tbl_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _create(spark, sf_dir).select("event_key", "is_transactional", "status")


@query
def tbl_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.outcome_counts(_create(spark, sf_dir))


def _create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the tables of both sides in schemas of their own, and drop these again."""
    root, suffix = inputs.scratch(spark, "tables"), uuid.uuid4().hex[:12]
    names = {flag: f"{name}_{suffix}" for flag, name in tables.NAMESPACES.items()}
    config = inputs.parquet_config(
        root, txn_path=f"{root}/Txn", non_txn_path=f"{root}/NonTxn"
    )
    definitions = defs.table_definitions(inputs.topic_registry(spark, sf_dir))
    statements = tables.create_statements(definitions, config, "spark_catalog", names)
    for name in names.values():
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{name}'")
    try:
        return tables.create_tables(spark, statements, sides=tuple(names.values()))
    finally:
        for name in names.values():
            spark.sql(f"DROP SCHEMA {name} CASCADE")


# --- flows ------------------------------------------------------------------------------


def _append(spark: SparkSession, records: DataFrame, config: IngestConfig, schema: str) -> str:
    rows = rec.to_rows(records, schema, config.codec, config.mode)
    sink.start_event(rows, "event", DAY, config).awaitTermination()
    return config.event_path("event")


@query
def flow_event_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = inputs.parquet_config(inputs.scratch(spark, "append"))
    records = inputs.json_records(inputs.body_fields(inputs.events_stream(spark, sf_dir)))
    return _rows_at(spark, _append(spark, records, config, inputs.BODY_SCHEMA))


@query
def flow_permissive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the bodies is damaged; their rows are kept, all null, in the null partition."""
    config = inputs.parquet_config(inputs.scratch(spark, "permissive"))
    fields = inputs.body_fields(inputs.events_stream(spark, sf_dir))
    records = inputs.damaged_json_records(fields)
    return _rows_at(spark, _append(spark, records, config, inputs.BODY_SCHEMA))


@query
def flow_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a stream with damaged records, and the damaged ones as they came."""
    config = inputs.parquet_config(inputs.scratch(spark, "quarantine"), quarantine=True)
    records = inputs.damaged_json_records(inputs.body_fields(inputs.events_stream(spark, sf_dir)))
    start_separated(records, "event", inputs.BODY_SCHEMA, DAY, config).awaitTermination()
    rows = ledger.read_event(spark, config, "event", ROW_SCHEMA)
    lost = quarantined_records(spark, config, "event").select("topic", F.length("value").cast("long").alias("octets"))
    return lost.withColumn("quarantined", F.lit(True)).unionByName(
        rows.withColumn("quarantined", F.lit(False)), allowMissingColumns=True)


@query
def flow_schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two schema ids through the streams of their events, each decoded by its own."""
    root = inputs.scratch(spark, "ids")
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    inputs.versioned_json_records(_fields(spark, sf_dir)).write.partitionBy("topic").parquet(f"{root}/log")
    started = fanout.start_all(spark, inputs.topic_registry(spark, sf_dir), inputs.identified_schemas(spark, sf_dir), config)
    fanout.await_all(spark, started)
    rows = spark.createDataFrame([], f"event_key string, {ROW_SCHEMA}")
    for outcome in started:
        read = ledger.read_event(spark, config, outcome.event_key, ROW_SCHEMA)
        rows = rows.unionByName(read.withColumn("event_key", F.lit(outcome.event_key)))
    return rows


def _halves(spark, sf_dir) -> list[DataFrame]:
    """All events, as an earlier and a later delivery."""
    fields = _fields(spark, sf_dir)
    return [fields.where("event_id % 2 = 0"), fields.where("event_id % 2 = 1")]


def _deliver(fields: DataFrame, log: str) -> None:
    inputs.json_records(fields).write.mode("append").partitionBy("topic").parquet(log)


@query
def flow_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.scratch(spark, "restart")
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    for delivery in _halves(spark, sf_dir):
        _deliver(delivery, f"{root}/log")
        for _ in range(2):  # the second run finds nothing new and adds nothing
            rows = fanout.event_rows(spark, config, TOPICS, inputs.BODY_SCHEMA)
            sink.start_event(rows, "event", DAY, config).awaitTermination()
    return _rows_at(spark, config.event_path("event"))


@query
def flow_relayout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries under three layouts: one more partition column, then the other kind's directory."""
    root, fields = inputs.scratch(spark, "relayout"), _fields(spark, sf_dir)
    config = inputs.parquet_config(
        root, source_options={"path": f"{root}/log"}, txn_path=f"{root}/txn", non_txn_path=f"{root}/non-txn")
    for n, (partitions, flag) in enumerate([(DAY[:1], False), (DAY, False), (DAY, True)]):
        _deliver(fields.where(F.col("event_id") % 3 == n), f"{root}/log")
        for _ in range(2):  # the second run finds nothing new and stays in its generation
            rows = fanout.event_rows(spark, config, TOPICS, inputs.BODY_SCHEMA)
            sink.start_event(rows, "event", partitions, config, flag).awaitTermination()
    names = [field.split()[0] for field in ROW_SCHEMA.split(", ")]
    return ledger.read_event(spark, config, "event", ROW_SCHEMA).select(*names)


def _narrow_then_wide(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, IngestConfig]:
    """Two runs; the second one's rows have a column more."""
    root = inputs.scratch(spark, label)
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    for delivery, schema in zip(
        _halves(spark, sf_dir), (inputs.NARROW_SCHEMA, inputs.BODY_SCHEMA)
    ):
        _deliver(delivery, f"{root}/log")
        rows = fanout.event_rows(spark, config, TOPICS, schema)
        sink.start_event(rows, "event", DAY, config).awaitTermination()
    return root, config


@query
def flow_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, config = _narrow_then_wide(spark, sf_dir, "merge")
    merged = spark.read.option("mergeSchema", "true").parquet(config.event_path("event"))
    return merged.select("event_id", "user_id", "value", *DAY)


def _fan_out(spark: SparkSession, sf_dir: str):
    root = inputs.scratch(spark, "fanout")
    log = _record_log(spark, _fields(spark, sf_dir), "log")
    topic_directories = {"path": f"{log}/topic={{topics}}", "basePath": log}
    config = inputs.parquet_config(root, source_options=topic_directories)
    started = fanout.start_all(
        spark, inputs.topic_registry(spark, sf_dir), inputs.schema_versions(spark, sf_dir), config
    )
    fanout.await_all(spark, started)
    return config, started


@query
def flow_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events' output in one scan; the key, and what a directory name holds, from the path."""
    config, started = _fan_out(spark, sf_dir)
    names = [field.split()[0] for field in ROW_SCHEMA.split(", ")]
    if all(outcome.error for outcome in started):
        return spark.createDataFrame([], f"event_key string, {ROW_SCHEMA}")
    path = F.col("_metadata.file_path")
    rows = spark.read.schema(ROW_SCHEMA).option("recursiveFileLookup", "true").parquet(config.output_path)
    value = lambda n: F.coalesce(n, F.regexp_extract(path, f"/{n}=([0-9]+)/", 1).try_cast("int"))
    return rows.select(
        F.regexp_extract(path, "/out/([^/]+)/", 1).alias("event_key"),
        *(value(n).alias(n) if n in DAY else n for n in names),
    )


@query
def flow_multiplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries to groups of two events, then the newest batch of each group once more."""
    root = inputs.scratch(spark, "multiplex")
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    registry, schemas = inputs.topic_registry(spark, sf_dir), inputs.schema_versions(spark, sf_dir)
    keys: set[str] = set()
    for delivery in _halves(spark, sf_dir):
        _deliver(delivery, f"{root}/log")
        started = multiplex.start_groups(spark, registry, schemas, config, per_query=2)
        fanout.await_all(spark, started)
        keys.update(key for outcome in started for key in outcome.events)
    for outcome in started:
        if outcome.events:
            files.remove(spark, f"{config.checkpoint_path}/_{outcome.event_key}/commits/1")
    fanout.await_all(spark, multiplex.start_groups(spark, registry, schemas, config, per_query=2))
    rows = spark.createDataFrame([], f"event_key string, {ROW_SCHEMA}")
    for key in sorted(keys):
        rows = rows.unionByName(
            ledger.read_event(spark, config, key, ROW_SCHEMA).withColumn("event_key", F.lit(key)))
    return rows


@query
def flow_query_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, started = _fan_out(spark, sf_dir)
    return spark.createDataFrame(
        [(s.event_key, s.query.name if s.query else None) for s in started], "event_key string, query_name string"
    )


@query
def flow_fanout_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, started = _fan_out(spark, sf_dir)
    return spark.createDataFrame(
        [(n, s.event_key, s.bucket_id, s.error is None) for n, s in enumerate(started)],
        "position int, event_key string, bucket_id string, streamed boolean",
    )


def _files_per_day(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(ROW_SCHEMA).parquet(path)
    return rows.select(*DAY, F.col("_metadata.file_path").alias("file")).groupBy(*DAY).agg(
        F.count("*").alias("rows"), F.count_distinct("file").alias("files")
    )


@query
def sink_optimized_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = inputs.parquet_config(inputs.scratch(spark, "optimized"), optimize_write=True)
    records = inputs.json_records(inputs.body_fields(inputs.events_stream(spark, sf_dir)))
    return _files_per_day(spark, _append(spark, records, config, inputs.BODY_SCHEMA))


@query
def sink_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.scratch(spark, "compact")
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    for delivery in _halves(spark, sf_dir):  # two batches, so two files a day or more
        _deliver(delivery, f"{root}/log")
        rows = fanout.event_rows(spark, config, TOPICS, inputs.BODY_SCHEMA)
        sink.start_event(rows, "event", DAY, config).awaitTermination()
    sink.compact(spark, config.event_path("event"), f"{root}/compacted", DAY, schema=ROW_SCHEMA)
    before = _files_per_day(spark, config.event_path("event"))
    after = _files_per_day(spark, f"{root}/compacted")
    values = spark.read.schema(ROW_SCHEMA).parquet(f"{root}/compacted").groupBy(*DAY).agg(
        F.sum("event_id").alias("event_ids"), F.sum("user_id").alias("user_ids"),
        F.count("value").alias("filled"), F.min("value").alias("least"), F.max("value").alias("most"),
    )
    before = before.withColumnsRenamed({"rows": "n", "files": "files_before"})
    return after.join(before, list(DAY)).join(values, list(DAY)).select(
        *DAY, "rows", "files", (F.col("files") < F.col("files_before")).alias("fewer"),
        "event_ids", "user_ids", "filled", "least", "most",
    )


@query
def sink_compact_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction of files of two schemas, the older ones without ``value``."""
    root, config = _narrow_then_wide(spark, sf_dir, "compact-merged")
    sink.compact(spark, config.event_path("event"), f"{root}/compacted", DAY)
    return _rows_at(spark, f"{root}/compacted")


@query
def sink_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live directory read three times: after its first delivery is published, after a later one, and published again."""
    root = inputs.scratch(spark, "published")
    config = inputs.parquet_config(root, source_options={"path": f"{root}/log"})
    source, target, reads = config.event_path("event"), f"{root}/published", []
    names = [field.split()[0] for field in ROW_SCHEMA.split(", ")]

    def look(stage: str) -> None:
        rows = read_published(spark, source, target, DAY, ROW_SCHEMA)
        reads.append(rows.select(F.lit(stage).alias("stage"), *names))

    for n, delivery in enumerate(_halves(spark, sf_dir)):
        _deliver(delivery, f"{root}/log")
        rows = fanout.event_rows(spark, config, TOPICS, inputs.BODY_SCHEMA)
        sink.start_event(rows, "event", DAY, config).awaitTermination()
        if n:
            look("late rows")
        publish(spark, source, target, DAY, "dpDay % 2 = 0", schema=ROW_SCHEMA)
        look(f"publication {n + 1}")
    return reads[0].unionAll(reads[1]).unionAll(reads[2])


@query
def sink_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = inputs.parquet_config(inputs.scratch(spark, "compression"), compression="zstd")
    records = inputs.json_records(inputs.body_fields(inputs.events_stream(spark, sf_dir)))
    rows = spark.read.schema(ROW_SCHEMA).parquet(_append(spark, records, config, inputs.BODY_SCHEMA))
    codec = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9]+)\.parquet$", 1)
    return rows.select(*DAY, codec.alias("codec")).groupBy(*DAY, "codec").agg(F.count("*").alias("rows"))

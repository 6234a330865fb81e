"""Writing the rows of an event, and keeping its files large."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sluice.config import IngestConfig
from sluice.streaming import files
from sluice.streaming.ledger import Layout, append_batch, settle

ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def sink_options(config: IngestConfig) -> dict[str, str]:
    options = {"mergeSchema": _text(config.merge_schema)}
    if config.compression:
        options["compression"] = config.compression
    if config.sink_format == "delta":
        options["delta.autoOptimize.optimizeWrite"] = _text(config.optimize_write)
        options["delta.autoOptimize.autoCompact"] = _text(config.auto_compact)
    return options


def _text(flag: bool) -> str:
    return str(flag).lower()


def require_switches(spark: SparkSession, config: IngestConfig) -> None:
    """Refuse switches that this sink or session would ignore without a word."""
    if config.quarantine and (config.sink_format == "delta" or config.mode != "PERMISSIVE"):
        raise ValueError("quarantine needs mode PERMISSIVE and a sink with batch directories, not Delta")
    if config.sink_format == "delta":
        if config.target_bytes is not None:
            raise ValueError("target_bytes has no effect on a Delta sink")
        return
    if config.auto_compact:
        raise ValueError(
            f"auto_compact needs a Delta sink, not {config.sink_format!r}; run compact instead"
        )
    if config.target_bytes is not None and not config.optimize_write:
        raise ValueError("target_bytes needs optimize_write")
    if config.optimize_write and spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("optimize_write needs spark.sql.adaptive.enabled")


def gather_partitions(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring the rows of an output partition together before the write.

    A rebalance, so adaptive execution joins small output partitions into one
    task and splits one that is too large for a task, however hot its value.
    """
    return rows.hint("rebalance", *partitions)


def event_writer(
    rows: DataFrame,
    event_key: str,
    partitions: Sequence[str],
    config: IngestConfig,
    is_transactional: bool | None = None,
    layout: Layout | None = None,
) -> DataStreamWriter:
    """The append of one event: own directory, own checkpoint, own query name.

    Exactly-once comes from the sink's own commit log and the checkpoint. That log cannot start in the middle
    of a checkpoint, so generations after the first take each batch to the directory of its number.
    Delta gathers partitions itself if told to; for other formats
    ``optimize_write`` adds the shuffle here, inside the same micro-batch plan.
    """
    require_switches(rows.sparkSession, config)
    if config.optimize_write and config.sink_format != "delta":
        rows = gather_partitions(rows, partitions)
    writer = rows.writeStream.outputMode("append")
    if layout is not None and layout.in_batches:
        form, options = config.sink_format, sink_options(config)
        writer = writer.foreachBatch(lambda batch, number: append_batch(batch, number, layout, form, options))
    else:
        path = config.event_path(event_key, is_transactional)
        writer = writer.format(config.sink_format).options(**sink_options(config)).option("path", path)
        if partitions:
            writer = writer.partitionBy(*partitions)
    writer = writer.option("checkpointLocation", config.event_checkpoint(event_key)).queryName(f"Stream-{event_key}")
    return trigger(writer, config)


def trigger(writer: DataStreamWriter, config: IngestConfig) -> DataStreamWriter:
    if config.available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=config.processing_time)


def start_event(
    rows: DataFrame,
    event_key: str,
    partitions: Sequence[str],
    config: IngestConfig,
    is_transactional: bool | None = None,
) -> StreamingQuery:
    """Starts the append where the ledger says. A query keeps the session settings of its start, so the size holds."""
    spark, layout = rows.sparkSession, None
    require_switches(spark, config)
    if config.sink_format != "delta":
        layout = settle(spark, config, event_key, rows.schema, partitions, is_transactional)
    writer = event_writer(rows, event_key, partitions, config, is_transactional, layout)
    size = {} if config.target_bytes is None else {ADVISORY_SIZE: str(config.target_bytes)}
    with session_conf(spark, size):
        return writer.start()


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: Sequence[str] = (),
    format: str = "parquet",
    target_bytes: int = 256 * 1024 * 1024,
    where: str | None = None,
    schema: T.StructType | str | None = None,
) -> None:
    """Rewrite small files as files of about ``target_bytes`` in a new directory.

    The source stays as it is: a streaming sink's log pins its files. ``where``
    on partition columns limits the work to some directories. ``schema`` is that of the rows,
    partition columns included; without one the schemas of all files are merged, which
    opens every footer. A schema that lacks a column of the files is refused, by one footer of each directory. Partition
    values that no schema types are text and are carried over unchanged. The target must have the
    columns and as many rows as were read; both counts come from footers. Without any row nothing is written.
    """
    with session_conf(spark, {
        "spark.sql.adaptive.enabled": "true",
        ADVISORY_SIZE: str(target_bytes),
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }):
        reader = spark.read.format(format)
        reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
        rows = reader.load(source)
        if schema is not None:
            require_columns(rows, source, format)
        if where:
            rows = rows.where(where)
        if rows.isEmpty():
            return
        writer = gather_partitions(rows, partitions).write.format(format).mode("errorifexists")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.save(target)
        written = spark.read.format(format).schema(rows.schema).load(target)
        stored = spark.read.format(format).load(target).columns
        if sorted(stored) != sorted(rows.columns) or written.count() != rows.count():
            raise RuntimeError(f"{target} does not hold the rows of {source}")


def require_columns(rows: DataFrame, source: str, format: str = "parquet") -> None:
    """Refuse a reader's schema that leaves out a column of the files it reads."""
    sample = {path.rsplit("/", 1)[0]: path for path in files.input_paths(rows)}
    if not sample:
        return
    reader = rows.sparkSession.read.format(format).option("mergeSchema", "true").option("basePath", source)
    lacking = sorted(set(reader.load(list(sample.values())).columns) - set(rows.columns))
    if lacking:
        raise ValueError(f"the schema lacks the columns {', '.join(lacking)} of {source}")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)

"""Table definitions: the columns of each event, from its registry entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.avro_types import avro_columns
from sluice.operators.latest import last_per_key
from sluice.operators.registry import (
    event_flag,
    tableable,
    with_partitions,
    with_stream_schema,
    with_topics,
)


def with_newest_schemas(registry: DataFrame, schemas: DataFrame) -> DataFrame:
    """The registry with the schema its streams decode with in place of ``complete_schema``."""
    events = with_topics(registry.select("ordinal", "event_key", "topic_list"))
    newest = with_stream_schema(
        events.select(F.col("ordinal").alias("event_key"), "topics"), schemas
    ).select(F.col("event_key").alias("ordinal"), F.col("schema").alias("complete_schema"))
    return registry.drop("complete_schema").join(newest, "ordinal").select(*registry.columns)


def described(registry: DataFrame) -> DataFrame:
    """Complete entries with ``columns``, or with an ``error`` and no columns."""
    parsed = tableable(registry).withColumn("parsed", avro_columns(F.col("complete_schema")))
    return parsed.select(
        "ordinal", "event_key", "is_transactional", "partition_columns",
        F.col("parsed.columns").alias("columns"), F.col("parsed.error").alias("error"),
    )


def rejects(registry: DataFrame) -> DataFrame:
    """Entries whose schema is unusable. They take no other entry with them."""
    return rejected(described(registry))


def rejected(entries: DataFrame) -> DataFrame:
    return entries.where("error IS NOT NULL").select("ordinal", "event_key", "error")


def table_definitions(registry: DataFrame) -> DataFrame:
    """One definition per event: its last entry with a usable schema, and the event's flag."""
    return defined(described(registry), event_flag(registry))


def defined(entries: DataFrame, flags: DataFrame) -> DataFrame:
    """The definitions among described entries. Both sides are laid out by key: the join is local."""
    usable = last_per_key(entries.where("error IS NULL").drop("error", "is_transactional"))
    names = ("ordinal", "event_key", "is_transactional", "partition_columns", "columns")
    return with_partitions(usable.join(flags, "event_key").select(*names)).drop("stream_partitions")


def column_list(definitions: DataFrame) -> DataFrame:
    """One row per column of every definition, in schema order."""
    exploded = definitions.select("event_key", F.posexplode("columns").alias("ordinal", "column"))
    return exploded.select("event_key", "ordinal", "column.column_name", "column.data_type")


def transactional_side(definitions: DataFrame, is_transactional: bool) -> DataFrame:
    """The definitions of one side; both sides come from one plan by this filter."""
    return definitions.where(F.col("is_transactional") == is_transactional)


def definition_counts(definitions: DataFrame) -> DataFrame:
    return definitions.groupBy("is_transactional").agg(F.count("*").alias("definitions"))

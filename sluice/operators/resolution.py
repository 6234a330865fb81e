"""One entry per event for both sides: what streams and what its table describes.

Filtering the two sides apart picks two entries of a key wherever its newest entry suits only one of
them, and then stream and table disagree on flag, directory or partition columns. Here every entry is
ranked by what it suits, one composite maximum per key picks the winner, and the winner goes to both sides
as one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.avro_types import avro_columns
from sluice.operators.registry import (
    active,
    can_stream,
    can_table,
    in_bucket,
    with_partitions,
    with_topics,
)

#: Ranks, high ones first: an entry for both sides, for the table only, for the stream only.
BOTH, TABLE_ONLY, STREAM_ONLY = 3, 2, 1


def ranked(registry: DataFrame, require_partitions: bool = True) -> DataFrame:
    """Active entries with ``rank`` (0: suits no side), ``columns`` (null without a usable schema) and ``error``."""
    parsed = active(registry).withColumn("parsed", F.when(can_table(), avro_columns(F.col("complete_schema"))))
    streams = F.coalesce(can_stream(require_partitions) & in_bucket(), F.lit(False))
    rank = F.when(F.col("parsed.columns").isNotNull(), TABLE_ONLY).otherwise(0) + F.when(streams, STREAM_ONLY).otherwise(0)
    return parsed.select(
        *registry.columns, rank.alias("rank"), F.col("parsed.columns").alias("columns"), F.col("parsed.error").alias("error"))


def resolved_entries(registry: DataFrame, require_partitions: bool = True) -> DataFrame:
    return resolved(ranked(registry, require_partitions))


def resolved(entries: DataFrame) -> DataFrame:
    """event_key, ``rank``, ``entry`` and ``source``, one row per event that streams or has a table.

    ``entry`` (ordinal, partition_columns, is_transactional, columns) is the newest of the entries with
    the highest rank; both sides take their layout from it. Its flag is that of the newest entry with a usable schema,
    as for ``table_definitions``: an entry that moves an event to the other kind need not stream to do so. ``source``
    (ordinal, topic_list, bucket_id) is where the event streams from: the entry itself, or, if no entry suits
    both sides, the newest that streams; null if none does. All maxima combine before the shuffle.
    """
    streams, usable = F.col("rank").isin(BOTH, STREAM_ONLY), F.col("rank") >= TABLE_ONLY
    best = entries.where("rank > 0").groupBy("event_key").agg(
        F.max_by(
            F.struct("rank", "ordinal", "partition_columns", "is_transactional", "columns"),
            F.struct("rank", "ordinal"),
        ).alias("entry"),
        F.max_by(
            F.struct("ordinal", "topic_list", "bucket_id"),
            F.when(streams, F.struct((F.col("rank") == BOTH).alias("both"), "ordinal")),
        ).alias("source"),
        F.max_by("is_transactional", F.when(usable, F.col("ordinal"))).alias("flag"),
    )
    entry = F.col("entry").withField("is_transactional", F.coalesce("flag", "entry.is_transactional"))
    return best.select("event_key", "entry.rank", entry.dropFields("rank").alias("entry"), "source")


def stream_side(resolved: DataFrame) -> DataFrame:
    """The events to stream, as ``events_to_stream`` gives them, with the resolved layout."""
    events = resolved.where("source IS NOT NULL").select(
        "source.ordinal", "event_key", "source.topic_list", "source.bucket_id", "entry.partition_columns",
        "entry.is_transactional",
    )
    return with_partitions(with_topics(events))


def table_side(resolved: DataFrame) -> DataFrame:
    """The definitions of the tables, as ``table_definitions`` gives them, from the same entries."""
    tables = resolved.where(F.col("rank") >= TABLE_ONLY).select(
        "entry.ordinal", "event_key", "entry.is_transactional", "entry.partition_columns", "entry.columns")
    return with_partitions(tables).drop("stream_partitions")

"""Which registry entries take part, in which bucket and in which order.

All of it is DataFrame to DataFrame. What groups does so on keys that spread
(event key, or all four identifying fields) and combines before the shuffle, so
a key with a large share of the rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import list_items, subject_of, trim_blanks, unbracket
from sluice.operators.latest import last_per_key
from sluice.sources.registry import latest_schemas

# The bucket names, in the order in which they start.
BUCKETS = ("p0Event", "nonP0Event")
IDENTITY = ("event_key", "topic_list", "bucket_id", "partition_columns")


def active(registry: DataFrame) -> DataFrame:
    return registry.where("is_active")


def _filled(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & (F.col(name) != "")
    return condition


def streamable(registry: DataFrame, require_partitions: bool = True) -> DataFrame:
    """Active entries that name a key, a topic, a bucket and partition columns.

    ``require_partitions=False`` also admits entries without partition columns.
    """
    return active(registry).where(can_stream(require_partitions))


def can_stream(require_partitions: bool = True) -> Column:
    """Whether an entry names all that a stream needs."""
    return _filled(*(IDENTITY if require_partitions else IDENTITY[:3]))


def can_table() -> Column:
    """Whether an entry has all that a table needs but for the schema's being usable."""
    names = ("event_key", "complete_schema", "is_transactional")
    return reduce(and_, (F.col(name).isNotNull() for name in names))


def tableable(registry: DataFrame) -> DataFrame:
    """Active entries with a key, a schema and a transaction flag."""
    return active(registry).where(can_table())


def bucketed(registry: DataFrame) -> DataFrame:
    """Entries of a known bucket; the match is exact and case-sensitive."""
    return registry.where(in_bucket())


def in_bucket() -> Column:
    return F.col("bucket_id").isin(*BUCKETS)


def distinct_events(registry: DataFrame) -> DataFrame:
    """One row per key, topics, bucket and partition text."""
    return registry.select(*IDENTITY).distinct()


def transactional_keys(registry: DataFrame) -> DataFrame:
    return registry.where("is_transactional").select("event_key").distinct()


def non_transactional_keys(registry: DataFrame) -> DataFrame:
    """Keys flagged false; an entry without a flag is on neither side."""
    return registry.where("NOT is_transactional").select("event_key").distinct()


def bucket_rank() -> Column:
    rank = F.lit(None).cast("int")
    for position, bucket in enumerate(BUCKETS):
        rank = F.when(F.col("bucket_id") == bucket, position).otherwise(rank)
    return rank


def priority_order(events: DataFrame) -> DataFrame:
    """All of the first bucket before the second, by key within a bucket."""
    ranked = events.withColumn("priority", bucket_rank())
    ties = [name for name in IDENTITY if name not in ("event_key", "bucket_id")]
    return ranked.orderBy("priority", "event_key", *ties)


def bucket_members(registry: DataFrame) -> DataFrame:
    """The events of each bucket, one row per member.

    A bucket holds any number of events, so members are rows and not one list.
    """
    return bucketed(registry).select("bucket_id", "event_key").distinct()


def with_topics(registry: DataFrame) -> DataFrame:
    """Adds ``topics``, the text a source subscribes to."""
    return registry.withColumn("topics", unbracket(F.col("topic_list")))


def with_partitions(registry: DataFrame) -> DataFrame:
    """Adds the partition columns for a stream (may be empty) and for a table (then null)."""
    items = list_items(F.col("partition_columns"))
    return registry.withColumn(
        "stream_partitions", F.coalesce(items, F.array().cast("array<string>"))
    ).withColumn("table_partitions", F.when(F.size(items) > 0, items))


def event_flag(registry: DataFrame) -> DataFrame:
    """event_key, is_transactional: the flag that both the stream and the table of an event follow.

    It is that of the event's newest complete entry for a table. An event without such an
    entry has no flag and no table.
    """
    complete = tableable(registry)
    return complete.groupBy("event_key").agg(
        F.max_by("is_transactional", "ordinal").alias("is_transactional")
    )


def events_to_stream(registry: DataFrame, require_partitions: bool = True) -> DataFrame:
    """The newest entry of every event of the known buckets, with topics, partitions and flag.

    A key has one directory and one checkpoint, so one of its entries streams: the one with the
    highest ordinal, as for its table.
    """
    wanted = bucketed(streamable(registry, require_partitions)).select("ordinal", *IDENTITY)
    events = last_per_key(wanted).join(event_flag(registry), "event_key", "left")
    return with_partitions(with_topics(events.select("ordinal", *IDENTITY, "is_transactional")))


def with_stream_schema(events: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``schema``, the newest one of the event's topics, or null.

    The text is that of the first topic. Only events with several topics are taken apart, to
    see by 128-bit digests that all their subjects have that schema; if not, it is null.
    """
    newest = latest_schemas(schemas).select("subject", "schema")
    digests = newest.select(
        "subject", F.xxhash64("schema").alias("d1"), F.xxhash64(F.lit("second"), "schema").alias("d2")
    )
    topics = F.split("topics", ",")
    parts = events.where(F.size(topics) > 1).select("event_key", F.explode(topics).alias("topic"))
    parts = parts.withColumn("subject", subject_of(trim_blanks(F.col("topic"))))
    agreed = parts.join(digests, "subject", "left").groupBy("event_key").agg(
        ((F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2")) & (F.count("d1") == F.count("*"))).alias("agreed")
    )
    first = events.withColumn("subject", subject_of(trim_blanks(F.get(topics, F.lit(0)))))
    found = first.join(newest, "subject", "left").join(agreed, "event_key", "left")
    schema = F.when((F.size(topics) == 1) | F.col("agreed"), F.col("schema"))
    return found.select(*events.columns, schema.alias("schema"))

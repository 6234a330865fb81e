"""Many events on few queries: one query reads all topics of a group and deals every micro-batch out.

A batch is scanned once, gathered by topic and kept, so that each event reads only the blocks with its
own topics. Each event's rows replace what an earlier attempt at the same batch wrote, so a replayed batch adds
nothing. Which events a group has is recorded once, beside its checkpoint: a group never
takes in an event later, since its checkpoint is past what that event has to read. New events form new groups.

An event whose rows cannot be written does not stop the others: its raw records of that batch are parked, and
``replay_parked`` appends them once the cause is gone.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.config import IngestConfig, join_path
from sluice.operators.records import require_codec
from sluice.operators.versions import to_rows
from sluice.plans.tables import brief
from sluice.sources.stream import RECORD_SCHEMA, read_records
from sluice.streaming import files
from sluice.streaming.fanout import Started, resolved_stream_plan, start_one, writers_of
from sluice.streaming.ledger import BATCH, Layout, append_batch, settle
from sluice.streaming.quarantine import separate, tagged
from sluice.streaming.sink import gather_partitions, require_switches, sink_options, trigger

LOG = logging.getLogger(__name__)
EVENTS_PER_QUERY = 200
#: Events of one batch written at the same time.
THREADS = 16


@dataclass
class Member:
    """An event of a group: where its rows go, or why they are parked."""

    event_key: str
    topics: list[str]
    schema: str | None = None
    partitions: list[str] = field(default_factory=list)
    is_transactional: bool | None = None
    layout: Layout | None = None
    error: str | None = None
    writers: dict[int, str] | None = None


def member_of(event: Row) -> Member:
    topics = [topic.strip() for topic in event.topics.split(",") if topic.strip()]
    return Member(
        event.event_key, topics, event.schema, list(event.stream_partitions), event.is_transactional, writers=writers_of(event))


def settled(spark: SparkSession, member: Member, config: IngestConfig) -> Member:
    """``member`` with the layout of its rows; raises what would keep its rows from being written."""
    if member.schema is None:
        raise LookupError(f"no schema shared by the topics {', '.join(member.topics)}")
    rows = to_rows(spark.createDataFrame([], RECORD_SCHEMA), member.schema, config.codec, config.mode, member.writers)
    absent = [name for name in member.partitions if name not in rows.columns]
    if absent:
        raise ValueError(f"no partition column {', '.join(absent)}")
    if set(rows.columns) <= set(member.partitions):
        raise ValueError("every column is a partition column")
    if config.sink_format != "delta":
        member.layout = settle(
            spark, config, member.event_key, rows.schema, member.partitions, member.is_transactional, batched=True)
    return member


def _records(config: IngestConfig) -> str:
    return join_path(config.checkpoint_path, "_groups")


def groups(spark: SparkSession, config: IngestConfig) -> dict[str, dict]:
    """name -> bucket_id and the members (event_key -> topics at the time) of every group so far."""
    found = {}
    for name, _ in files.names(spark, _records(config)):
        if name.endswith(".json") and not name.startswith("."):
            found[name[:-5]] = json.loads(files.read_text(spark, join_path(_records(config), name)))
    return found


def _form(spark: SparkSession, config: IngestConfig, bucket_id: str, members: list[Member]) -> str:
    record = json.dumps({"bucket_id": bucket_id, "members": {m.event_key: m.topics for m in members}})
    n = len(groups(spark, config))
    while not files.create_once(spark, join_path(_records(config), f"group-{n:05}.json"), record):
        n += 1
    return f"group-{n:05}"


def start_groups(
    spark: SparkSession, registry: DataFrame, schemas: DataFrame, config: IngestConfig,
    per_query: int = EVENTS_PER_QUERY,
) -> list[Started]:
    """One query for up to ``per_query`` events of a bucket, first bucket first, instead of one for each.

    Every ``Started`` with ``events`` is a group. An event that cannot start yet is reported by itself and joins no
    group, so it reads everything once it can. One that has a checkpoint of its own goes on alone. A group
    keeps its events when their bucket changes; an event that left the registry is still read, and its
    records are dropped, as they are for an event without a query. One program at a time may run
    on a checkpoint path, as for any streaming checkpoint.
    """
    require_codec(spark, config.codec)
    require_switches(spark, config)
    events = list(resolved_stream_plan(registry, schemas).toLocalIterator())
    alone = {name for name, _ in files.names(spark, config.checkpoint_path)}
    known = groups(spark, config)
    home = {key: name for name, group in known.items() for key in group["members"]}
    running: dict[str, list[Member]] = {name: [] for name in known}
    fresh: dict[str, list[Member]] = {}
    started = []
    for event in events:
        member = member_of(event)
        if event.event_key in alone and event.event_key not in home:
            started.append(start_one(spark, event, config))
            continue
        try:
            settled(spark, member, config)
        except Exception as e:  # one event must not stop the others
            member.error = brief(e)
            LOG.error("event %s has no rows: %s", event.event_key, e)
            started.append(Started(event.event_key, event.bucket_id, error=member.error))
        if event.event_key in home:
            running[home[event.event_key]].append(member)
        elif member.error is None:
            fresh.setdefault(event.bucket_id, []).append(member)
    for bucket_id, members in fresh.items():
        for i in range(0, len(members), per_query):
            name = _form(spark, config, bucket_id, members[i:i + per_query])
            running[name] = members[i:i + per_query]
    known = groups(spark, config)
    order = sorted((name for name in running if running[name]), key=lambda n: (known[n]["bucket_id"] != "p0Event", n))
    return started + [_start_group(spark, name, known[name], running[name], config) for name in order]


def _start_group(spark: SparkSession, name: str, record: dict, members: list[Member], config: IngestConfig) -> Started:
    recorded = [topic for topics in record["members"].values() for topic in topics]
    topics = ",".join(sorted({*recorded, *(topic for member in members for topic in member.topics)}))

    def start() -> StreamingQuery:
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", record["bucket_id"])
        try:
            writer = read_records(spark, config, topics).writeStream.foreachBatch(dealer(name, members, config))
            writer = writer.option("checkpointLocation", join_path(config.checkpoint_path, f"_{name}"))
            return trigger(writer.queryName(f"Stream-{name}"), config).start()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)

    outcome = Started(name, record["bucket_id"], events=tuple(m.event_key for m in members), start=start)
    return outcome.begin()


def dealer(name: str, members: list[Member], config: IngestConfig) -> Callable[[DataFrame, int], None]:
    """What a group does with each of its batches."""

    def deal(batch: DataFrame, number: int) -> None:
        # Lets adaptive execution split a hot topic and join small ones in what is kept, too.
        batch.sparkSession.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
        # Sorted by topic, so that the kept blocks' statistics leave out those without an event's topics.
        kept = gather_partitions(batch.select("topic", "value"), ["topic"]).sortWithinPartitions("topic").persist()
        try:
            # One row for each subscribed topic.
            present = {row.topic for row in kept.groupBy("topic").count().collect()}
            due = [member for member in members if present.intersection(member.topics)]
            write = inheritable_thread_target(batch.sparkSession)(lambda member: _write(kept, name, number, member, config))
            with ThreadPoolExecutor(THREADS) as pool:
                list(pool.map(write, due))
        finally:
            kept.unpersist()

    return deal


def _write(kept: DataFrame, name: str, number: int, member: Member, config: IngestConfig) -> None:
    spark, records = kept.sparkSession, kept.where(F.col("topic").isin(member.topics))
    parked = join_path(_parked(config, member.event_key), f"{BATCH}={name}-{number}")
    if member.error is None:
        try:
            append_event(records, f"{name}-{number}", member, config)
            if files.exists(spark, parked):  # an earlier attempt at this batch parked it
                files.remove(spark, parked)
            return
        except Exception as e:  # one event must not stop the others
            LOG.error("event %s, batch %s of %s is parked: %s: %s", member.event_key, number, name, type(e).__name__, e)
    records.write.mode("overwrite").parquet(parked)


def append_event(records: DataFrame, batch: str, member: Member, config: IngestConfig) -> None:
    """The rows of one event and batch, in place of an earlier attempt at it."""
    if config.quarantine:
        separate(tagged(records, member.schema, config, member.writers), batch, member.layout, config)
        return
    rows = to_rows(records, member.schema, config.codec, config.mode, member.writers)
    if config.sink_format == "delta":
        name, number = batch.rsplit("-", 1)
        writer = rows.write.format("delta").mode("append").options(**sink_options(config), **delta_attempt(
            config, name, number, member.event_key))
        if member.partitions:
            writer = writer.partitionBy(*member.partitions)
        writer.save(config.event_path(member.event_key, member.is_transactional))
        return
    if config.optimize_write:
        rows = gather_partitions(rows, member.partitions)
    append_batch(rows, batch, member.layout, config.sink_format, sink_options(config))


def delta_attempt(config: IngestConfig, name: str, number: str, event_key: str) -> dict[str, str]:
    """Options by which a Delta table skips a batch that it has already."""
    return {"txnAppId": f"{config.checkpoint_path}/{name}/{event_key}", "txnVersion": number}


def _parked(config: IngestConfig, event_key: str) -> str:
    return join_path(config.checkpoint_path, f"_parked/{event_key}")


def parked_records(spark: SparkSession, config: IngestConfig, event_key: str) -> DataFrame:
    """topic, value and the batch of the records that could not be written."""
    folder = _parked(config, event_key)
    schema = f"topic string, value binary, {BATCH} string"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def replay_parked(spark: SparkSession, event: Row, config: IngestConfig) -> list[str]:
    """Append what is parked of ``event`` (a row of the stream plan), batch by batch; returns the batches.

    A batch leaves the parking place after its rows are written, and writing it again replaces them, so a replay that
    stops half-way is simply repeated. A batch that fails again stays, and raises.
    """
    member, done = settled(spark, member_of(event), config), []
    folder = _parked(config, event.event_key)
    for name, _ in files.names(spark, folder):
        if name.startswith(f"{BATCH}="):
            place, batch = join_path(folder, name), name.split("=", 1)[1]
            append_event(spark.read.schema(RECORD_SCHEMA).parquet(place), batch, member, config)
            files.remove(spark, place)
            done.append(batch)
    return done

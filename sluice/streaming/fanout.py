"""One streaming query per event of the registry."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluice.config import IngestConfig
from sluice.operators.reconcile import START, STOP, actions, with_digest
from sluice.operators.records import require_codec
from sluice.operators.registry import events_to_stream, priority_order, with_stream_schema
from sluice.operators.resolution import resolved_entries, stream_side
from sluice.operators.versions import to_rows, with_writers
from sluice.plans.tables import brief
from sluice.sources.stream import read_records
from sluice.streaming.quarantine import start_separated
from sluice.streaming.sink import require_switches, start_event

LOG = logging.getLogger(__name__)


@dataclass
class Started:
    """An event's query, or why there is none. A query of a group names its ``events``.

    ``start`` begins a run from the checkpoint, the first one as any later one.
    """

    event_key: str
    bucket_id: str
    query: StreamingQuery | None = None
    error: str | None = None
    digest: str | None = None
    events: tuple[str, ...] = ()
    start: Callable[[], StreamingQuery] | None = field(default=None, repr=False)
    restarts: int = 0

    def begin(self) -> Started:
        self.query = self.error = None
        try:
            self.query = self.start()
        except Exception as e:  # one event must not stop the others
            self.error = brief(e)
            LOG.error("event %s did not start: %s: %s", self.event_key, type(e).__name__, e)
        return self


def event_rows(
    spark: SparkSession, config: IngestConfig, topics: str, schema: str, writers: Mapping[int, str] | None = None
) -> DataFrame:
    """Source to typed rows for one event."""
    records = read_records(spark, config, topics)
    return to_rows(records, schema, config.codec, config.mode, writers)


def stream_plan(registry: DataFrame, schemas: DataFrame) -> DataFrame:
    """The events to start in starting order, each with what its query needs."""
    return priority_order(with_stream_schema(events_to_stream(registry), schemas))


def resolved_stream_plan(registry: DataFrame, schemas: DataFrame) -> DataFrame:
    """As ``stream_plan``, with the entries and layouts that the tables have too.

    If the schemas have a ``schema_id``, the plan has the ``writers`` by which records are decoded.
    """
    plan = with_stream_schema(stream_side(resolved_entries(registry)), schemas)
    return priority_order(with_writers(plan, schemas) if "schema_id" in schemas.columns else plan)


def writers_of(event: Row) -> dict[int, str] | None:
    """The schemas by id of a row of the stream plan; None if the plan decodes by the newest schema alone."""
    return {w.schema_id: w.schema for w in event.writers} if "writers" in event else None


def start_all(
    spark: SparkSession, registry: DataFrame, schemas: DataFrame, config: IngestConfig
) -> list[Started]:
    """Start the queries, first bucket first. An event that fails is reported and skipped.

    Each key starts its resolved entry, whose layout its table has too. Every query runs in the scheduler pool of its bucket,
    so a FAIR scheduler can weigh the buckets. Settings that no event could run with (a
    codec without its module, a switch the sink or session lacks) are refused at once.
    """
    require_codec(spark, config.codec)
    require_switches(spark, config)
    plan = with_digest(resolved_stream_plan(registry, schemas))
    return [start_one(spark, event, config) for event in plan.toLocalIterator()]


def start_one(spark: SparkSession, event: Row, config: IngestConfig) -> Started:
    """Start the query of one row of the stream plan, in the pool of its bucket."""

    def start() -> StreamingQuery:
        if event.schema is None:
            raise LookupError(f"no schema shared by the topics {event.topics}")
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", event.bucket_id)
        try:
            writers = writers_of(event)
            if config.quarantine:
                records = read_records(spark, config, event.topics)
                return start_separated(
                    records, event.event_key, event.schema, event.stream_partitions, config, event.is_transactional, writers)
            rows = event_rows(spark, config, event.topics, event.schema, writers)
            return start_event(rows, event.event_key, event.stream_partitions, config, event.is_transactional)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)

    digest = event.digest if "digest" in event else None
    return Started(event.event_key, event.bucket_id, digest=digest, start=start).begin()


def reconcile(
    spark: SparkSession, started: Iterable[Started], registry: DataFrame, schemas: DataFrame, config: IngestConfig
) -> tuple[list[Started], dict[str, str]]:
    """Bring the queries of ``start_all`` in line with a newer registry: those that run now, and what was done.

    A query that ended counts as not running. A changed event stops and starts again from its
    checkpoint, in the generation that its new layout asks for; the rest never stop.
    """
    running = {o.event_key: o for o in started if o.query is not None and o.query.isActive}
    now = spark.createDataFrame([(o.event_key, o.digest) for o in running.values()], "event_key string, digest string")
    plan = with_digest(resolved_stream_plan(registry, schemas))
    todo = actions(now, plan)
    done = {}
    for event in todo.join(plan, "event_key", "left").orderBy("priority", "event_key").toLocalIterator():
        done[event.event_key] = event.action
        if event.action != START:
            running.pop(event.event_key).query.stop()
        if event.action != STOP:
            running[event.event_key] = start_one(spark, event, config)
    return list(running.values()), done


def await_all(spark: SparkSession, started: Iterable[Started]) -> None:
    """Wait until every query has ended; a failed one is reported and the rest go on."""
    running = [outcome for outcome in started if outcome.query is not None]
    while any(outcome.query.isActive for outcome in running):
        try:
            spark.streams.awaitAnyTermination(60)
        except StreamingQueryException as e:
            LOG.error("a query ended: %s", e)
        spark.streams.resetTerminated()
    for outcome in running:
        failure = outcome.query.exception()
        if failure is not None:
            outcome.error = brief(failure)

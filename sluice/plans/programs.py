"""The two programs: run the streams of a registry, and create its tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from sluice.config import IngestConfig
from sluice.operators.definitions import definition_counts, rejected, with_newest_schemas
from sluice.operators.drift import drifted
from sluice.operators.resolution import ranked, resolved, table_side
from sluice.plans.tables import (
    NAMESPACES,
    THREADS,
    alter_statements,
    create_statements,
    create_tables,
    outcome_counts,
    table_schemas,
)
from sluice.streaming.fanout import Started, await_all, start_all
from sluice.streaming.ledger import current_layouts
from sluice.streaming.multiplex import start_groups
from sluice.streaming.supervision import supervise

LOG = logging.getLogger(__name__)


def run_streams(
    spark: SparkSession, registry: DataFrame, schemas: DataFrame, config: IngestConfig,
    per_query: int = 1, restarts: int = 0,
) -> list[Started]:
    """Start the queries and wait for all of them, in production forever.

    With ``per_query`` above 1 up to so many events share a query; with ``restarts`` a failed query starts again
    up to so many times in a row.
    """
    if per_query > 1:
        started = start_groups(spark, registry, schemas, config, per_query)
    else:
        started = start_all(spark, registry, schemas, config)
    running = sum(outcome.query is not None for outcome in started)
    LOG.info("%d of %d queries started", running, len(started))
    if restarts:
        supervise(spark, started, restarts)
    else:
        await_all(spark, started)
    return started


def provision_tables(
    spark: SparkSession,
    registry: DataFrame,
    config: IngestConfig,
    catalog: str | None = None,
    sides: Iterable[str] = ("NonTxn",),
    namespaces: Mapping[bool, str] = NAMESPACES,
    schemas: DataFrame | None = None,
    threads: int = THREADS,
    widen: bool = False,
) -> DataFrame:
    """Create the tables of the given sides and return the outcome of each.

    With ``schemas`` a table's columns come from the schema that its stream decodes with,
    without from the registry's own copy. Every schema is parsed once. Entry and layout of an event are
    those that its stream has. With ``widen`` a table that was there already gets the columns that its schema has
    more, which is one more outcome of the event; changes it cannot follow are logged.
    """
    if schemas is not None:
        registry = with_newest_schemas(registry, schemas)
    entries = ranked(registry).persist()
    try:
        definitions = table_side(resolved(entries))
        for row in definition_counts(definitions).collect():  # at most one row per side
            LOG.info("%s events: %d", namespaces[row.is_transactional], row.definitions)
        LOG.info("entries without a usable schema: %d", rejected(entries).count())
        layouts = None if config.sink_format == "delta" else current_layouts(spark, config)
        statements = create_statements(definitions, config, catalog, namespaces, layouts=layouts)
        outcomes = create_tables(spark, statements, sides, threads)
        if widen:
            tables = table_schemas(spark, definitions, catalog, namespaces, sides, threads)
            altered = alter_statements(drifted(definitions, registry, tables), catalog, namespaces).persist()
            for row in altered.where("size(refused) > 0").toLocalIterator():
                LOG.warning("table of %s cannot follow: %s", row.event_key, "; ".join(row.refused))
            added = create_tables(spark, altered.where("statement IS NOT NULL"), sides, threads)
            outcomes = outcomes.unionByName(added)
            altered.unpersist()
    finally:
        entries.unpersist()
    for row in outcome_counts(outcomes).collect():  # at most three rows per side
        LOG.info("%s tables, %s: %d", namespaces[row.is_transactional], row.status, row.tables)
    return outcomes

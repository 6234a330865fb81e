"""CREATE TABLE statements for definitions, and running them."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import IngestConfig
from sluice.functions.text import quote_literal, quote_name
from sluice.streaming.ledger import BATCH

LOG = logging.getLogger(__name__)
# The schema that holds the tables of each side.
NAMESPACES = {True: "Txn", False: "NonTxn"}
# Statements in flight; each waits for the catalog and hardly for the driver.
THREADS = 16
OUTCOME_SCHEMA = "event_key string, is_transactional boolean, status string, message string"


def create_statements(
    definitions: DataFrame,
    config: IngestConfig,
    catalog: str | None = None,
    namespaces: Mapping[bool, str] = NAMESPACES,
    quoted: bool = True,
    layouts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``namespace`` and the ``statement`` that creates the event's table.

    With ``layouts`` (event_key, directory, generation, batched) a table lies where its event's newest generation
    does. Where batches have directories of their own, their name is the table's first partition column, and
    ``repair`` is the statement that makes the directories known, which each run repeats for new ones.
    ``quoted=False`` gives bare names without a catalog or schema, for a
    session that has already chosen them.
    """
    flag, key = F.col("is_transactional"), F.col("event_key")
    namespace = F.when(flag, namespaces[True]).otherwise(namespaces[False])
    mark = quote_name if quoted else (lambda name: name)
    type_field = "quoted_type" if quoted else "data_type"
    columns = F.transform(
        "columns", lambda c: F.concat_ws(" ", mark(c["column_name"]), c[type_field])
    )
    parts, batch = F.col("table_partitions"), F.lit("")
    name = _table_name(key, namespace, catalog) if quoted else key
    place = config.event_path_column(key, flag)
    if layouts is not None:
        in_batches = (F.coalesce("batched", F.lit(False)) | (F.col("generation") > 0)).alias("in_batches")
        definitions = definitions.join(layouts.select("event_key", "directory", in_batches), "event_key", "left")
        place = F.coalesce("directory", place)
        own = F.array(F.lit(BATCH))
        parts = F.when(F.col("in_batches"), F.concat(own, F.coalesce(parts, F.array().cast("array<string>")))).otherwise(parts)
        batch = F.when(F.col("in_batches"), F.concat(F.lit(", "), mark(F.lit(BATCH)), F.lit(" string"))).otherwise(batch)
    parts = F.array_join(F.transform(parts, mark), ", ")
    found = definitions.withColumn("namespace", namespace).withColumn("statement", F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "),
        name, F.lit(" ("), F.array_join(columns, ", "), batch,
        F.lit(f") USING {config.sink_format.upper()}"),
        F.coalesce(F.concat(F.lit(" PARTITIONED BY ("), parts, F.lit(")")), F.lit("")),
        F.lit(" LOCATION "), quote_literal(place),
    ))
    if layouts is None:
        return found
    repair = F.when(F.col("in_batches"), F.concat(F.lit("MSCK REPAIR TABLE "), name))
    return found.withColumn("repair", repair).drop("directory", "in_batches")


def _table_name(key: Column, namespace: Column, catalog: str | None) -> Column:
    names = [namespace, key] if catalog is None else [F.lit(catalog), namespace, key]
    return F.concat_ws(".", *map(quote_name, names))


def alter_statements(
    drift: DataFrame, catalog: str | None = None, namespaces: Mapping[bool, str] = NAMESPACES
) -> DataFrame:
    """Adds ``namespace`` and the ``statement`` that adds a lagging table's columns; null if there is none to add.

    A nested field is a path, which Delta takes; a table of files refuses it, as an outcome of its own.
    """
    namespace = F.when(F.col("is_transactional"), namespaces[True]).otherwise(namespaces[False])
    columns = F.transform(
        "added", lambda c: F.concat_ws(" ", F.array_join(F.transform(c["path"], quote_name), "."), c["type"]))
    statement = F.concat(
        F.lit("ALTER TABLE "), _table_name(F.col("event_key"), namespace, catalog), F.lit(" ADD COLUMNS ("),
        F.array_join(columns, ", "), F.lit(")"))
    return drift.withColumn("namespace", namespace).withColumn("statement", F.when(F.size("added") > 0, statement))


def table_schemas(
    spark: SparkSession, definitions: DataFrame, catalog: str | None = None,
    namespaces: Mapping[bool, str] = NAMESPACES, sides: Iterable[str] = ("NonTxn",), threads: int = THREADS,
) -> DataFrame:
    """event_key and table_schema (Spark's JSON form) of the tables that are there; one catalog look-up for each."""
    namespace = F.when(F.col("is_transactional"), namespaces[True]).otherwise(namespaces[False])
    name = _table_name(F.col("event_key"), namespace, catalog)
    wanted = definitions.where(namespace.isin(*sides)).select("event_key", name.alias("name")).hint("rebalance")

    def look(row) -> tuple[str, str] | None:
        try:
            return row.event_key, spark.table(row.name).schema.json()
        except AnalysisException:
            return None

    with ThreadPoolExecutor(threads) as pool:
        found = [row for row in pool.map(look, wanted.toLocalIterator()) if row]
    return spark.createDataFrame(found, "event_key string, table_schema string")


def create_tables(
    spark: SparkSession,
    statements: DataFrame,
    sides: Iterable[str] = ("NonTxn",),
    threads: int = THREADS,
) -> DataFrame:
    """Run the statements of the given namespaces; one row per event tells the outcome.

    ``success``, ``failure`` (the statement was refused) or ``error`` (anything
    else). No event keeps another from being tried. DDL runs on the driver, by up to
    ``threads`` at once, so a slow statement does not hold up the others. Statements come
    one partition at a time and are never held together; the rebalance makes these few
    and of limited size. A message is short: the error's class and condition.
    """
    wanted = statements.where(F.col("namespace").isin(*sides))
    repair = F.col("repair") if "repair" in wanted.columns else F.lit(None).cast("string").alias("repair")
    wanted = wanted.select("event_key", "is_transactional", "statement", repair).hint("rebalance")
    outcomes, running = [], deque()

    def settle() -> None:
        row, run = running.popleft()
        outcomes.append((row.event_key, row.is_transactional, *run.result()))

    with ThreadPoolExecutor(threads) as pool:
        for row in wanted.toLocalIterator():
            running.append((row, pool.submit(_run, spark, row.event_key, row.statement, row.repair)))
            while running and (running[0][1].done() or len(running) > 8 * threads):
                settle()
        while running:
            settle()
    return spark.createDataFrame(outcomes, OUTCOME_SCHEMA)


def _run(spark: SparkSession, event_key: str, statement: str, repair: str | None = None) -> tuple[str, str | None]:
    try:
        spark.sql(statement)
        if repair is not None:
            spark.sql(repair)
    except (AnalysisException, ParseException) as e:
        LOG.warning("table of %s refused: %s", event_key, e)
        return "failure", brief(e)
    except Exception as e:  # one event must not stop the others
        LOG.error("table of %s: %s: %s", event_key, type(e).__name__, e)
        return "error", brief(e)
    return "success", None


def brief(error: Exception) -> str:
    """The class of an error and its condition, or the start of its text."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return f"{type(error).__name__}: {condition or str(error)[:200]}"


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("is_transactional", "status").agg(F.count("*").alias("tables"))

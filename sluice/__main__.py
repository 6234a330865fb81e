"""``python -m sluice streams|tables|compact settings.json``, or the same through spark-submit.

The settings name the ``registry`` and ``schemas`` tables (paths, with an
optional ``table_format``), the ``config`` (fields of IngestConfig), and for
tables an optional ``catalog`` and the ``sides`` to create, and ``schema_source``: ``streams``
takes the columns from the schemas table; for streams an optional ``per_query`` (events that share a query) and
``restarts`` (of a failed query, in a row). ``compact`` needs only ``compact``, a list of
the arguments of :func:`sluice.streaming.sink.compact`. Master, storage
credentials, catalogs and extensions are session configuration.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import SparkSession

from sluice.config import IngestConfig
from sluice.plans.programs import provision_tables, run_streams
from sluice.sources.registry import read_registry, read_schemas
from sluice.streaming.sink import compact


def run(program: str, settings: dict, spark: SparkSession):
    if program == "compact":
        for arguments in settings["compact"]:
            compact(spark, **arguments)
        return None
    config = IngestConfig(**settings["config"])
    table_format = settings.get("table_format", "parquet")
    registry = read_registry(spark, settings["registry"], table_format)
    if program == "streams":
        schemas = read_schemas(spark, settings["schemas"], table_format, settings.get("decode_by_id", False))
        return run_streams(
            spark, registry, schemas, config, settings.get("per_query", 1), settings.get("restarts", 0))
    sides = settings.get("sides", ["NonTxn"])
    shared = settings.get("schema_source") == "streams"
    schemas = read_schemas(spark, settings["schemas"], table_format) if shared else None
    return provision_tables(spark, registry, config, settings.get("catalog"), sides, schemas=schemas,
        widen=settings.get("widen", False))


def main() -> None:
    parser = argparse.ArgumentParser(prog="sluice")
    parser.add_argument("program", choices=["streams", "tables", "compact"])
    parser.add_argument("settings", type=Path)
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"sluice-{arguments.program}").getOrCreate()
    try:
        run(arguments.program, json.loads(arguments.settings.read_text()), spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

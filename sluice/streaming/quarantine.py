"""Undecodable records beside the rows: the query that reads them counts them and keeps them raw.

Every batch is decoded once and kept; its rows go to the event's directory of the batch, its bad records to one
beside the checkpoints. Both replace what an earlier attempt at the batch wrote, so rows and quarantined records
together are the records, whatever is replayed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.config import IngestConfig, join_path
from sluice.operators.records import cast_date_parts, flatten
from sluice.operators.versions import decoded
from sluice.streaming import files
from sluice.streaming.ledger import BATCH, Layout, append_batch, settle
from sluice.streaming.sink import ADVISORY_SIZE, gather_partitions, require_switches, session_conf, sink_options, trigger

#: The name under which a query's progress has the counts ``records`` and ``quarantined``.
METRIC = "decoded"


def tagged(
    records: DataFrame, schema: str, config: IngestConfig, writers: Mapping[int, str] | None = None
) -> DataFrame:
    """topic, value, ``output`` and ``bad``: no field of the record has a value.

    That is what an undecodable body gives, and a body with nothing in it: null values, short headers, broken
    bodies and unknown schema ids, and records that are all null.
    """
    rows = decoded(records, schema, config.codec, config.mode, writers, keep=("topic", "value"))
    empty = [F.col("output").getField(name).isNull() for name in rows.schema["output"].dataType.names]
    return rows.withColumn("bad", F.col("output").isNull() | reduce(and_, empty, F.lit(True)))


def counted(rows: DataFrame) -> DataFrame:
    return rows.observe(METRIC, F.count(F.lit(1)).alias("records"), F.count_if("bad").alias("quarantined"))


def start_separated(
    records: DataFrame, event_key: str, schema: str, partitions: Sequence[str], config: IngestConfig,
    is_transactional: bool | None = None, writers: Mapping[int, str] | None = None,
) -> StreamingQuery:
    """Start the append of one event with its bad records set aside."""
    spark = records.sparkSession
    require_switches(spark, config)
    rows = tagged(records, schema, config, writers)
    layout = settle(
        spark, config, event_key, cast_date_parts(flatten(rows)).schema, partitions, is_transactional, batched=True)
    writer = counted(rows).writeStream.foreachBatch(lambda batch, number: separate(batch, number, layout, config))
    writer = writer.option("checkpointLocation", config.event_checkpoint(event_key)).queryName(f"Stream-{event_key}")
    size = {} if config.target_bytes is None else {ADVISORY_SIZE: str(config.target_bytes)}
    with session_conf(spark, size):
        return trigger(writer, config).start()


def separate(batch: DataFrame, number: int | str, layout: Layout, config: IngestConfig) -> None:
    """Write the rows of a tagged batch, and its bad records where ``quarantined_records`` finds them."""
    kept = batch.persist()
    try:
        rows = cast_date_parts(flatten(kept.where(~F.col("bad"))))
        if config.optimize_write:
            rows = gather_partitions(rows, layout.partitions)
        append_batch(rows, number, layout, config.sink_format, sink_options(config))
        place = join_path(_folder(config, layout.event_key), f"{BATCH}={number}")
        lost = kept.where("bad").select("topic", "value")
        if not lost.isEmpty():
            lost.write.mode("overwrite").parquet(place)
        elif files.exists(batch.sparkSession, place):  # an earlier attempt knew fewer schemas
            files.remove(batch.sparkSession, place)
    finally:
        kept.unpersist()


def _folder(config: IngestConfig, event_key: str) -> str:
    return join_path(config.checkpoint_path, f"_quarantine/{event_key}")


def quarantined_records(spark: SparkSession, config: IngestConfig, event_key: str) -> DataFrame:
    """topic, value and the batch of the records that gave no row, as they came."""
    folder, schema = _folder(config, event_key), f"topic string, value binary, {BATCH} string"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)

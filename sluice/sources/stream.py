"""The stream of wire records of one event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import IngestConfig

# Formats whose streams must be told their schema; other sources know it.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")
RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.BinaryType()),
])


def source_options(config: IngestConfig, topics: str) -> dict[str, str]:
    """The options shared by all events, overridden by those of this one."""
    own = {"subscribe": topics}
    if config.starting_offsets is not None:
        own["startingOffsets"] = config.starting_offsets
    if config.fail_on_data_loss is not None:
        own["failOnDataLoss"] = str(config.fail_on_data_loss).lower()
    return {**config.source_options, **own}


def read_records(spark: SparkSession, config: IngestConfig, topics: str) -> DataFrame:
    """``topic, value`` of the given comma list of topics, as a stream.

    Kafka subscribes to the topics. Any other format reads a shared record log,
    where the topic is a filter that reaches the scan. If the log has a
    directory per topic, a ``path`` option that ends in ``topic={topics}``, with
    the log as ``basePath``, lists the event's own directories only.
    """
    options = source_options(config, topics)
    reader = spark.readStream.format(config.source_format)
    if config.source_format == "kafka":
        return reader.options(**options).load().select("topic", "value")
    wanted = [topic.strip() for topic in topics.split(",") if topic.strip()]
    if "path" in options:
        options["path"] = options["path"].replace("{topics}", "{" + ",".join(wanted) + "}")
    if config.source_format in FILE_FORMATS:
        reader = reader.schema(RECORD_SCHEMA)
    log = reader.options(**options).load()
    return log.select("topic", "value").where(F.col("topic").isin(wanted))

"""The registry of events and the table of their schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.operators.latest import last_per_key

REGISTRY_SCHEMA = T.StructType([
    T.StructField("ordinal", T.LongType(), False),
    T.StructField("event_key", T.StringType()),
    T.StructField("topic_list", T.StringType()),
    T.StructField("bucket_id", T.StringType()),
    T.StructField("partition_columns", T.StringType()),
    T.StructField("is_active", T.BooleanType(), False),
    T.StructField("is_transactional", T.BooleanType()),
    T.StructField("complete_schema", T.StringType()),
])
SUBJECT_SCHEMA = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("schema", T.StringType()),
])

VERSIONED_SCHEMA = T.StructType([*SUBJECT_SCHEMA.fields, T.StructField("schema_id", T.IntegerType())])


def read_registry(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).format(format).load(path)


def read_schemas(spark: SparkSession, path: str, format: str = "parquet", ids: bool = False) -> DataFrame:
    """The schema table; with ``ids`` also the ``schema_id`` by which streams then decode each record."""
    return spark.read.schema(VERSIONED_SCHEMA if ids else SUBJECT_SCHEMA).format(format).load(path)


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """The schema of the highest version of every subject."""
    return last_per_key(schemas, "subject", "version").select("subject", "version", "schema")

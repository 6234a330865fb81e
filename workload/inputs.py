"""Inputs of the queries, derived row by row from the ``events`` table.

Every events row yields one wire record, one registry entry and one version of
its topic's schema, so all inputs grow with the table.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import IngestConfig
from sluice.operators.drift import wanted_type

HEADER = "0000000001"
EVENTS_SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)

# The schema of every decoded event in the flows.
_FIELDS = [
    {"name": "event_id", "type": "long"},
    {"name": "user_id", "type": "long"},
    {"name": "value", "type": ["null", "double"]},
    {"name": "dpYear", "type": "string"},
    {"name": "dpMonth", "type": "string"},
    {"name": "dpDay", "type": "string"},
]
BODY_SCHEMA = json.dumps({"type": "record", "name": "Body", "fields": _FIELDS})
_NARROW_FIELDS = [field for field in _FIELDS if field["name"] != "value"]
NARROW_SCHEMA = json.dumps({"type": "record", "name": "Body", "fields": _NARROW_FIELDS})

# Registry schemas by event type: flat, nested, unions and logical types, date parts.
TABLE_SCHEMAS = {
    "click": {"type": "record", "name": "Click", "fields": [
        {"name": "page", "type": "string"},
        {"name": "position", "type": "int"},
        {"name": "visible", "type": "boolean"},
    ]},
    "error": {"type": "record", "name": "Failure", "fields": [
        {"name": "code", "type": ["null", "int"]},
        {"name": "origin", "type": {"type": "record", "name": "Origin", "fields": [
            {"name": "host", "type": "string"},
            {"name": "dpYear", "type": "string"},
            {"name": "frames", "type": {"type": "array", "items": "long"}},
        ]}},
        {"name": "cause", "type": ["null", "Origin"]},
    ]},
    "purchase": {"type": "record", "name": "Purchase", "fields": [
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "price", "type": {
            "type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "amount", "type": ["int", "long"]},
        {"name": "rate", "type": ["float", "double"]},
        {"name": "ref", "type": ["string", "long"]},
        {"name": "attrs", "type": {"type": "map", "values": ["null", "long"]}},
    ]},
    "signup": {"type": "record", "name": "Signup", "fields": [
        {"name": "plan", "type": {"type": "enum", "name": "Plan", "symbols": ["FREE", "PAID"]}},
        {"name": "dpYear", "type": "string"},
        {"name": "dpMonth", "type": ["null", "string"]},
        {"name": "dpDay", "type": "int"},
        {"name": "dpHour", "type": "long"},
    ]},
}
TABLE_COLUMNS = {
    "click": [("page", "string"), ("position", "integer"), ("visible", "boolean")],
    "error": [
        ("code", "integer"),
        ("origin", "Struct<host: string, dpYear: string, frames: Array<long>>"),
        ("cause", "Struct<host: string, dpYear: string, frames: Array<long>>"),
    ],
    "purchase": [
        ("at", "timestamp"), ("day", "date"), ("price", "decimal(10,2)"), ("amount", "long"),
        ("rate", "double"), ("ref", "Struct<member0: string, member1: long>"),
        ("attrs", "Map<string,long>"),
    ],
    "signup": [
        ("plan", "string"), ("dpYear", "integer"), ("dpMonth", "integer"),
        ("dpDay", "integer"), ("dpHour", "integer"),
    ],
}
MALFORMED_SCHEMA = '{"type": "record", "name": '
RECURSIVE_SCHEMA = json.dumps({"type": "record", "name": "Node", "fields": [
    {"name": "next", "type": ["null", "Node"]},
]})

# Registry columns as expressions over ``events``, valid in Spark and in the oracles' SQL.
REGISTRY_COLUMNS = {
    "ordinal": "event_id",
    "event_key": "concat(event_type, '_', CAST(user_id AS STRING))",
    "topic_list": """CASE event_id % 5 WHEN 0 THEN concat(' [', event_type, ']') WHEN 1 THEN event_type
        WHEN 2 THEN concat('[', event_type, CASE event_id % 3 WHEN 0 THEN ',audit]'
            WHEN 1 THEN concat(', ', event_type, ' ]') ELSE ',click]' END) ELSE concat('[', event_type, ']') END""",
    "bucket_id": """CASE event_id % 4 WHEN 0 THEN 'p0Event' WHEN 1 THEN 'nonP0Event'
        WHEN 2 THEN 'other' END""",
    "partition_columns": """CASE event_id % 7 WHEN 0 THEN '[dpYear, dpMonth, dpDay]'
        WHEN 1 THEN ' dpYear ,, dpDay ' WHEN 2 THEN '[]' WHEN 3 THEN '' END""",
    "is_active": "event_id % 5 <> 0",
    "is_transactional": "CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "complete_schema": f"""CASE WHEN event_id % 11 = 0 THEN NULL
        WHEN event_id % 13 = 0 THEN '{MALFORMED_SCHEMA}'
        WHEN event_type = 'click' THEN '{json.dumps(TABLE_SCHEMAS["click"])}'
        WHEN event_type = 'error' THEN '{json.dumps(TABLE_SCHEMAS["error"])}'
        WHEN event_type = 'purchase' THEN '{json.dumps(TABLE_SCHEMAS["purchase"])}'
        WHEN event_type = 'signup' THEN '{json.dumps(TABLE_SCHEMAS["signup"])}'
        WHEN event_type = 'view' THEN '{RECURSIVE_SCHEMA}' END""",
}

# One entry per event type, over ``(event_type, ordinal)``. Each plays a part in a fan-out:
# purchase streams first and unpartitioned, view has a bad schema, error has no bucket.
TOPIC_REGISTRY_COLUMNS = {
    "ordinal": "ordinal",
    "event_key": "event_type",
    "topic_list": "concat(' [', event_type, '] ')",
    "bucket_id": """CASE WHEN event_type IN ('purchase', 'view') THEN 'p0Event'
        WHEN event_type IN ('click', 'signup') THEN 'nonP0Event' ELSE 'other' END""",
    "partition_columns": """CASE WHEN event_type = 'click' THEN ' dpYear ,, dpDay '
        WHEN event_type = 'purchase' THEN '[]' ELSE '[dpYear, dpMonth, dpDay]' END""",
    "is_active": "true",
    "is_transactional": "event_type IN ('purchase', 'view')",
    "complete_schema": f"""CASE WHEN event_type = 'view' THEN '{MALFORMED_SCHEMA}'
        WHEN event_type = 'error' THEN '{json.dumps(TABLE_SCHEMAS["error"])}'
        ELSE '{BODY_SCHEMA}' END""",
}

# Every events row registers one version of its topic's schema; its doc tells which.
SCHEMA_COLUMNS = {
    "subject": "concat(event_type, '-value')",
    "version": "CAST(event_id AS INT)",
    "schema": f"""CASE WHEN event_type = 'view' THEN '{MALFORMED_SCHEMA}'
        ELSE concat('{BODY_SCHEMA[:-1]}, "doc": "v', CAST(event_id AS STRING), '"}}') END""",
}


# The versions of a topic by schema id: the first has no ``value``, the second a default for it.
DEFAULT_VALUE = -1.0
DEFAULTING_SCHEMA = json.dumps({"type": "record", "name": "Body", "fields": [
    {**field, "type": ["double", "null"], "default": DEFAULT_VALUE} if field["name"] == "value" else field
    for field in _FIELDS
]})

# A history whose versions differ in one field: as it is, without it, with a default, user_id as an int, malformed.
_OPTIONAL = [{**field, "default": None} if field["name"] == "value" else field for field in _FIELDS]
_INT_USER = [{**field, "type": "int"} if field["name"] == "user_id" else field for field in _FIELDS]
HISTORY_SCHEMAS = [
    BODY_SCHEMA, NARROW_SCHEMA, *[json.dumps({"type": "record", "name": "Body", "fields": fields}) for fields in (_OPTIONAL, _INT_USER)],
    MALFORMED_SCHEMA,
]
HISTORY_COLUMNS = {
    "subject": "concat(event_type, '-value')",
    "version": "CAST(event_id AS INT)",
    "schema": "CASE event_id % 5 " + " ".join(f"WHEN {n} THEN '{text}'" for n, text in enumerate(HISTORY_SCHEMAS)) + " END",
}


def _older_type(event_type: str, kind: int) -> str:
    """The type of a table that lacks a column or a nested field (1), has another type for one (2), or both (3)."""
    tree = wanted_type(json.dumps(TABLE_SCHEMAS[event_type]))
    if kind & 1:
        (tree["fields"][1]["type"]["fields"] if event_type == "error" else tree["fields"]).pop()
    if kind & 2:
        tree["fields"][0]["type"] = "binary"
    return json.dumps(tree)


def older_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_key and table_schema of a table for every user and event type; a quarter of them is up to date."""
    kind, found = F.col("user_id") % 4, F.lit(None).cast("string")
    for event_type in TABLE_SCHEMAS:
        for n in range(4):
            found = F.when((F.col("event_type") == event_type) & (kind == n), _older_type(event_type, n)).otherwise(found)
    keys = events(spark, sf_dir).select("event_type", "user_id").distinct()
    key = F.concat("event_type", F.lit("_"), F.col("user_id").cast("string"))
    return keys.select(key.alias("event_key"), found.alias("table_schema"))


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*select_list(HISTORY_COLUMNS))


def identified_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions with ids of every topic's schema."""
    topics = events(spark, sf_dir).select(F.concat("event_type", F.lit("-value")).alias("subject")).distinct()
    return topics.selectExpr(
        "subject", f"stack(2, 1, '{NARROW_SCHEMA}', 2, '{DEFAULTING_SCHEMA}') AS (version, schema)"
    ).withColumn("schema_id", F.col("version"))


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*select_list(REGISTRY_COLUMNS))


def topic_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = events(spark, sf_dir).groupBy("event_type").agg(F.max("event_id").alias("ordinal"))
    return newest.selectExpr(*select_list(TOPIC_REGISTRY_COLUMNS))


def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*select_list(SCHEMA_COLUMNS))


# Every events row has a type in Spark's JSON form, some of them undeclared or no type at all.
TYPE_COLUMNS = {
    "event_id": "event_id",
    "type_json": """CASE event_id % 6 WHEN 0 THEN '"integer"'
        WHEN 1 THEN '{"type":"array","elementType":"long","containsNull":true}'
        WHEN 2 THEN '{"type":"widget"}' WHEN 3 THEN concat('no type ', CAST(event_id AS STRING))
        WHEN 4 THEN '{"type":"map","keyType":"string","valueType":{"type":"blob"},"valueContainsNull":true}'
        END""",
}


def type_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*select_list(TYPE_COLUMNS))


# --- wire records ------------------------------------------------------------------


def body_fields(rows: DataFrame) -> DataFrame:
    """The fields of a body: a tenth of the values is missing, date parts are text."""
    return rows.select(
        F.col("event_type").alias("topic"),
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"),
        F.date_format("ts", "yyyy").alias("dpYear"),
        F.date_format("ts", "MM").alias("dpMonth"),
        F.date_format("ts", "dd").alias("dpDay"),
    )


def _framed(body: Column) -> Column:
    return F.concat(F.unhex(F.lit(HEADER)), body)


def _json_value(fields: DataFrame) -> Column:
    names = [name for name in fields.columns if name != "topic"]
    return _framed(F.encode(F.to_json(F.struct(*names)), "UTF-8"))


def versioned_json_records(fields: DataFrame) -> DataFrame:
    """Records of two schema ids and, a tenth of them, of an id that no schema has."""
    number = F.when(F.col("event_id") % 10 == 3, 9).otherwise(1 + F.col("event_id") % 2)
    body = F.encode(F.to_json(F.struct(*[name for name in fields.columns if name != "topic"])), "UTF-8")
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(number), 8, "0")))
    return fields.select("topic", F.concat(header, body).alias("value"))


def json_records(fields: DataFrame) -> DataFrame:
    return fields.select("topic", _json_value(fields).alias("value"))


GARBAGE = b'{"event_id": "no number"'


def damaged_json_records(fields: DataFrame) -> DataFrame:
    return _damaged(fields, _json_value(fields), GARBAGE)


def _damaged(fields: DataFrame, value: Column, garbage: bytes) -> DataFrame:
    """A third of the records lose their value, part of the header, the body or its sense."""
    framed = fields.select("topic", "event_id", value.alias("value"))
    value, kind = F.col("value"), F.col("event_id") % 12
    broken = (
        F.when(kind == 1, F.lit(None).cast("binary"))
        .when(kind == 4, F.substring(value, 1, 3))
        .when(kind == 7, F.substring(value, 1, 5))
        .when(kind == 10, F.concat(F.substring(value, 1, 5), F.lit(garbage)))
        .otherwise(value)
    )
    return framed.select("topic", broken.alias("value"))


# --- places to write -----------------------------------------------------------------


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory in the folder the cluster shares, local only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/sluice-{label}-{uuid.uuid4().hex[:12]}"


def parquet_config(root: str, **settings) -> IngestConfig:
    """Parquet in and out, one run over all that is there, JSON bodies unless told otherwise."""
    defaults = {
        "source_format": "parquet", "sink_format": "parquet", "codec": "json",
        "mode": "PERMISSIVE", "available_now": True,
    }
    return IngestConfig(f"{root}/out", f"{root}/checkpoints", **{**defaults, **settings})

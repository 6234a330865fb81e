"""Compaction beside a live stream: closed partitions are rewritten and published, readers unite both.

``target`` holds three things, each by generation: ``rows``, ``files`` (what each generation replaces) and
``manifests`` (the partitions it holds). A generation is visible from the moment its manifest has its name, a
single rename; what a failed run left without a manifest is never read. The stream's directory stays as it is, and
rows that reach a closed partition later are read from there until the next run takes them in.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import join_path
from sluice.streaming import files
from sluice.streaming.sink import ADVISORY_SIZE, gather_partitions, require_columns, session_conf

GENERATION = "generation"
_MANIFEST = "generation int, partitions array<string>"
_TEXT = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def partition_key(partitions: Sequence[str]) -> Column:
    """One text for the values of a row's partition columns, null apart from any text."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("")) for p in partitions]
    return F.concat_ws("/", *values)


def published(spark: SparkSession, target: str) -> DataFrame:
    """key and generation: the newest generation of every published partition."""
    root = join_path(target, "manifests")
    if not any(name.endswith(".json") for name, _ in files.names(spark, root)):
        return spark.createDataFrame([], "key string, generation int")
    manifests = spark.read.schema(_MANIFEST).json(f"{root}/*.json")
    entries = manifests.select(F.explode("partitions").alias("key"), GENERATION)
    return entries.groupBy("key").agg(F.max(GENERATION).alias(GENERATION))


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _committed(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """file and key of the files that a reader of the stream's directory sees; the driver has listed them."""
    listed = rows.sparkSession.createDataFrame([(path,) for path in files.input_paths(rows)], "file string")
    values = [F.regexp_extract("file", f"/{p}=([^/]*)/", 1) for p in partitions]
    parts = [
        F.when(v == "__HIVE_DEFAULT_PARTITION__", "").otherwise(F.concat(F.lit("="), _unescaped(v))) for v in values
    ]
    return listed.select("file", F.concat_ws("/", *parts).alias("key"))


def _replaced(spark: SparkSession, target: str) -> DataFrame:
    """The files that the newest generations of their partitions hold."""
    newest = published(spark, target)
    if not files.exists(spark, join_path(target, "files")):
        return spark.createDataFrame([], "file string, key string")
    held = spark.read.schema("file string, key string, generation int").parquet(join_path(target, "files"))
    return held.join(newest, ["key", GENERATION], "left_semi").select("file", "key")


def _schema(spark: SparkSession, schema: T.StructType | str | None, source: str) -> T.StructType:
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(source).schema
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def publish(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: Sequence[str],
    closed: str,
    target_bytes: int = 256 * 1024 * 1024,
    schema: T.StructType | str | None = None,
) -> int | None:
    """Rewrite the partitions for which ``closed`` holds and that have files not yet published.

    ``source`` is a Parquet directory with these partition columns; a partition is rewritten whole. Returns the
    generation, or null if there was nothing to do. The number of rows is checked against the source, both by
    footers, before the manifest is named. Of two runs at once one gets the number, the other raises.
    """
    if not partitions:
        raise ValueError("only partitions can be published")
    with session_conf(spark, {"spark.sql.adaptive.enabled": "true", ADVISORY_SIZE: str(target_bytes), **_TEXT}):
        rows = spark.read.schema(_schema(spark, schema, source)).parquet(source)
        if schema is not None:
            require_columns(rows, source)
        key = partition_key(partitions)
        committed = _committed(rows, partitions)
        new = committed.join(_replaced(spark, target), ["file", "key"], "left_anti").select("key").distinct()
        wanted = rows.where(closed).select(key.alias("key")).distinct()  # no column of the files is read
        todo = [r.key for r in wanted.join(new, "key", "left_semi").collect()]  # one text a partition, as listed
        if not todo:
            return None
        numbers = [int(n.removesuffix(".json")) for n, _ in files.names(spark, join_path(target, "manifests")) if n.endswith(".json")]
        taken = [int(n.split("=")[1]) for n, _ in files.names(spark, join_path(target, "rows")) if n.startswith(f"{GENERATION}=")]
        generation = max([0, *numbers, *taken]) + 1
        mine, place = rows.where(key.isin(todo)), f"{GENERATION}={generation}"
        gather_partitions(mine, partitions).write.mode("errorifexists").partitionBy(*partitions).parquet(
            join_path(target, f"rows/{place}"))
        committed.where(F.col("key").isin(todo)).write.mode("errorifexists").parquet(join_path(target, f"files/{place}"))
        written = spark.read.schema(rows.schema).parquet(join_path(target, f"rows/{place}"))
        if written.count() != mine.count():
            raise RuntimeError(f"generation {generation} of {target} does not hold the rows of {source}")
        manifest = json.dumps({GENERATION: generation, "partitions": sorted(todo)})
        if not files.create_once(spark, join_path(target, f"manifests/{generation:08}.json"), manifest):
            raise RuntimeError(f"generation {generation} of {target} was published by another run")
        return generation


def read_published(
    spark: SparkSession, source: str, target: str, partitions: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """The rows of ``source``, those of published partitions from ``target``, each once.

    The published generations and the files of the source are those of this call. Open partitions are pruned by their
    keys; of a published one only the files that no generation holds are read from the source.
    """
    with session_conf(spark, _TEXT):
        whole = _schema(spark, schema, source)
        # Manifests first: a file that is committed between the two listings counts as not published.
        newest = [(r.key, r.generation) for r in published(spark, target).collect()]  # one row a partition
        rows = spark.read.schema(whole).parquet(source)
        if not newest:
            return rows
        key, keys = partition_key(partitions), [k for k, _ in newest]
        committed = _committed(rows, partitions).where(F.col("key").isin(keys))
        late = [r.file for r in committed.join(_replaced(spark, target), ["file", "key"], "left_anti").collect()]
        parts = [rows.where(~key.isin(keys))]
        if late:
            parts.append(spark.read.schema(whole).option("basePath", source).parquet(*late))
        held = spark.read.schema(T.StructType([*whole.fields, T.StructField(GENERATION, T.IntegerType())])).parquet(
            join_path(target, "rows"))
        pair = F.concat_ws("/", F.col(GENERATION).cast("string"), key)
        parts.append(held.where(pair.isin([f"{g}/{k}" for k, g in newest])))
        united = parts[0].select(*whole.names)
        for part in parts[1:]:
            united = united.unionAll(part.select(*whole.names))
        return united

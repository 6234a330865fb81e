"""Small files beside the data: listed, read, and created at most once, through Hadoop's file systems."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def names(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a directory) of what lies in ``path``, sorted; empty if there is no such directory."""
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(hadoop))


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = _path(spark, path)
    fs.delete(hadoop, True)


def input_paths(rows: DataFrame) -> list[str]:
    """The files that ``rows`` reads, as paths; Spark lists them as encoded URIs."""
    return [unquote(uri) for uri in rows.inputFiles()]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` whole unless it is there already; whether this call wrote it.

    The text goes to a hidden file first and is renamed, so no reader sees a part of it. A rename onto an existing
    file fails on HDFS and is checked for elsewhere; on stores without an atomic rename two writers need a lock.
    """
    fs, hadoop = _path(spark, path)
    if fs.exists(hadoop):
        return False
    uuid = spark._jvm.java.util.UUID.randomUUID().toString()
    hidden = spark._jvm.org.apache.hadoop.fs.Path(hadoop.getParent(), f".{uuid}.tmp")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if not fs.exists(hadoop) and fs.rename(hidden, hadoop):
            return True
    except PySparkException:
        if not fs.exists(hadoop):
            raise
    fs.delete(hidden, False)
    return False

"""Tables between the steps of an operator, kept where all executors can read them."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_thread = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only in local mode without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/sluice-llm-{label}-{uuid.uuid4().hex[:12]}"
    if getattr(_thread, "recording", False):
        _thread.paths.append(path)
    return path


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back: lineage ends here and a lost executor loses nothing."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nobody holds; else they stay until the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def sweeping(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables stored inside this thread's last ``sweeping``, and notes those stored inside this one.

    For steps whose result is written before the next step begins, so that nothing reads the tables any more.
    """
    for path in getattr(_thread, "paths", []):
        delete(spark, path)
    _thread.paths, _thread.recording = [], True
    try:
        yield
    finally:
        _thread.recording = False

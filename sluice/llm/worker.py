"""Giving memory back when a task ends.

Spark reuses its Python workers, and allocators keep what a task has freed for the next one. On an executor
where many kinds of task follow each other, each worker would stay as large as its largest task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import SparkSession

T, R = TypeVar("T"), TypeVar("R")


#: Bytes of a batch; the JVM and the worker each hold one of every chained node, with room to grow.
BATCH_BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit for batches to Python to ``BATCH_BYTES``; a lower one stays."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_LIMIT))
    if now > BATCH_BYTES:
        spark.conf.set(_LIMIT, f"{BATCH_BYTES}b")


def release() -> None:
    """Return freed memory of Python, Arrow and the C library to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def releasing(function: Callable[[Iterator[T]], Iterator[R]]) -> Callable[[Iterator[T]], Iterator[R]]:
    """``function`` over a task's batches, with the task's memory returned at its end."""
    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return run

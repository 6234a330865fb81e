"""Token counts through a cache of (content digest, tokenizer digest) -> count.

Texts whose digests the cache holds are not encoded. Of the others each distinct content is
encoded once, and its count is appended to the cache, which any later call may join to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.line_dedup import BROADCAST_ROWS
from sluice.llm.scratch import stored
from sluice.llm.tokens import count_tokens, worker_cache
from sluice.llm.worker import releasing

CACHE_SCHEMA = "content binary, tokenizer binary, n_tokens long"
#: Part of the tokenizer's digest: raise it when the way of counting changes.
COUNTING = b"plain-1"
#: Pieces of text that a Python worker remembers beside the JVM's aggregation.
PIECES = 200_000


def tokenizer_digest(path: str) -> bytes:
    """Of the vocabulary file and of the way of counting."""
    return hashlib.sha256(COUNTING + Path(path).read_bytes()).digest()[:16]


def content_digest(text):
    """128 bits of the SHA-256 of the UTF-8 bytes; null is the empty text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at ``path``, empty if nothing was written there yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def add_misses(docs: DataFrame, cache_path: str, tokenizer_path: str, text_col: str = "text") -> None:
    """Encodes every distinct text that the cache lacks and appends its count.

    Digests meet the cache alone, without their texts. Then a task sends one text for each digest it has, so a text
    held by a third of all rows is no hot key. Cached texts are not shuffled while the missing
    digests are few enough to broadcast (or all are missing); beyond that a task sends one text for a cached digest
    too, which is dropped before it is encoded.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path)
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == F.lit(version)).select("content")
    texts = docs.select(
        content_digest(F.col(text_col)).alias("content"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    misses = missing_texts(texts, known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = count_tokens(worker_cache(tokenizer_path, PIECES), batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([version] * len(counts), pa.binary()),
                     pa.array(counts.astype(np.int64))],
                    names=["content", "tokenizer", "n_tokens"],
                )

    misses.mapInArrow(releasing(encode), CACHE_SCHEMA).write.mode("append").parquet(cache_path)


def missing_texts(texts: DataFrame, known: DataFrame) -> DataFrame:
    """content and text, once for each content of ``texts`` that ``known`` lacks."""
    one = F.first("text").alias("text")
    if known.isEmpty():
        return texts.groupBy("content").agg(one)
    missing = stored(texts.select("content").distinct().join(known, "content", "left_anti"), "missing-digests")
    few = missing.count() <= BROADCAST_ROWS
    if few:
        texts = texts.join(F.broadcast(missing), "content", "left_semi")
    found = texts.groupBy("content").agg(one)
    # Not a semi-join, which the optimizer would move below the aggregate, to where copies have not met.
    return found if few else found.join(missing, "content")


def token_counts(
    docs: DataFrame,
    cache_path: str,
    tokenizer_path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens), one row per input row.

    A null or empty text has no bytes and no tokens. Repeated rows each keep their row, null ids
    stay null, an empty table gives no rows, other columns are not read. If several runs
    appended the same digest, its counts are equal and one of them is used.
    """
    add_misses(docs, cache_path, tokenizer_path, text_col)
    version = tokenizer_digest(tokenizer_path)
    cache = (
        read_cache(docs.sparkSession, cache_path)
        .where(F.col("tokenizer") == F.lit(version))
        .groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    )
    # Stored, so that the join has plain exchanges on both sides and a common text's side is split.
    cache = stored(cache, "token-counts")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        content_digest(F.col(text_col)).alias("content"),
    )
    return rows.join(cache, "content", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

"""Removal of repeated multi-line chunks whose boundaries the lines themselves choose.

A rolling hash over the hashes of the last lines ends a chunk wherever it is divisible by a
number, so an inserted line moves no boundary farther on. Chunks of several lines whose digest
occurs again are compared byte by byte; the first occurrence (smallest id, then row, then line)
stays. Only DataFrame functions are used. Texts of chunks are moved only for digests that recur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import stored

MODULUS = 2**31
#: Rows of a table of keys (or entries of its lists) up to which it is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 300_000


def small(df: DataFrame, entries: Column | None = None) -> DataFrame:
    """``df`` (stored) marked for broadcast if it has few rows, or few ``entries`` in all."""
    held = df.count() if entries is None else df.agg(F.sum(entries)).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_ROWS else df


def line_hash(line: Column) -> Column:
    """The first 32 bits of the MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(df: DataFrame, text_col: str, window: int, divisor: int) -> DataFrame:
    """Adds ``lines`` and ``spans`` (first line * 2^31 + last line, from 0); null for null texts."""
    hashes, ends = F.col("line_hashes"), F.col("chunk_ends")

    def ends_here(i: Column) -> Column:
        rolled = F.lit(0).cast("long")
        for back in range(window - 1, -1, -1):
            one = F.when(i >= back, F.get(hashes, i - back)).otherwise(F.lit(0).cast("long"))
            rolled = F.pmod(rolled * 31 + one, F.lit(MODULUS))
        return (F.pmod(rolled, F.lit(divisor)) == 0) | (i == F.size(hashes) - 1)

    df = df.withColumn("lines", F.split(F.col(text_col), "\n", -1))
    df = df.withColumn("line_hashes", F.transform("lines", line_hash))
    df = df.withColumn("chunk_ends", F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), ends_here))
    first = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.get(ends, j - 1) + 1)
    spans = F.transform(ends, lambda e, j: first(j).cast("long") * MODULUS + e)
    spans = F.when(F.col(text_col).isNotNull(), spans)
    return df.withColumn("spans", spans).drop("line_hashes", "chunk_ends")


def span_lines(lines: Column, span: Column) -> Column:
    first = F.floor(span / MODULUS).cast("int")
    return F.slice(lines, first + 1, F.pmod(span, F.lit(MODULUS)).cast("int") - first + 1)


def deduplicated(
    docs: DataFrame, window: int = 2, divisor: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc`` (the input row as a struct), ``kept`` (its new text), ``n_lines`` and ``n_removed``.

    Lines end at ``\\n``; a chunk of one line, or of white space only, always stays. A null text
    stays null with no lines, an empty one is one empty line. Null ids come last in the
    order of occurrences; repeated rows are occurrences like any other. An empty table gives no rows.
    """
    base = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "line-input")
    base = base.withColumn("id", F.col("doc").getField(id_col)).withColumn("body", F.col("doc").getField(text_col))
    several = F.filter("spans", lambda s: F.pmod(s, F.lit(MODULUS)) > F.floor(s / MODULUS))
    chunks = (
        with_chunks(base.select("id", "row", "body"), "body", window, divisor)
        .select("id", "row", F.explode(F.transform(several, lambda s: F.struct(
            s.alias("span"), F.array_join(span_lines(F.col("lines"), s), "\n").alias("chunk")))).alias("c"))
        .select("id", "row", "c.span", "c.chunk").where("chunk rlike '\\\\S'")
        .withColumn("digest", F.md5("chunk"))
    )
    recurring = stored(chunks.groupBy("digest").count().where("count > 1").select("digest"), "line-digests")
    again = stored(chunks.join(small(recurring), "digest"), "line-chunks")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "span")
    # Grouping by the text compares bytes; copies meet map-side.
    first = again.groupBy("digest", "chunk").agg(F.min(place).alias("first"))
    # Stored, so that the join has plain exchanges on both sides and a common chunk's side is split.
    first = stored(first, "line-first")
    removed = (
        again.alias("a").join(first.alias("f"), ["digest", "chunk"])
        .where((F.col("a.row") != F.col("first.row")) | (F.col("a.span") != F.col("first.span")))
        .groupBy("row").agg(F.collect_list("span").alias("gone"))
    )
    removed = small(stored(removed, "line-removed"), F.size("gone"))
    rows = with_chunks(base.join(removed, "row", "left"), "body", window, divisor)
    stays = F.when(F.col("gone").isNull(), F.col("spans")).otherwise(F.array_except("spans", "gone"))
    left = F.flatten(F.transform(stays, lambda s: span_lines(F.col("lines"), s)))
    kept = F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(left, "\n"))
    total = F.coalesce(F.size("lines"), F.lit(0))
    total = F.when(F.col("body").isNull(), 0).otherwise(total)
    gone = F.when(F.col("gone").isNull(), 0).otherwise(total - F.size(left))
    return rows.select("doc", kept.alias("kept"), total.alias("n_lines"), gone.alias("n_removed"))


def drop_repeated_chunks(
    docs: DataFrame, window: int = 2, divisor: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the text less its repeated chunks, as ``deduplicated`` describes; all columns kept."""
    found = deduplicated(docs, window, divisor, id_col, text_col)
    return found.select(*(
        F.col("kept").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns
    ))

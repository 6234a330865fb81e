"""Benchmark items inside documents by size-partitioned MinHash containment search.

An item's sketch holds its shingles with the smallest hashes. Items are partitioned by
their number of shingles, and a partition sets how many sketch entries must occur in a document.
With ``n`` shingles of which ``k`` must occur, any ``n - k + r`` of them hold at least ``r`` that
occur, so a sketch of that size misses no document, however long. What the sketches find is
verified by counting the item's shingles in the document's whole text. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.line_dedup import small
from sluice.llm.scratch import stored

SHINGLE = 5


def word_list(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _starts(words: Column, width: int) -> Column:
    count = F.size(words) - (width - 1)
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def shingle_texts(words: Column, width: int = SHINGLE) -> Column:
    """Distinct shingles, words joined by one space; ``words`` must be a column, being read per shingle."""
    return F.array_distinct(F.transform(_starts(words, width), lambda i: F.array_join(F.slice(words, i, width), " ")))


def shingle_keys(hashes: Column, width: int = SHINGLE) -> Column:
    """64-bit hashes of the shingles from the hashes of their words."""
    return F.transform(_starts(hashes, width), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(-1, width - 1))))


def item_sketches(items: DataFrame, threshold: float, short_items: bool = False) -> tuple[DataFrame, DataFrame]:
    """(item, width, n, needed, shingles) of all items with a shingle, and (key, item, hits) of their sketches.

    ``width`` is the number of words in a shingle: with ``short_items``, all of an item of fewer than five.
    """
    per_cent = math.ceil(threshold * 100)
    short = (F.size("words") > 0) & (F.size("words") < SHINGLE) & F.lit(short_items)
    whole = F.array(F.array_join("words", " "))
    listed = (
        items.select(F.struct("item_id", F.xxhash64("text").alias("copy")).alias("item"), word_list(F.col("text")).alias("words"))
        .select("item", F.when(short, F.size("words")).otherwise(SHINGLE).alias("width"),
                F.when(short, whole).otherwise(shingle_texts(F.col("words"))).alias("shingles"))
        .withColumn("n", F.size("shingles")).where("n > 0")
        .withColumn("needed", F.ceil(F.col("n") * per_cent / 100).cast("int"))
        # One entry more must occur for each eight shingles of the partition's smallest item.
        .withColumn("hits", F.greatest(F.lit(1), F.pow(2, F.floor(F.log2("n")) - 3).cast("int")))
    )
    def key(s: Column) -> Column:
        hashes = [F.xxhash64(F.get(F.split(s, " "), k)) for k in range(SHINGLE)]
        return F.coalesce(*(F.when(F.col("width") == k, F.xxhash64(*hashes[:k])) for k in range(SHINGLE, 0, -1)))

    sketch = F.slice(
        F.array_sort(F.transform("shingles", key)), F.lit(1),
        F.least(F.col("n"), F.col("n") - F.col("needed") + F.col("hits")),
    )
    sketches = listed.select("item", "hits", F.explode(F.array_distinct(sketch)).alias("key"))
    return listed, sketches


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    short_items: bool = False,
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared and containment for every row and item at or above the threshold.

    Containment is the share of an item's distinct five-word shingles that the row's text
    holds. An item of fewer than five words has one shingle with ``short_items``, its whole word
    sequence; else it has none, like an item or text without words (or null), and is never found. Rows with equal or null ids are judged each by its own text; copies of a row give copies
    of its result, copies of an item one result for each distinct (item_id, text).
    """
    listed, sketches = item_sketches(items.select("item_id", "text").distinct(), threshold, short_items)
    listed, sketches = stored(listed, "items"), stored(sketches, "sketches")
    # At most as many rows as a shingle has words; five are looked up in any case.
    widths = {SHINGLE} | ({r.width for r in listed.select("width").distinct().collect()} if short_items else set())
    over = lambda f, words: f(words) if widths == {SHINGLE} else F.concat(*(f(words, k) for k in sorted(widths)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashes = F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w))
    keys = rows.select("doc_id", hashes.alias("hashes")).select(
        "doc_id", F.explode(over(shingle_keys, F.col("hashes"))).alias("key")
    )
    candidates = (
        keys.join(small(sketches), "key")
        .groupBy("doc_id", "item", "key").agg(F.min("hits").alias("hits"))
        .groupBy("doc_id", "item").agg(F.count("*").alias("found"), F.min("hits").alias("hits"))
        .where("found >= hits").select(F.col("doc_id").alias("candidate"), "item")
    )
    candidates = stored(candidates, "candidates")
    holders = small(stored(candidates.select("candidate").distinct(), "candidate-docs"))
    texts = rows.join(holders, F.col("doc_id").eqNullSafe(F.col("candidate")), "left_semi").select(
        "doc_id", word_list(F.col("text")).alias("words")
    ).select("doc_id", over(shingle_texts, F.col("words")).alias("own"))
    shared = F.size(F.array_intersect("shingles", "own"))
    return (
        candidates.join(small(listed, F.col("n")), "item")
        .join(texts, F.col("doc_id").eqNullSafe(F.col("candidate")))
        .select("doc_id", F.col("item.item_id").alias("item_id"), F.col("n").alias("n_shingles"), shared.alias("n_shared"), "needed")
        .where("n_shared >= needed")
        .select("doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    short_items: bool = False,
) -> DataFrame:
    """``docs`` without the rows whose text holds an item; rows with the same id but other texts stay.

    Null and empty texts hold nothing, repeated rows go or stay together, an empty table of either side drops
    nothing, and all columns are kept, whatever their names.
    """
    hit = contained_items(
        docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("copy")).alias("doc_id"),
                    F.col(text_col).alias("text")),
        items, threshold, short_items=short_items,
    ).select("doc_id").distinct()
    hit = small(stored(hit, "contaminated"))
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("copy"))
    taken = {c.lower() for c in docs.columns}
    name = next(c for c in (f"contaminated_row_{i}" for i in range(len(taken) + 1)) if c not in taken)
    return docs.join(hit.select(F.col("doc_id").alias(name)), own.eqNullSafe(F.col(name)), "left_anti")

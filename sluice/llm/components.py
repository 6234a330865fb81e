"""Connected components of a graph by alternating large-star and small-star steps.

Each round is two joins on the edges, with minima that combine map-side; the edges are
written to the shared folder between rounds. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import stored

#: Far beyond the logarithmic number of rounds that the steps need.
MAX_ROUNDS = 60


def roots(edges: DataFrame) -> DataFrame:
    """node, root for every node that is not the smallest of its component (columns a, b: long)."""
    edges = stored(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
        "edges",
    )
    for _ in range(MAX_ROUNDS):
        many = edges.groupBy("b").count().where("count > 1").limit(1)
        inner = edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi").limit(1)
        if not many.select("b").unionAll(inner).take(1):
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where("a != m").select("m", "a").unionAll(least.select("m", "b"))
        edges = stored(small.toDF("a", "b").distinct(), "edges")
    raise RuntimeError("the components did not settle")

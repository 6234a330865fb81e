"""Nearest neighbours by a forest of hash prefixes.

Each tree hashes a vector to a long string of bits, the sides of random hyperplanes, and keeps
these strings as a sorted array. A query descends each tree to its longest matching prefix; then
all trees ascend together, one bit at a time, until the ranges of rows below those prefixes
hold enough candidates, which are scored on the original vectors.

Rows lie in shards and queries in blocks, both of bounded size; a task holds the forest of one
shard and answers one block. For the largest inner product the rows get one more coordinate
that gives all the same length, so that angle and product order them alike.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import stored

SHARD_ROWS, BLOCK_QUERIES = 1 << 16, 512
TREES, BITS, SEED = 48, 24, 42
MAX_PARTITIONS = 20_000
#: Candidates of a query in a shard: this share of its rows, and so many at least.
SHARE, LEAST = 0.45, 6000


class Forest:
    """Sorted arrays of hash strings over the rows of a shard."""

    def __init__(self, vectors: np.ndarray, longest: float):
        self.vectors = vectors
        draw = np.random.default_rng(SEED)
        self.planes = draw.standard_normal((TREES, vectors.shape[1] + 1, BITS)).astype(np.float32)
        rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
        wide = np.hstack([vectors, rest[:, None]]).astype(np.float32)
        self.order, self.hashes = [], []
        for t in range(TREES):
            h = self._hash(wide, t)
            order = np.argsort(h, kind="stable").astype(np.int32)
            self.order.append(order)
            self.hashes.append(h[order])

    def _hash(self, wide: np.ndarray, tree: int) -> np.ndarray:
        return ((wide @ self.planes[tree]) > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def candidates(self, queries: np.ndarray, wanted: int):
        """Yields for each query the rows that the ascent reaches, as numbers."""
        wide = np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32)
        keys = [self._hash(wide, t) for t in range(TREES)]
        low = np.zeros((BITS + 1, TREES, len(queries)), dtype=np.int32)
        high = np.zeros_like(low)
        for depth in range(BITS + 1):
            step = np.int64(1) << np.int64(BITS - depth)
            for t in range(TREES):
                first = keys[t] // step * step
                low[depth, t] = np.searchsorted(self.hashes[t], first, "left")
                high[depth, t] = np.searchsorted(self.hashes[t], first + step, "left")
        reached = (high - low).sum(axis=1, dtype=np.int64)
        for q in range(len(queries)):
            # The sum counts rows found by several trees more than once, so the ascent may go on.
            depth = int(np.max(np.flatnonzero(reached[:, q] >= wanted), initial=0))
            while True:
                seen = np.zeros(len(self.vectors), dtype=bool)
                for t in range(TREES):
                    seen[self.order[t][low[depth, t, q]:high[depth, t, q]]] = True
                if depth == 0 or np.count_nonzero(seen) >= wanted:
                    break
                depth -= 1
            yield np.flatnonzero(seen)


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """The places of the largest scores, ties to the smaller id."""
    if len(scores) > count:
        edge = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:count]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    table: DataFrame, is_query: Column, count: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, share: float = SHARE, least: int = LEAST,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` rows of largest inner product that the forest finds.

    ``is_query`` picks the queries among the rows; candidates are all rows but the query's own
    id. Ties go to the smaller id. Rows with a null id or vector, a zero vector or null or non-finite
    components take no part; vectors of other lengths are not compared. Of equal vectors the
    ``count + 1`` smallest ids suffice for whole results, so only they are indexed, and a common
    vector fills no shard. Repeated rows (same id and vector) count once. An empty table
    gives no rows.
    """
    rows = (
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks"))
        .where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
        .withColumn("dims", F.size("vector"))
    )
    rows = stored(rows, "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy("dims").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("n_asks"), F.max(F.sqrt(square)).alias("longest")
    ).withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("long")).withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("n_asks") / block_queries)).cast("long"))
    same = Window.partitionBy("vector").orderBy("id")
    indexed = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= count + 1)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    def tiled(df: DataFrame, asks: bool) -> DataFrame:
        own, all_ = ("block", "shard") if asks else ("shard", "block")
        df = df.join(sizes, "dims").withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"{own}s")))
        return df.withColumn(all_, every(F.col(f"{all_}s"))).select(
            "dims", "shard", "block", F.lit(asks).alias("asks"), "id", F.col("vector").cast("array<double>").alias("vector"),
            "longest",
        )

    def answer(tile: pa.Table) -> pa.Table:
        asks = tile.column("asks")
        queries, index = tile.filter(asks), tile.filter(pc.invert(asks))
        out: list[tuple] = []
        if len(queries) and len(index):
            ids, vectors = index.column("id").to_numpy(), _matrix(index.column("vector"))
            query_ids, asked = queries.column("id").to_numpy(), _matrix(queries.column("vector"))
            forest = Forest(vectors, tile.column("longest")[0].as_py())
            wanted = max(math.ceil(share * len(ids)), least) + 1
            for i, found in enumerate(forest.candidates(asked, wanted)):
                found = found[ids[found] != query_ids[i]]
                near = vectors[found] @ asked[i]
                if len(found) > count:  # rounding differs with a row's place, so rows near the edge stay in
                    edge = np.partition(near, len(near) - count)[len(near) - count]
                    found = found[near >= edge - 1e-9 * max(1.0, np.abs(near).max())]
                scores = (vectors[found] * asked[i]).sum(axis=1)
                top = best(scores, ids[found], count)
                out += zip([int(query_ids[i])] * len(top), ids[found][top].tolist(), scores[top].tolist(), strict=True)
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table({
            "query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
            "score": pa.array(columns[2], pa.float64()),
        })

    # A tile is few bytes but much work, so tiles are not gathered into tasks by their size.
    total = sizes.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 1
    parts = int(min(4 * total, MAX_PARTITIONS))
    tiles = tiled(indexed, False).unionByName(tiled(rows.where("asks"), True))
    key = ("dims", "shard", "block")
    found = tiles.repartition(parts, *key).groupBy(*key).applyInArrow(answer, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")

"""Components of similar shingle sets among trees of close fingerprints.

The nodes of a tree are a bucket, and every pair in it is a candidate. The links of the trees come first. Each round
then takes the sets that have one of another component and a fitting
size in their bucket, compares in the buckets their parities, compares the pairs of the first ones that may be
alike as a whole, contracts the links that pass and lets the first sets go, since all their pairs are decided. Of the
others only those stay that may be alike to one another. It ends when none stays, so a candidate
is either compared or already in the same component; a dense group costs one comparison a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import roots
from sluice.llm.line_dedup import small
from sluice.llm.scratch import free_shuffles, stored
from sluice.llm.worker import releasing

#: A bucket of so few sets is compared at once; of larger ones the first 4, then 16 and so on up to this many.
AT_ONCE, MOST_FIRST = 24, 256
#: Up to this size a bucket's rows without any partner of a fitting size are told apart before parities are sent.
LOOKED_AT = 64
#: Pairs of a bucket in hand at a time.
PAIRS = 1 << 15


#: Bytes of a sketch.
SKETCH_BYTES = 68
#: Of a shingle's 64-bit hash the upper 40 bits are kept: two of a pair of texts of a thousand words fall together
#: once in a million pairs, and then move the similarity by a thousandth.
HASH_BYTES = 5


def packed(hashes: np.ndarray) -> bytes:
    """Ascending 40-bit values, five bytes each."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view("<u8").ravel()


def parity(hashes: np.ndarray) -> bytes:
    """A bit for each of 1024 classes of hashes: whether their number is odd.

    Two sets differ in at least as many elements as their parities in bits.
    """
    return np.packbits(np.bincount((hashes >> np.uint64(30)).astype(np.int64), minlength=1024) & 1).tobytes()


def sketch(raw: bytes, n: int) -> bytes:
    """A parity folded to 512 classes, which bounds the difference as well, and the number of elements."""
    whole = np.frombuffer(raw, np.uint64)
    return (whole[:8] ^ whole[8:]).tobytes() + n.to_bytes(4, "little")


def sketches(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded parities (a row of 8 words each) and numbers of elements of sketches (a row of bytes each)."""
    folded, n = (np.ascontiguousarray(x) for x in (matrix[:, :-4], matrix[:, -4:]))
    return folded.view(np.uint64), n.view("<u4").ravel().astype(np.int64)


def may_be_similar(x: np.ndarray, y: np.ndarray, both: np.ndarray, threshold: float) -> np.ndarray:
    """Whether parities (a row of words each) admit this similarity of sets of ``both`` elements together."""
    apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return apart * (1 + threshold) <= (1 - threshold) * both + 1e-6


def parities(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 16)


def screened(links: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The links (a, b) whose sets may have this similarity by their parities, which are short."""

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = b.column(4).to_numpy() + b.column(5).to_numpy()
            keep = may_be_similar(parities(b.column(2)), parities(b.column(3)), both, threshold)
            yield b.select([0, 1]).filter(pa.array(keep))

    short = sets.select("node", "parity", "n")
    pairs = links.join(short.toDF("a", "x", "n"), "a").join(short.toDF("b", "y", "m"), "b")
    return pairs.select("a", "b", "x", "y", "n", "m").mapInArrow(releasing(may), "a long, b long")


def passed(links: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The links (a, b; stored) whose sets (node, hashes) have at least this Jaccard similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ends = links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct()
    linked = sets.join(small(stored(ends, "set-ends")), "node", "left_semi").select("node", "hashes")
    pairs = links.join(linked.toDF("a", "x"), "a").join(linked.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return pairs.mapInArrow(releasing(check), "a long, b long")


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of whole buckets, from batches sorted by their first column, and where each bucket starts and ends."""

    def cut_up(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        key = table.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return table, starts, np.append(starts[1:], len(key))

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        cut = int(np.argmax(key == key[-1]))  # the last bucket may go on in the next batch
        if cut or (held and held[-1].column(0)[-1].as_py() != key[0]):
            yield cut_up([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield cut_up(held)


def undecided(buckets: DataFrame, threshold: float) -> DataFrame:
    """The rows of buckets (key, node, n, root) with a row of another root and a fitting size in their bucket.

    Of buckets larger than ``LOOKED_AT`` with several roots all rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends in whole_buckets(batches):
            n, root = (table.column(i).to_numpy() for i in (2, 3))
            keep, size = np.zeros(len(n), bool), ends - starts
            two = starts[size == 2]
            two = two[(root[two] != root[two + 1]) & (n[two] >= threshold * n[two + 1] - 1e-6)]
            keep[two] = keep[two + 1] = True
            several = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
            at = np.flatnonzero(several & (size > 2))
            for start, end in zip(starts[at].tolist(), ends[at].tolist(), strict=True):
                if end - start > LOOKED_AT:
                    keep[start:end] = True
                    continue
                a, r = n[start:end], root[start:end]
                fits = (np.minimum.outer(a, a) >= threshold * np.maximum.outer(a, a) - 1e-6) & (r[:, None] != r)
                keep[start:end] = fits.any(axis=1)
            yield from table.filter(pa.array(keep)).combine_chunks().to_batches()

    dealt = buckets.select("key", "node", "n", "root").repartition("key").sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(releasing(run), "key long, node long, n long, root long")


def bucket_links(buckets: DataFrame, threshold: float, most: int, partners: bool = False) -> DataFrame:
    """key, a, b, n of buckets with key, node, n, root and parity: links that may pass, and what stays (b null).

    Parities are compared in the bucket, so unlike sets make no row; with ``partners`` only rows stay that have
    a link that may pass to another of these.
    """

    def links(bucket: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of linked rows (n ascending), and of those that stay, as their pairs are not among these links."""
        n, root = bucket[2], bucket[3]
        m = len(n)
        go = m - 1 if m <= AT_ONCE else min(m - 1, most)
        step = max(1, PAIRS // m)
        found, stays = [], np.arange(m) >= (m if partners or m - go <= 1 else go)
        for first in range(0, m - 1 if partners else go, step):
            own = np.arange(first, min(first + step, m - 1 if partners else go))
            i = np.repeat(own, m - 1 - own)
            j = np.concatenate([np.arange(k + 1, m) for k in own.tolist()])
            fits = (root[i] != root[j]) & (n[i] >= threshold * n[j] - 1e-6)
            i, j = i[fits], j[fits]
            fits = may_be_similar(prints[i], prints[j], n[i] + n[j], threshold)
            i, j = i[fits], j[fits]
            late = i >= go
            stays[i[late]] = stays[j[late]] = True
            found.append((i[~late], j[~late]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        return i, j, np.flatnonzero(stays)

    def batch(key: list, a: list, b: list, n: list) -> pa.RecordBatch:
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(key)), pa.array(a), pa.array(b, mask=b == -1), pa.array(np.concatenate(n))],
            names=["key", "a", "b", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends in whole_buckets(batches):
            rows, prints = np.stack([table.column(i).to_numpy() for i in range(4)]), parities(table.column(4))
            several = np.minimum.reduceat(rows[3], starts) != np.maximum.reduceat(rows[3], starts)
            out: tuple[list, list, list, list] = ([], [], [], [])
            held = 0
            for start, end in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
                bucket = rows[:, start:end]
                i, j, stays = links(bucket, prints[start:end])
                stay = bucket[:, stays]
                parts = (
                    np.full(len(i) + stay.shape[1], bucket[0, 0]), np.concatenate([bucket[1, i], stay[1]]),
                    np.concatenate([bucket[1, j], np.full(stay.shape[1], -1)]), np.concatenate([bucket[2, i], stay[2]]),
                )
                for column, part in zip(out, parts, strict=True):
                    column.append(part)
                held += len(parts[0])
                if held > 100_000:
                    yield batch(*out)
                    out, held = ([], [], [], []), 0
            if held:
                yield batch(*out)

    dealt = buckets.select("key", "node", "n", "root", "parity").repartition("key")
    dealt = dealt.sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(releasing(run), "key long, a long, b long, n long")


def of_trees(sets: DataFrame, trees: DataFrame) -> DataFrame:
    """The sets (node, hashes, parity) of the nodes of trees, with their number of elements; stored."""
    linked = stored(trees.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "linked-nodes")
    n = F.floor(F.length("hashes") / HASH_BYTES).cast("long").alias("n")
    return stored(sets.join(small(linked), "node", "left_semi").select("node", "hashes", "parity", n), "linked-sets")


def linked_roots(sets: DataFrame, trees: DataFrame, threshold: float, root: DataFrame | None = None) -> DataFrame:
    """node, root of the components by the links (a, b) of trees that have this similarity, and by ``root`` before."""
    links = stored(trees.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "set-links")
    sets = of_trees(sets, links)
    free_shuffles(sets.sparkSession)
    good = passed(stored(screened(links, sets, threshold), "set-pairs"), sets, threshold)
    return roots(good if root is None else joined(root, good))


def joined(root: DataFrame, links: DataFrame) -> DataFrame:
    return root.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(links)


def similar_roots(sets: DataFrame, trees: DataFrame, root: DataFrame, threshold: float) -> DataFrame:
    """node, root of the components of all pairs of this similarity that are in one tree.

    ``sets`` (node, hashes, parity; stored) has ascending distinct 40-bit hashes and their parity, ``trees`` (key, a, b) has
    the links of each tree, ``root`` what is joined already, by ``linked_roots``. That saves rounds where the links are
    good, and loses nothing where they are not. Nodes are not negative, and those that are the smallest of their component have no row.
    """
    spark = sets.sparkSession
    trees = stored(trees, "set-trees")
    buckets = stored(trees.select("key", F.explode(F.array("a", "b")).alias("node")).distinct(), "tree-nodes")
    sets = of_trees(sets, trees)
    buckets, short, most = buckets.join(small(sets.select("node", "n")), "node"), sets.select("node", "parity"), 4
    while True:
        free_shuffles(spark)
        buckets = buckets.join(small(root), "node", "left").withColumn("root", F.coalesce("root", "node"))
        buckets = stored(undecided(buckets, threshold), "set-buckets")
        free_shuffles(spark)
        found = stored(bucket_links(buckets.join(short, "node"), threshold, most, partners=True), "set-found")
        links = stored(found.where("b is not null").select("a", "b").distinct(), "set-links")
        if links.take(1):
            free_shuffles(spark)
            root = roots(joined(root, passed(links, sets, threshold)))
        elif not found.take(1):
            return root
        buckets, most = found.where("b is null").select("key", F.col("a").alias("node"), "n"), min(4 * most, MOST_FIRST)

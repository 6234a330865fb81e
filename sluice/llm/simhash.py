"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has a bit set if more than half of a text's shingle hashes have it. Fingerprints
that agree on all bits of some band meet in a bucket. There they lie in bit planes, 64 of them to a
word: one XOR compares a fingerprint's bit with those of 64 others, and carry-save adders count the
differences of all 64 at once. Words whose fingerprints all differ by more than the radius are
abandoned. A bucket gives only the links of a spanning forest, so dense groups stay linear, and a
bucket larger than a block is compared in pairs of blocks by different tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import roots
from sluice.llm.line_dedup import small
from sluice.llm.scratch import free_shuffles, stored
from sluice.llm.similar_sets import (
    HASH_BYTES, SKETCH_BYTES, linked_roots, may_be_similar, packed, parity, similar_roots, sketch, sketches,
)
from sluice.llm.worker import releasing

SEED = 42
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Fingerprints of a bucket that one task compares with each other.
BLOCK = 8192
#: Bands whose buckets are shuffled at a time; the shuffle files of the ones before are gone then.
BANDS_AT_ONCE = 28
#: Bands whose links are contracted before the others are read.
FIRST_BANDS = 16
#: Pairs of a fingerprint and a word of 64 others in hand at a time.
PAIRS = 1 << 16
#: Shingle hashes of a text in hand at a time.
SHINGLES = 1 << 15
#: Words of 64 compared fingerprints whose close ones are listed at a time.
LISTED = 1 << 12


# --- fingerprints ------------------------------------------------------------------------------


def shingle_hashes(raw: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, in parts: lower-case words (A-Z only) between ASCII white space."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()
    if not words:
        return
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(size, len(words))
    starts, ends = (ends - lengths)[:len(words) - size + 1], ends[size - 1:]
    for i in range(0, len(starts), SHINGLES):
        spans = zip(starts[i:i + SHINGLES].tolist(), ends[i:i + SHINGLES].tolist(), strict=True)
        yield np.array([xxh64_intdigest(text[a:b], SEED) for a, b in spans], dtype=np.uint64)


def widened(hashes: np.ndarray, words: int) -> np.ndarray:
    """The hashes and further 64-bit mixes of them, one column each."""
    columns = [hashes]
    for k in range(1, words):
        z = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        columns.append(z ^ (z >> np.uint64(31)))
    return np.stack(columns, axis=1)


def fingerprint(parts: Iterable[np.ndarray], words: int) -> bytes:
    """Little-endian bytes of the fingerprint of hashes in parts; all zero without any."""
    counts, total = np.zeros(64 * words, dtype=np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(
            widened(hashes, words).view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little"
        )
        total += len(bits)
        for i in range(0, len(bits), 255):  # so many sums fit a byte
            counts += np.add.reduce(bits[i:i + 255], axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > total, bitorder="little").tobytes()


def with_fingerprints(rows: DataFrame, size: int, words: int) -> DataFrame:
    """row, doc_id, fp of rows with row, doc_id and text; null is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(shingle_hashes(raw or b"", size), words) for raw in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps, pa.binary())], names=["row", "doc_id", "fp"]
            )

    rows = rows.select("row", F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(releasing(run), "row long, doc_id long, fp binary")


def with_sets(rows: DataFrame, size: int, words: int) -> DataFrame:
    """row, doc_id, digest, fp, parity, sketch and hashes: the distinct shingles' hashes, ascending, and what stands for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            sets = [
                np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(raw or b"", size)]))
                for raw in b.column(2).to_pylist()
            ]
            fps = [fingerprint((own[i:i + SHINGLES] for i in range(0, len(own), SHINGLES)), words) for own in sets]
            digests = [blake2b(own.tobytes(), digest_size=16).digest() for own in sets]
            sets = [np.unique(own >> np.uint64(64 - 8 * HASH_BYTES)) for own in sets]
            parities = [parity(own) for own in sets]
            short = [sketch(x, len(own)) for x, own in zip(parities, sets, strict=True)]
            sets = [packed(own) for own in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x, pa.binary()) for x in (digests, fps, parities, short, sets))],
                names=["row", "doc_id", "digest", "fp", "parity", "sketch", "hashes"],
            )

    rows = rows.select("row", F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    schema = "row long, doc_id long, digest binary, fp binary, parity binary, sketch binary, hashes binary"
    return rows.mapInArrow(releasing(run), schema)


# --- bit-sliced comparison ----------------------------------------------------------------------


def full_adder(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def above(counter: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose count, lowest plane first, exceeds the limit."""
    over, equal = np.zeros_like(counter[0]), np.full_like(counter[0], ONES)
    for k in range(len(counter) - 1, -1, -1):
        if limit >> k & 1:
            equal = equal & counter[k]
        else:
            over = over | (equal & counter[k])
            equal = equal & ~counter[k]
    return over


def close_pairs(fps: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs i < j < ends[i] with at most ``radius`` differing bits, and their number.

    ``fps`` is a matrix of bytes, a row each; rows of a bucket are together and ``ends`` holds for
    each row where its bucket ends.
    """
    n = len(fps)
    bits = np.unpackbits(fps, axis=1, bitorder="little")
    padded = np.zeros((-(-n // 64) * 64, bits.shape[1]), dtype=np.uint8)
    padded[:n] = bits
    planes = np.packbits(padded, axis=0, bitorder="little").T.copy().view(np.uint64)
    width = (radius + 7).bit_length()
    row = np.arange(n)
    words = np.where(row + 1 < ends, (ends - 1) // 64 - row // 64 + 1, 0)
    bound = np.concatenate([[0], np.cumsum(words)])
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bound, bound[first] + PAIRS, "right")) - 1)
        count = words[first:last]
        q = np.repeat(row[first:last], count)
        w = q // 64 + np.arange(len(q)) - np.repeat(bound[first:last] - bound[first], count)
        low = np.maximum(q + 1 - 64 * w, 0)
        high = np.minimum(ends[q] - 64 * w, 64)
        alive = np.where(
            low < high, (ONES << np.minimum(low, 63).astype(np.uint64)) & (ONES >> (64 - high).astype(np.uint64)), 0
        ).astype(np.uint64)
        counter = [np.zeros(len(q), dtype=np.uint64) for _ in range(width)]
        first = last
        for p in range(0, len(planes), 7):
            keep = np.flatnonzero(alive)
            if len(keep) < len(alive) * 0.75:
                q, w, alive, counter = q[keep], w[keep], alive[keep], [c[keep] for c in counter]
            if not len(q):
                break
            at, shift = q // 64, (q % 64).astype(np.uint64)
            diff = []
            for plane in planes[p:p + 7]:
                own = (plane[at] >> shift) & np.uint64(1)
                diff.append(plane[w] ^ (np.uint64(0) - own))
            zero = np.zeros_like(alive)
            diff += [zero] * (7 - len(diff))
            one, two_a = full_adder(*diff[0:3])
            other, two_b = full_adder(*diff[3:6])
            one, two_c = full_adder(one, other, diff[6])
            two, four = full_adder(two_a, two_b, two_c)
            carry = zero
            for k in range(width):
                add = (one, two, four)[k] if k < 3 else zero
                counter[k], carry = full_adder(counter[k], add, carry)
            alive = alive & ~above(counter, radius)
        hits = np.flatnonzero(alive) if len(q) else np.zeros(0, np.int64)
        for i in range(0, len(hits), LISTED):
            hit = hits[i:i + LISTED]
            at, lane = np.nonzero(
                np.unpackbits(alive[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            )
            distance = np.zeros(len(at), np.int64)
            for k, c in enumerate(counter):
                distance += ((c[hit[at]] >> lane.astype(np.uint64)) & np.uint64(1)).astype(np.int64) << k
            yield q[hit[at]], 64 * w[hit[at]] + lane, distance


def plausible_pairs(
    pairs: Iterator[tuple[np.ndarray, ...]], short: np.ndarray, n: np.ndarray, root: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, ...]]:
    """The pairs of two roots whose sets of ``n`` elements may have this similarity by their sizes and sketches.

    Where ``n`` is 0 there is no sketch, and the pair may.
    """
    for listed in pairs:
        for i in range(0, len(listed[0]), PAIRS):
            a, b, distance = (x[i:i + PAIRS] for x in listed)
            low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            keep = (root[a] != root[b]) & ((low == 0) | (low >= threshold * high - 1e-6))
            a, b, distance, low = a[keep], b[keep], distance[keep], low[keep]
            keep = (low == 0) | may_be_similar(short[a], short[b], n[a] + n[b], threshold)
            yield a[keep], b[keep], distance[keep]


def lightest(n: int, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> list[np.ndarray]:
    """The pairs of a spanning forest of 0..n-1 that joins the closest first."""
    label, kept = np.arange(n), []
    for level in np.unique(distance):
        x, y = a[distance == level], b[distance == level]
        while True:
            la, lb = label[x], label[y]
            open_ = la != lb
            if not open_.any():
                break
            x, y, la, lb = x[open_], y[open_], la[open_], lb[open_]
            high, at = np.unique(np.maximum(la, lb), return_index=True)
            kept.append((x[at], y[at], np.full(len(at), level)))
            label[high] = np.minimum(la, lb)[at]
            while not np.array_equal(label, shorter := label[label]):
                label = shorter
    return [np.concatenate(v) for v in zip(*kept, strict=True)] if kept else [np.zeros(0, np.int64)] * 3


def forest(n: int, pairs: Iterator[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than n pairs that connect the same nodes, by the smallest distances possible."""
    kept = [np.zeros(0, np.int64)] * 3
    for part in pairs:
        kept = lightest(n, *(np.concatenate(v) for v in zip(kept, part, strict=True)))
    return kept[0], kept[1]


def tree_keys(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each link of a forest (places a and b) a number that stands for the set of its tree's nodes."""
    label = np.arange(len(node))
    while True:
        low = np.minimum(label[a], label[b])
        # The larger label's own place learns of the smaller one, so that whole branches follow.
        for x in (label[a], label[b], a, b):
            np.minimum.at(label, x, low)
        while not np.array_equal(label, shorter := label[label]):
            label = shorter
        if np.array_equal(label[a], label[b]):
            break
    total = np.zeros(len(node), np.uint64)
    np.add.at(total, label, widened(node.view(np.uint64), 2)[:, 1])
    return total[label[a]].view(np.int64)


def near_trees(
    nodes: DataFrame, bands: Sequence[Sequence[int]], radius: int, block: int = BLOCK, threshold: float | None = None
) -> DataFrame:
    """key, a, b: links that connect all nodes (node, fp; distinct fps) within the radius that share a band.

    With a threshold nodes have a root and a sketch (or null) too, and pairs that cannot have this similarity by their sketches
    or have one root already count as not within the radius, so they make no row. Two nodes of a bucket (or of a pair of its blocks) that are within the radius are in one tree, and the
    links of a tree have one key. Equal trees of other buckets have the same key.
    """
    picks = [np.array(band) for band in bands]
    if threshold is None:
        nodes, schema = nodes.select("node", "fp"), "bucket long, node long, fp binary"
    else:
        nodes = nodes.select("node", "fp", "root", "sketch")
        schema = "bucket long, node long, fp binary, root long, sketch binary"

    nodes_columns = nodes.columns

    def buckets(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        fps = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1)
        bits = np.unpackbits(fps, axis=1, bitorder="little")
        for band, pick in enumerate(picks):
            key = bits[:, pick] @ (np.int64(1) << np.arange(len(pick), dtype=np.int64))
            yield key * len(picks) + band

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket in buckets(b) if b.num_rows else ():
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *b.columns], names=["bucket", *nodes_columns])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket in buckets(b) if b.num_rows else ():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in np.unique(bucket, return_counts=True)], names=["bucket", "count"]
                )

    rows = nodes.mapInArrow(releasing(keyed), schema)
    large = (
        nodes.mapInArrow(releasing(counted), "bucket long, count long")
        .groupBy("bucket").agg(F.sum("count").alias("count")).where(F.col("count") > block)
        .select("bucket", F.ceil(F.col("count") / block).cast("long").alias("blocks"))
    )
    large = stored(large, "large-buckets")
    if large.take(1):
        own = F.pmod(F.xxhash64("node"), F.col("blocks"))
        tiles = F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
            lambda j: F.least(j, own) * F.col("blocks") + F.greatest(j, own),
        )
        rows = rows.join(large, "bucket", "left").withColumn(
            "tile", F.explode(F.coalesce(tiles, F.array(F.lit(0).cast("long"))))
        )
    else:
        rows = rows.withColumn("tile", F.lit(0).cast("long"))
    rows = rows.select("bucket", "tile", *nodes_columns).repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")

    def compare(table: pa.Table) -> pa.RecordBatch:
        bucket, tile = (table.column(i).to_numpy() for i in (0, 1))
        new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])) + 1
        edges = np.concatenate([[0], new, [len(bucket)]])
        sizes = np.diff(edges)
        rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
        sizes = sizes[sizes > 1]
        node = table.column(2).to_numpy()[rows]
        fps = b"".join(table.column(3).take(pa.array(rows)).to_pylist())
        ends = np.repeat(np.cumsum(sizes), sizes)
        if len(rows):
            matrix = np.frombuffer(fps, dtype=np.uint8).reshape(len(rows), -1)
            pairs = close_pairs(matrix, ends, radius)
            if threshold is not None:
                root, short = table.column(4).to_numpy()[rows], table.column(5).take(pa.array(rows)).to_pylist()
                short = np.frombuffer(b"".join(x or bytes(SKETCH_BYTES) for x in short), np.uint8).reshape(len(rows), -1)
                pairs = plausible_pairs(pairs, *sketches(short), root, threshold)
            a, b = forest(len(rows), pairs)
        else:
            a = b = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (tree_keys(node, a, b), node[a], node[b])], names=["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            held = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
            if held.num_rows >= 2 * block:
                bucket, tile = held.column(0).to_numpy(), held.column(1).to_numpy()
                same = (bucket == bucket[-1]) & (tile == tile[-1])
                cut = int(np.argmax(same))  # the last bucket may go on in the next batch
                if cut:
                    yield compare(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None:
            yield compare(held)

    return rows.mapInArrow(releasing(run), "key long, a long, b long")


def near_links(nodes: DataFrame, bands: Sequence[Sequence[int]], radius: int, block: int = BLOCK) -> DataFrame:
    """a, b: links that connect all nodes (node, fp; distinct fps) within the radius that share a band."""
    return near_trees(nodes, bands, radius, block).select("a", "b")


def near_groups(
    rows: DataFrame, size: int, words: int, bands: Sequence[Sequence[int]], radius: int, block: int = BLOCK
) -> DataFrame:
    """row, doc_id, fp, root and component_id (smallest doc_id) of rows with row, doc_id and text."""
    prints = stored(with_fingerprints(rows, size, words), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "fingerprint-nodes")
    return prints.join(labelled(nodes, roots(near_links(nodes, bands, radius, block)), "fp"), "fp")


def similar_groups(
    rows: DataFrame, size: int, words: int, bands: Sequence[Sequence[int]], radius: int, threshold: float
) -> DataFrame:
    """row, doc_id, root and component_id of rows with distinct row, doc_id and text.

    Texts are linked if their fingerprints share a band and differ in at most ``radius`` bits, and their sets of
    distinct shingles have this Jaccard similarity; no such pair is missed. One node stands for all rows of a set.
    """
    prints = stored(with_sets(rows, size, words), "shingle-sets")
    nodes = prints.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min("row").alias("node"), F.min("fp").alias("fp"),
        F.min("sketch").alias("sketch"),
    )
    nodes = stored(nodes, "set-nodes")
    copies = prints.select("row").join(nodes.select(F.col("node").alias("row")), "row", "left_anti")
    sets = prints.join(small(stored(copies, "set-copies")), "row", "left_anti")
    sets = sets.select(F.col("row").alias("node"), "hashes", "parity")
    free_shuffles(rows.sparkSession)
    trees = [stored(near_trees(nodes, bands[:FIRST_BANDS], radius).distinct(), "near-trees")]
    root = linked_roots(sets, trees[0], threshold)
    if len(bands) > FIRST_BANDS:
        # What the first bands have joined makes no rows in the others; what is close to others takes its sketch along.
        close = trees[0].select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("close", F.lit(True))
        rooted = nodes.join(small(root), "node", "left").join(small(stored(close, "close-nodes")), "node", "left")
        rooted = stored(rooted.select(
            "node", "fp", F.coalesce("root", "node").alias("root"), F.when(F.col("close"), F.col("sketch")).alias("sketch")
        ), "rooted-nodes")
        for i in range(FIRST_BANDS, len(bands), BANDS_AT_ONCE):
            free_shuffles(rows.sparkSession)
            found = near_trees(rooted, bands[i:i + BANDS_AT_ONCE], radius, threshold=threshold).distinct()
            trees.append(stored(found, "near-trees"))
        root = linked_roots(sets, reduce(DataFrame.unionAll, trees[1:]), threshold, root)
    root = similar_roots(sets, reduce(DataFrame.unionAll, trees).distinct(), root, threshold)
    return prints.select("row", "doc_id", "digest").join(labelled(nodes, root, "digest"), "digest").drop("digest")


def labelled(nodes: DataFrame, root: DataFrame, key: str) -> DataFrame:
    """``key``, root and component_id of nodes with ``key``, node and least."""
    rooted = nodes.select("node", key, "least").join(root, "node", "left").select(key, "least", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select(key, "root", "component_id")


def thirds(bits: int = 64, parts: int = 3) -> list[list[int]]:
    """Disjoint bands: fingerprints within ``parts - 1`` bits agree on at least one of them."""
    return [x.tolist() for x in np.array_split(np.arange(bits), parts)]


def random_bands(bits: int, count: int, size: int) -> list[list[int]]:
    """Fixed pseudo-random choices of bits."""
    draw = np.random.default_rng(SEED)
    return [sorted(draw.choice(bits, size, replace=False).tolist()) for _ in range(count)]


def simhash_components(
    docs: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per input row.

    Fingerprints of 64 bits are linked at ``radius`` or fewer differing bits; no link is missed. A
    text with fewer than ``size`` words has one shingle, one without words (or null) the fingerprint
    zero, linked like any other. Repeated rows keep their rows; null ids stay null and
    count in no minimum (a component with null ids alone has a null id). Empty tables give
    no rows, other columns are not read.
    """
    rows = docs.select(
        F.lit(0).cast("long").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    found = near_groups(rows, size, 1, thirds(64, radius + 1), radius)
    # The bytes are little-endian, the digits are not.
    turned = F.regexp_replace(F.hex("fp"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1")
    return found.select("doc_id", F.lower(turned).alias("fingerprint"), "component_id")


#: At a similarity of 0.8 fingerprints differ in 58 of 384 bits on average, standard deviation 7, and in 72 at most, which is
#: sets of 4 and 5 shingles; unlike ones in 192. So the radius lets about one such pair in two million go at worst, and of
#: the bands 128 * 0.08 fit at worst and 128 * 0.14 as a rule: about one pair in 20,000 or in 50 million shares none.
WIDE_WORDS, WIDE_BANDS, WIDE_BAND_BITS, WIDE_RADIUS = 6, 128, 12, 110
SIMILARITY = 0.8


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Texts are alike if their 384-bit fingerprints share one of 128 bands and differ in at most 110 bits, and their
    sets of word shingles, compared over whole texts, have a Jaccard similarity of 0.8 or more. Each pair
    of close fingerprints in a bucket is decided, so a failed check displaces no other pair. Repeated rows and rows
    with equal or null ids are told apart, and one of a group stays. All columns are kept,
    whatever their names.
    """
    row = next(c for c in ("row", *(f"row_{i}" for i in range(len(docs.columns) + 1)))
               if c not in {x.lower() for x in docs.columns})
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "near-input", "zstd")
    rows = kept.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bands = random_bands(64 * WIDE_WORDS, WIDE_BANDS, WIDE_BAND_BITS)
    members = stored(similar_groups(rows, size, WIDE_WORDS, bands, WIDE_RADIUS, SIMILARITY), "near-members")
    stays = (
        members.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root").agg(F.min("row").alias("stays"))
    )
    dropped = stored(members.join(stays, "root").where("row != stays").select(F.col("row").alias(row)), "near-dropped")
    if dropped.count() <= broadcast_rows:
        dropped = F.broadcast(dropped)
    return kept.join(dropped, row, "left_anti").drop(row)

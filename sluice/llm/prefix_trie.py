"""A trie of shared conversation beginnings, built as ternary search trees over range shards.

Turns are numbered in text order (a dictionary of their own), conversations become arrays of
numbers, equal arrays one row, and ranges of the sorted rows become shards. A shard inserts its rows
median first into a ternary search tree, one tree node for each beginning, and goes through the nodes
level by level from the deepest. Only the beginnings on a shard's first and last path can
lie in another shard as well; these are sent apart and merged, all others are complete at once.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import stored
from sluice.llm.worker import releasing

#: Turns in a shard, which a task holds as a tree; a single longer conversation is a shard's row all the same.
SHARD_TURNS = 200_000
NOTHING = hashlib.sha256(b"").hexdigest()
_SHARD = """key binary, parent_key binary, depth long, least long, parent_least long, n long, children long,
    leaves long, saved long, size long, ends string"""


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id and ``turns``, its (number, bytes of text) by turn, then role and text; null turns first.

    Equal (role, text) have one number, and numbers ascend with them. Rows without a conv_id are left out.
    """
    told = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    content = _digest(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    dictionary = stored(
        told.select("role", "text").distinct().orderBy("role", "text").select(
            content.alias("content"), F.monotonically_increasing_id().alias("id"),
            F.octet_length("text").cast("long").alias("size"),
        ), "turns")
    rows = told.select("conv_id", "turn", content.alias("content")).join(dictionary, "content")
    whole = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("told"), "turn", "id", "size")))
    return rows.groupBy("conv_id").agg(
        F.transform(whole, lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def rebuilt(conversations: DataFrame, group: int = 5, longest: int = 8) -> DataFrame:
    """Every conversation with its first turns from its group's first conversation.

    Conversation c takes h = crc32(decimal c) % (``longest`` + 1) turns of conversation c - c % ``group``
    (all if it has fewer, none if there is no such conversation) in place of its own first h.
    """
    conversations = stored(conversations, "conversations")
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = conversations.where(first == F.col("conv_id")).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, longest).alias("head"))
    kind = conversations.schema["turns"].dataType
    rows = conversations.withColumn("first", first).join(heads, "first", "left")
    head = F.slice(F.coalesce("head", F.array().cast(kind)), F.lit(1), borrowed)
    rest = F.slice("turns", borrowed + 1, F.greatest(F.size("turns") - borrowed, F.lit(0)))
    return rows.select("conv_id", F.concat(head, rest).alias("turns"))


def member_hashes(members: DataFrame) -> DataFrame:
    """key, n, least and ends: how many ids a key has, the smallest, and the SHA-256 of all in order.

    The ids (decimal, ascending, comma between) of a key with many are joined to texts of a batch each
    by all tasks of its range, so that the task that hashes the key reads few rows and holds one at a time.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1])]
            parts = [ids[a:b] for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([keys[a] for a in starts], pa.binary()), "least": [p[0] for p in parts],
                "n": [len(p) for p in parts], "ids": [",".join(map(str, p)) for p in parts],
            })

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now and now[0] == row["key"]:
                    now[1] += row["n"]
                    now[3].update(b"," + row["ids"].encode())
                    continue
                if now:
                    done.append(now)
                now = [row["key"], row["n"], row["least"], hashlib.sha256(row["ids"].encode())]
            if done:
                yield _hash_rows(done)
                done = []
        if now:
            yield _hash_rows([now])

    ranged = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = ranged.mapInArrow(joined, "key binary, least long, n long, ids string")
    return parts.repartition("key").sortWithinPartitions("key", "least").mapInArrow(
        hashed, "key binary, n long, least long, ends string")


def _hash_rows(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "key": pa.array([r[0] for r in rows], pa.binary()), "n": [r[1] for r in rows],
        "least": [r[2] for r in rows], "ends": [r[3].hexdigest() for r in rows],
    })


class TernaryTree:
    """One node for each beginning; 0 is the empty one, and as a link it says that there is none."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        """``sequences`` are sorted and distinct. The middle of a range goes in before its halves."""
        self.turn, self.parent, self.depth = [-1], [-1], [0]
        self.low, self.equal, self.high = [0], [0], [0]
        self.last = [0] * len(sequences)
        ranges = deque([(0, len(sequences))])
        while ranges:
            a, b = ranges.popleft()
            if a < b:
                middle = (a + b) // 2
                self.last[middle] = self._insert(sequences[middle])
                ranges += [(a, middle), (middle + 1, b)]

    def _insert(self, sequence: Sequence[int]) -> int:
        turn, low, high, node = self.turn, self.low, self.high, 0
        for t in sequence:
            links, at = self.equal, node
            while (below := links[at]) and turn[below] != t:
                links, at = (low if t < turn[below] else high), below
            if not below:
                links[at] = below = len(turn)
                turn.append(t)
                self.parent.append(node)
                self.depth.append(self.depth[node] + 1)
                low.append(0)
                high.append(0)
                self.equal.append(0)
            node = below
        return node

    def path(self, node: int) -> list[int]:
        """From the empty beginning to ``node``."""
        found = [node]
        while node:
            node = self.parent[node]
            found.append(node)
        return found[::-1]


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard's sorted rows (ids, sizes, n, least, ends).

    A node on the first or last path has a key, and its counts leave out its children with keys.
    """
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    ids, sizes = table["ids"].to_pylist(), table["sizes"].to_pylist()
    tree = TernaryTree(ids)
    parent, depth, last = np.array(tree.parent), np.array(tree.depth), np.array(tree.last)
    total = len(parent)
    n, least = np.zeros(total, np.int64), np.full(total, np.iinfo(np.int64).max)
    n[last], least[last] = table["n"].to_numpy(), table["least"].to_numpy()
    ends = np.full(total, None, object)
    ends[last] = table["ends"].to_pylist()
    size = np.zeros(total, np.int64)
    for row, node in enumerate(tree.last):
        # Upwards to the first node that has its size already, so each node is met once.
        at, d = node, len(sizes[row])
        while d and not size[at]:
            size[at] = sizes[row][d - 1]
            at, d = parent[at], d - 1
    keys: dict[int, bytes] = {}
    for end in (tree.last[0], tree.last[-1]):
        for node in tree.path(end):
            if node not in keys:
                above = keys[tree.parent[node]] + tree.turn[node].to_bytes(8, "little") if node else b""
                keys[node] = hashlib.blake2b(above, digest_size=16).digest()
    inner = np.ones(total, bool)
    inner[list(keys)] = False
    children = np.bincount(parent[1:][inner[1:]], minlength=total)
    leaves, saved = (inner & (children == 0)).astype(np.int64), np.zeros(total, np.int64)
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
    for level in range(depth.max(), 0, -1):
        nodes = by_depth[bounds[level]:bounds[level + 1]]
        np.add.at(n, parent[nodes], n[nodes])
        np.minimum.at(least, parent[nodes], least[nodes])
        nodes = nodes[inner[nodes]]
        saved[nodes] += (n[nodes] - 1) * size[nodes]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    keyed_parent = np.append(~inner, False)[parent]
    parent_least = least[parent]
    for a in range(0, total, 50_000):
        some = range(a, min(total, a + 50_000))
        part = slice(a, some.stop)
        yield pa.RecordBatch.from_arrays([
            pa.array([keys.get(i) for i in some], pa.binary()),
            pa.array([keys.get(tree.parent[i]) for i in some], pa.binary()),
            pa.array(depth[part]), pa.array(least[part]),
            pa.array(parent_least[part], mask=keyed_parent[part] | (depth[part] == 0)),
            pa.array(n[part]), pa.array(children[part]), pa.array(leaves[part]), pa.array(saved[part]),
            pa.array(size[part]), pa.array(ends[part], pa.string()),
        ], names=["key", "parent_key", "depth", "least", "parent_least", "n", "children", "leaves", "saved",
                  "size", "ends"])


def merged_paths(parts: DataFrame) -> DataFrame:
    """The nodes with keys, each once: counts of all shards, and those of the nodes with keys below.

    Sums over subtrees double their reach each round, so a path of any length takes the logarithm of it.
    """
    merged = stored(parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("least").alias("least"),
        F.sum("n").alias("n"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.first("size").alias("size"), F.max("ends").alias("ends"),
    ), "paths")
    below = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
        F.count("*").alias("keyed"))
    nodes = merged.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("keyed", F.lit(0)))
    nodes = stored(nodes.drop("keyed"), "path-nodes")
    childless = F.when(F.col("children") == 0, 1).otherwise(0)
    sums = stored(nodes.select(
        "key", F.col("parent_key").alias("above"), (F.col("leaves") + childless).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved")), "path-sums")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        up = sums.where("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        skip = sums.select(F.col("key").alias("above"), F.col("above").alias("next"))
        sums = stored(sums.join(up, "key", "left").join(skip, "above", "left").select(
            "key", F.col("next").alias("above"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "path-sums")
    return stored(nodes.drop("leaves", "saved").join(sums.drop("above"), "key"), "paths-merged")


def prefix_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie of ``sequences``: conv_id and ``turns``, an array of (id, size).

    conv_id is the smallest member's, then depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (sum of (n_convs - 1) * size over
    the subtree) and ends_sha256 (of the ids that end at the node). A conversation without turns belongs
    to the root; without conversations there is no node, not even the root.
    """
    rows = stored(sequences.select(
        "conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes")
    ).withColumn("key", _digest(F.array_join(F.col("ids").cast("array<string>"), ","))), "sequences")
    distinct = rows.groupBy("key").agg(F.first("ids").alias("ids"), F.first("sizes").alias("sizes"))
    distinct = stored(distinct.join(member_hashes(rows), "key").drop("key"), "distinct-sequences")
    turns = distinct.agg(F.sum(F.size("ids"))).first()[0] or 0
    shards = 1 + turns // shard_turns
    ranged = distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    nodes = stored(ranged.mapInArrow(releasing(shard_nodes), _SHARD), "shard-nodes")
    paths = merged_paths(nodes.where("key IS NOT NULL"))
    above = paths.select(F.col("key").alias("parent_key"), F.col("least").alias("above"))
    inner = nodes.where("key IS NULL").join(above, "parent_key", "left").withColumn(
        "parent_least", F.coalesce("parent_least", "above"))
    outer = paths.join(above, "parent_key", "left").withColumn("parent_least", F.col("above"))
    names = {
        "least": "conv_id", "depth": "depth", "parent_least": "parent_conv_id", "n": "n_convs",
        "children": "n_children", "leaves": "n_leaves", "saved": "saved_tokens",
    }
    columns = [F.col(a).cast("long").alias(b) for a, b in names.items()]
    ends = F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")
    return inner.select(*columns, ends).unionAll(outer.select(*columns, ends))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations' trie.

    Null role or text is empty, rows without a conv_id are left out, turns of one number are ordered by role
    and text, repeated rows are turns of their own, an empty table gives no rows, and other columns
    are not read. A conversation is one row and its turns one array.
    """
    return prefix_nodes(rebuilt(numbered_turns(conversations)))

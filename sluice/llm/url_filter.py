"""URL rules looked up in a Bloom filter cascade.

Level 1 holds the listed keys. Level 2 holds those keys of the corpus that are not listed but
pass level 1, level 3 those listed ones that pass level 2, and so on until no key passes wrongly.
Since the levels are built over every key that the corpus can ask for, the first level that a
key fails decides its membership exactly, and no row is joined with the lists.

A key is a rule's host and path as one string. A url asks for the host suffixes and
path prefixes that have a rule's number of labels and length, longest key first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Different pairs of label count and path length among the rules; each costs a lookup per url.
MAX_SHAPES = 512
#: Levels shrink geometrically; only keys with equal hashes could reach this many.
MAX_LEVELS = 64


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; the second is odd, so that its multiples spread."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key).bitwiseOR(F.lit(1))


def _bit(h1: np.ndarray, h2: np.ndarray, level: int, probe: int, n_bits: int) -> np.ndarray:
    """The bit of a key; all bits of both hashes are mixed anew for each probe and level."""
    z = h1 + np.uint64(probe + 1) * h2 + np.uint64(level * 0x632BE59BD9B4E019 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) % np.uint64(n_bits)


class Cascade:
    """The levels as arrays of 64-bit words; level ``i`` uses ``probes[i]`` bits of a key."""

    def __init__(self) -> None:
        self.words: list[np.ndarray] = []
        self.probes: list[int] = []

    @property
    def n_bytes(self) -> int:
        return sum(w.nbytes for w in self.words)

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words, ok = self.words[level], np.ones(len(h1), dtype=bool)
        h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
        for i in range(self.probes[level]):
            bit = _bit(h1, h2, level, i, 64 * len(words))
            ok &= (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return ok

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Keys that pass an odd number of levels before the first that they fail are listed."""
        member, alive = np.zeros(len(h1), dtype=bool), np.ones(len(h1), dtype=bool)
        for level in range(len(self.words)):
            at = np.flatnonzero(alive)
            passed = self.passes(level, h1[at], h2[at])
            alive[at] = passed
            member[at[passed]] = level % 2 == 0
        return member


def _with_level(keys: DataFrame, count: int, rate: float, cascade: Cascade) -> None:
    """Adds a level that holds ``keys`` (h1, h2) with this rate of wrong passes.

    Bits are combined word by word on the executors; the driver gets the words of one filter,
    whose number the caller has checked.
    """
    level = len(cascade.words)
    n_words = max(1, math.ceil(max(count, 1) * 1.4427 * math.log2(1 / rate) / 64))
    probes = max(1, round(math.log2(1 / rate)))
    cascade.words.append(np.zeros(n_words, dtype=np.uint64))
    cascade.probes.append(probes)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2 = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            for i in range(probes):
                bit = _bit(h1, h2, level, i, 64 * n_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((bit >> np.uint64(6)).astype(np.int64)),
                     pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))],
                    names=["word", "bits"],
                )

    words = (
        keys.select("h1", "h2").mapInArrow(positions, "word long, bits long")
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))
    )
    for row in words.toLocalIterator():
        cascade.words[-1][row.word] = np.array(row.bits, dtype=np.int64).view(np.uint64)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int) -> Cascade | None:
    """Levels that tell ``listed`` from the other keys of ``universe`` (columns key, h1, h2).

    None if the filters would exceed ``max_bytes``; the caller then joins instead.
    """
    cascade, spark = Cascade(), listed.sparkSession
    others = universe.join(listed.select("key"), "key", "left_anti")
    n_listed, n_others = listed.count(), others.agg(F.approx_count_distinct("key")).first()[0]
    # The first rate balances the first two levels; the later ones halve.
    rate = min(0.5, max(1e-9, 0.7 * n_listed / max(n_others, 1)))
    held, asked, count = listed, others, n_listed

    def passing(keys: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(cascade)
        level = len(cascade.words) - 1

        def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = sent.value.passes(level, b.column(1).to_numpy(), b.column(2).to_numpy())
                yield b.filter(pa.array(ok))

        return keys.mapInArrow(only, "key string, h1 long, h2 long")

    while count:
        if len(cascade.words) == MAX_LEVELS:
            raise RuntimeError("two keys have equal hashes")
        if cascade.n_bytes + count * 1.4427 * math.log2(1 / rate) / 8 > max_bytes:
            return None
        _with_level(held, count, rate, cascade)
        wrong = stored(passing(asked).distinct(), "cascade")
        held, asked, count, rate = wrong, held, wrong.count(), 0.5
    return cascade


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    max_filter_bytes: int = 16 << 20,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    ``rules`` has host, path and verdict (allow or block); a rule fits its host and all
    subdomains if the path starts with the rule's. The longest rule wins, among equals the one
    with the longer host. If one rule is both allowed and blocked, it blocks. Without a rule
    the url's keys are not listed: rule null, verdict ``default``. A url that is null or has
    no ``://`` has neither host nor path and no rule; null rules and rules without a host fit
    nothing. Empty tables and repeated rows are fine, other columns are not read.
    """
    spark = pages.sparkSession
    rules = (
        rules.where("host is not null and host != '' and verdict is not null")
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                (F.col("verdict") == "block").alias("blocks"))
        .groupBy("host", "path").agg(F.max("blocks").alias("blocks"))
        .withColumn("key", F.concat("host", "path"))
        .withColumn("h1", _hashes(F.col("key"))[0]).withColumn("h2", _hashes(F.col("key"))[1])
    )
    shapes = [
        (r.labels, r.length) for r in rules.select(
            F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")
        ).distinct().limit(MAX_SHAPES + 1).collect()
    ]
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have over {MAX_SHAPES} shapes (labels of the host, path length)")
    urls = pages.select(
        F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    )
    if not shapes:
        return urls.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    labels = F.size(F.split("host", r"\."))
    asked = [
        F.when(
            (labels >= n) & (F.length("path") >= m) & (F.col("host") != ""),
            F.struct(
                (F.length(F.substring_index("host", ".", -n)) + m).alias("size"),
                F.length(F.substring_index("host", ".", -n)).alias("host_size"),
                F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)).alias("key"),
            ),
        )
        for n, m in shapes
    ]
    keys = F.transform(
        F.sort_array(F.filter(F.array(*asked), lambda x: x.isNotNull()), asc=False), lambda x: x["key"]
    )
    urls = urls.withColumn("keys", keys)
    universe = stored(
        urls.select(F.explode("keys").alias("key")).distinct()
        .select("key", _hashes(F.col("key"))[0].alias("h1"), _hashes(F.col("key"))[1].alias("h2")),
        "url-keys",
    )
    # Only listed keys that the corpus can ask for matter.
    listed = stored(rules.join(universe.select("key"), "key", "left_semi"), "url-listed")
    plain, blocking = listed.select("key", "h1", "h2"), listed.where("blocks").select("key", "h1", "h2")
    member = build_cascade(plain, universe, max_filter_bytes)
    blocks = member and build_cascade(blocking, plain, max_filter_bytes - member.n_bytes)
    if member is None or blocks is None:
        return _joined(urls, listed, default)
    sent = spark.sparkContext.broadcast((member, blocks))

    def first_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, blockers = sent.value
        for b in batches:
            lists, h1s, h2s = b.column(3), b.column(4), b.column(5)
            starts = lists.offsets.to_numpy()
            starts = starts - starts[0]
            h1, h2 = (h.flatten().to_numpy() for h in (h1s, h2s))
            row = np.repeat(np.arange(b.num_rows), np.diff(starts))
            at = np.flatnonzero(members.contains(h1, h2))
            rows, first = np.unique(row[at], return_index=True)
            chosen = at[first]
            blocked = blockers.contains(h1[chosen], h2[chosen])
            rule, verdict = [None] * b.num_rows, [default] * b.num_rows
            for r, key, bad in zip(rows, lists.flatten().take(pa.array(chosen)).to_pylist(), blocked, strict=True):
                rule[r], verdict[r] = key, "block" if bad else "allow"
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    hashed = urls.select(
        "page_id", "host", "path", "keys",
        F.transform("keys", lambda k: _hashes(k)[0]).alias("h1"),
        F.transform("keys", lambda k: _hashes(k)[1]).alias("h2"),
    )
    kind = dict(urls.dtypes)["page_id"]
    return hashed.mapInArrow(
        first_listed, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


def _joined(urls: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same result by a join of the keys, for lists whose filters outgrow a broadcast."""
    marked = urls.withColumn("row", F.monotonically_increasing_id())
    marked = stored(marked, "url-rows")
    found = (
        marked.select("row", F.posexplode("keys").alias("at", "key"))
        .join(listed.select("key", "blocks"), "key")
        .groupBy("row").agg(F.min_by(F.struct("key", "blocks"), "at").alias("hit"))
    )
    verdict = F.when(F.col("hit.blocks"), "block").when(F.col("hit").isNotNull(), "allow").otherwise(default)
    return marked.join(found, "row", "left").select(
        "page_id", "host", "path", F.col("hit.key").alias("rule"), verdict.alias("verdict")
    )

"""Removal of repeated passages located by sharded Aho-Corasick automata.

1. Every window of ``span`` words picks one of its phrases of ``PHRASE`` words, that with the
   smallest hash. Equal windows pick the same phrase. Hashes of picked phrases are counted over all
   documents; those met more than once go into a Bloom filter.
2. All documents stream past the filter. Runs of windows whose phrase passes become segments, and
   phrases whose text occurs in several places are confirmed as recurring.
3. Confirmed phrases are dealt to shards, each small enough for one automaton, and each stretch of
   windows with one phrase goes to that phrase's shard. The automaton confirms the phrase at its known
   place. Equal windows have equal phrases, so they meet in one shard, which keeps the first place of each
   digest and gives back the runs of all later windows.
4. A shard with a hot phrase is salted. Its tasks send on only the first place that each of them
   found for a digest, and the least of these stays.

Later copies of a whole text need no search: all their windows started earlier.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.line_dedup import small
from sluice.llm.scratch import stored
from sluice.llm.url_filter import Cascade, _with_level

#: Half a window: the longer, the fewer windows share a phrase and yet differ.
PHRASE = 10
#: Phrases in one automaton, some hundred bytes of memory each and node.
SHARD_PHRASES = 25_000
#: Phrases in their surroundings that one task streams through an automaton; a shard has half as many on average.
SHARD_SEGMENTS = 200_000
#: Beyond this size the filter is left out and every window is a candidate.
MAX_FILTER_BYTES = 32 << 20
NO_ID = 2**63 - 1


class Words:
    """The words of a text (bytes between ASCII white space) and their places in it joined by spaces."""

    def __init__(self, raw: bytes):
        self.words = raw.split()
        self.n, self.text = len(self.words), b" ".join(self.words)
        lengths = np.fromiter(map(len, self.words), dtype=np.int64, count=self.n)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def part(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last``, the latter included."""
        return self.text[self.starts[first]:self.ends[last]]

    def picks(self, span: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window the first word of its phrase, the leftmost of the smallest hash, and that hash."""
        if self.n < span:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        codes = np.fromiter(map(crc32, self.words), dtype=np.uint64, count=self.n)
        best = np.zeros(self.n - PHRASE + 1, dtype=np.uint64)
        for k in range(PHRASE):
            best = best * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + len(best)]
        best = (best ^ (best >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        best ^= best >> np.uint64(32)
        at, width = np.arange(len(best)), 1
        while width < span - PHRASE + 1:  # a stretch is the smaller of two that cover it
            step = min(width, span - PHRASE + 1 - width)
            left, right = best[:-step], best[step:]
            later = right < left
            best, at = np.where(later, right, left), np.where(later, at[step:], at[:-step])
            width += step
        return at, best


def second_hash(h: np.ndarray) -> np.ndarray:
    return (h * np.uint64(0xD6E8FEB86659FD93)) ^ (h >> np.uint64(32)) | np.uint64(1)


def _distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, oid, copy, text), and the keys (oid, copy) of later copies of a text."""
    rows = docs.withColumn("oid", F.coalesce("id", F.lit(NO_ID))).withColumn("copy", F.xxhash64("text"))
    first = rows.groupBy("copy", F.xxhash64(F.lit("b"), F.col("text")).alias("other")).agg(
        F.min("oid").alias("least"), F.max("oid").alias("most")
    ).where("most > least")
    first = small(stored(first, "phrase-copies"))
    later = rows.join(first, (rows["copy"] == first["copy"]) & (F.xxhash64(F.lit("b"), F.col("text")) == first["other"])
                      & (rows["oid"] > first["least"]), "left_semi")
    return rows, stored(later.select("oid", "copy").distinct(), "phrase-later")


def _recurring_filter(texts: DataFrame, span: int) -> Cascade | None:
    """A Bloom filter of the picked phrases that occur more than once; None if it would be too large."""

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.zeros(0, np.uint64)]
            for raw in b.column(0).to_pylist():
                at, hashes = Words(raw).picks(span)
                found.append(hashes[np.flatnonzero(np.diff(at, prepend=-1))])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h1"])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h2 = second_hash(b.column(0).to_numpy().view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h2)], names=["h1", "h2"])

    hashes = texts.select(F.col("text").cast("binary")).mapInArrow(picked, "h1 long")
    recurring = hashes.groupBy("h1").count().where("count > 1").select("h1")
    recurring = stored(recurring.mapInArrow(both, "h1 long, h2 long"), "phrase-hashes")
    count = recurring.count()
    if count * 10 / 8 > MAX_FILTER_BYTES:
        return None
    cascade = Cascade()
    _with_level(recurring, count, 0.01, cascade)
    return cascade


def _segments(texts: DataFrame, span: int, passing: Cascade | None) -> DataFrame:
    """oid, copy, text and stretches of each run of windows that may recur.

    A stretch is the windows that picked one phrase: the first window's number in the document, their count, and first
    byte and length, in the segment, of their words and of the phrase.
    """
    sent = texts.sparkSession.sparkContext.broadcast(passing)
    names = ("first", "windows", "start", "bytes", "at", "length")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys: list[tuple] = []
            parts: list[bytes] = []
            sizes = [0]
            stretches: list[np.ndarray] = []
            for oid, copy, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = Words(raw)
                at, hashes = words.picks(span)
                if not len(at):
                    continue
                first = np.flatnonzero(np.diff(at, prepend=-1))
                last = np.append(first[1:], len(at))
                ok = np.ones(len(first), dtype=bool)
                if sent.value is not None:
                    h = hashes[first]
                    ok = sent.value.passes(0, h, second_hash(h))
                edges = np.flatnonzero(np.diff(ok.astype(np.int8), prepend=0, append=0))
                begins, ends = edges[::2], edges[1::2]
                if not len(begins):
                    continue
                origin = np.repeat(words.starts[first[begins]], ends - begins)
                first, last = first[ok], last[ok]
                phrase, start = words.starts[at[first]], words.starts[first]
                stretches.append(np.stack([
                    first, last - first, start - origin, words.ends[last + span - 2] - start,
                    phrase - origin, words.ends[at[first] + PHRASE - 1] - phrase,
                ]).astype(np.int32))
                n = 0
                for size in (ends - begins).tolist():
                    keys.append((oid, copy))
                    parts.append(words.part(first[n], last[n + size - 1] + span - 2))
                    sizes.append(size)
                    n += size
            table = np.concatenate(stretches, axis=1) if stretches else np.zeros((len(names), 0), np.int32)
            inner = pa.StructArray.from_arrays([pa.array(row) for row in table], names=list(names))
            found = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), inner)
            oids, copies = zip(*keys, strict=True) if keys else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(oids, pa.int64()), pa.array(copies, pa.int64()), pa.array(parts, pa.binary()), found],
                names=["oid", "copy", "part", "stretches"])

    rows = texts.select("oid", "copy", F.col("text").cast("binary"))
    inner = ",".join(f"{name}:int" for name in names)
    return rows.mapInArrow(cut, f"oid long, copy long, part binary, stretches array<struct<{inner}>>")


def _runs(oid: np.ndarray, copy: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows as (oid, copy, first window, count) of maximal runs."""
    order = np.lexsort((start, copy, oid))
    oid, copy, start = oid[order], copy[order], start[order]
    same = (oid[1:] == oid[:-1]) & (copy[1:] == copy[:-1])
    new = np.ones(len(oid), dtype=bool)
    new[1:] = ~(same & (start[1:] <= start[:-1] + 1))  # equal rows give equal windows
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(oid))[: len(first)] - 1
    return oid[first], copy[first], start[first], start[last] - start[first] + 1


def _located(segments: DataFrame, span: int) -> DataFrame:
    """What the shards' automata find.

    Runs of windows that start earlier elsewhere, as (oid, copy, start, windows) without a digest; and, of salted shards,
    the first place that a task found for each digest (w1, w2), with ``windows`` 1.
    """
    parts = segments.select("oid", "copy", "part", F.explode("stretches").alias("s")).select("oid", "copy", "part", "s.*")
    parts = parts.withColumn("phrase", F.substring("part", F.col("at") + 1, F.col("length")))
    phrases = stored(parts.groupBy("phrase").count().where("count > 1"), "phrases")
    size = phrases.agg(F.count("*").alias("phrases"), F.coalesce(F.sum("count"), F.lit(0)).alias("places")).first()
    shards = max(1, -(-size.phrases // SHARD_PHRASES), -(-size.places // (SHARD_SEGMENTS // 2)))
    shard = F.pmod(F.xxhash64("phrase"), F.lit(shards)).cast("int").alias("shard")
    salts = phrases.groupBy(shard).agg(F.ceil(F.sum("count") / SHARD_SEGMENTS).cast("long").alias("salts"))
    salts = small(stored(salts, "phrase-salts"))
    routed = parts.select(
        "oid", "copy", "first", "windows", (F.col("at") - F.col("start") + F.col("length")).alias("until"), shard,
        F.substring("part", F.col("start") + 1, F.col("bytes")).alias("part"),
    )
    routed = routed.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("oid", "copy", "first"), F.col("salts")))
    dealt = phrases.select("phrase", shard).join(salts, "shard").select(
        "shard", "phrase", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    )

    def locate(parts: pa.Table, patterns: pa.Table) -> pa.Table:
        import ahocorasick
        from xxhash import xxh3_128_digest

        found: list[int] = []
        digests: list[bytes] = []
        if len(parts) and len(patterns):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for p in patterns.column("phrase").to_pylist():
                automaton.add_word(f" {p.decode('latin-1')} ")
            automaton.make_automaton()
            columns = (parts.column(c).to_pylist() for c in ("windows", "until", "part"))
            for row, (count, until, part) in enumerate(zip(*columns, strict=True)):
                # Bytes as characters; a space on both sides keeps matches to whole words.
                if any(end == until + 1 for end, _ in automaton.iter(f" {part.decode('latin-1')} ")):
                    at = list(accumulate((len(word) + 1 for word in part.split(b" ")), initial=0))
                    digests += [xxh3_128_digest(part[at[i]:at[i + span] - 1]) for i in range(count)]
                    found.append(row)
        rows = parts.select(["oid", "copy", "first", "windows"]).take(pa.array(found, pa.int64()))
        oid, copy, first, count = (c.to_numpy().astype(np.int64) for c in rows.columns)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        w1, w2 = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2).T
        place = np.stack([np.repeat(oid, count), np.repeat(copy, count), np.repeat(first, count) + inner])
        order = np.lexsort((*place[::-1], w2, w1))
        w1, w2, place = w1[order], w2[order], place[:, order]
        new = np.ones(len(w1), dtype=bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        leaders = np.flatnonzero(new)
        later = (place != place[:, leaders[np.cumsum(new) - 1]]).any(axis=0) if len(leaders) else new
        oid, copy, start, count = _runs(*place[:, later])
        if not len(parts) or parts.column("salts")[0].as_py() == 1:
            leaders = leaders[:0]
        closed, ones = pa.nulls(len(oid), pa.int64()), np.ones(len(leaders), np.int64)
        return pa.table({
            "oid": np.append(oid, place[0, leaders]), "copy": np.append(copy, place[1, leaders]),
            "start": np.append(start, place[2, leaders]).astype(np.int32),
            "windows": np.append(count, ones).astype(np.int32),
            "w1": pa.concat_arrays([closed, pa.array(w1[leaders])]), "w2": pa.concat_arrays([closed, pa.array(w2[leaders])]),
        })

    return (
        routed.groupBy("shard", "salt").cogroup(dealt.groupBy("shard", "salt"))
        .applyInArrow(locate, "oid long, copy long, start int, windows int, w1 long, w2 long")
    )


def without_repeats(
    docs: DataFrame, span: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space).

    A word goes if a window of ``span`` words covers it whose words also start earlier: in a document
    with a smaller id, or in the same one before. Null texts have no words; texts with fewer
    words than a window keep all. Null ids come after all others. Rows with equal id and text are one
    document and get the same result each; rows with equal id and different texts are ordered by
    a hash of the text. An empty table gives no rows; other columns are not read.
    """
    if span < PHRASE:
        raise ValueError(f"a window has at least {PHRASE} words")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows, later = _distinct_texts(given)
    later = small(later)
    texts = rows.join(later, ["oid", "copy"], "left_anti")
    segments = stored(_segments(texts, span, _recurring_filter(texts, span)), "segments", "zstd")
    located = stored(_located(segments, span), "phrase-places")
    # At most one row of a digest for each salt of its shard.
    open_ = located.where("w1 IS NOT NULL")
    place = F.struct("oid", "copy", "start")
    first = (
        open_.groupBy("w1", "w2").agg(F.min(place).alias("place"), F.max(place).alias("last"))
        .where("place != last").select("w1", "w2", "place")
    )
    repeated = open_.join(first, ["w1", "w2"]).where(place != F.col("place"))
    runs = located.where("w1 IS NULL").select("oid", "copy", "start", "windows").unionAll(
        repeated.select("oid", "copy", "start", "windows"))
    gone = runs.groupBy("oid", "copy").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    gone = small(stored(gone, "phrase-gone"), F.size("runs"))
    marked = (
        rows.join(gone, ["oid", "copy"], "left")
        .join(later.withColumn("whole", F.lit(True)), ["oid", "copy"], "left")
        .select("id", F.col("text").cast("binary").alias("text"), "runs", F.coalesce("whole", F.lit(False)).alias("whole"))
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, runs, whole in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                words = raw.split()
                n = len(words)
                if whole and n >= span:
                    words = []
                elif runs:
                    edge = np.zeros(n + 1, dtype=np.int64)
                    at = np.array([(run["start"], run["windows"]) for run in runs])
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at.sum(axis=1) + span - 1, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:n] == 0).tolist()]
                out.append((n, n - len(words), b" ".join(words).decode()))
            columns = list(zip(*out, strict=True)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return marked.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")



"""Spelling variants: words one edit from a commoner word, found by edit-matrix rows over sorted lists.

The matrix of a query word against a sorted list is worked out down the list: words that share a
beginning share the matrix rows of that beginning, and of each row only the three cells around the
diagonal matter for a single edit. A range of the list whose shared rows all exceed one edit is skipped
as a whole. All queries of a list go down together, one numpy step for each depth.

Two words within one edit share the first or the last half of the shorter one. So lists are made of words
that share a half, once for words as written and once reversed, and no list is compared with another.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import stored
from sluice.llm.worker import releasing

# The letters of a run (after A-Z are lower-cased), one deletion in so many runs, the least word.
RUN = re.compile("[a-zÀ-ÿ]+")
DAMAGED, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3

#: Different words that a task counts before it passes its counts on.
COUNTED = 200_000
#: Rows of lists that a task takes at a time; a larger list is cut in blocks, compared two by two.
BLOCK = 20_000
#: Queries that go down a list together.
QUERIES = 2_000
#: Far beyond the doubled steps of a chain whose counts double.
MAX_ROUNDS = 12
_FOUND = "word string, n_near long, best struct<less: long, word: string>"


def damaged(run: str, h: int) -> str:
    """The run without its code point h % length if ``DAMAGED`` divides h."""
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: runs of letters after their damage, at least ``LEAST_LENGTH`` long and ``LEAST_COUNT`` times in all.

    Counts combine in the task before the shuffle, so a common word is a row for each task.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{key.as_py() if key.is_valid else ''}:".encode())
                lowered = text.as_py().encode().lower().decode()  # bytes lower only A-Z
                for run, n in Counter(RUN.findall(lowered)).items():
                    word = damaged(run, zlib.crc32(run.encode(), start))
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
            if len(counts) > COUNTED:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(releasing(count), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _letters(words: list[str], width: int) -> np.ndarray:
    """A row of Latin-1 code points for each word, zeros behind."""
    return np.array([w.encode("latin-1") for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)


def near_pairs(lists: np.ndarray, queries: np.ndarray, of: np.ndarray, list_of: np.ndarray, same: int):
    """Yields arrays (query, row) of the pairs exactly one edit apart.

    ``lists`` are rows of letters, sorted within their lists, whose numbers ``list_of`` ascend; ``of`` names
    each query's list. Words of a list and its queries have their first ``same`` letters in common.
    """
    size, width = lists.shape
    length, wanted = (lists > 0).sum(axis=1), (queries > 0).sum(axis=1)
    differs = lists[1:] != lists[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    shared[list_of[1:] != list_of[:-1]] = 0
    shared = np.concatenate([[0], shared])  # longest common prefix with the row before
    starts = [np.flatnonzero(shared < d) for d in range(width + 1)]
    padded = np.pad(queries, ((0, 0), (0, 2)))
    tops, ends = np.searchsorted(list_of, of, "left"), np.searchsorted(list_of, of, "right")
    for a in range(0, len(queries), QUERIES):
        query = np.arange(a, min(len(queries), a + QUERIES))
        low, high = tops[query], ends[query]
        query, low, high = query[low < high], low[low < high], high[low < high]
        # Cells before, on and after the diagonal; the first letters are equal.
        before, on, after = (np.full(len(query), x, np.int8) for x in (1, 0, 1))
        for d in range(same, width):
            # A range at depth d falls into those that also share letter d, whose rows are worked out once.
            begins = starts[d + 1]
            first, last = np.searchsorted(begins, low), np.searchsorted(begins, high)
            each = last - first
            into = np.repeat(np.arange(len(query)), each)
            child = np.arange(len(into)) - np.repeat(np.cumsum(each) - each, each) + first[into]
            low = begins[child]
            high = np.append(begins, size)[child + 1]
            letter = lists[low, d]
            query, before, on, after = query[into], before[into], on[into], after[into]
            left = wanted[query]
            x = np.minimum(before + (letter != padded[query, d - 1]), on + 1)
            y = np.minimum(np.minimum(on + (letter != padded[query, d]), after + 1), x + 1)
            z = np.minimum(after + (letter != padded[query, d + 1]), y + 1)
            x[left < d], y[left < d + 1], z[left < d + 2] = 2, 2, 2
            keep = (letter > 0) & (np.minimum(np.minimum(x, y), z) <= 1)
            query, low, high, before, on, after = (v[keep] for v in (query, low, high, x, y, z))
            if not len(query):
                break
            whole = length[low] == d + 1
            over = wanted[query] - d - 1
            edits = np.where(over == 0, on, np.where(over == 1, after, np.where(over == -1, before, 2)))
            hit = whole & (edits == 1)
            yield query[hit], low[hit]


def _searched(rows: pa.Table) -> list[tuple]:
    """(word, near words, best near word as (-n, word)) of whole lists, sorted by side, m, key and tile."""
    side, m = rows["side"].to_numpy(), rows["m"].to_numpy()
    cuts = np.flatnonzero((np.diff(side) != 0) | (np.diff(m) != 0)) + 1
    found = []
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        found += _searched_alike(rows.slice(a, b - a), int(side[a]), int(m[a]))
    return found


def _searched_alike(rows: pa.Table, side: int, m: int) -> list[tuple]:
    words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
    use, half = rows["use"].to_numpy(), m // 2
    letters = _letters([w[::-1] for w in words] if side else words, m + 1)
    keys, tile = rows["key"].to_pylist(), rows["tile"].to_numpy()
    new = [i == 0 or keys[i] != keys[i - 1] or tile[i] != tile[i - 1] for i in range(len(keys))]
    number = np.cumsum(new)
    listed, asked = np.flatnonzero(use != 2), np.flatnonzero(use != 1)
    order = np.lexsort([*letters[listed].T[::-1], number[listed]])
    listed = listed[order]
    length = (letters > 0).sum(axis=1)
    written = _letters(words, m + 1)
    near, best = Counter(), {}
    for q, w in near_pairs(letters[listed], letters[asked], number[asked], number[listed], half):
        q, w = asked[q], listed[w]
        keep = np.minimum(length[q], length[w]) == m
        if side:  # pairs with equal first halves are found by the other side
            keep &= (written[q, :half] != written[w, :half]).any(axis=1)
        for i, j in zip(q[keep].tolist(), w[keep].tolist(), strict=True):
            near[i] += 1
            best[i] = min(best.get(i, (0, "")), (-int(n[j]), words[j]))
    return [(words[i], k, best[i]) for i, k in near.items()]


def _halves(words: DataFrame) -> DataFrame:
    """A row for each list of a word: side (1: reversed), m (letters of the shorter word) and key."""
    size, ways = F.char_length("word"), F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.withColumn("side", ways).withColumn("less", ways).withColumn("m", size - F.col("less"))
    turned = F.when(F.col("side") == 1, F.reverse("word")).otherwise(F.col("word"))
    return rows.where(F.col("m") >= LEAST_LENGTH).drop("less").withColumn("key", F.substring(turned, F.lit(1), F.floor(F.col("m") / 2)))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near and best (less: -n, word) of the words (word, n; stored) that have near words.

    A list of more than ``block`` words is cut in blocks by hash; each pair of blocks is a list of its own in which
    the words of one only ask and those of the other are only found.
    """
    rows, names = _halves(words), ["side", "m", "key"]
    large = stored(rows.groupBy(*names).count().where(F.col("count") > block), "large-lists")
    blocks = F.ceil(F.coalesce("count", F.lit(0)) / block).cast("long")
    rows = rows.join(large, names, "left").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    tile = F.struct(F.lit(0).alias("tile"), F.lit(0).alias("use"))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    tiles = F.when(F.col("blocks") <= 1, F.array(tile)).otherwise(F.concat(
        F.transform(numbers, lambda i: F.struct((i * F.col("blocks") + own).alias("tile"), F.lit(1).alias("use"))),
        F.transform(numbers, lambda i: F.struct((own * F.col("blocks") + i).alias("tile"), F.lit(2).alias("use"))),
    ))
    rows = rows.withColumn("t", F.explode(tiles)).select(*names, "t.tile", "t.use", "word", "n")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > block:
                table = pa.Table.from_batches(held)
                last = [table[c][-1] for c in ("side", "m", "key", "tile")]
                cut = len(table)
                while cut and [table[c][cut - 1] for c in ("side", "m", "key", "tile")] == last:
                    cut -= 1
                if cut:
                    yield _found(_searched(table.slice(0, cut)))
                held = table.slice(cut).to_batches()
        if held:
            yield _found(_searched(pa.Table.from_batches(held)))

    tasks = 1 + 4 * words.count() // block
    dealt = rows.repartition(tasks, *names, "tile").sortWithinPartitions(*names, "tile")
    found = dealt.mapInArrow(releasing(search), _FOUND)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _found(rows: list[tuple]) -> pa.RecordBatch:
    best = pa.StructArray.from_arrays(
        [pa.array([r[2][0] for r in rows], pa.int64()), pa.array([r[2][1] for r in rows], pa.string())],
        names=["less", "word"])
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), best],
        names=["word", "n_near", "best"])


def chain_ends(forms: DataFrame) -> DataFrame:
    """word and root, the last of the chain word -> form -> ...; each round doubles the reach (forms: word, form)."""
    ends = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MAX_ROUNDS):
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = stored(ends.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not ends.where("moved").take(1):
            return ends.select("word", "root")
        ends = ends.select("word", "root")
    raise RuntimeError("the chains did not end")


def grouped_spellings(words: DataFrame, ratio: int = 2, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of a vocabulary (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of
    largest n, of equal ones the first in code-point order, if its n is at least ``ratio`` times the word's. Words are
    distinct, at least five code points long and of the letters a-z and U+00C0 to U+00FF.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    near = stored(near_words(words, block), "near-words")
    known = words.join(near, "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    known = stored(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    ), "forms")
    roots = chain_ends(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """The spelling variants among the words of whole texts.

    Null and empty texts have no words, a null doc_id counts as no digits in the damage's checksum, repeated rows
    count again, an empty table gives no rows, other columns are not read.
    """
    return grouped_spellings(word_counts(docs))

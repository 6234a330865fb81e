"""Sum-of-squares online packing of token sequences into fixed windows.

Every input partition packs its own documents, in their order, without a shuffle. A level array
holds how many windows are open at each fill; a document goes to the level (or a new
window) after which the sum of the squared counts is smallest. A document longer than a window
first fills windows of its own. At most ``max_open`` windows are open, so memory is bounded:
beyond that, and at a partition's end, the open windows are re-cut into full ones. What
remains of a partition is cut along the binary digits of its length, since a sequence whose
length is a power of two needs no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.tokens import SpaceSplitEncoder, forget
from sluice.llm.worker import releasing

SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
#: Sequence numbers of one partition; the partition's number stands above them.
PARTITION_BITS = 40


class Packer:
    """One partition's windows. A piece is (doc_id, start, ids, number of the document's ids)."""

    def __init__(self, window: int, max_open: int, first_sequence: int):
        self.window, self.max_open, self.next = window, max_open, first_sequence
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.done: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self._close([(doc_id, start, ids[start:start + self.window], total)])
            start += self.window
        if start < total:
            self._place((doc_id, start, ids[start:], total))
            if int(self.levels.sum()) > self.max_open:
                self._recut()

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.best_level(size)
        pieces = self.open[level].pop() if level else []
        self.levels[level] -= level > 0
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
        else:
            self.levels[level + size] += 1
            self.open.setdefault(level + size, []).append(pieces)

    def best_level(self, size: int) -> int:
        """Where the sum of squares grows least; the fuller window among equals, 0 for a new one."""
        levels = np.flatnonzero(self.levels[:self.window - size + 1])
        levels = np.concatenate([[0], levels])
        grown = 2 * self.levels[levels + size] + 1
        grown[levels + size == self.window] = 0
        grown -= np.where(levels > 0, 2 * self.levels[levels] - 1, 0)
        return int(levels[len(levels) - 1 - np.argmin(grown[::-1])])

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.done.append((doc_id, start, len(ids), total, self.next, offset, ids.tobytes()))
            offset += len(ids)
        self.next += 1

    def _recut(self) -> list[tuple]:
        """Cuts the open windows into full ones, and keeps what remains as one open window."""
        queue = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        self.open, held, fill = {}, [], 0
        self.levels[:] = 0
        for doc_id, start, ids, total in queue:
            while fill + len(ids) >= self.window:
                cut = self.window - fill
                self._close([*held, (doc_id, start, ids[:cut], total)])
                held, fill, start, ids = [], 0, start + cut, ids[cut:]
            if len(ids):
                held.append((doc_id, start, ids, total))
                fill += len(ids)
        if held:
            self.levels[fill], self.open[fill] = 1, [held]
        return held

    def finish(self) -> None:
        rest = self._recut()
        self.open, self.levels[:] = {}, 0
        fill = sum(len(p[2]) for p in rest)
        for bit in range(fill.bit_length() - 1, -1, -1):
            room, pieces = fill & (1 << bit), []
            while room:
                doc_id, start, ids, total = rest.pop(0)
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            if pieces:
                self._close(pieces)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) if self.done else [()] * 7
        self.done = []
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 4096,
    end_id: int = 2,
    max_open: int = 1024,
    most_pieces: int = 700_000,
    keep_pieces: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    Ids are those of the tokenizer plus ``end_id``; ``ids`` holds a piece's as little-endian
    unsigned 32-bit numbers. A null or empty text is the end id alone. Each row is
    packed for itself, also if ids or texts repeat or the id is null. An empty table gives no
    rows; other columns are not read. A Python worker remembers ``most_pieces`` pieces of text,
    some hundred bytes each, also while it runs other tasks unless ``keep_pieces`` is off.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = SpaceSplitEncoder(tokenizer_path, most_pieces)
        packer = Packer(window, max_open, TaskContext.get().partitionId() << PARTITION_BITS)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                packer.add(doc_id, np.concatenate([ids, end]))
                if len(packer.done) >= 2000:
                    yield packer.taken()
        packer.finish()
        yield packer.taken()
        if not keep_pieces:
            forget(tokenizer_path, most_pieces)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(releasing(run), SCHEMA)

"""Token ids of many texts by encoding each distinct piece between two spaces once.

Both public tokenizers split a text before they merge, and never across a white-space
character that has none beside it. The ids of a text are therefore those of its pieces, and the
pieces of a batch repeat a lot. Distinct pieces go through the library in long strings,
separated by a special token whose id ends each piece's ids.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces in one string; long enough to amortise a call, short enough to stay small.
PIECES_PER_CALL = 128
#: Strings in the library at a time; its results are far larger than the ids.
CALLS = 16
#: A space with white space (or a control character that some libraries count as such) beside it.
CROWDED_SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}\x{180e}\x{200b}\x{feff}] | [\s\v\x1c-\x1f\x{85}\p{Z}\x{180e}\x{200b}\x{feff}]"


class PieceEncoder:
    """Encodes distinct pieces with a tokenizers file; ``add_special_tokens=False`` throughout."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        plain = {i: t.content for i, t in added.items() if t.special and not (
            t.lstrip or t.rstrip or t.single_word or t.normalized)}
        self.specials = [t.content for t in added.values()]
        self.end_id, self.end = max(plain.items()) if plain else (-1, "")

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each piece's ids begin (one more at the end)."""
        odd = [i for i, p in enumerate(pieces) if not self.end or any(s in p for s in self.specials)]
        alone = {i: self.encode(pieces[i]) for i in odd}
        joined = [p if i not in alone else "" for i, p in enumerate(pieces)] if alone else pieces
        calls = [
            self.end.join(joined[i:i + PIECES_PER_CALL]) + self.end
            for i in range(0, len(joined), PIECES_PER_CALL)
        ] if self.end else []
        found = [
            np.array(e.ids, dtype=np.uint32)
            for i in range(0, len(calls), CALLS)
            for e in self.tokenizer.encode_batch_fast(calls[i:i + CALLS], add_special_tokens=False)
        ]
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.end_id) if self.end else np.zeros(0, np.int64)
        lengths = np.diff(np.concatenate([[-1], ends])) - 1 if self.end else np.zeros(len(pieces), np.int64)
        ids = ids[ids != self.end_id] if self.end else ids
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        if not alone:
            return ids, starts
        each = [alone.get(i, ids[starts[i]:starts[i + 1]]) for i in range(len(pieces))]
        sizes = np.array([len(x) for x in each], dtype=np.int64)
        return np.concatenate(each), np.concatenate([[0], np.cumsum(sizes)])


def spread(ids: np.ndarray, starts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The ids of the pieces ``index``, one piece after another."""
    lengths = (starts[1:] - starts[:-1])[index]
    total = int(lengths.sum())
    begins = np.cumsum(lengths) - lengths
    return ids[np.repeat(starts[index] - begins, lengths) + np.arange(total)]


class PieceCache:
    """The ids of pieces met so far; beyond ``most`` pieces, new ones are kept for one call only."""

    def __init__(self, encoder: PieceEncoder, most: int = 700_000):
        self.encoder, self.most = encoder, most
        self.known: dict[str, int] = {}
        self.passing: list[str] = []
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """Where the pieces are in ``starts``; valid until the next call."""
        if self.passing:
            for p in self.passing:
                del self.known[p]
            self.starts = self.starts[:len(self.known) + 1]
            self.ids, self.passing = self.ids[:self.starts[-1]], []
        new = [p for p in pieces if p not in self.known]
        if new:
            if len(self.known) + len(new) > self.most:
                self.passing = new
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            ids, starts = self.encoder.encode_pieces(new)
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.known.__getitem__, pieces), dtype=np.int64, count=len(pieces))


def worker_cache(path: str, most: int) -> PieceCache:
    """The cache of this Python worker, which Spark reuses for further tasks.

    Functions reach the workers by value, so a global of this module would last for one task.
    """
    kept = sys.modules.setdefault("_sluice_worker", types.ModuleType("_sluice_worker")).__dict__
    if (path, most) not in kept:
        kept[path, most] = PieceCache(PieceEncoder(path), most)
    return kept[path, most]


def forget(path: str, most: int) -> None:
    """Drop this worker's cache."""
    sys.modules.get("_sluice_worker", types.ModuleType("")).__dict__.pop((path, most), None)


def slices(texts: pa.Array, most_bytes: int = 2 << 20):
    """Parts of the texts of at most so many bytes, or of one text."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most_bytes, "right")))
        yield a, texts.slice(a, b - a)
        a = b


class SpaceSplitEncoder:
    """Ids of whole texts under a tokenizer that drops white space, such as the word BPE."""

    def __init__(self, path: str, most: int = 700_000):
        self.cache = worker_cache(path, most)

    def __call__(self, texts: pa.Array):
        """Yields an array of ids for each text, in order; null counts as empty."""
        for _, part in slices(texts.fill_null("").cast(pa.large_string())):
            lists = pc.ascii_split_whitespace(part)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten().dictionary_encode()
            number = self.cache.numbers(flat.dictionary.to_pylist())
            words = number[flat.indices.to_numpy(zero_copy_only=False)]
            ids = spread(self.cache.ids, self.cache.starts, words)
            ends = np.concatenate([[0], np.cumsum(np.diff(self.cache.starts)[words])])[bounds]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                yield ids[a:b]


def count_tokens(cache: PieceCache, texts: pa.Array) -> np.ndarray:
    """Numbers of tokens of whole texts under a tokenizer that joins one space to the next word.

    A text is cut before each of its spaces, so that all its pieces but the first begin
    with one. A text in which a space stands beside other white space is encoded whole.
    """
    counts = np.zeros(len(texts), dtype=np.int64)
    for at, part in slices(texts.fill_null("").cast(pa.large_string())):
        crowded = pc.match_substring_regex(part, CROWDED_SPACE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(crowded):
            counts[at + i] = len(cache.encoder.encode(part[i].as_py()))
        rest = np.flatnonzero(~crowded)
        if not len(rest):
            continue
        lists = pc.split_pattern(part.take(pa.array(rest)), " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten().dictionary_encode()
        index, words = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()
        number = cache.numbers([f" {w}" for w in words])
        sizes = np.diff(cache.starts)[number][index]
        used, where = np.unique(index[bounds[:-1]], return_inverse=True)
        number = cache.numbers([words[i] for i in used])
        sizes[bounds[:-1]] = np.diff(cache.starts)[number][where]
        total = np.concatenate([[0], np.cumsum(sizes)])
        counts[at + rest] = total[bounds[1:]] - total[bounds[:-1]]
    return counts

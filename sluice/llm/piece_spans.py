"""Encoding with a sentencepiece model that keeps every piece's place in the original text.

A text is normalised through the model's compiled character map: at each place the longest key of
the map's trie is replaced by its value, and every byte of the result remembers the source byte that
it came from. The library then only merges the normalised text (it loads the model with its
normaliser switched off), and each piece's bytes are projected through the alignment to a
span of the original bytes. Decoding reads the pieces' bytes from one table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.tokens import slices, spread
from sluice.llm.worker import releasing

#: Field numbers of the model file, the kinds of piece and the sign for a space.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_KIND = 1, 3
MODEL_TYPE, BPE, SPACE_AS_SUFFIX = 3, 2, 24
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"

#: Segments that a task remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 150_000, 48
SPANS = "ids array<int>, begins array<int>, ends array<int>, decoded string"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message's fields, in order."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys, followed by the replacements.

    A trie unit holds its label in the low byte, whether a key ends there in bit 8, and the
    offset to its children above; a leaf holds the place of a replacement, which a zero ends.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.values = compiled[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``at`` and what replaces it."""
        units, found = self.units, None
        node = _children(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= _children(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.values[found[1]:self.values.index(b"\0", found[1])]


def _children(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalizer:
    """Source text to normalised bytes and, for each of them and the end, its source byte."""

    def __init__(self, spec: dict[int, int | bytes], symbols: list[str], suffix: bool):
        self.map = CharacterMap(spec.get(CHARSMAP, b""))
        # The three switches are on where the file leaves them out.
        self.dummy, self.trim, self.escape = (
            bool(spec.get(k, 1)) for k in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES)
        )
        self.suffix = suffix
        longest_first = sorted(symbols, key=len, reverse=True)
        self.symbols = re.compile("|".join(map(re.escape, longest_first)).encode()) if symbols else None

    def _prefix(self, text: bytes, at: int) -> tuple[int, bytes]:
        if self.symbols and (kept := self.symbols.match(text, at)):
            return len(kept[0]), kept[0]
        if self.map.units and (found := self.map.longest(text, at)):
            return found
        end = at + 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        return end - at, text[at:end]

    def __call__(self, text: bytes, dummy: bool | None = None) -> tuple[bytes, list[int]]:
        """``dummy`` overrides whether a space is put before (or after) the text."""
        dummy = self.dummy if dummy is None else dummy
        space = SPACE.encode() if self.escape else b" "
        out, align, at = bytearray(), [], 0
        if not text:
            return b"", [0]
        if self.trim:
            while at < len(text) and (p := self._prefix(text, at))[1] == b" ":
                at += p[0]
            if at == len(text):
                return b"", [0]
        if dummy and not self.suffix:
            out += space
            align += [at] * len(space)
        after_space = self.trim
        while at < len(text):
            length, piece = self._prefix(text, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                after_space = self.trim and piece.endswith(b" ")
                piece = piece.replace(b" ", space)
                out += piece
                align += [at] * len(piece)
            at += length
        if self.trim:
            while out.endswith(space):
                at = align[len(out) - len(space)]
                del out[-len(space):], align[-len(space):]
        if dummy and self.suffix:
            out += space
            align += [at] * len(space)
        return bytes(out), [*align, at]


    def many(self, texts: list[str], dummy: bool) -> tuple[list[str], np.ndarray]:
        """The normalised texts, and all their alignments one after another."""
        if self.map.units or self.trim or self.symbols or dummy or not self.escape:
            found = [self(t.encode(), dummy) for t in texts]
            return [n.decode() for n, _ in found], np.fromiter((a for _, x in found for a in x), np.int32)
        # An empty map leaves all but spaces as it is: each text's bytes and one more for its end.
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        source = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        aligned = np.repeat(source, np.where(data == 32, len(SPACE.encode()), 1)).astype(np.int32)
        return [t.replace(" ", SPACE) for t in texts], aligned


class SpanEncoder:
    """One model's normaliser, merges and decoding table, with a memory for repeated segments."""

    def __init__(self, model: bytes):
        import sentencepiece

        every = list(message_fields(model))
        pieces = [dict(message_fields(v)) for k, v in every if k == PIECES]
        spec = {k: v for f, m in every if f == NORMALIZER for k, v in message_fields(m)}
        trainer = {k: v for f, m in every if f == TRAINER for k, v in message_fields(m)}
        texts = [p.get(PIECE_TEXT, b"").decode() for p in pieces]
        kinds = np.array([p.get(PIECE_KIND, NORMAL) for p in pieces])
        symbols = [t for t, k in zip(texts, kinds, strict=True) if k == USER_DEFINED]
        self.normalizer = Normalizer(spec, symbols, bool(trainer.get(SPACE_AS_SUFFIX, 0)))
        if (kinds == BYTE).sum() != 256:
            raise ValueError("the model has no piece for every byte")
        # A repeated message field is merged, so this switches the normaliser off.
        off = bytes(x for k in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES) for x in (k << 3, 0))
        off = bytes([CHARSMAP << 3 | 2, 0]) + off
        self.merges = sentencepiece.SentencePieceProcessor(
            model_proto=model + bytes([NORMALIZER << 3 | 2, len(off)]) + off)
        self.end_id = self.merges.eos_id()
        self.byte_of = np.full(len(pieces), -1)
        self.byte_of[kinds == BYTE] = [int(texts[i][3:5], 16) for i in np.flatnonzero(kinds == BYTE)]
        self.sizes = np.array([len(t.encode()) for t in texts])
        shown = [
            bytes([self.byte_of[i]]) if k == BYTE else b"" if k == CONTROL
            else t.replace(SPACE, " ").encode()
            for i, (t, k) in enumerate(zip(texts, kinds, strict=True))
        ]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_starts = np.concatenate([[0], np.cumsum([len(s) for s in shown])])
        self.leading_space = np.array([t.startswith(SPACE) for t in texts])
        self.control = kinds == CONTROL
        # Text may be cut before a space after another character if no piece, and so no merge, spans it.
        self.separable = (
            not self.normalizer.map.units and not self.normalizer.trim and self.normalizer.escape
            and self.normalizer.dummy and not self.normalizer.suffix and not symbols
            and trainer.get(MODEL_TYPE, 1) == BPE and not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in texts)
        )
        self.known: dict[str, int] = {}
        self.passing: list[str] = []
        self.starts = np.zeros(1, np.int64)
        self.ids, self.begins, self.ends = (np.zeros(0, np.int32) for _ in range(3))

    def project(self, texts: list[str], dummy: bool) -> tuple[np.ndarray, ...]:
        """ids, begins and ends of all texts one after another (places within their text), and how many each has."""
        normal, aligned = self.normalizer.many(texts, dummy)
        found = self.merges.encode(normal, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.int32, int(counts.sum()))
        # A character that falls back to bytes is the span of its last byte; the others' are empty.
        byte, sizes = self.byte_of[ids], self.sizes[ids]
        spelled = np.flatnonzero(byte >= 0)
        lead = np.maximum.accumulate(np.where((byte & 0xC0 == 0x80) & (byte >= 0), 0, np.arange(len(ids))))
        width = np.select([byte < 0x80, byte < 0xE0, byte < 0xF0], [1, 2, 3], 4)[lead]
        place = np.arange(len(ids)) - lead + 1
        sizes[spelled] = np.where(place == width, width, 0)[spelled]
        to = np.cumsum(sizes)
        segment = np.repeat(np.arange(len(texts)), counts)
        return ids, aligned[to - sizes + segment], aligned[to + segment], counts

    def numbers(self, segments: list[str]) -> np.ndarray:
        """Where the segments are in ``starts``; valid until the next call."""
        if self.passing:
            for s in self.passing:
                del self.known[s]
            self.starts = self.starts[:len(self.known) + 1]
            keep, self.passing = self.starts[-1], []
            self.ids, self.begins, self.ends = self.ids[:keep], self.begins[:keep], self.ends[:keep]
        new = sorted((s for s in segments if s not in self.known), key=len)
        if new:
            room = max(0, REMEMBERED - len(self.known))
            keep = min(room, int(np.searchsorted([len(s) for s in new], LONGEST, "right")))
            self.passing = new[keep:]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            ids, begins, ends, counts = self.project(new, False)
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.ids = np.concatenate([self.ids, ids])
            self.begins, self.ends = np.concatenate([self.begins, begins]), np.concatenate([self.ends, ends])
        return np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))

    def _segments(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct segments of the texts with a space before, each segment's number, segments per text."""
        words = pc.split_pattern(texts, " ")
        counts = np.diff(words.offsets.to_numpy())
        flat = words.flatten().dictionary_encode()
        distinct = [f" {w}" for w in flat.dictionary.to_pylist()]
        index = flat.indices.to_numpy(zero_copy_only=False)
        crowded = pc.match_substring_regex(texts, rf"\A |  |{SPACE}")
        odd = np.flatnonzero(crowded.to_numpy(zero_copy_only=False))
        if not len(odd):
            return distinct, index, counts
        number = {s: i for i, s in enumerate(distinct)}
        runs, bounds = [], np.concatenate([[0], np.cumsum(counts)])
        last = 0
        for i in odd:
            found = re.findall(f"[ {SPACE}]+[^ {SPACE}]*", f" {texts[i].as_py()}")
            runs += [index[bounds[last]:bounds[i]], np.array([number.setdefault(s, len(number)) for s in found])]
            counts[i], last = len(found), i + 1
        return list(number), np.concatenate([*runs, index[bounds[last]:]]), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """ids, begins, ends of all texts with an end id each, and how many ids each text has."""
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        if self.separable:
            distinct, index, per_text = self._segments(texts)
            used, index = np.unique(index, return_inverse=True)
            distinct = [distinct[i] for i in used]
            number = self.numbers(distinct)[index]
            counts = np.diff(self.starts)[number]
            text = np.repeat(np.arange(len(texts)), per_text)
            length = np.array([len(s.encode()) for s in distinct])[index]
            at = np.cumsum(length) - length
            at -= (np.cumsum(size + 1) - size - 1)[text] + 1  # within the text, without the space before it
            each = np.repeat(at, counts)
            ids = spread(self.ids, self.starts, number)
            begins = np.maximum(spread(self.begins, self.starts, number) + each, 0)
            ends = np.maximum(spread(self.ends, self.starts, number) + each, 0)
            counts = np.bincount(text, counts, len(texts)).astype(np.int64)
            # An empty text gets no space before it.
            filled = np.repeat(size > 0, counts)
            ids, begins, ends = ids[filled], begins[filled], ends[filled]
            counts[size == 0] = 0
        else:
            ids, begins, ends, counts = self.project(texts.to_pylist(), self.normalizer.dummy)
        final = np.cumsum(counts)
        return (
            np.insert(ids, final, self.end_id).astype(np.int32), np.insert(begins, final, size).astype(np.int32),
            np.insert(ends, final, size).astype(np.int32), counts + 1,
        )

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of so many ids each, in UTF-8; bytes that form no character become U+FFFD one by one.

        The first space goes where the normaliser adds one. Control ids show nothing.
        """
        text = np.repeat(np.arange(len(counts)), counts)
        shown = ~self.control[ids]
        ids, text = ids[shown], text[shown]
        # Bytes on both sides of a control id belong to no common character.
        parted = np.flatnonzero(np.diff(np.flatnonzero(shown)) > 1) + 1
        parted = parted[(self.byte_of[ids[parted]] >= 0) & (self.byte_of[ids[parted - 1]] >= 0)]
        lengths = np.diff(self.shown_starts)[ids]
        starts = self.shown_starts[:-1][ids].copy()
        bounds = np.searchsorted(text, np.arange(len(counts) + 1))
        if self.normalizer.dummy or self.normalizer.trim:
            firsts = bounds[:-1][np.diff(bounds) > 0]
            firsts = firsts[self.leading_space[ids[firsts]]]
            starts[firsts] += 1
            lengths[firsts] -= 1
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.shown[np.repeat(starts - total[:-1], lengths) + np.arange(total[-1])].tobytes()
        at = np.union1d(bounds, parted)
        whole = [b""] * len(counts)
        for a, b in zip(at[:-1], at[1:], strict=True):
            whole[text[a]] += _characters(data[total[a]:total[b]])
        return whole


def _characters(data: bytes) -> bytes:
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        return re.sub(
            rb"[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}|.",
            lambda m: m[0].decode("utf-8", "ignore").encode() or "�".encode() * len(m[0]), data, flags=re.DOTALL,
        )


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, begins, ends and decoded, one row per input row.

    ``ids`` are the library's, then the end id; ``begins`` and ``ends`` are the bytes of the original text
    (UTF-8) that a piece stands for. Pieces of one character spelled in bytes have an empty
    span, its last one the character's; a space that only the normaliser adds takes no
    bytes; the end id lies behind the text. A null or empty text has the end id only and decodes to the
    empty text. Repeated rows each keep their row, null ids stay null, an empty table gives no
    rows, and other columns are not read. Long texts are encoded whole.
    """
    model = docs.sparkSession.sparkContext.broadcast(_read(model_path))  # one file, half a megabyte here

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or SpanEncoder(model.value)
            for at, part in slices(batch.column(1).fill_null("").cast(pa.large_string())):
                ids, begins, ends, counts = encoder.encode(part)
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (ids, begins, ends)]
                decoded = pa.array(encoder.decode(ids, counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), *lists, decoded],
                    names=["doc_id", "ids", "begins", "ends", "decoded"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(releasing(encode), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SPANS}")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()

"""Encoding with spans against the library: ids, offsets, decoding, and its compiled character maps."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import SparkSession

from sluice.llm.piece_spans import Normalizer, SpanEncoder, encoded, message_fields
from sluice.llm.queries import op11_piece_spans

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    *"abcdefgh ABC  \n\t▁éÀß中文\U0001f9e1　́\x00", "<0x0A>", "</s>", " the", " of", "ing", "  ",
]
NORMALISED = [*"ｱｲﬁﬀ①㌀가각ḀÅＡ̀​\xa0ﷺ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as file:
        return SpanEncoder(file.read())


def drawn(signs: list[str], n: int, longest: int) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def check_texts(encoder, library, texts):
    ids, begins, ends, counts = encoder.encode(pa.array(texts, pa.large_string()))
    decoded, at = encoder.decode(ids, counts), 0
    for text, n, back in zip(texts, counts, decoded, strict=True):
        expected = library.encode(text)
        assert ids[at:at + n].tolist() == [*expected, library.eos_id()]
        pieces = library.encode(text, return_type="proto").pieces
        size = len(text.encode())
        assert list(zip(begins[at:at + n].tolist(), ends[at:at + n].tolist(), strict=True)) == [
            *((p.begin, p.end) for p in pieces), (size, size)]
        assert back.decode() == library.decode(expected)
        at += n


def test_encoding_equals_the_library(encoder, library):
    check_texts(encoder, library, [*drawn(SIGNS, 1500, 40), "", " ", "  ", "a", "</s>", "<s> x </s>", "▁", "▁▁ x "])


def test_whole_texts_equal_segments(encoder, library):
    """The way for models whose texts cannot be cut."""
    whole = SpanEncoder(open(MODEL, "rb").read())
    whole.separable = False
    check_texts(whole, library, drawn(SIGNS, 500, 40))


def test_very_long_texts(encoder, library):
    words = ["".join(random.Random(i).choices("abcdefgé", k=8)) for i in range(20_000)]
    check_texts(encoder, library, [" ".join(words), "x" * 50_000, " " * 5_000, "中" * 20_000])


def test_segments_beyond_the_memory(encoder, library, monkeypatch):
    monkeypatch.setattr("sluice.llm.piece_spans.REMEMBERED", 50)
    small = SpanEncoder(open(MODEL, "rb").read())
    for texts in (drawn(SIGNS, 200, 30), drawn(SIGNS, 300, 20)):
        check_texts(small, library, texts)
    assert len(small.known) - len(small.passing) <= 50


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
def test_compiled_maps_equal_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = library.serialized_model_proto()
    spec = {k: v for f, m in message_fields(proto) if f == 3 for k, v in message_fields(m)}
    normalize = Normalizer(spec, [], False)
    for text in drawn([s for s in SIGNS if s != "\x00"] + NORMALISED, 1000, 30):
        expected, offsets = library.normalize(text, with_offsets=True)
        out, align = normalize(text.encode())
        assert out.decode() == expected
        source, places = [0], [0]
        for c in text:
            source.append(source[-1] + len(c.encode()))
        for c in expected:
            places.append(places[-1] + len(c.encode()))
        assert [source[x] for x in offsets] == [align[p] for p in places]


def test_symbols_are_not_normalised():
    proto = sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto()
    spec = {k: v for f, m in message_fields(proto) if f == 3 for k, v in message_fields(m)}
    out, align = Normalizer(spec, ["ﬁ"], False)("ﬀﬁ".encode())
    assert out.decode() == "▁ffﬁ" and align == [0, 0, 0, 0, 0, 3, 3, 3, 6]


def test_decoding_of_any_ids_equals_the_library(encoder, library):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [
            rng.choice([rng.randint(3, 258), rng.randint(3, 258), rng.randint(0, 31999), rng.choice([29871, 1, 2])])
            for _ in range(rng.randint(0, 6))
        ]
        found = encoder.decode(np.array(ids, np.int64), np.array([len(ids)]))[0].decode()
        assert found == library.decode(ids)


def test_rows_nulls_and_other_columns(spark: SparkSession, library):
    rows = [(1, "a b", 5), (1, "a b", 5), (2, None, 6), (None, "", 7), (3, "é\n", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    found = sorted(encoded(docs, MODEL).collect(), key=lambda r: (r.doc_id or 0, r.decoded))
    assert [r.doc_id for r in found] == [None, 1, 1, 2, 3]
    assert [r.decoded for r in found] == ["", "a b", "a b", "", "é\n"]
    assert found[0].ids == found[3].ids == [2] and found[0].ends == [0]
    assert found[1].ids == [*library.encode("a b"), 2]
    last = found[4]
    spans = [(b, e) for b, e in zip(last.begins, last.ends, strict=True) if e > b]
    assert spans[0][0] == 0 and spans[-1][1] == 3
    assert encoded(docs.limit(0), MODEL).count() == 0


def test_query_equals_the_library(spark: SparkSession, sf_dir: str, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in op11_piece_spans(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = [*library.encode(d.text or ""), library.eos_id()]
        row = found[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()

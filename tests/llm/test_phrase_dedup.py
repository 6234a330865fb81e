from __future__ import annotations

import random

from sluice.llm import phrase_dedup
from sluice.llm.phrase_dedup import without_repeats

SCHEMA = "doc_id long, text string, starts string, copy int"


def plain(rows: list[tuple], span: int) -> list[tuple]:
    seen, out = {}, []
    for doc, text in sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - span + 1):
            if seen.setdefault(tuple(words[s:s + span]), (doc, s)) != (doc, s):
                gone[s:s + span] = [True] * span
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out += [(doc, len(words), sum(gone), kept)] * sum(r[:2] == (doc, text) for r in rows)
    return sorted(out, key=str)


def corpus() -> list[tuple]:
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["Été", "the", "The", "\u00a0x"]
    passages = [[draw.choice(words) for _ in range(n)] for n in (20, 25, 60)]
    rows = []
    for i in range(60):
        text = [draw.choice(words) for _ in range(draw.choice([0, 5, 40, 120]))]
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(text) + 1)
            text[at:at] = draw.choice(passages)
        rows.append((i, draw.choice([" ", "\n", " \t"]).join(text), "s", 1))
    rows += [(60, rows[7][1], "s", 1), (61, rows[7][1], "s", 1), (62, "a b " * 200, "s", 1), (63, "the " * 100, "s", 1)]
    return [*rows, (64, None, "s", 1), (65, "", "s", 1), (None, rows[9][1], "s", 1), (7, rows[7][1], "s", 1)]


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    expected = plain(rows, 20)
    assert sum(r[2] for r in expected) > 1000
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, without_repeats(docs).collect()), key=str) == expected
    # Many shards, salted, and no filter.
    monkeypatch.setattr(phrase_dedup, "SHARD_PHRASES", 7)
    monkeypatch.setattr(phrase_dedup, "SHARD_SEGMENTS", 3)
    monkeypatch.setattr(phrase_dedup, "MAX_FILTER_BYTES", 0)
    assert sorted(map(tuple, without_repeats(docs).collect()), key=str) == expected


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []

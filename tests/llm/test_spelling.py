"""Spelling variants against all pairs, and the edit-matrix rows against the whole matrix."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import SparkSession

from sluice.llm.queries import op13_spelling
from sluice.llm.spelling import _letters, chain_ends, grouped_spellings, near_pairs, spelling_groups

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a: str, b: str) -> bool:
    """By deleting and replacing each place of the longer word."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def vocabulary(rows) -> dict[str, int]:
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_force(n: dict[str, int]) -> list[tuple]:
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {
        w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if v != w and one_edit(w, v)] for w in n
    }
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    found = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(found)


def result(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


def drawn(n: int, letters: str, seed: int = 5) -> dict[str, int]:
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(n)}
    for w in sorted(words)[:n // 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]}
    return {w: rng.choice([3, 4, 7, 20, 300]) for w in words if len(w) >= 5}


def test_rows_of_the_matrix_find_every_pair():
    """One list whose words share nothing, against all pairs."""
    words = sorted(w for w in drawn(150, "abé") if len(w) in (6, 7))
    letters = _letters(words, 7)
    zeros = np.zeros(len(words), int)
    found = {
        (words[q], words[w]) for qs, ws in near_pairs(letters, letters, zeros, zeros, 0)
        for q, w in zip(qs, ws, strict=True)
    }
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize("block", [7, 20_000])
def test_groups_equal_brute_force(spark: SparkSession, block: int):
    n = drawn(60, "abÿ") | drawn(60, "abcdefghijklmnop")
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert result(grouped_spellings(words, block=block)) == brute_force(n)


def test_chains_of_any_length(spark: SparkSession):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(40)], "word string, form string")
    assert {r.root for r in chain_ends(forms).collect()} == {"w040"}


def test_texts_with_nulls_case_and_damage(spark: SparkSession):
    rows = [(None, None), (1, ""), (2, "Étude étude ÉTUDE"), (3, "x" * 30_000)]
    rows += [(i, "Horse house mouse HOUSE! houses; horses_9 rouse étude études×") for i in range(2500)] + [(5, "house")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word")
    expected = brute_force(vocabulary([(k, t) for k, t in rows]))
    assert len(expected) > 8
    assert result(spelling_groups(docs)) == expected
    assert result(spelling_groups(docs.limit(0))) == []


def test_query_equals_brute_force(spark: SparkSession, sf_dir: str):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert result(op13_spelling(spark, sf_dir)) == brute_force(vocabulary([tuple(r) for r in docs]))

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sluice.llm.prefix_forest import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score string"
def asks():
    return F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False))


def plain(rows: list[tuple], count: int) -> dict[int, list[tuple]]:
    fine = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, v in fine:
        if q % 20 == 0:
            scored = [(-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in fine if i != q and len(w) == len(v)]
            out[q] = [(i, round(-s, 9)) for s, i in sorted(scored)[:count]]
    return out


def found(df) -> dict[int, list[tuple]]:
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_ties_copies_and_unusable_vectors(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.integers(-3, 4, 4).astype(float).tolist(), 1, "x") for i in range(150)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0], 1, "x") for i in range(200, 290)]
    rows += [(300, None, 1, "x"), (320, [0.0] * 4, 1, "x"), (340, [1.0, None, 0.0, 0.0], 1, "x"), (360, [float("nan")] * 4, 1, "x"),
             (380, [float("inf"), 0.0, 0.0, 0.0], 1, "x"), (None, [1.0] * 4, 1, "x"), (400, [9.0, 9.0], 1, "x"), (5, rows[5][1], 1, "x"),
             (420, [], 1, "x"), (440, [2.0, 4.0, 0.0, 2.0], 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {q: x for q, x in plain(rows, 7).items() if x}
    assert found(nearest(df, asks(), count=7)) == expected
    assert found(nearest(df, asks(), count=7, shard_rows=60, block_queries=3)) == expected


def test_empty_table(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), asks()).collect() == []


def test_recall_when_only_a_share_is_read(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    answers = found(nearest(table, asks(), share=0.6, least=10))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        scores[q] = -9
        best = {int(ids[i]) for i in np.argsort(-scores)[:20]}
        hits += len(best & {i for i, _ in answers[int(ids[q])]})
        total += 20
    assert hits / total >= 0.9

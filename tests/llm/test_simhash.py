from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from sluice.llm.components import roots
from sluice.llm import simhash
from sluice.llm.simhash import (
    LISTED, close_pairs, drop_near_duplicates, forest, near_links, near_trees, random_bands, similar_groups,
    simhash_components, thirds, tree_keys,
)
from sluice.llm.similar_sets import bucket_links, parity, sketch, sketches, undecided

SCHEMA = "doc_id long, text string, row long, fp int"


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    size = min(size, len(words))
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple]) -> list[tuple]:
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None)
             for g in set(group)}
    return [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group, strict=True)]


def texts(count: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "the", "A b", "x\ty"]
    rows = []
    for i in range(count):
        if rows and draw.random() < 0.5:
            t = (draw.choice(rows)[1] or "").split(" ")
            t[draw.randrange(len(t))] = draw.choice(words)
            rows.append((i, " ".join(t), i, i))
        else:
            rows.append((i, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 3, 8, 300]))), i, i))
    return rows


def test_components_equal_brute_force(spark):
    rows = texts(150, 1) + [(900, None, 0, 0), (901, "", 0, 0), (None, "w1 w2 w3", 0, 0), (3, "w1 w2", 0, 0), (3, "w1 w2", 0, 0)]
    found = simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_components(rows), key=str)


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], SCHEMA)).collect() == []
    assert drop_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(("width", "radius"), [(1, 2), (1, 0), (6, 58)])
def test_close_pairs(width, radius):
    draw = np.random.default_rng(radius)
    base = draw.integers(0, 256, (30, 8 * width), dtype=np.uint8)
    fps = base[draw.integers(0, 30, 500)]
    for i in range(500):
        for b in draw.integers(0, 64 * width, draw.integers(0, radius + 3)):
            fps[i, b // 8] ^= np.uint8(1 << (b % 8))
    ends = np.repeat([1, 3, 70, 200, 500], [1, 2, 67, 130, 300])
    bits = np.unpackbits(fps, axis=1)
    expected = {(i, j) for i in range(500) for j in range(i + 1, ends[i]) if (bits[i] != bits[j]).sum() <= radius}
    found = []
    for a, b, distance in close_pairs(fps, ends, radius):
        assert (distance == (bits[a] != bits[b]).sum(axis=1)).all()
        found += zip(a.tolist(), b.tolist(), strict=True)
    assert len(found) == len(set(found)) and set(found) == expected
    a, b = forest(500, close_pairs(fps, ends, radius))
    # Of the same weight as a forest grown pair by pair, closest first.
    group, weight = list(range(500)), 0
    for i, j in sorted(expected, key=lambda p: (bits[p[0]] != bits[p[1]]).sum()):
        if group[i] != group[j]:
            weight += (bits[i] != bits[j]).sum()
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    assert (bits[a] != bits[b]).sum() == weight
    assert len(a) < 500 and set(zip(a.tolist(), b.tolist(), strict=True)) <= expected


def test_blocks_of_a_large_bucket_lose_no_link(spark):
    nodes = [(i, (i * 0x10001 % 4096).to_bytes(8, "little")) for i in range(600)]
    df = spark.createDataFrame([(n, bytearray(f)) for n, f in nodes], "node long, fp binary")
    whole = {tuple(r) for r in roots(near_links(df, thirds(), 2)).collect()}
    split = {tuple(r) for r in roots(near_links(df, thirds(), 2, block=50)).collect()}
    assert whole == split and whole


def test_roots_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(150, 99), (7, 7)]
    found = {r.node: r.root for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 99 for i in range(100, 160)}}


def test_similarity_decides_over_whole_texts(spark):
    """Pairs on both sides of 0.8: 5 shingles change with each word apart."""
    draw, rows = random.Random(12), []
    for i in range(40):
        base = [f"u{draw.randrange(10**6)}" for _ in range(304)]
        other, changed = list(base), [6, 5, 9, 8][i % 4]
        for k in range(changed):
            other[10 + k * 30] = f"c{i}_{k}"
        rows += [(2 * i, " ".join(base), 0, 0), (2 * i + 1, " ".join(other), 0, 0)]
    kept = {r.doc_id for r in drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(40):
        same = 300 - 5 * [6, 5, 9, 8][i % 4]
        assert (2 * i + 1 in kept) == (same / (600 - same) < 0.8) and 2 * i in kept


def test_one_of_each_group_stays(spark):
    draw = random.Random(5)
    words = [f"v{i}" for i in range(3000)]
    base = [draw.choice(words) for _ in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    other = [draw.choice(words) for _ in range(300)]
    rows = [(5, " ".join(near), 1, 1), (2, " ".join(base), 2, 2), (9, " ".join(base), 3, 3), (9, " ".join(base), 3, 3),
            (7, " ".join(other), 4, 4), (None, None, 5, 5), (11, "", 6, 6)]
    kept = drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "row", "fp"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 11]


def joined_groups(rows: list[tuple], size: int = 5) -> set[int]:
    """The smallest id of each component of pairs of similarity 0.8 or more, pair by pair."""
    words = {r[0]: (r[1] or "").lower().split() for r in rows}
    sets = {i: {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set() for i, w in words.items()}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and group[a] != group[b] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    return set(group.values())


def kept_ids(spark, rows: list[tuple]) -> list[int]:
    return sorted(r.doc_id for r in drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())


def test_failed_links_displace_no_similar_pair(spark):
    """Variants of one text with similarities on both sides of 0.8."""
    draw = random.Random(31)
    base, rows = [f"u{i}" for i in range(304)], []
    for i in range(150):
        text = list(base)
        for k in draw.sample(range(0, 304, 4), draw.randrange(3, 14)):
            text[k] = f"c{draw.randrange(3)}_{k}"
        rows.append((i, " ".join(text), 0, 0))
    expected = joined_groups(rows)
    assert 1 < len(expected) < 150
    assert kept_ids(spark, rows) == sorted(expected)


def test_repeated_lines_count_once(spark):
    draw, rows = random.Random(32), []
    for i in range(0, 20, 2):  # one line five times more: the same set but for its seams
        text = [f"u{draw.randrange(10**6)}" for _ in range(200)]
        rows += [(i, " ".join(text), 0, 0), (i + 1, " ".join(text + text[40:52] * 5), 0, 0)]
    line = [f"line{k}" for k in range(7)] * 50
    for i in range(20, 40):  # hardly alike but for one line 50 times
        rows.append((i, " ".join([f"u{draw.randrange(10**6)}" for _ in range(100)] + line), 0, 0))
    expected = joined_groups(rows)
    assert expected == {*range(0, 20, 2), *range(20, 40)}
    assert kept_ids(spark, rows) == sorted(expected)


def test_short_texts_of_similarity_are_all_found(spark):
    draw, rows = random.Random(33), []
    for i in range(0, 400, 2):
        text = [f"u{draw.randrange(10**6)}" for _ in range(8 + i % 3)]
        rows += [(i, " ".join(text), 0, 0), (i + 1, " ".join([*text, f"u{draw.randrange(10**6)}"]), 0, 0)]
    expected = joined_groups(rows)
    assert len(expected) == 200
    assert kept_ids(spark, rows) == sorted(expected)


def test_a_large_bucket_is_compared_to_its_end(spark):
    """Texts that share one rare shingle each hold their pair far behind in the bucket."""
    draw, rows = random.Random(34), []
    for i in range(0, 120, 2):
        text = [f"line{k}" for k in range(30)] + [f"u{draw.randrange(10**6)}" for _ in range(60)]
        rows += [(i, " ".join(text), 0, 0), (i + 1, " ".join(text[:-1] + ["other"]), 0, 0)]
    assert kept_ids(spark, rows) == sorted(joined_groups(rows)) == list(range(0, 120, 2))


def test_unlike_sets_of_a_bucket_make_no_row(spark):
    """One large bucket of texts that share a shingle and little else, with one similar pair at its end."""
    draw = np.random.default_rng(35)
    own = [np.unique(draw.integers(0, 2**40, 200, dtype=np.uint64)) for _ in range(299)]
    own.append(np.unique(np.append(own[298][1:], np.uint64(7))))
    rows = [(1, i, 200, i, bytearray(parity(x))) for i, x in enumerate(own)]
    rows += [(2, 500, 200, 500, rows[0][4]), (2, 501, 300, 501, rows[0][4]), (3, 502, 200, 9, rows[0][4]), (3, 503, 200, 9, rows[0][4])]
    buckets = spark.createDataFrame(rows, "key long, node long, n long, root long, parity binary")
    left = undecided(buckets, 0.8)  # the second bucket's sizes do not fit, the third has one root
    assert sorted(r.node for r in left.collect()) == list(range(300))
    found = bucket_links(left.join(buckets.select("node", "parity"), "node"), 0.8, 299).collect()
    assert [(r.a, r.b) for r in found] == [(298, 299)]
    # With fewer first sets the others stay, in proportion to the bucket.
    found = bucket_links(left.join(buckets.select("node", "parity"), "node"), 0.8, 4).collect()
    assert sorted(r.a for r in found) == list(range(4, 300)) and all(r.b is None for r in found)


def test_undecided_rows_have_a_partner(spark):
    """Small buckets over several batches, next to a comparison of all pairs."""
    draw = random.Random(36)
    rows = [(draw.randrange(60), i, draw.randrange(10, 40), draw.randrange(12)) for i in range(300)]
    expected = {
        b for k, b, n, r in rows
        if any(k == k2 and r != r2 and min(n, n2) >= 0.8 * max(n, n2) - 1e-6 for k2, _, n2, r2 in rows)
    }
    found = undecided(spark.createDataFrame(rows, "key long, node long, n long, root long"), 0.8).collect()
    assert sorted(r.node for r in found) == sorted(expected) and 0 < len(expected) < 300


def test_fingerprints_decide_which_pairs_are_checked(spark):
    """Similar texts are linked if their fingerprints are close, and by nothing else."""
    draw, rows = random.Random(37), []
    for i in range(0, 40, 2):
        text = [f"u{draw.randrange(10**6)}" for _ in range(100)]
        rows += [(i, " ".join(text), i, 0), (i + 1, " ".join([*text[:-1], "other"]), i + 1, 0)]
    df, bands = spark.createDataFrame(rows, SCHEMA).select("row", "doc_id", "text"), random_bands(384, 128, 12)

    def found(radius: int, bands: list) -> list:
        return sorted((r.doc_id, r.component_id) for r in similar_groups(df, 5, 6, bands, radius, 0.8).collect())

    prints = simhash.with_fingerprints(df, 5, 6).collect()
    ints = {r.doc_id: int.from_bytes(r.fp, "little") for r in prints}
    apart = {i: (ints[i] ^ ints[i + 1]).bit_count() for i in range(0, 40, 2)}
    middle = sorted(apart.values())[10]
    assert min(apart.values()) < middle and max(apart.values()) < 110
    assert found(110, bands) == [(i, i - i % 2) for i in range(40)]
    every = [[b] for b in range(2)] + bands
    assert found(middle - 1, every) == [(i, i - i % 2 if apart[i - i % 2] < middle else i) for i in range(40)]


def test_trees_hold_all_close_pairs_of_a_bucket(spark):
    """Any two close fingerprints of a band are in one tree, and equal trees of several bands have one key."""
    draw = np.random.default_rng(38)
    fps = draw.integers(0, 256, (40, 48), dtype=np.uint8)[np.arange(200) % 40]
    for i in range(200):
        for b in draw.integers(0, 384, 30):
            fps[i, b // 8] ^= np.uint8(1 << (b % 8))
    bits, bands = np.unpackbits(fps, axis=1, bitorder="little"), random_bands(384, 12, 8)
    df = spark.createDataFrame([(3 * i, bytearray(fps[i].tobytes())) for i in range(200)], "node long, fp binary")
    trees: dict[int, set] = {}
    for r in near_trees(df, bands, 70).collect():
        trees.setdefault(r.key, set()).update((r.a, r.b))
    expected = {
        (3 * i, 3 * j) for i in range(200) for j in range(i + 1, 200)
        if (bits[i] != bits[j]).sum() <= 70 and any((bits[i, b] == bits[j, b]).all() for b in bands)
    }
    assert len(expected) > 50
    assert all(any(i in t and j in t for t in trees.values()) for i, j in expected)
    assert len({frozenset(t) for t in trees.values()}) == len(trees)


def test_keys_of_trees():
    node = np.array([10, 11, 12, 13, 14, 15, 16])
    keys = tree_keys(node, np.array([5, 0, 1, 3]), np.array([6, 2, 5, 4])).tolist()  # 1-5-6, 0-2, 3-4
    assert keys[0] == keys[2] and len(set(keys)) == 3
    turned = tree_keys(node[::-1].copy(), np.array([0, 1]), np.array([5, 5]))  # 16, 15 and 11 again
    assert turned.tolist() == [keys[0]] * 2
    path = np.arange(5000)
    assert len(set(tree_keys(path, path[:-1][::-1], path[1:][::-1]).tolist())) == 1


def test_a_dense_bucket_is_listed_in_parts():
    n = 3000
    sizes = [len(a) for a, *_ in close_pairs(np.zeros((n, 48), np.uint8), np.full(n, n), 110)]
    assert sum(sizes) == n * (n - 1) // 2 and max(sizes) <= 64 * LISTED


def test_unlike_sets_with_close_fingerprints_make_no_row(spark):
    """A group of one fingerprint and sets half alike, with one similar pair: links of that pair alone, and of two roots alone."""
    draw = np.random.default_rng(39)
    own = [np.unique(np.append(np.arange(100, dtype=np.uint64) << np.uint64(30), draw.integers(0, 2**40, 50, dtype=np.uint64)))
           for _ in range(299)]
    own.append(np.unique(np.append(own[298][:-1], np.uint64(7))))
    rows = [(i, bytearray(48), bytearray(sketch(parity(x), len(x))), i) for i, x in enumerate(own)]
    nodes = spark.createDataFrame(rows, "node long, fp binary, sketch binary, root long")
    bands = random_bands(384, 3, 12)
    assert {(r.a, r.b) for r in near_trees(nodes, bands, 110, threshold=0.8).collect()} == {(298, 299)}
    assert near_trees(nodes, bands, 110).count() == 3 * 299
    joined = nodes.selectExpr("node", "fp", "sketch", "if(node = 299, 298, root) as root")
    assert near_trees(joined, bands, 110, threshold=0.8).count() == 0


def test_rows_without_a_partner_do_not_stay(spark):
    """Of a large bucket whose first rows are compared only those stay that may be similar to another one."""
    draw = np.random.default_rng(40)
    own = [np.unique(draw.integers(0, 2**40, 200, dtype=np.uint64)) for _ in range(299)]
    own.append(np.unique(np.append(own[298][1:], np.uint64(7))))
    rows = [(1, i, 200, i, bytearray(parity(x))) for i, x in enumerate(own)]
    buckets = spark.createDataFrame(rows, "key long, node long, n long, root long, parity binary")
    found = bucket_links(buckets, 0.8, 4, partners=True).collect()
    assert sorted((r.a, r.b) for r in found) == [(298, None), (299, None)]
    found = bucket_links(buckets.where("node >= 290"), 0.8, 4, partners=True).collect()
    assert [(r.a, r.b) for r in found] == [(298, 299)]


def test_sketches_bound_the_difference():
    draw = np.random.default_rng(41)
    for apart in (0, 1, 30, 400):
        a = np.unique(draw.integers(0, 2**40, 300, dtype=np.uint64))
        b = np.union1d(a[apart // 2:], draw.integers(0, 2**40, apart - apart // 2, dtype=np.uint64))
        raw = b"".join(sketch(parity(x), len(x)) for x in (a, b))
        short, n = sketches(np.frombuffer(raw, np.uint8).reshape(2, -1))
        assert n.tolist() == [len(a), len(b)]
        assert np.bitwise_count(short[0] ^ short[1]).sum() <= len(np.setxor1d(a, b))

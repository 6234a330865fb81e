"""Line dedup, decontamination and preference pairs against brute force on rows that tables lack."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

import check
from sluice.llm.decontaminate import contained_items, drop_contaminated
from sluice.llm.line_dedup import drop_repeated_chunks
from sluice.llm.oracles import ORACLES
from sluice.llm.preference import pairs_by_order, preference_rows

DOCS = "doc_id long, text string, row string, kept string, doc string"
ITEMS = "item_id long, text string"


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_query_equals_its_oracle(spark, sf_dir, name):
    assert check.compare(spark, sf_dir, name) is None


def test_only_dataframe_functions(spark, sf_dir):
    from sluice.llm.queries import QUERIES

    for name in ("op2_preference", "op9_decontamination", "op10_line_dedup"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan), name


# --- line dedup ------------------------------------------------------------------------------


def plain_lines(rows: list[tuple]) -> list[tuple]:
    seen, out = set(), []
    for doc, text in sorted((r[:2] for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None:
            out.append((doc, None))
            continue
        lines, kept, chunk, before = text.split("\n"), [], [], 0
        for i, line in enumerate(lines):
            h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
            chunk.append(line)
            if (before % 2**31 * 31 + h) % 2**31 % 4 == 0 or i == len(lines) - 1:
                body = "\n".join(chunk)
                if len(chunk) == 1 or not body.strip() or body not in seen:
                    kept += chunk
                if len(chunk) > 1:
                    seen.add(body)
                chunk = []
            before = h
        out.append((doc, "\n".join(kept)))
    return sorted(out, key=str)


def test_lines_equal_brute_force(spark):
    draw = random.Random(2)
    passages = ["\n".join(f"line {draw.randrange(40)}" for _ in range(n)) for n in (2, 4, 9, 15)]
    rows = []
    for i in range(80):
        parts = [draw.choice(passages) if draw.random() < 0.4 else f"own {draw.randrange(10**6)}" for _ in range(draw.randrange(9))]
        rows.append((i, "\n".join(parts), "r", "k", "d"))
    rows += [(100, None, "r", "k", "d"), (101, "", "r", "k", "d"), (102, "\n\n \n\n" * 9, "r", "k", "d"), (103, "\n\n \n\n" * 9, "r", "k", "d"),
             (104, rows[3][1], "r", "k", "d"), (None, rows[4][1], "r", "k", "d"), (105, "same\n" * 20_000, "r", "k", "d"), (106, "x\r\ny", "r", "k", "d")]
    docs = spark.createDataFrame(rows, DOCS)
    found = drop_repeated_chunks(docs)
    assert found.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == plain_lines(rows)


def test_an_inserted_line_moves_no_far_boundary(spark):
    lines = [f"sentence number {i}" for i in range(200)]
    rows = [(1, "\n".join(lines), "", "", ""), (2, "\n".join([*lines[:100], "new", *lines[100:]]), "", "", "")]
    second = drop_repeated_chunks(spark.createDataFrame(rows, DOCS)).where("doc_id = 2").first().text
    assert "new" in second and len(second.split("\n")) < 40


# --- decontamination ---------------------------------------------------------------------------


def shingles(text: str | None) -> set:
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_containment_equals_brute_force(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "the", "of"]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([3, 5, 6, 12, 40, 90])))) for i in range(40)]
    docs = []
    for i in range(120):
        text = [draw.choice(words) for _ in range(draw.choice([0, 4, 60, 800]))]
        for _ in range(2):
            part = draw.choice(items)[1].upper().split()
            for _ in range(draw.randrange(3)):
                part[draw.randrange(len(part))] = "changed"
            text[len(text) // 2:len(text) // 2] = part
        docs.append((i, ", ".join(text), "r", "k", "d"))
    items += [(90, None), (91, ""), (92, items[4][1]), (4, items[4][1]), (None, items[5][1])]
    docs += [(200, None, "", "", ""), (None, items[7][1], "", "", ""), (3, items[8][1], "", "", ""), (3, items[8][1], "", "", ""), (201, (items[3][1] + " ") * 5000, "", "", "")]
    expected = [
        (d[0], i, len(s), len(s & shingles(d[1]))) for d in docs for i, t in set(items)
        if (s := shingles(t)) and len(s & shingles(d[1])) * 5 >= 4 * len(s)
    ]
    table, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = [(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in contained_items(table, bench).collect()]
    assert len(expected) > 60 and sorted(set(found), key=str) == sorted(set(expected), key=str)
    clean = drop_contaminated(table, bench)
    assert clean.columns == table.columns
    bad = {(d, t) for d, t, *_ in docs if any((s := shingles(x)) and len(s & shingles(t)) * 5 >= 4 * len(s) for _, x in items)}
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted((d[:2] for d in docs if d[:2] not in bad), key=str)


def test_clashing_names_and_nulls_in_decontamination(spark):
    item = "one two three four five six"
    rows = [(1, f"a {item} b", 0, 0), (1, "other text", 0, 0), (None, item, 0, 0), (2, None, 0, 0), (2, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, contaminated_row int, Contaminated_Row_0 int")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "-") for r in kept.collect()) == [(1, "other text"), (2, "-"), (2, "-")]


def test_empty_tables(spark):
    none, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    one = spark.createDataFrame([(1, "x a b c d e f", "", "", "")], DOCS)
    assert contained_items(none, bench).collect() == [] and drop_contaminated(none, bench).collect() == []
    assert contained_items(one, bench.limit(0)).collect() == [] and drop_contaminated(one, bench.limit(0)).count() == 1
    assert drop_contaminated(one, bench).count() == 0 and drop_repeated_chunks(none).collect() == []


@pytest.mark.parametrize("short_items", [True, False])
def test_items_of_fewer_than_five_words(spark, short_items):
    items = [(1, "Paris"), (2, "blue whale"), (3, "it is 42 km"), (4, "one two three four five"), (5, "?!"), (6, "日本の首都"), (7, "no no")]
    docs = [(1, "He lives in Paris, France."), (2, "the Blue-Whale is large"), (3, "whale blue"), (4, "it is 42 km"), (5, "it is 41 km"),
            (6, "x one two three four five"), (7, "「日本の首都」は"), (8, "no"), (9, "No! no."), (10, ""), (11, None), (12, "parisian " * 500 + "paris")]
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    expected = set()
    for i, item in items:
        n = min(len(w := words(item)), 5)
        if n == 5 or (n and short_items):
            expected |= {(d, i) for d, t in docs if any(words(t)[k:k + n] == w for k in range(len(words(t))))}
    table = spark.createDataFrame([(*d, "r", "k", "d") for d in docs], DOCS)
    bench = spark.createDataFrame(items, ITEMS)
    found = contained_items(table, bench, short_items=short_items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    assert all((r.n_shingles, r.n_shared, r.containment) == (1, 1, 1.0) for r in found)
    assert len(expected) == (7 if short_items else 1)
    clean = drop_contaminated(table, bench, short_items=short_items)
    assert {r.doc_id for r in clean.collect()} == {d[0] for d in docs} - {d for d, _ in expected}


# --- preference pairs --------------------------------------------------------------------------


def test_pairs_equal_brute_force(spark):
    draw = random.Random(8)
    schema = "pair_id long, turn long, role string, text string, prompt string"
    talk = lambda: [(t, draw.choice(["user", "assistant", None]), draw.choice(["hi", "", None, "x" * 50_000]), "p") for t in range(draw.randrange(1, 6))]
    sides = []
    for i in range(60):
        a = talk()
        b = a[:draw.randrange(len(a) + 1)] + [(t + 9, *x) for t, *x in talk()] if draw.random() < 0.7 else list(a)
        sides.append(([(i, *t) for t in a], [(i, *t) for t in b]))
    sides += [([(100, 1, "user", "x", "p")] * 2, [(100, 1, "user", "x", "p")]), ([(101, 1, "user", "x", "p")], []), ([(None, 1, "user", "x", "p")], [(None, 1, "user", "x", "p")])]
    flat = [[t for s in sides for t in s[k]] for k in (0, 1)]
    found = {r.pair_id: r for r in preference_rows(*(spark.createDataFrame(x, schema) for x in flat)).collect()}
    block = lambda t: f"<|{t[2] or ''}|>\n{t[3] or ''}\n<|end|>\n"
    assert set(found) == {*range(60), 100}
    for a, b in sides:
        if not a or a[0][0] not in found:
            continue
        key = lambda t: (t[1], t[2] or "", t[2] is not None, t[3] or "", t[3] is not None)
        a, b, r = sorted(a, key=key), sorted(b, key=key), found[a[0][0]]
        n = 0
        while n < min(len(a), len(b)) and a[n][2:4] == b[n][2:4]:
            n += 1
        assert r.prompt_turns == n and r.prompt == "".join(map(block, a[:n]))
        for turns, text, spans in ((a[n:], r.chosen, r.chosen_spans), (b[n:], r.rejected, r.rejected_spans)):
            assert text == "".join(map(block, turns))
            trained = [text[s.start:s.start + s.length] for s in spans]
            assert trained == [f"{t[3] or ''}\n<|end|>\n" for t in turns if t[2] == "assistant"]


def plain_order(rows: list[tuple]) -> dict:
    """pair_id to its two talks, by the rule of ``pairs_by_order``."""
    talks = {}
    for conv, *turn in rows:
        if conv is not None:
            talks.setdefault(conv, []).append(tuple(turn[:3]))
    for talk in talks.values():
        talk.sort(key=lambda t: [(x is not None, x) if x is not None else (False,) for x in t])
    cuts = {c: [i for i, x in enumerate(t) if x[1] == "assistant"] for c, t in talks.items()}
    cuts = {c: at[len(at) // 2] for c, at in cuts.items() if at}
    order = sorted(cuts)
    return {
        c: (talks[c], talks[c][:cuts[c]] + talks[o][cuts[o]:])
        for c, o in zip(order, order[1:] + order[:1], strict=True)
    }


CONVERSATIONS = "conv_id long, turn long, role string, text string, pair_id string, a string, range string"


def test_pairs_by_order_equal_brute_force(spark):
    draw = random.Random(12)
    rows = [
        (conv, t, draw.choice(["user", "assistant", "assistant", "system", None]), draw.choice(["hi", "", None, "yes", "x" * 20_000]))
        for conv in [-5, 0, 1, 2, 4, *range(100, 160), 2**40, None] for t in range(draw.randrange(1, 9))
    ]
    rows += [(7, 0, "user", "alone"), (8, None, "assistant", "b"), (8, None, "assistant", "a"), (8, 3, "user", None)]
    rows += draw.sample(rows, 40)
    table = spark.createDataFrame([(*r, "p", "a", "r") for r in rows], CONVERSATIONS)
    found, expected = pairs_by_order(table).collect(), plain_order(rows)
    block = lambda t: f"<|{t[1] or ''}|>\n{t[2] or ''}\n<|end|>\n"
    assert len(found) == len(expected) and {r.pair_id for r in found} == set(expected) and 7 not in expected
    lengths = set()
    for r in found:
        a, b = expected[r.pair_id]
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1
        assert (r.prompt_turns, r.prompt) == (n, "".join(map(block, a[:n])))
        for turns, text, spans in ((a[n:], r.chosen, r.chosen_spans), (b[n:], r.rejected, r.rejected_spans)):
            lengths.add(len(spans))
            assert text == "".join(map(block, turns))
            assert [text[s.start:s.start + s.length] for s in spans] == [f"{t[2] or ''}\n<|end|>\n" for t in turns if t[1] == "assistant"]
    assert {0, 1, 2, 3} <= lengths


def test_a_lone_conversation_and_none(spark):
    one = spark.createDataFrame([(3, 0, "user", "q", "", "", ""), (3, 1, "assistant", "r", "", "", "")], CONVERSATIONS)
    row = pairs_by_order(one).first()
    assert (row.pair_id, row.prompt_turns, row.chosen, row.rejected, row.chosen_spans) == (3, 2, "", "", [])
    assert pairs_by_order(one.where("turn = 0")).count() == 0 and pairs_by_order(one.limit(0)).count() == 0


def test_every_answered_conversation_has_a_pair(spark, sf_dir):
    from sluice.llm.queries import QUERIES

    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = QUERIES["op2_preference"](spark, sf_dir).collect()
    assert len(found) == table.where("role = 'assistant'").select("conv_id").distinct().count()
    assert any(" " in r.chosen_spans for r in found) and any(" " in r.rejected_spans for r in found)

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import definitions as defs
from sluice.operators import registry as reg
from sluice.operators.latest import last_per_key
from sluice.sources.registry import REGISTRY_SCHEMA, SUBJECT_SCHEMA, latest_schemas, read_registry

GOOD = json.dumps({"type": "record", "name": "R", "fields": [{"name": "x", "type": "int"}]})
WIDER = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "x", "type": "int"}, {"name": "y", "type": "string"}]})


def entry(ordinal, key="e", topics="[t]", bucket="p0Event", parts="[dpYear]", active=True,
          txn=None, schema=None):
    return (ordinal, key, topics, bucket, parts, active, txn, schema)


def registry(spark, *entries):
    return spark.createDataFrame(entries, REGISTRY_SCHEMA)


def ordinals(df):
    return sorted(r.ordinal for r in df.collect())


def test_streamable_needs_all_four_and_active(spark):
    entries = [entry(0)]
    for n, missing in enumerate((None, "")):
        entries += [
            entry(10 * n + 1, key=missing), entry(10 * n + 2, topics=missing),
            entry(10 * n + 3, bucket=missing), entry(10 * n + 4, parts=missing),
        ]
    entries += [entry(90, active=False), entry(91, parts="[]"), entry(92, bucket="else")]
    given = registry(spark, *entries)
    assert ordinals(reg.streamable(given)) == [0, 91, 92]
    assert ordinals(reg.streamable(given, require_partitions=False)) == [0, 4, 14, 91, 92]


def test_tableable_allows_missing_partitions_and_empty_text(spark):
    given = registry(
        spark, entry(0, txn=True, schema=GOOD), entry(1, txn=False, schema=GOOD, parts=None),
        entry(2, schema=GOOD), entry(3, txn=True), entry(4, key=None, txn=True, schema=GOOD),
        entry(5, txn=True, schema=GOOD, active=False), entry(6, key="", txn=True, schema=""),
    )
    assert ordinals(reg.tableable(given)) == [0, 1, 6]


def test_buckets_match_exactly(spark):
    names = ["p0Event", "nonP0Event", "P0Event", "p0event", " p0Event", "other", None]
    given = registry(spark, *[entry(i, bucket=b) for i, b in enumerate(names)])
    assert ordinals(reg.bucketed(given)) == [0, 1]


def test_flags_ignore_activity_and_null_is_on_neither_side(spark):
    given = registry(
        spark, entry(0, "a", txn=True, active=False), entry(1, "a", txn=False), entry(2, "b"),
        entry(3, "c", txn=False), entry(4, "c", txn=False), entry(5, None, txn=True),
    )
    assert {r.event_key for r in reg.transactional_keys(given).collect()} == {"a", None}
    assert sorted(r.event_key for r in reg.non_transactional_keys(given).collect()) == ["a", "c"]


def test_distinct_compares_the_raw_texts(spark):
    given = registry(
        spark, entry(0), entry(1), entry(2, parts="dpYear"), entry(3, topics="t"), entry(4, bucket="x"))
    assert reg.distinct_events(given).count() == 4


def test_last_wins(spark):
    given = registry(spark, entry(5, "a", topics="new"), entry(3, "a"), entry(4, None), entry(1, None))
    assert ordinals(last_per_key(given)) == [4, 5]


def test_priority_order(spark):
    given = registry(
        spark, entry(0, "z", bucket="p0Event"), entry(1, "a", bucket="nonP0Event"),
        entry(2, "b", bucket="p0Event"), entry(3, "0", bucket="nonP0Event"))
    ordered = [r.event_key for r in reg.priority_order(given).collect()]
    assert ordered == ["b", "z", "0", "a"]


def test_bucket_members_are_rows(spark):
    given = registry(spark, entry(0, "a"), entry(1, "a"), entry(2, "b", bucket="other"))
    assert [tuple(r) for r in reg.bucket_members(given).collect()] == [("p0Event", "a")]


def test_partition_lists(spark):
    texts = ["[dpYear, dpMonth]", " a ,,b ", "[]", "", None]
    parsed = reg.with_partitions(registry(spark, *[entry(i, parts=t) for i, t in enumerate(texts)]))
    rows = parsed.orderBy("ordinal").collect()
    assert [r.stream_partitions for r in rows] == [["dpYear", "dpMonth"], ["a", "b"], [], [], []]
    assert [r.table_partitions for r in rows] == [["dpYear", "dpMonth"], ["a", "b"], None, None, None]


def subjects(spark, *rows):
    return spark.createDataFrame(rows, SUBJECT_SCHEMA)


def test_latest_schema(spark):
    given = subjects(spark, ("a-value", 2, "two"), ("a-value", 10, "ten"), ("b-value", 1, "one"))
    rows = {r.subject: (r.version, r.schema) for r in latest_schemas(given).collect()}
    assert rows == {"a-value": (10, "ten"), "b-value": (1, "one")}


@pytest.mark.parametrize(("topics", "schema"), [
    ("[a]", "A"), ("[a, a2]", "A"), ("[a,b]", None), ("[a,none]", None), ("none", None), (" b ", "B"),
])
def test_topics_of_an_event_share_a_schema(spark, topics, schema):
    events = reg.events_to_stream(registry(spark, entry(0, topics=topics)))
    known = subjects(spark, ("a-value", 1, "old"), ("a-value", 2, "A"), ("a2-value", 7, "A"), ("b-value", 1, "B"))
    assert [r.schema for r in reg.with_stream_schema(events, known).collect()] == [schema]


def test_a_bad_schema_skips_only_its_entry(spark):
    given = registry(
        spark,
        entry(1, "a", txn=True, schema=GOOD), entry(2, "a", txn=True, schema="{"),
        entry(1, "b", txn=False, schema="{"),
        entry(1, "c", txn=False, schema=GOOD), entry(2, "c", txn=True, schema=WIDER, parts="[y]"),
        entry(3, "c", txn=True, schema=None),
    )
    definitions = {r.event_key: r for r in defs.table_definitions(given).collect()}
    assert set(definitions) == {"a", "c"}
    assert definitions["a"].ordinal == 1
    assert [c.column_name for c in definitions["c"].columns] == ["x", "y"]
    assert definitions["c"].table_partitions == ["y"] and definitions["c"].is_transactional
    rejected = defs.rejects(given).select("event_key", "ordinal").collect()
    assert sorted(map(tuple, rejected)) == [("a", 2), ("b", 1)]
    counts = {r.is_transactional: r.definitions for r in defs.definition_counts(defs.table_definitions(given)).collect()}
    assert counts == {True: 2}
    assert defs.transactional_side(defs.table_definitions(given), False).count() == 0


def test_read_registry_uses_the_declared_schema(spark, root):
    registry(spark, entry(0, txn=True)).write.parquet(f"{root}/r")
    assert [f.name for f in read_registry(spark, f"{root}/r").schema] == REGISTRY_SCHEMA.fieldNames()


def test_a_hot_key_is_one_row_per_task_after_the_shuffle(spark):
    """Most rows share a key; what reaches its reducer is one row per task."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("ordinal"), F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("event_key"))
    assert {tuple(r) for r in last_per_key(rows).collect()} == {(199_998, "hot"), (199_999, "cold")}
    plan = last_per_key(rows)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before

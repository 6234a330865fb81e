from __future__ import annotations

import json

import pytest

from sluice.__main__ import run
from sluice.streaming import fanout, files, ledger, multiplex
from sluice.streaming.multiplex import groups, parked_records, replay_parked, start_groups
from tests.test_records import HEADER
from tests.test_registry import entry, registry, subjects
from tests.test_streaming import SCHEMA, log
from workload.inputs import parquet_config

TOPICS = ("a", "b", "c", "d")


def settings(root, **more):
    return parquet_config(f"{root}/x", source_options={"path": f"{root}/log"}, **more)


def known(spark, *topics):
    return subjects(spark, *[(f"{t}-value", 1, SCHEMA) for t in topics])


def go(spark, events, schemas, config, per_query=2):
    started = start_groups(spark, events, schemas, config, per_query)
    fanout.await_all(spark, started)
    return started


def numbers(spark, config, key):
    return sorted(r.n for r in ledger.read_event(spark, config, key).collect())


def test_events_share_queries_and_new_ones_form_new_groups(spark, root):
    config = settings(root)
    log(spark, root, *[(t, n, "2024") for n, t in enumerate(TOPICS)])
    entries = [entry(n, t, f"[{t}]") for n, t in enumerate(TOPICS[:3])]
    started = go(spark, registry(spark, *entries), known(spark, *TOPICS), config)
    assert [s.events for s in started] == [("a", "b"), ("c",)]
    assert [s.error for s in started] == [None, None]
    log(spark, root, *[(t, n + 10, "2025") for n, t in enumerate(TOPICS)])
    # d is new and b has left; group 0 keeps a, d reads all from its start.
    entries = [entry(n, t, f"[{t}]") for n, t in enumerate(TOPICS) if t != "b"]
    started = go(spark, registry(spark, *entries), known(spark, *TOPICS), config)
    assert [s.events for s in started] == [("a",), ("c",), ("d",)]
    assert [list(g["members"]) for g in groups(spark, config).values()] == [["a", "b"], ["c"], ["d"]]
    assert {t: numbers(spark, config, t) for t in TOPICS} == {"a": [0, 10], "b": [1], "c": [2, 12], "d": [3, 13]}


def test_one_topic_may_feed_several_events_and_one_event_several_topics(spark, root):
    config = settings(root)
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"))
    events = registry(spark, entry(0, "both", "[a, b]"), entry(1, "one", "[a]"))
    go(spark, events, known(spark, "a", "b"), config)
    assert numbers(spark, config, "both") == [1, 2] and numbers(spark, config, "one") == [1]


def test_a_replayed_batch_adds_nothing(spark, root):
    config = settings(root)
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"), ("a", 3, None))
    events, schemas = registry(spark, entry(0, "a", "[a]"), entry(1, "b", "[b]")), known(spark, "a", "b")
    go(spark, events, schemas, config)
    files.remove(spark, f"{config.checkpoint_path}/_group-00000/commits/0")
    go(spark, events, schemas, config)
    assert numbers(spark, config, "a") == [1, 3] and numbers(spark, config, "b") == [2]


def test_records_that_cannot_be_written_are_parked_and_replayed(spark, root):
    config = settings(root, mode="FAILFAST")
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"))
    bad = spark.createDataFrame([("b", bytearray(HEADER + b"{no json"))], "topic string, value binary")
    bad.write.mode("append").partitionBy("topic").parquet(f"{root}/log")
    events, schemas = registry(spark, entry(0, "a", "[a]"), entry(1, "b", "[b]")), known(spark, "a", "b")
    started = go(spark, events, schemas, config)
    assert [s.error for s in started] == [None] and numbers(spark, config, "a") == [1]
    parked = parked_records(spark, config, "b").collect()
    assert len(parked) == 2 and {r.ingest_batch for r in parked} == {"group-00000-0"}
    assert {bytes(r.value) for r in parked} >= {HEADER + b"{no json"}
    event = fanout.resolved_stream_plan(events, schemas).where("event_key = 'b'").first()
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        replay_parked(spark, event, config)
    assert parked_records(spark, config, "b").count() == 2
    assert replay_parked(spark, event, settings(root)) == ["group-00000-0"]
    assert parked_records(spark, config, "b").isEmpty()
    found = ledger.read_event(spark, config, "b").collect()
    assert sorted((r.n for r in found), key=str) == [2, None]
    assert replay_parked(spark, event, settings(root)) == []


def test_an_event_that_lost_its_schema_is_parked_and_others_go_on(spark, root):
    config = settings(root)
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"))
    events = registry(spark, entry(0, "a", "[a]"), entry(1, "b", "[b]"), entry(2, "c", "[c]"))
    started = go(spark, events, known(spark, "a", "b"), config)
    assert [(s.event_key, s.error is None) for s in started] == [("c", False), ("group-00000", True)]
    log(spark, root, ("a", 3, "2024"), ("b", 4, "2024"))
    started = go(spark, events, known(spark, "a"), config)
    assert [(s.event_key, s.error is None) for s in started] == [
        ("b", False), ("c", False), ("group-00000", True)]
    assert numbers(spark, config, "a") == [1, 3] and numbers(spark, config, "b") == [2]
    assert parked_records(spark, config, "b").count() == 1
    event = fanout.resolved_stream_plan(events, known(spark, "a", "b")).where("event_key = 'b'").first()
    replay_parked(spark, event, config)
    assert numbers(spark, config, "b") == [2, 4]


def test_an_event_with_its_own_checkpoint_goes_on_alone(spark, root):
    config = settings(root)
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"))
    first = registry(spark, entry(0, "a", "[a]"))
    fanout.await_all(spark, fanout.start_all(spark, first, known(spark, "a", "b"), config))
    log(spark, root, ("a", 3, "2024"))
    started = go(spark, registry(spark, entry(0, "a", "[a]"), entry(1, "b", "[b]")), known(spark, "a", "b"), config)
    assert [(s.event_key, s.events) for s in started] == [("a", ()), ("group-00000", ("b",))]
    assert numbers(spark, config, "a") == [1, 3] and numbers(spark, config, "b") == [2]


def test_a_changed_layout_opens_a_generation(spark, root):
    config = settings(root)
    log(spark, root, ("a", 1, "2024"))
    go(spark, registry(spark, entry(0, "a", "[a]")), known(spark, "a"), config)
    log(spark, root, ("a", 2, "2024"))
    go(spark, registry(spark, entry(1, "a", "[a]", parts="[n]")), known(spark, "a"), config)
    assert numbers(spark, config, "a") == [1, 2]
    assert [(k.generation, k.partitions, k.batched) for k in ledger.layouts(spark, config, "a")] == [
        (0, ["dpYear"], True), (1, ["n"], True)]


def test_a_delta_table_skips_a_batch_by_its_number(root):
    config = settings(root)
    assert multiplex.delta_attempt(config, "group-00001", "7", "e") == {
        "txnAppId": f"{config.checkpoint_path}/group-00001/e", "txnVersion": "7"}


def test_tables_over_a_group_from_settings(spark, root):
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2025"), ("a", 3, "2025"))
    registry(spark, entry(0, "a", "[a]", txn=False, schema=SCHEMA), entry(1, "b", "[b]", txn=False, schema=SCHEMA)) \
        .write.parquet(f"{root}/registry")
    known(spark, "a", "b").write.parquet(f"{root}/schemas")
    given = {"registry": f"{root}/registry", "schemas": f"{root}/schemas", "per_query": 10, "restarts": 1, "config": {
        "output_path": f"{root}/out", "checkpoint_path": f"{root}/checkpoints", "source_format": "parquet",
        "source_options": {"path": f"{root}/log"}, "sink_format": "parquet", "codec": "json", "available_now": True}}
    started = run("streams", json.loads(json.dumps(given)), spark)
    assert [(s.events, s.error, s.restarts) for s in started] == [(("a", "b"), None, 0)]
    spark.sql(f"CREATE SCHEMA NonTxn LOCATION '{root}/side'")
    try:
        assert {r.status for r in run("tables", given, spark).collect()} == {"success"}
        assert sorted((r.n, r.dpYear) for r in spark.table("NonTxn.a").collect()) == [(1, 2024), (3, 2025)]
    finally:
        spark.sql("DROP SCHEMA NonTxn CASCADE")

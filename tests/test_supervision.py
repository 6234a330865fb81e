from __future__ import annotations

import time

from sluice.operators import reconcile
from sluice.streaming import fanout, ledger, supervision
from sluice.streaming.fanout import Started
from sluice.streaming.supervision import supervise, wait_before
from tests.test_registry import entry, registry, subjects
from tests.test_streaming import SCHEMA, log
from workload.inputs import parquet_config


def failing(spark, root, key, times, **config):
    """An event whose batches raise for the first so many runs, and the numbers it has written."""
    settings = parquet_config(f"{root}/{key}", source_options={"path": f"{root}/log"}, **config)
    rows, written, runs = fanout.event_rows(spark, settings, key, SCHEMA), [], []

    def batch(frame, number):
        if len(runs) <= times:
            raise RuntimeError("injected")
        written.extend(r.n for r in frame.collect())

    def start():
        runs.append(time.monotonic())
        writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", settings.event_checkpoint(key))
        return writer.trigger(availableNow=True).start() if settings.available_now else writer.start()

    return Started(key, "p0Event", start=start).begin(), written, runs


def test_waits_double_up_to_a_limit():
    assert [wait_before(n, 1, 10) for n in (1, 2, 3, 4, 5, 5000)] == [1, 2, 4, 8, 10, 10]


def test_a_failed_query_restarts_and_the_others_never_stop(spark, root):
    log(spark, root, ("a", 1, "2024"), ("b", 2, "2024"), ("a", 3, "2024"))
    flaky, rows, runs = failing(spark, root, "a", 2)
    steady, others, once = failing(spark, root, "b", 0)
    supervise(spark, [flaky, steady], limit=3, first_wait=0.2)
    assert sorted(rows) == [1, 3] and flaky.error is None and flaky.restarts == 2
    assert runs[1] - runs[0] >= 0.2 and runs[2] - runs[1] >= 0.4
    assert others == [2] and steady.restarts == 0 and len(once) == 1


def test_the_limit_ends_it_and_the_error_stays(spark, root):
    log(spark, root, ("a", 1, "2024"))
    down, rows, runs = failing(spark, root, "a", 100)
    never = Started("n", "p0Event", error="LookupError: no schema")
    supervise(spark, [down, never], limit=2, first_wait=0.05)
    assert rows == [] and len(runs) == 3 and down.restarts == 2
    assert "StreamingQueryException" in down.error and never.error == "LookupError: no schema"


def test_a_start_that_fails_counts_too(spark, root):
    log(spark, root, ("a", 1, "2024"))
    outcome, _, _ = failing(spark, root, "a", 1)
    begin, tries = outcome.start, []

    def start():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("no source yet")
        return begin()

    outcome.start = start
    supervise(spark, [outcome], limit=5, first_wait=0.05)
    assert outcome.error is None and len(tries) == 3 and outcome.restarts == 3


def test_a_stopped_query_stays_down(spark, root):
    log(spark, root, ("a", 1, "2024"))
    outcome, rows, runs = failing(spark, root, "a", 0, available_now=False)
    outcome.query.processAllAvailable()
    outcome.query.stop()
    supervise(spark, [outcome], first_wait=0.05)
    assert len(runs) == 1 and outcome.error is None and rows == [1]


def test_a_lost_notice_is_made_up_for(spark, root, monkeypatch):
    monkeypatch.setattr(supervision, "LOOK", 0.2)
    monkeypatch.setattr(supervision.Endings, "onQueryTerminated", lambda self, event: None)
    log(spark, root, ("a", 1, "2024"))
    outcome, rows, _ = failing(spark, root, "a", 1)
    supervise(spark, [outcome], first_wait=0.05)
    assert rows == [1] and outcome.restarts == 1


# --- reconciliation ---------------------------------------------------------------------


def test_actions(spark):
    kind = "event_key string, digest string"
    running = spark.createDataFrame([("same", "x"), ("old", "x"), ("changed", "x"), ("mute", "x"), ("unknown", None)], kind)
    wanted = spark.createDataFrame(
        [("same", "x", "s"), ("changed", "y", "s"), ("mute", "y", None), ("new", "z", "s"), ("silent", "z", None),
         ("unknown", "x", "s")], f"{kind}, schema string")
    assert {r.event_key: r.action for r in reconcile.actions(running, wanted).collect()} == {
        "old": "stop", "changed": "restart", "new": "start", "silent": "start", "unknown": "restart"}
    assert reconcile.actions(running.limit(0), wanted.limit(0)).collect() == []


def test_null_and_absent_facts_differ(spark):
    kind = "event_key string, topics string, bucket_id string, is_transactional boolean, stream_partitions array<string>, schema string"
    plan = spark.createDataFrame(
        [("a", "t", "p0Event", None, [], "s"), ("b", "t", "p0Event", False, [], "s"), ("c", "t", "p0Event", None, [""], "s"),
         ("d", "t", "p0Event", None, [], "s")], kind)
    digest = {r.event_key: r.digest for r in reconcile.with_digest(plan).collect()}
    assert digest["a"] == digest["d"] and len(set(digest.values())) == 3


def test_reconcile_starts_stops_and_restarts(spark, root):
    log(spark, root, *[(t, n, "2024") for n, t in enumerate("abcd")])
    config = parquet_config(
        root, source_options={"path": f"{root}/log"}, available_now=False, processing_time="1 second")
    schemas = subjects(spark, *[(f"{t}-value", 1, SCHEMA) for t in "abcd"])
    events = lambda *e: registry(spark, *e)
    started = fanout.start_all(
        spark, events(entry(0, "a", "[a]"), entry(1, "b", "[b]"), entry(2, "c", "[c]")), schemas, config)
    kept = started[0].query.runId
    try:
        for outcome in started:
            outcome.query.processAllAvailable()
        newer = events(entry(0, "a", "[a]"), entry(3, "b", "[b]", parts="[n]"), entry(4, "d", "[d]"))
        started, done = fanout.reconcile(spark, started, newer, schemas, config)
        assert done == {"b": "restart", "c": "stop", "d": "start"}
        log(spark, root, *[(t, n + 10, "2024") for n, t in enumerate("abcd")])
        for outcome in started:
            outcome.query.processAllAvailable()
        assert {o.event_key: o.error for o in started} == {"a": None, "b": None, "d": None}
        assert next(o for o in started if o.event_key == "a").query.runId == kept
        again, done = fanout.reconcile(spark, started, newer, schemas, config)
        assert done == {} and len(again) == 3
        read = lambda key: sorted(r.n for r in ledger.read_event(spark, config, key).collect())
        assert {key: read(key) for key in "abcd"} == {"a": [0, 10], "b": [1, 11], "c": [2], "d": [3, 13]}
    finally:
        for query in spark.streams.active:
            query.stop()

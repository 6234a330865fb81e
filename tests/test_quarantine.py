from __future__ import annotations

import pytest

from sluice.streaming import fanout, files, ledger, sink
from sluice.streaming.multiplex import start_groups
from sluice.streaming.quarantine import METRIC, quarantined_records
from tests.test_registry import entry, registry, subjects
from tests.test_streaming import SCHEMA, log
from workload.inputs import parquet_config

BAD = [None, bytearray(b"\x00\x00"), bytearray(b"\x00\x00\x00\x00\x01"), bytearray(b"\x00\x00\x00\x00\x01{no")]


def deliver(spark, root, n):
    log(spark, root, ("a", n, "2024"), ("a", n + 1, None))
    spark.createDataFrame([("a", b) for b in BAD], "topic string, value binary").write.mode("append").partitionBy(
        "topic").parquet(f"{root}/log")


def held(spark, config):
    rows = sorted(r.n for r in ledger.read_event(spark, config, "a").collect())
    lost = [r.value and bytes(r.value) for r in quarantined_records(spark, config, "a").collect()]
    return rows, sorted(lost, key=str)


@pytest.mark.parametrize("grouped", [False, True])
def test_rows_and_quarantined_records_are_the_records(spark, root, grouped):
    config = parquet_config(f"{root}/x", source_options={"path": f"{root}/log"}, quarantine=True)
    start = start_groups if grouped else fanout.start_all
    events, schemas = registry(spark, entry(0, "a", "[a]")), subjects(spark, ("a-value", 1, SCHEMA))
    bad = [b and bytes(b) for b in BAD]
    for run in (1, 2):
        deliver(spark, root, 10 * run)
        started = start(spark, events, schemas, config)
        fanout.await_all(spark, started)
        assert [s.error for s in started] == [None]
        if not grouped:
            counts = [p.observedMetrics[METRIC].asDict() for p in started[0].query.recentProgress if METRIC in p.observedMetrics]
            assert sum(c["records"] for c in counts) == 6 and sum(c["quarantined"] for c in counts) == 4
    expected = [10, 11, 20, 21], sorted(bad * 2, key=str)
    assert held(spark, config) == expected
    # The last batch once more adds nothing.
    commits = f"{config.checkpoint_path}/{'_group-00000' if grouped else 'a'}/commits"
    numbers = [int(n) for n, _ in files.names(spark, commits) if n.isdigit()]
    files.remove(spark, f"{commits}/{max(numbers)}")
    fanout.await_all(spark, start(spark, events, schemas, config))
    assert held(spark, config) == expected


def test_nothing_is_quarantined_without_bad_records(spark, root):
    config = parquet_config(f"{root}/x", source_options=log(spark, root, ("a", 1, "2024")), quarantine=True, optimize_write=True)
    fanout.await_all(spark, fanout.start_all(
        spark, registry(spark, entry(0, "a", "[a]")), subjects(spark, ("a-value", 1, SCHEMA)), config))
    assert held(spark, config) == ([1], [])


def test_sinks_that_cannot_set_records_aside_are_refused(spark, root):
    for settings in ({"mode": "FAILFAST"}, {"sink_format": "delta"}):
        with pytest.raises(ValueError, match="quarantine"):
            sink.require_switches(spark, parquet_config(root, quarantine=True, **settings))

from __future__ import annotations

import pytest

from sluice.operators.resolution import resolved_entries, stream_side, table_side
from sluice.streaming import fanout
from tests.test_registry import GOOD, WIDER, entry, registry

BAD = '{"type": "record", "name": '


def sides(spark, *entries):
    found = resolved_entries(registry(spark, *entries))
    streams = {r.event_key: r for r in stream_side(found).collect()}
    return streams, {r.event_key: r for r in table_side(found).collect()}


@pytest.mark.parametrize("second, expected", [
    (entry(2, parts="[x,y]", txn=True, schema=BAD), ["x"]),  # a bad schema suits the stream only
    (entry(2, parts="[y]", bucket="other", txn=True, schema=GOOD), ["x"]),  # an unknown bucket the table only
    (entry(2, parts="", txn=True, schema=GOOD), ["x"]),  # without partition columns the table only
    (entry(2, parts="[x,y]", txn=False, schema=GOOD), ["x", "y"]),  # suits both, so the newer one
])
def test_both_sides_follow_one_entry(spark, second, expected):
    streams, tables = sides(spark, entry(1, parts="[x]", txn=True, schema=GOOD), second)
    assert streams["e"].stream_partitions == tables["e"].table_partitions == expected
    assert streams["e"].is_transactional == tables["e"].is_transactional
    assert streams["e"].ordinal == tables["e"].ordinal


def test_no_entry_suits_both(spark):
    """The table's entry gives the layout; the stream takes topics and bucket of the newest that streams."""
    streams, tables = sides(
        spark, entry(1, topics="[a]", parts="[x]"), entry(2, topics="[b]", parts="[y]"),
        entry(3, topics="[c]", bucket="other", parts="[z]", txn=False, schema=WIDER),
        entry(4, topics="[d]", bucket="other", parts="[w]", txn=True, schema=BAD),
    )
    assert (streams["e"].ordinal, streams["e"].topics, streams["e"].stream_partitions) == (2, "b", ["z"])
    assert (tables["e"].ordinal, tables["e"].table_partitions) == (3, ["z"])
    assert streams["e"].is_transactional is tables["e"].is_transactional is False


def test_events_of_one_side(spark):
    streams, tables = sides(
        spark, entry(1, key="s", parts="[x]", txn=True), entry(2, key="t", bucket=None, parts=None, txn=True, schema=GOOD),
        entry(3, key="n", bucket=None), entry(4, key="o", active=False, txn=True, schema=GOOD),
    )
    assert set(streams) == {"s"} and set(tables) == {"t"}
    assert tables["t"].table_partitions is None


def test_the_program_starts_the_resolved_entry(spark):
    entries = registry(
        spark, entry(1, parts="[x]", txn=True, schema=GOOD), entry(2, topics="[u]", parts="[x,y]", txn=True, schema=BAD))
    schemas = spark.createDataFrame([("t-value", 1, GOOD), ("u-value", 1, WIDER)], "subject string, version int, schema string")
    planned = fanout.resolved_stream_plan(entries, schemas).collect()
    assert [(r.topics, r.stream_partitions, r.schema) for r in planned] == [("t", ["x"], GOOD)]

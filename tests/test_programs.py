from __future__ import annotations

import pytest

from sluice.__main__ import run
from workload import inputs, queries


@pytest.fixture
def settings(spark, sf_dir, root):
    inputs.topic_registry(spark, sf_dir).write.parquet(f"{root}/registry")
    inputs.schema_versions(spark, sf_dir).write.parquet(f"{root}/schemas")
    log = inputs.json_records(inputs.body_fields(inputs.events(spark, sf_dir)))
    log.write.partitionBy("topic").parquet(f"{root}/log")
    return {
        "registry": f"{root}/registry",
        "schemas": f"{root}/schemas",
        "config": {
            "output_path": f"{root}/out", "checkpoint_path": f"{root}/checkpoints",
            "source_format": "parquet", "source_options": {"path": f"{root}/log"},
            "sink_format": "parquet", "codec": "json", "available_now": True,
        },
    }


def test_streams_then_tables_over_their_output(spark, sf_dir, settings):
    started = run("streams", settings, spark)
    assert [s.event_key for s in started if s.error is None] == ["purchase", "click", "signup"]

    before = spark.catalog.currentDatabase()
    for side in ("Txn", "NonTxn"):
        spark.sql(f"CREATE SCHEMA {side} LOCATION '{settings['registry']}_{side}'")
    try:
        outcomes = run("tables", {**settings, "sides": ["NonTxn", "Txn"]}, spark)
        assert {r.event_key: r.status for r in outcomes.collect()} == {
            "purchase": "success", "click": "success", "signup": "success", "error": "failure"}
        signups = spark.table("NonTxn.signup")
        expected = inputs.events(spark, sf_dir).where("event_type = 'signup'").count()
        assert signups.count() == expected
        assert signups.select(*queries.DAY).where("dpDay IS NULL").isEmpty()
        assert spark.table("Txn.purchase").where("event_id IS NULL").isEmpty()
    finally:
        for side in ("Txn", "NonTxn"):
            spark.sql(f"DROP SCHEMA {side} CASCADE")
        assert spark.catalog.currentDatabase() == before


def test_compact_from_settings(spark, sf_dir, settings, root):
    assert all(s.error is None for s in run("streams", settings, spark) if s.event_key != "view")
    run("compact", {"compact": [
        {"source": f"{root}/out/signup", "target": f"{root}/compacted", "partitions": list(queries.DAY)}]}, spark)
    expected = inputs.events(spark, sf_dir).where("event_type = 'signup'").count()
    assert spark.read.parquet(f"{root}/compacted").count() == expected


def test_tables_can_follow_the_schemas_of_their_streams(spark, settings, root):
    spark.sql(f"CREATE SCHEMA NonTxn LOCATION '{root}/side'")
    try:
        outcomes = run("tables", {**settings, "schema_source": "streams"}, spark)
        assert {r.event_key: r.status for r in outcomes.collect()} == {
            "click": "success", "signup": "success", "error": "success"}
        assert "event_id" in spark.table("NonTxn.error").columns
    finally:
        spark.sql("DROP SCHEMA NonTxn CASCADE")


def test_the_default_side_is_the_non_transactional_one(spark, settings, root):
    spark.sql(f"CREATE SCHEMA NonTxn LOCATION '{root}/side'")
    try:
        keys = {r.event_key for r in run("tables", settings, spark).collect()}
        assert keys == {"click", "signup", "error"}
    finally:
        spark.sql("DROP SCHEMA NonTxn CASCADE")

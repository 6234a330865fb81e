"""The plans at scale: what reaches the scan, and how often data is shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.operators import definitions as defs
from sluice.operators import records as rec
from sluice.operators import registry as reg
from sluice.operators.latest import last_per_key
from sluice.sources.registry import read_registry
from sluice.streaming import fanout, sink
from workload import inputs, queries
from workload.queries import QUERIES


def plan_of(df) -> str:
    with sink.session_conf(df.sparkSession, {"spark.sql.maxMetadataStringLength": "10000"}):
        return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition")


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "registry")
    inputs.registry(spark, sf_dir).write.parquet(path)
    return read_registry(spark, path)


def test_registry_filters_reach_the_scan(stored):
    plan = plan_of(reg.bucketed(reg.streamable(stored)).select("event_key"))
    assert "EqualTo(is_active,true)" in plan and "In(bucket_id, [nonP0Event,p0Event])" in plan
    assert "Not(EqualTo(event_key,))" in plan and "complete_schema" not in plan
    plan = plan_of(defs.table_definitions(stored))
    for name in ("event_key", "complete_schema", "is_transactional"):
        assert f"IsNotNull({name})" in plan[plan.index("PushedFilters"):]
    assert "bucket_id" not in plan[plan.index("ReadSchema"):]
    plan = plan_of(reg.non_transactional_keys(stored))
    assert "Not(EqualTo(is_transactional,true))" in plan and "topic_list" not in plan


@pytest.mark.parametrize(("build", "count"), [
    (reg.streamable, 0),
    (reg.tableable, 0),
    (reg.with_partitions, 0),
    (reg.distinct_events, 1),
    (reg.bucket_members, 1),
    (reg.transactional_keys, 1),
    (last_per_key, 1),
    (reg.event_flag, 1),
    (reg.events_to_stream, 2),
    (defs.table_definitions, 2),
    (lambda r: defs.column_list(defs.table_definitions(r)), 2),
    (lambda r: reg.priority_order(reg.distinct_events(r)), 2),
])
def test_shuffles(stored, build, count):
    assert shuffles(plan_of(build(stored))) == count


def test_groups_are_combined_before_the_shuffle(stored):
    for build in (reg.distinct_events, reg.transactional_keys, defs.definition_counts):
        given = defs.table_definitions(stored) if build is defs.definition_counts else stored
        plan = plan_of(build(given))
        assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_schemas_of_events_are_found_by_hashes(stored, spark, sf_dir):
    """Exchanges: newest entries and flags by key, newest schemas, lists of topics, the order."""
    plan = fanout.stream_plan(stored, inputs.schema_versions(spark, sf_dir))
    assert "SortAggregate" not in plan_of(plan)
    plan.write.format("noop").mode("overwrite").save()
    stages = set()
    rows = plan.collect()
    final = plan_of(plan).split("Initial Plan")[0]
    for line in final.splitlines():
        if " Exchange " in line and "ReusedExchange" not in line:
            stages.add(line[line.index(" Exchange "):])
    assert rows and len(stages) <= 5, stages


def test_schemas_are_parsed_once(stored):
    plan = plan_of(defs.column_list(defs.table_definitions(stored)))
    assert plan.count("ArrowEvalPython") == 1


def test_record_plans_are_narrow_and_read_only_what_bodies_hold(spark, sf_dir):
    for name in ("proj_strip_header", "proj_decode", "proj_date_parts"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "Exchange" not in plan and "props" not in plan
    assert plan_of(QUERIES["proj_date_parts"](spark, sf_dir)).count("from_json") == 1


def test_a_topic_filter_reaches_the_scan(spark, sf_dir):
    given = inputs.json_records(inputs.body_fields(inputs.events(spark, sf_dir)))
    rows = rec.to_rows(given.where("topic = 'click'"), inputs.BODY_SCHEMA, "json")
    assert "EqualTo(event_type,click)" in plan_of(rows)


def _stream_plan(spark, sf_dir, root, **settings) -> str:
    config = inputs.parquet_config(root, **settings)
    given = inputs.json_records(inputs.body_fields(inputs.events_stream(spark, sf_dir)))
    rows = rec.to_rows(given, inputs.BODY_SCHEMA, "json", "PERMISSIVE")
    query = sink.start_event(rows, "event", queries.DAY, config)
    query.awaitTermination()
    return query._jsq.explainInternal(False)


def test_the_append_does_not_shuffle(spark, sf_dir, root):
    assert "Exchange" not in _stream_plan(spark, sf_dir, root)


def test_the_optimized_append_rebalances_once(spark, sf_dir, root):
    plan = _stream_plan(spark, sf_dir, root, optimize_write=True)
    final = plan.split("Initial Plan")[0]
    assert final.count("REBALANCE_PARTITIONS_BY_COL") == 1 and "AdaptiveSparkPlan" in final


def test_output_partitions_prune_reads(spark, sf_dir):
    rows = QUERIES["flow_event_append"](spark, sf_dir).where(F.col("dpDay") == 7)
    plan = plan_of(rows)
    start = plan.index("PartitionFilters")
    assert "dpDay" in plan[start : plan.index("PushedFilters")]

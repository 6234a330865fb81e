from __future__ import annotations

import threading

import pytest

from sluice.config import IngestConfig
from sluice.operators.definitions import table_definitions
from sluice.plans import tables
from sluice.plans.tables import create_statements, create_tables, outcome_counts
from sluice.streaming.sink import session_conf
from tests.test_avro_types import ORDER_PLACED
from tests.test_registry import GOOD, entry, registry

CONFIG = IngestConfig("/base", "/ck", txn_path="/base/Txn/", non_txn_path="/base/NonTxn/")
PARTS = "[dpYear, dpHour]"


def definitions(spark, *entries):
    return table_definitions(registry(spark, *entries))


def statement(spark, given, config=CONFIG, **options):
    return create_statements(definitions(spark, given), config, **options).first().statement


def test_golden_statement(spark):
    given = entry(0, "order_placed", parts=PARTS, txn=False, schema=ORDER_PLACED)
    assert statement(spark, given, quoted=False) == (
        "CREATE TABLE IF NOT EXISTS order_placed (orderId string, qty integer, amount double, "
        "raw binary, at timestamp, price decimal(10,2), tags Array<string>, "
        "attrs Map<string,long>, addr Struct<city: string, dpYear: string>, dpYear integer, "
        "dpHour integer) USING DELTA PARTITIONED BY (dpYear, dpHour) "
        "LOCATION '/base/NonTxn/order_placed'"
    )


def test_quoted_and_qualified_statement(spark):
    given = entry(0, "order-`x`", parts="[x]", txn=True, schema=GOOD)
    assert statement(spark, given, catalog="main") == (
        "CREATE TABLE IF NOT EXISTS `main`.`Txn`.`order-``x```  (`x` integer) USING DELTA "
        "PARTITIONED BY (`x`) LOCATION '/base/Txn/order-`x`'"
    ).replace("  ", " ")


@pytest.mark.parametrize("parts", ["[]", "", None, " , "])
def test_no_partitions_no_clause(spark, parts):
    assert "PARTITIONED" not in statement(spark, entry(0, parts=parts, txn=True, schema=GOOD))


def test_base_path_by_flag(spark):
    config = IngestConfig("/out", "/ck", txn_path="/t")
    assert "LOCATION '/t/e'" in statement(spark, entry(0, txn=True, schema=GOOD), config)
    assert "LOCATION '/out/e'" in statement(spark, entry(0, txn=False, schema=GOOD), config)


def test_tables_point_at_the_output_of_their_stream():
    assert CONFIG.event_path("e", True) == "/base/Txn/e"
    assert CONFIG.event_path("e", False) == "/base/NonTxn/e"
    assert CONFIG.event_path("e") == "/base/e"
    assert CONFIG.event_checkpoint("e") == "/ck/e"


@pytest.fixture
def schemas(spark, root, unique):
    names = {flag: f"{name}_{unique}" for flag, name in tables.NAMESPACES.items()}
    for name in names.values():
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{name}'")
    yield names
    for name in names.values():
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def local_config(root):
    return IngestConfig(
        f"{root}/out", f"{root}/ck", sink_format="parquet", txn_path=f"{root}/out/T",
        non_txn_path=f"{root}/out/N")


def test_create_tables(spark, root, schemas):
    given = definitions(
        spark,
        entry(0, "order_placed", parts=PARTS, txn=False, schema=ORDER_PLACED),
        entry(0, "bad-name", parts=None, txn=False, schema=GOOD),
        entry(0, "bad_parts", parts="[zip]", txn=False, schema=GOOD),
        entry(0, "table", parts=None, txn=True, schema=GOOD),
    )
    statements = create_statements(given, local_config(root), "spark_catalog", schemas)
    outcomes = create_tables(spark, statements, tuple(schemas.values()))
    assert {r.event_key: r.status for r in outcomes.collect()} == {
        "order_placed": "success", "bad-name": "failure", "bad_parts": "failure",
        "table": "success"}
    created = spark.table(f"{schemas[False]}.order_placed")
    assert created.columns[-2:] == ["dpYear", "dpHour"] and dict(created.dtypes)["qty"] == "int"
    counts = {(r.is_transactional, r.status): r.tables for r in outcome_counts(outcomes).collect()}
    assert counts == {(False, "success"): 1, (False, "failure"): 2, (True, "success"): 1}
    again = create_tables(spark, statements, tuple(schemas.values()))
    assert {r.status for r in again.where("event_key NOT LIKE 'bad%'").collect()} == {"success"}


def test_only_the_named_sides_are_created(spark, root, schemas):
    given = definitions(
        spark, entry(0, "t", parts=None, txn=True, schema=GOOD), entry(0, "n", parts=None, txn=False, schema=GOOD))
    statements = create_statements(given, local_config(root), "spark_catalog", schemas)
    outcomes = create_tables(spark, statements, sides=(schemas[False],))
    assert [r.event_key for r in outcomes.collect()] == ["n"]
    assert create_tables(spark, statements).count() == 0  # the default side has another name here


def test_statements_reach_the_driver_in_few_jobs(spark, root, unique):
    """However many shuffle partitions there are, empty ones are not fetched one by one."""
    given = registry(spark, *[entry(0, f"e{i}", txn=False, schema=GOOD) for i in range(5)])
    spark.sparkContext.setJobGroup(unique, unique)
    try:
        with session_conf(spark, {"spark.sql.shuffle.partitions": "200"}):
            statements = create_statements(table_definitions(given).persist(), CONFIG)
            assert create_tables(spark, statements, sides=("NonTxn",)).count() == 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(unique)) < 12


def test_an_unexpected_error_is_counted_and_stops_nothing(spark, root, monkeypatch):
    given = definitions(
        spark, entry(0, "a", txn=False, schema=GOOD), entry(0, "b", txn=False, schema=GOOD))
    statements = create_statements(given, CONFIG)

    class Broken:
        createDataFrame = spark.createDataFrame

        def sql(self, text):
            if "`a`" in text:
                raise ConnectionError("gone")

    outcomes = create_tables(Broken(), statements)
    assert {r.event_key: r.status for r in outcomes.collect()} == {"a": "error", "b": "success"}


def test_a_slow_statement_does_not_hold_up_the_others(spark):
    given = definitions(spark, *[entry(0, f"e{i}", txn=False, schema=GOOD) for i in range(6)])
    waiting, rest = threading.Event(), []

    class Slow:
        createDataFrame = spark.createDataFrame

        def sql(self, text):
            if "`e0`" in text:
                assert waiting.wait(60)
                raise ValueError("x" * 5000)
            rest.append(text)
            if len(rest) == 5:
                waiting.set()

    outcomes = {r.event_key: (r.status, r.message) for r in create_tables(Slow(), create_statements(given, CONFIG), threads=2).collect()}
    assert len(outcomes) == 6 and outcomes["e0"][0] == "error" and len(outcomes["e0"][1]) < 300
    assert all(outcomes[f"e{i}"] == ("success", None) for i in range(1, 6))

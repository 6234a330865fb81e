from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.streaming import files
from sluice.streaming.published import published, publish, read_published

SCHEMA = "i int, p string, q int"


def append(spark, root, *rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.mode("append").partitionBy("p", "q").parquet(f"{root}/in")


def run(spark, root, closed="q < 3", **settings):
    return publish(spark, f"{root}/in", f"{root}/out", ["p", "q"], closed, schema=SCHEMA, **settings)


def numbers(spark, root):
    return sorted(r.i for r in read_published(spark, f"{root}/in", f"{root}/out", ["p", "q"], SCHEMA).collect())


def test_each_row_once_before_during_and_after(spark, root):
    append(spark, root, (1, "a", 1), (2, "a/b", 1), (3, None, 2), (4, "a", 3), (5, "+ %", 1))
    assert numbers(spark, root) == [1, 2, 3, 4, 5]
    assert run(spark, root) == 1
    assert {r.key for r in published(spark, f"{root}/out").collect()} == {"=a/=1", "=a/b/=1", "/=2", "=+ %/=1"}
    before = read_published(spark, f"{root}/in", f"{root}/out", ["p", "q"], SCHEMA)
    append(spark, root, (6, "a", 1), (7, "a", 3), (8, "c", 2))  # late for a closed partition, open, new and closed
    assert numbers(spark, root) == list(range(1, 9))
    assert run(spark, root) == 2
    assert sorted(r.i for r in before.collect()) == [1, 2, 3, 4, 5]  # its generation is still there
    assert numbers(spark, root) == list(range(1, 9))
    newest = {r.key: r.generation for r in published(spark, f"{root}/out").collect()}
    assert newest == {"=a/=1": 2, "=c/=2": 2, "=a/b/=1": 1, "/=2": 1, "=+ %/=1": 1}
    assert run(spark, root) is None


def test_published_rows_are_not_read_from_the_source(spark, root):
    append(spark, root, (1, "a", 1), (2, "a", 3))
    run(spark, root)
    found = read_published(spark, f"{root}/in", f"{root}/out", ["p", "q"], SCHEMA)
    read = found.select("i", F.input_file_name().alias("file")).collect()
    assert {(r.i, "/in/" in r.file) for r in read} == {(1, False), (2, True)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") - plan.count("PartitionFilters: []") == 2


def test_what_has_no_manifest_is_not_read(spark, root):
    append(spark, root, (1, "a", 1))
    spark.createDataFrame([(9, "a", 1)], SCHEMA).write.partitionBy("p", "q").parquet(f"{root}/out/rows/generation=1")
    assert numbers(spark, root) == [1]
    assert run(spark, root) == 2  # the number of the failed run is not used again
    assert numbers(spark, root) == [1]


def test_refusals(spark, root):
    append(spark, root, (1, "a", 1))
    with pytest.raises(ValueError, match="columns i"):
        publish(spark, f"{root}/in", f"{root}/out", ["p", "q"], "q < 3", schema="p string, q int")
    with pytest.raises(ValueError, match="partitions"):
        publish(spark, f"{root}/in", f"{root}/out", [], "true")
    assert not files.exists(spark, f"{root}/out")

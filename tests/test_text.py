from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.functions import text


def evaluate(spark, function, *inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, t string")
    return [r.r for r in rows.select("i", function(F.col("t")).alias("r")).orderBy("i").collect()]


def test_unbracket(spark):
    given = {
        "[orders]": "orders", " [orders] ": "orders", "orders": "orders", "[a,b]": "a,b",
        "[[a]]": "[a]", "[a": "a", "a]": "a", "[]": "", "": "", "\t[a]\n": "a", None: None,
        "[ a ]": " a ",
    }
    assert evaluate(spark, text.unbracket, *given) == list(given.values())


def test_list_items(spark):
    given = {
        "[dpYear, dpMonth]": ["dpYear", "dpMonth"], " a ,,b ": ["a", "b"], "[]": [], "": [],
        None: None, "[\ta\t]": ["a"], ",": [], "a": ["a"], "[ ]": [],
    }
    assert evaluate(spark, text.list_items, *given) == list(given.values())


@pytest.mark.parametrize(("name", "quoted"), [("a", "`a`"), ("a`b", "`a``b`"), ("a-b", "`a-b`")])
def test_quote_name(spark, name, quoted):
    assert evaluate(spark, text.quote_name, name) == [quoted]


@pytest.mark.parametrize("value", ["/a/b", "it's", "back\\slash", "\\'"])
def test_quoted_literal_reads_back(spark, value):
    (literal,) = evaluate(spark, text.quote_literal, value)
    assert spark.sql(f"SELECT {literal} AS v").first().v == value

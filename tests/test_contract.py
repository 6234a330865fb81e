from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
from workload.oracles import ORACLES
from workload.queries import QUERIES


OWN = [name for name in contract.queries() if name in QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_oracle(spark, sf_dir, name):
    assert check.compare(spark, sf_dir, name) is None


def test_every_query_has_an_oracle():
    assert set(OWN) == set(ORACLES) == set(QUERIES)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 1000
    assert dict(rows.dtypes)["dpYear"] == "int"

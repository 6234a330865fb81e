from __future__ import annotations

import uuid

import pytest
from pyspark.sql import SparkSession

import check


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return check.session()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path)


@pytest.fixture
def unique() -> str:
    return uuid.uuid4().hex[:12]
